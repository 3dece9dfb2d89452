"""Values as Spark SQL text."""

from __future__ import annotations

import math


def dlit(x: float | None) -> str:
    """A DOUBLE literal in Spark SQL text."""
    if x is None:
        return "CAST(NULL AS DOUBLE)"
    if not math.isfinite(x):
        return f"double('{float(x)}')"
    return f"({float(x)!r}D)"
