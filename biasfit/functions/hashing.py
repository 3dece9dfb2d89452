"""Deterministic per-row order keys.

Sampling orders rows by ``md5(seed | key1 | key2 ...)``.  The hash depends on
row content only, so a recomputed partition (lost executor, re-read file)
yields the same order, unlike ``rand()``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# 13 hex digits = 52 bits: exactly representable in a double, and in the
# same order as the full hex string whenever the prefixes differ.
PREFIX_HEX_DIGITS = 13


def order_hash(seed: str, key_cols: Sequence[str]) -> Column:
    parts = [F.lit(str(seed))] + [F.col(c).cast("string") for c in key_cols]
    return F.md5(F.concat_ws("|", *parts))


def hash_prefix_number(h: Column) -> Column:
    """Leading 52 bits of a hex hash as an exact DOUBLE (order preserving)."""
    return F.conv(F.substring(h, 1, PREFIX_HEX_DIGITS), 16, 10).cast("double")
