"""Tag flags: named 0/1 columns from one delimited tag string."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def flag_columns(tags: str | Column, patterns: Mapping[str, str]) -> list[Column]:
    """One INT column per flag: 1 if the case-sensitive substring occurs.

    A NULL tag string gives NULL flags (not 0), so a row of an unknown item
    keeps an unknown prediction downstream.
    """
    c = F.col(tags) if isinstance(tags, str) else tags
    return [c.contains(F.lit(p)).cast("int").alias(name) for name, p in patterns.items()]


def add_flags(df: DataFrame, patterns: Mapping[str, str], tags: str = "genres",
              drop: tuple[str, ...] = ("genres", "title")) -> DataFrame:
    """Append all flags in a single projection, then drop the text columns."""
    out = df.select("*", *flag_columns(tags, patterns))
    return out.drop(*[c for c in drop if c in df.columns])


#: Flags packed in one BIGINT.
WORD = 62
_ONE, _GONE = "_one", "_gone"


def flag_words(flags: Sequence[str]) -> list[Column]:
    """0/1 flags as integers ``_one<i>`` (which are 1) and ``_gone<i>`` (which are missing)."""
    def words(test: str, name: str) -> list[Column]:
        sums = [" | ".join(f"(CASE WHEN {test.format(f)} THEN {1 << j}L ELSE 0L END)" for j, f in enumerate(flags[i:i + WORD])) or "0L"
                for i in range(0, max(len(flags), 1), WORD)]
        return [F.expr(x).alias(f"{name}{i}") for i, x in enumerate(sums)]

    return words("`{}` = 1", _ONE) + words("`{}` IS NULL", _GONE)


def word_names(flags: Sequence[str]) -> list[str]:
    return [f"{n}{i}" for n in (_ONE, _GONE) for i in range(max(1, -(-len(flags) // WORD)))]


def flag_of_words(k: int) -> str:
    """The k-th of the packed flags, as SQL: 0, 1 or NULL."""
    bit = lambda name: f"bit_get({name}{k // WORD}, {k % WORD})"                        # noqa: E731
    return f"(CASE WHEN {bit(_GONE)} = 0 THEN CAST({bit(_ONE)} AS INT) END)"


def pack_flags(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """The flags as two integers, for rows that are about to be moved."""
    return df.select(*[c for c in df.columns if c not in set(flags)], *flag_words(flags))


def unpack_flags(df: DataFrame, flags: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The flags as columns again; ``columns`` gives names and order of the result."""
    at = {f: k for k, f in enumerate(flags)}
    return df.select(*[F.expr(flag_of_words(at[c])).alias(c) if c in at else c for c in columns])
