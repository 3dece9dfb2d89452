"""Mergeable statistics: effects kept up to date without reading train again.

A state is one line per key: the sum of the values, how many rows had a value
and how many lacked one.  Lines of several states are added; withdrawn ratings
are a state taken with sign -1.  Sums, counts and missing rows are all that the
shrunken effects need, whatever lambda is:

    item effect   (total - n mu) / (n + lambda)
    user effect   total / (n + lambda),       of values r - mu - b_i
    flag effect   total / (n + lambda), 0 if n = 0, per user, flag and level

An effect is NULL while a row of its key lacks a value (no NA removal); a NULL
key is a key like any other; a key whose rows have all been withdrawn is gone.
The values of user and flag states hold the item effects that they were made
with: they merge with states made with the same model.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from biasfit.functions.flags import flag_of_words, flag_words, word_names
from biasfit.operators.effects import ITEM, RATING, USER

TOTAL, ROWS, MISSING = "total", "n_rows", "n_missing"
#: Flags of one aggregate: two sums and four counts each, below the codegen field limit.
FLAGS_AT_ONCE = 12


def state(df: DataFrame, keys: str | Sequence[str], value: str | Column) -> DataFrame:
    """``keys..., total, n_rows, n_missing``: one partial and one final aggregate."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    v = F.when(~F.isnan(v), v)
    return df.groupBy(*keys).agg(F.coalesce(F.sum(v), F.lit(0.0)).alias(TOTAL), F.count(F.lit(1)).alias(ROWS),
                                 (F.count(F.lit(1)) - F.count(v)).alias(MISSING))


def withdrawn(s: DataFrame) -> DataFrame:
    """The state to add when its rows are taken back."""
    return s.withColumns({c: -F.col(c) for c in (TOTAL, ROWS, MISSING)})


def merge(*states: DataFrame) -> DataFrame:
    """The state of all rows together: states are added line by line.  Its cost
    is that of the keys, not of the ratings behind them."""
    both = states[0]
    for s in states[1:]:
        both = both.unionByName(s)
    keys = [c for c in both.columns if c not in (TOTAL, ROWS, MISSING)]
    out = both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in (TOTAL, ROWS, MISSING)])
    return out.where(F.col(ROWS) != 0)


def mean_of(s: DataFrame) -> tuple[float | None, int]:
    """``(mu, n)`` of all rows of a rating state; ``mu`` is None if a rating is missing."""
    r = s.agg(F.sum(TOTAL).alias("t"), F.sum(ROWS).alias("n"), F.sum(MISSING).alias("m")).first()
    return (r["t"] / r["n"] if r["n"] and not r["m"] else None), r["n"] or 0


def _whole(value: Column) -> Column:
    return F.when(F.col(MISSING) == 0, value)


def item_effects(s: DataFrame, mu: float | None, lam: float, item: str = ITEM) -> DataFrame:
    """``item, b_i, n_i`` of a state of ratings per item."""
    mean = F.lit(mu).cast("double")
    return s.select(item, _whole((F.col(TOTAL) - F.col(ROWS) * mean) / (F.col(ROWS) + F.lit(float(lam)))).alias("b_i"),
                    F.col(ROWS).alias("n_i"))


def user_effects(s: DataFrame, lam: float, user: str = USER) -> DataFrame:
    """``user, b_u, m_u`` of a state of ``r - mu - b_i`` per user."""
    return s.select(user, _whole(F.col(TOTAL) / (F.col(ROWS) + F.lit(float(lam)))).alias("b_u"), F.col(ROWS).alias("m_u"))


def item_residual(df: DataFrame, items: DataFrame, mu: float | None, joined, rating: str = RATING) -> DataFrame:
    """Rows with ``_value = r - mu - b_i``; ``joined(df, items)`` adds ``b_i``."""
    return joined(df, items).withColumn("_value", F.col(rating) - F.lit(mu).cast("double") - F.col("b_i"))


def flag_states(df: DataFrame, flags: Sequence[str], value: str = "resid", user: str = USER) -> DataFrame:
    """``user, flag, level, total, n_rows, n_missing``: the residual state of each
    user, flag and level that has rows.  Rows are first added up by user and flag
    pattern, a narrow state.  These aren't repeated by flag: dealt out by user,
    each aggregate has the sums of some flags as columns, and its lines are
    unpivoted; partial sums of that width are never shuffled."""
    flags = list(flags)
    names = word_names(flags)
    lines = state(df.select(user, *flag_words(flags), F.col(value).alias("_v")), [user, *names], "_v").repartition(user)
    lines = lines.select(user, TOTAL, ROWS, MISSING, *[F.expr(flag_of_words(k)).alias(f) for k, f in enumerate(flags)])
    out = None
    for i in range(0, len(flags), FLAGS_AT_ONCE):
        aggs, cells = [], []
        for f in flags[i:i + FLAGS_AT_ONCE]:
            for level in (0, 1):
                at = F.col(f) == level
                k = len(cells)
                aggs += [F.coalesce(F.sum(F.when(at, F.col(c))), F.lit(0).cast(kind)).alias(f"_{x}{k}")
                         for x, c, kind in (("t", TOTAL, "double"), ("n", ROWS, "bigint"), ("m", MISSING, "bigint"))]
                cells.append(F.struct(F.lit(f).alias("flag"), F.lit(level).alias("level"), F.col(f"_t{k}").alias(TOTAL),
                                      F.col(f"_n{k}").alias(ROWS), F.col(f"_m{k}").alias(MISSING)))
        part = lines.groupBy(user).agg(*aggs).select(user, F.inline(F.array(*cells))).where(F.col(ROWS) > 0)
        out = part if out is None else out.unionByName(part)
    return out


def flag_effects(s: DataFrame, lam: float) -> DataFrame:
    """``user, flag, level, effect`` of :func:`flag_states`; cells without rows are absent (their effect is 0)."""
    keys = [c for c in s.columns if c not in (TOTAL, ROWS, MISSING)]
    return s.select(*keys, _whole(F.col(TOTAL) / (F.col(ROWS) + F.lit(float(lam)))).alias("effect"))
