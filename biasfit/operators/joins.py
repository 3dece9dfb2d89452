"""Joins of a large (possibly skewed) fact side to a table with one row per key.

Every join here goes through :func:`keyed_join`:

1. No size is guessed: the right side is an aggregate (or a scan), so AQE
   sees its real materialised size and turns the join into a broadcast join
   only below ``spark.sql.adaptive.autoBroadcastJoinThreshold`` -- the size
   check is Spark's own, at run time.  Explicit ``broadcast()`` hints are used
   only for tables with a bound proven by construction.
2. When the right side carries the fact-side row count of each key
   (``count_col``, which every statistics table here has) and an upper bound
   ``total`` of the fact rows is known, hot keys are *salted*.  A key is hot
   when it holds at least ``threshold = max(rows_per_bucket,
   total / max_hot_keys)`` rows; its fact rows are spread over
   ``ceil(n_key / rows_per_bucket)`` salts and its
   right-side row is replicated once per salt.  Hot counts sum to at most
   ``total``, so at most ``max_hot_keys`` keys are hot: the hot-key list
   broadcast to mark fact rows has a proven size bound.  A key with a third
   of all rows is thus split into thousands of tasks instead of one; data
   too small to have a hot key skips salting entirely.
   The salt is a hash of the whole row, so only identical rows stay together:
   a salt by row number would not survive a recomputed task.
3. Where no counts exist (raw facts), :func:`hot_keys` lists the hot keys from a
   sketch: per-task counters of frequent items with a proven error, merged in
   one narrow job.  A wrong estimate only changes the balance.  The list is
   bounded and fixed before the join, so both sides salt alike.
4. Two sides laid out by one placement of the key (``operators/copartition.py``)
   are joined where they are, by the columns of their place; hot keys are split
   in the layout.
5. A key that is known to have no NULL and never a bucket's rows
   (``JoinPolicy.plain``) is joined as it is, so that one exchange by it serves
   joins and aggregates alike.
6. AQE's skew-join split stays on as a further safety net.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class JoinPolicy:
    rows_per_bucket: int = 2_000_000
    max_hot_keys: int = 100_000
    plain: frozenset[str] = frozenset()     # keys known to have no NULL on the fact side, and never a bucket's rows

    def threshold(self, total: int) -> int:
        return max(self.rows_per_bucket, math.ceil(total / self.max_hot_keys))


DEFAULT_POLICY = JoinPolicy()

_SALT = "_salt"
_HOT = "_hot"


def _prefixed(right: DataFrame, keys: list[str]) -> tuple[DataFrame, dict[str, str]]:
    ren = {k: f"_rk_{k}" for k in keys}
    return right.withColumnsRenamed(ren), ren


def _join(left: DataFrame, right: DataFrame, keys: list[str], how: str,
          null_safe: bool, extra: list[str] = ()) -> DataFrame:
    """Equi-join on ``keys`` (+ ``extra`` plain keys); null-safe on request."""
    if not null_safe:
        return left.join(right, on=list(keys) + list(extra), how=how)
    r, ren = _prefixed(right, keys)
    cond: Column | None = None
    for k in keys:
        c = left[k].eqNullSafe(r[ren[k]])
        cond = c if cond is None else cond & c
    for e in extra:
        cond = cond & (left[e] == r[e])
    out = left.join(r, cond, how)
    if how in ("left_semi", "leftsemi", "semi", "left_anti", "leftanti", "anti"):
        return out
    return out.drop(*ren.values(), *[r[e] for e in extra])


def _plain_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    r, ren = _prefixed(right, keys)
    cond = [left[k] == r[ren[k]] for k in keys]
    out = left.join(r, cond, how)
    return out if "semi" in how or "anti" in how else out.drop(*ren.values())


def place_cols(key: str) -> list[str]:
    """The columns of a row's place in a layout by ``key``."""
    return [f"_at_{key}", f"_part_{key}"]


def placed_by(df: DataFrame, key: str) -> list[str]:
    """``place_cols(key)`` if ``df`` has them, else nothing."""
    cols = place_cols(key)
    return cols if set(cols) <= set(df.columns) else []


def _placed_join(left: DataFrame, right: DataFrame, key: str, how: str, null_safe: bool) -> DataFrame:
    at = place_cols(key)
    if not null_safe:      # a missing key matches nothing
        right = right.where(F.col(key).isNotNull())
    rest = [c for c in right.columns if c != key and c not in at]
    out = left.join(right.select(*at, *rest), at, how)
    semi = how in ("left_semi", "leftsemi", "semi", "left_anti", "leftanti", "anti")
    return out.select(*left.columns, *([] if semi else rest))


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``df`` with their row counts (partial-aggregated)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))


def keyed_join(left: DataFrame, right: DataFrame, keys: str | list[str], how: str = "left", *,
               count_col: str | None = None, total: int | None = None, null_safe: bool = False,
               salt_cols: list[str] | None = None, counts: DataFrame | None = None,
               hot: DataFrame | None = None, policy: JoinPolicy = DEFAULT_POLICY) -> DataFrame:
    """Join ``left`` to ``right`` (unique on ``keys``); runs no Spark job itself.

    ``count_col`` names a right-side column with the number of left-side rows
    expected per key and ``total`` an upper bound of their sum; together they
    enable hot-key salting.  ``counts`` is a narrow table of ``keys`` and
    ``count_col`` to list the hot keys from, for a ``right`` that is costly to
    compute twice.  ``count_col`` stays in the output unless the join is a
    semi/anti join.  ``hot`` (:func:`hot_keys` of ``left``) salts a join without
    counts.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if len(keys) == 1 and how in ("left", "inner", "left_semi", "left_anti") and placed_by(left, keys[0]) and placed_by(right, keys[0]):
        return _placed_join(left, right, keys[0], how, null_safe)
    if set(keys) <= policy.plain:
        return _plain_join(left, right, keys, how)
    if hot is not None:
        return _listed_join(left, right, keys, how, null_safe, salt_cols or left.columns, hot)
    if not count_col or not total or total < policy.threshold(total):
        return _join(left, right, keys, how, null_safe)
    return _salted_join(left, right, keys, how, count_col, policy.threshold(total), null_safe,
                        salt_cols or left.columns, right if counts is None else counts, policy)


#: Counters of a sketch (its error is at most 3.5 / TRACKED of the rows), and
#: keys that it may list.
TRACKED, LISTED = 1 << 16, 10_000


def hot_keys(df: DataFrame, key: str, policy: JoinPolicy = DEFAULT_POLICY) -> DataFrame:
    """``key, _salts`` of the keys that hold more than a bucket's rows, by a
    mergeable frequent-items sketch; at most ``LISTED`` local rows (one job)."""
    top = df.agg(F.expr(f"approx_top_k(`{key}`, {LISTED}, {TRACKED})").alias("_top"))
    found = top.select(F.inline("_top")).where((F.col("count") > policy.rows_per_bucket) & F.col("item").isNotNull()).collect()
    kind = df.schema[key].dataType.simpleString()
    return df.sparkSession.createDataFrame([(r["item"], math.ceil(r["count"] / policy.rows_per_bucket)) for r in found],
                                           f"`{key}` {kind}, {_HOT} INT")


def _listed_join(left: DataFrame, right: DataFrame, keys: list[str], how: str, null_safe: bool, salt_cols: list[str],
                 hot: DataFrame) -> DataFrame:
    (key,) = keys
    spread = F.pmod(F.xxhash64(*salt_cols), F.col(_HOT))
    if not null_safe:
        # rows without a key match nothing: any place does
        spread = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*salt_cols), F.lit(1 << 16))).otherwise(spread)
    salted = left.join(F.broadcast(hot), key, "left")
    salted = salted.select(*left.columns, F.coalesce(spread, F.lit(0)).cast("int").alias(_SALT))
    copies = right.join(F.broadcast(hot), key, "left")
    copies = copies.select(*right.columns, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_HOT), F.lit(1)) - 1)).alias(_SALT))
    return _join(salted, copies, keys, how, null_safe, extra=[_SALT]).drop(_SALT)


def _salted_join(left: DataFrame, right: DataFrame, keys: list[str], how: str,
                 count_col: str, threshold: int, null_safe: bool,
                 salt_cols: list[str], counts: DataFrame, policy: JoinPolicy) -> DataFrame:
    n = F.col(count_col)
    salts = F.ceil(n / F.lit(policy.rows_per_bucket)).cast("int")
    is_hot = n >= threshold
    # at most max_hot_keys rows by construction: safe to broadcast
    hot_keys = counts.filter(is_hot).select(*keys, salts.alias(_HOT))
    marked = _join(left, F.broadcast(hot_keys), keys, "left", null_safe)
    salted_left = marked.withColumn(
        _SALT,
        F.when(F.col(_HOT).isNotNull(), F.pmod(F.xxhash64(*salt_cols), F.col(_HOT))).otherwise(F.lit(0)).cast("int"),
    ).drop(_HOT)
    salted_right = right.withColumn(
        _SALT,
        F.explode(F.when(is_hot, F.sequence(F.lit(0), salts - 1)).otherwise(F.array(F.lit(0)))),
    )
    out = _join(salted_left, salted_right, keys, how, null_safe, extra=[_SALT])
    return out.drop(_SALT)
