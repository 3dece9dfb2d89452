"""Shrinkage sweeps in one plan per grid chunk.

Bias sweep: with ``s_i, n_i`` per item, ``b_i(l) = s_i / (n_i + l)``.  Items
with the same ``n_i`` share a divisor, so train is first added up by user and
``n_i`` (three narrow sums); one aggregate per user of those lines, dealt out by
user, produces ``U_l = sum(r - mu - b_i(l))`` for *every* l as separate columns,
which are never shuffled as partial sums.  One global aggregate over the scored
test rows gives every l's squared error.  The naive form (:func:`sweep_bias_naive`) rescans
train per lambda and exists to check this one.

Flag sweep: user-by-flag sums and counts are computed once
(``effects.user_flag_stats``); each lambda is a projection over them.

Grids longer than ``chunk`` are split so each aggregate stays under the
whole-stage-codegen field limit (41 and 9 points each fit one plan).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from biasfit.functions.metrics import rmse_columns
from biasfit.operators.effects import (ITEM, RATING, USER, dlit, fit_bias, flag_term_sql,
                                       item_stats, predict_bias, strict_sum_sql)
from biasfit.operators.joins import DEFAULT_POLICY, JoinPolicy, key_counts, keyed_join, placed_by

CHUNK = 64   # sums per aggregate; stays under spark.sql.codegen.maxFields (100)


def _rows_from_wide(wide: DataFrame, grid: Sequence[float], sse_cols: Sequence[str], n_col: str,
                    null_col: str) -> DataFrame:
    """One wide row -> ``(lambda, rmse)`` rows, without leaving Spark."""
    items = [F.struct(F.lit(float(l)).alias("lambda"), F.col(c).alias("_sse")) for l, c in zip(grid, sse_cols)]
    n, nn = F.col(n_col), F.col(null_col)
    return (wide.select(n, nn, F.explode(F.array(*items)).alias("_x"))
            .select(F.col("_x.lambda").alias("lambda"),
                    F.when((nn == 0) & (n > 0), F.sqrt(F.col("_x._sse") / n)).alias("rmse")))


def _chunks(grid: Sequence[float], size: int):
    for i in range(0, len(grid), size):
        yield list(grid[i:i + size])


def sweep_bias(train: DataFrame, test: DataFrame, grid: Sequence[float], mu: float, *,
               stats: DataFrame | None = None, chunk: int = CHUNK, total: int | None = None,
               policy: JoinPolicy = DEFAULT_POLICY, user_counts: DataFrame | None = None) -> DataFrame:
    """``lambda, rmse`` of ``mu + b_i(l) + b_u(l)`` on ``test`` for every l.

    ``user_counts`` (``userId, _n``): train rows per user, the list of hot
    users of a salted join; by default counted here in one narrow pass."""
    if user_counts is None:
        user_counts = key_counts(train, USER)
    st = stats if stats is not None else item_stats(train, mu)
    st = st.select(ITEM, "s_i", "n_i")
    parts = []
    m = dlit(mu)
    for g in _chunks(list(grid), chunk):
        j = keyed_join(train.select(USER, ITEM, RATING), st, ITEM, "left", count_col="n_i", total=total,
                       null_safe=True, policy=policy)
        if USER in policy.plain:
            # no hot user: the rows are dealt out by user, once
            j = j.select(USER, RATING, "s_i", "n_i").repartition(USER)
        # a hot user has at most one line per n_i, so dealing these out by user leaves no task behind
        lines = j.groupBy(USER, "n_i").agg(
            F.count(F.lit(1)).alias("_rows"), F.expr(strict_sum_sql(f"{RATING} - {m}")).alias("_r"),
            F.expr(strict_sum_sql("s_i")).alias("_s"))
        users = (lines if USER in policy.plain else lines.repartition(USER)).groupBy(USER).agg(
            F.sum("_rows").alias("m_u"),
            *[F.expr(strict_sum_sql(f"_r - _s / (n_i + {dlit(l)})")).alias(f"_u{k}") for k, l in enumerate(g)])
        t = keyed_join(test.select(USER, ITEM, RATING), st, ITEM, "left", count_col="n_i", total=total,
                       null_safe=True, policy=policy)
        t = keyed_join(t, users, USER, "left", count_col="m_u", total=total, null_safe=True, policy=policy,
                       counts=user_counts.withColumnRenamed("_n", "m_u"))
        preds = [f"({m} + s_i / (n_i + {dlit(l)}) + _u{k} / (m_u + {dlit(l)}))" for k, l in enumerate(g)]
        parts.append(_score(t, g, preds))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _score(t: DataFrame, grid: Sequence[float], preds: Sequence[str]) -> DataFrame:
    """One aggregate: squared error of every prediction column -> ``lambda, rmse`` rows."""
    wide = t.agg(F.count(F.lit(1)).alias("_n"),
                 F.expr(f"count(CASE WHEN {preds[0]} IS NULL OR rating IS NULL THEN 1 END)").alias("_nn"),
                 *[F.expr(f"sum((rating - {p}) * (rating - {p}))").alias(f"_sse{k}") for k, p in enumerate(preds)])
    return _rows_from_wide(wide, grid, [f"_sse{k}" for k in range(len(preds))], "_n", "_nn")


def sweep_bias_naive(train: DataFrame, test: DataFrame, grid: Sequence[float], mu: float,
                     policy: JoinPolicy = DEFAULT_POLICY) -> list[tuple[float, float | None]]:
    """One fit and one scoring job per lambda (the reference's loop shape)."""
    out = []
    for l in grid:
        m = fit_bias(train, l, mu, policy=policy)
        r = predict_bias(test, m, policy=policy).agg(*rmse_columns()).first()
        out.append((float(l), r["rmse"]))
    return out


def best_lambda(sweep: DataFrame) -> DataFrame:
    """First minimum of ``rmse`` (ties -> smallest lambda); NULL/NaN skipped."""
    ok = sweep.where(F.col("rmse").isNotNull() & ~F.isnan("rmse"))
    m = ok.agg(F.min(F.struct("rmse", "lambda")).alias("_m"))
    return m.select(F.col("_m.lambda").alias("lambda"), F.col("_m.rmse").alias("rmse"))


def sweep_flags(scored_test: DataFrame, stats: DataFrame, flags: Sequence[str], grid: Sequence[float], mu: float,
                *, chunk: int = CHUNK, total: int | None = None,
                policy: JoinPolicy = DEFAULT_POLICY) -> DataFrame:
    """``lambda, rmse`` of ``mu + b_i + b_u + sum_f term_f(l)``.

    ``scored_test`` carries ``b_i, b_u`` and the flag columns; ``stats`` is
    ``effects.user_flag_stats`` (frozen biases, one table for all lambdas).
    """
    cols = [USER, "m_u", *placed_by(stats, USER)] + [f"{f}__{x}" for f in flags for x in ("s1", "n1", "s0", "n0")]
    t = keyed_join(scored_test, stats.select(*cols), USER, "left", count_col="m_u", total=total,
                   null_safe=True, policy=policy)
    parts = []
    for g in _chunks(list(grid), chunk):
        preds = ["(" + " + ".join([f"{dlit(mu)} + b_i + b_u"] + [flag_term_sql(f, l) for f in flags]) + ")"
                 for l in g]
        parts.append(_score(t, g, preds))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
