"""Shrunken additive effects: global mean, item, user and user-by-flag.

    b_i = sum_i(r - mu) / (n_i + lambda)
    b_u = sum_u(r - mu - b_i) / (m_u + lambda)          (same lambda)
    e   = r - mu - b_i - b_u                              (bias residual)
    flag effect of user u, flag f, level v:
          sum(e | u, f = v) / (count(u, f = v) + lambda), 0 when the user has no such rows
    prediction term of flag f: (2 f - 1) * (up - down) / 2

A NULL in any row of a group makes the group's sum, and what follows from it,
NULL; a NULL key is a key like any other (it matches NULL).  A NULL rating in
train makes mu, and so every prediction, NULL.

Counts are row counts (``count(1)``).  Every statistics table keeps its row
count so joins back to the fact side can salt hot keys (operators/joins.py).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from biasfit.functions.flags import pack_flags, unpack_flags
from biasfit.functions.literals import dlit
from biasfit.operators.joins import DEFAULT_POLICY, JoinPolicy, keyed_join, placed_by

USER, ITEM, RATING = "userId", "movieId", "rating"


def global_mean(train: DataFrame, rating: str = RATING) -> tuple[float | None, int]:
    """``(mu, n)``; ``mu`` is NULL if any rating is NULL (no NA removal)."""
    r = train.agg(F.count(F.lit(1)).alias("n"), F.count(rating).alias("k"), F.avg(rating).alias("mu")).first()
    mu = r["mu"] if r["n"] == r["k"] else None
    return mu, r["n"]


def strict_sum_sql(expr: str) -> str:
    """Sum that is NULL if any row's value is NULL or NaN, in one aggregate: a
    missing value goes in as NaN, which no sum leaves."""
    return f"nullif(sum(coalesce({expr}, double('NaN'))), double('NaN'))"


def item_stats(train: DataFrame, mu: float, item: str = ITEM, rating: str = RATING) -> DataFrame:
    """``item, s_i = sum(r - mu), n_i`` (partial + final hash aggregate)."""
    return train.groupBy(item).agg(
        F.expr(strict_sum_sql(f"`{rating}` - {dlit(mu)}")).alias("s_i"),
        F.count(F.lit(1)).alias("n_i"))


@dataclass
class BiasModel:
    mu: float
    lam: float
    items: DataFrame   # movieId, b_i, n_i
    users: DataFrame   # userId, b_u, m_u


def fit_bias(train: DataFrame, lam: float, mu: float | None = None, *,
             items_stats: DataFrame | None = None, total: int | None = None,
             policy: JoinPolicy = DEFAULT_POLICY) -> BiasModel:
    """``total`` (rows of ``train``, or a bound) enables hot-key salting."""
    if mu is None:
        mu, total = global_mean(train)
    st = items_stats if items_stats is not None else item_stats(train, mu)
    items = st.select(ITEM, (F.col("s_i") / (F.col("n_i") + F.lit(float(lam)))).alias("b_i"), "n_i")
    j = keyed_join(train.select(USER, ITEM, RATING), items, ITEM, "left", count_col="n_i", total=total,
                   null_safe=True, policy=policy)
    users = j.groupBy(USER).agg(
        (F.expr(strict_sum_sql(f"`{RATING}` - b_i - {dlit(mu)}")) / (F.count(F.lit(1)) + F.lit(float(lam)))).alias("b_u"),
        F.count(F.lit(1)).alias("m_u"))
    return BiasModel(mu, lam, items, users)


def attach_bias(df: DataFrame, model: BiasModel, policy: JoinPolicy = DEFAULT_POLICY,
                total: int | None = None, flags: Sequence[str] = ()) -> DataFrame:
    """``df`` + ``b_i``, ``b_u`` (left joins; unknown keys give NULL).

    Hot keys are judged by their *training* counts; ``total`` bounds them.
    ``flags`` names 0/1 columns, which are moved as the bits of two integers.
    Where rows and users lie side by side, they are joined before the items'
    join may move the rows."""
    if flags:
        out = attach_bias(pack_flags(df, flags), model, policy, total)
        return unpack_flags(out, flags, [*df.columns, "b_i", "b_u"])
    users = model.users.select(USER, "b_u", "m_u", *placed_by(model.users, USER))
    if placed_by(df, USER) and placed_by(users, USER):
        out = keyed_join(df, users, USER, "left", null_safe=True).drop("m_u")
        out = keyed_join(out, model.items.select(ITEM, "b_i", "n_i"), ITEM, "left", count_col="n_i", total=total,
                         null_safe=True, policy=policy)
        return out.select(*df.columns, "b_i", "b_u")
    out = keyed_join(df, model.items.select(ITEM, "b_i", "n_i"), ITEM, "left", count_col="n_i", total=total,
                     null_safe=True, policy=policy)
    out = keyed_join(out.drop("n_i"), users.select(USER, "b_u", "m_u"), USER, "left",
                     count_col="m_u", total=total, null_safe=True, policy=policy)
    return out.drop("m_u")


def predict_bias(df: DataFrame, model: BiasModel, pred: str = "pred",
                 policy: JoinPolicy = DEFAULT_POLICY, total: int | None = None) -> DataFrame:
    out = attach_bias(df, model, policy, total)
    return out.withColumn(pred, F.lit(model.mu) + F.col("b_i") + F.col("b_u"))


def residuals(df: DataFrame, model: BiasModel, policy: JoinPolicy = DEFAULT_POLICY,
              total: int | None = None, flags: Sequence[str] = ()) -> DataFrame:
    """``df`` + ``b_i, b_u, resid = r - (mu + b_i + b_u)``."""
    return with_residual(attach_bias(df, model, policy, total, flags), model.mu)


def with_residual(df: DataFrame, mu: float | None) -> DataFrame:
    """Rows with ``b_i, b_u`` + ``resid``."""
    return df.withColumn("resid", F.col(RATING) - (F.lit(mu) + F.col("b_i") + F.col("b_u")))


# ------------------------------------------------------------ flag effects
# The wide builders below emit SQL expression text: one parse per output
# column instead of one JVM round-trip per operator (hundreds of columns).

def shrunk_sql(total: str, n: str, lam: float | str) -> str:
    lam_s = dlit(lam) if not isinstance(lam, str) else lam
    return f"(CASE WHEN {n} > 0 THEN {total} / ({n} + {lam_s}) WHEN {n} = 0 THEN 0.0D END)"


def flag_term_sql(flag: str, lam: float | None = None) -> str:
    """Signed half gap of one flag: ``(2 f - 1) * (up - down) / 2``.

    With ``lam`` the up/down effects come from the raw sums and counts (the
    sweep form); without it the ``<flag>_up/_down`` columns are read.
    """
    if lam is None:
        up, down = f"`{flag}_up`", f"`{flag}_down`"
    else:
        up = shrunk_sql(f"`{flag}__s1`", f"`{flag}__n1`", lam)
        down = shrunk_sql(f"`{flag}__s0`", f"`{flag}__n0`", lam)
    return f"((`{flag}` * 2 - 1) * ({up} - {down}) / 2)"


def flag_term(flag: str, lam: float | None = None) -> Column:
    return F.expr(flag_term_sql(flag, lam))


def flag_stat_columns(flags: Sequence[str], resid: str = "resid") -> list[Column]:
    """Per user and flag: residual sums and row counts at levels 1 and 0."""
    cols = []
    for f in flags:
        for lvl in (1, 0):
            # strict: a missing residual counts as NaN; rows of the other level add nothing
            cols += [F.expr(f"nullif(sum(CASE WHEN `{f}` = {lvl} THEN coalesce(`{resid}`, double('NaN')) END), double('NaN'))").alias(f"{f}__s{lvl}"),
                     F.expr(f"count(CASE WHEN `{f}` = {lvl} THEN 1 END)").alias(f"{f}__n{lvl}")]
    return cols


#: Flags of one aggregate: 4 sums each and the count stay below the codegen field limit.
FLAGS_AT_ONCE = 24


def user_flag_stats(resid_df: DataFrame, flags: Sequence[str], resid: str = "resid") -> DataFrame:
    """Residual sums and counts of all flags: ``userId, m_u, <f>__s1, <f>__n1, <f>__s0, <f>__n0``.

    One aggregate per ``FLAGS_AT_ONCE`` flags, joined by user.  Every lambda's
    effect is a projection over this table (no rescan)."""
    out = None
    for i in range(0, max(len(flags), 1), FLAGS_AT_ONCE):
        part = resid_df.groupBy(USER).agg(F.count(F.lit(1)).alias("m_u"), *flag_stat_columns(flags[i:i + FLAGS_AT_ONCE], resid))
        if out is None:
            out = part
        else:
            part = part.drop("m_u").withColumnRenamed(USER, "_same_user")
            out = out.join(part, out[USER].eqNullSafe(part["_same_user"])).drop("_same_user")
    return out


def flag_effect_columns(flags: Sequence[str], lam: float) -> list[Column]:
    """``<flag>_down, <flag>_up`` at ``lam`` (0 where the user has no such rows)."""
    cols = []
    for f in flags:
        cols += [F.expr(shrunk_sql(f"`{f}__s0`", f"`{f}__n0`", lam)).alias(f"{f}_down"),
                 F.expr(shrunk_sql(f"`{f}__s1`", f"`{f}__n1`", lam)).alias(f"{f}_up")]
    return cols


def user_flag_effects(stats: DataFrame, flags: Sequence[str], lam: float) -> DataFrame:
    return stats.select(USER, "m_u", *placed_by(stats, USER), *flag_effect_columns(flags, lam))


def predict_flags(df_with_bias: DataFrame, mu: float, effects: DataFrame, flags: Sequence[str],
                  pred: str = "pred", policy: JoinPolicy = DEFAULT_POLICY, total: int | None = None) -> DataFrame:
    """``mu + b_i + b_u + sum(flag terms)`` with one join to the wide user table."""
    cols = [USER, "m_u", *placed_by(effects, USER)] + [c for f in flags for c in (f"{f}_down", f"{f}_up")]
    j = keyed_join(df_with_bias, effects.select(*cols), USER, "left", count_col="m_u", total=total,
                   null_safe=True, policy=policy).drop("m_u")
    p = " + ".join([f"{dlit(mu)} + b_i + b_u"] + [flag_term_sql(f) for f in flags])
    return j.withColumn(pred, F.expr(p))
