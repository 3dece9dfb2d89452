"""Greedy forward selection of flags by hold-out RMSE, from one Gram matrix.

Each flag's effect is fitted on the bias residual only, so a candidate
model's prediction is ``base + sum_{f in K} x_f`` with fixed per-row terms
``x_f``.  With ``e = r - base``:

    n * RMSE(K)^2 = G_ee - 2 sum_{f in K} G_ef + sum_{f,g in K} G_fg

so ``(F + 1)(F + 2) / 2`` sums over the test rows give the RMSE of *every*
subset.  Within a user a term has one size and a sign, ``x_f = +-gap_f(u) / 2``,
so rows of a user with the same flags differ only in ``e``: they are aggregated
to (rows, sum e, sum e^2) per user and flag pattern *below* the join with the
user's gaps (:func:`pattern_terms`).  All sums are then one Gram matrix of the
lines; no row is repeated.  The greedy loop (fixed order, keep a flag iff the RMSE strictly
falls) runs on that small matrix at the driver, and the chosen model is
re-scored directly as a check.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, functions as F

from biasfit.functions.flags import flag_of_words, flag_words, word_names
from biasfit.functions.literals import dlit
from biasfit.operators.effects import USER, flag_term_sql
from biasfit.operators.joins import DEFAULT_POLICY, JoinPolicy, keyed_join, placed_by
from biasfit.session import materialize


@dataclass
class Selection:
    base_rmse: float
    steps: list[dict] = field(default_factory=list)   # step, flag, rmse, decision, kept
    kept: list[str] = field(default_factory=list)
    n: int = 0
    direct_rmse: float | None = None     # of the kept set, scored line by line


def row_terms(scored_test: DataFrame, flags: Sequence[str], mu: float) -> DataFrame:
    """``n, se, see, x0..``: one line per row of a table that holds the effects
    (``<flag>_up/_down``) beside the flags."""
    e = f"rating - ({dlit(mu)} + b_i + b_u)"
    return scored_test.select(F.lit(1).cast("long").alias("n"), F.expr(e).alias("se"), F.expr(f"({e}) * ({e})").alias("see"),
                              *[F.expr(flag_term_sql(f)).alias(f"x{k}") for k, f in enumerate(flags)])


def pattern_terms(scored_test: DataFrame, effects: DataFrame, flags: Sequence[str], mu: float, *, total: int | None = None,
                  policy: JoinPolicy = DEFAULT_POLICY) -> DataFrame:
    """``n, se, see, x0..``: one line per user and flag pattern.

    Flags (and which of them are missing) are packed into integers; the join
    with the users' gaps meets the aggregated lines."""
    words, names = flag_words(flags), word_names(flags)
    e = F.expr(f"coalesce(rating - ({dlit(mu)} + b_i + b_u), double('NaN'))")
    place = placed_by(scored_test, USER)
    rows = scored_test.select(USER, *place, *words, e.alias("_e"))
    if not place and USER in policy.plain:
        rows = rows.repartition(USER)       # for the lines and their join alike
    lines = (rows.groupBy(USER, *place, *names)
             .agg(F.count(F.lit(1)).alias("n"), F.sum("_e").alias("se"), F.expr("sum(_e * _e)").alias("see")))
    gaps = effects.select(USER, F.col("m_u").alias("_m"), *placed_by(effects, USER), *[F.expr(f"(`{f}_up` - `{f}_down`) / 2").alias(f"_gap{k}")
                                                            for k, f in enumerate(flags)])
    t = keyed_join(lines, gaps, USER, "left", count_col="_m", total=total, null_safe=True, policy=policy)
    return t.select("n", "se", "see", *[F.expr(f"(2 * {flag_of_words(k)} - 1) * _gap{k}").alias(f"x{k}") for k in range(len(flags))])


def _strict(expr: str) -> str:
    """A sum that is NaN if a line lacks the value."""
    return f"sum(coalesce({expr}, double('NaN')))"


def gram_sums(terms: DataFrame, k: int) -> dict:
    """``{n, g_e_e, g_e_<a>, g_<a>_<b>}`` of lines ``n, se, see, x0..x<k-1>``.

    A line stands for ``n`` rows: with ``(sum e / sqrt n, sqrt n x_0, ..)`` as
    its vector, the Gram matrix of all lines holds every sum but ``g_e_e``.  Each
    task adds up one packed triangle of (k + 1)^2 / 2 numbers; they are merged
    by a tree."""
    row = terms.agg(F.sum("n").alias("n"), F.expr(_strict("see")).alias("see")).first()
    if not row["n"]:
        return {"n": 0}
    cells = ["se / sqrt(n)", *[f"x{i} * sqrt(n)" for i in range(k)]]
    v = F.expr("array({})".format(", ".join(f"coalesce({c}, double('NaN'))" for c in cells)))
    lines = MLUtils.convertVectorColumnsFromML(terms.select(array_to_vector(v).alias("_1")), "_1")
    m = RowMatrix(lines, numCols=k + 1).computeGramianMatrix().toArray()
    out = {"n": row["n"], "g_e_e": row["see"]}
    out |= {f"g_e_{a}": float(m[0, a + 1]) for a in range(k)}
    out |= {f"g_{a}_{b}": float(m[a + 1, b + 1]) for a in range(k) for b in range(a, k)}
    return out


def subset_rmse(g: dict, n: int, subset: Sequence[int]) -> float:
    q = g["g_e_e"]
    for a in subset:
        q -= 2 * g[f"g_e_{a}"]
    for i, a in enumerate(subset):
        for b in subset[i:]:
            lo, hi = min(a, b), max(a, b)
            q += g[f"g_{lo}_{hi}"] * (1 if a == b else 2)
    return q if math.isnan(q) else math.sqrt(max(q, 0.0) / n)


def forward_select(scored_test: DataFrame, flags: Sequence[str], mu: float, effects: DataFrame | None = None, *,
                   total: int | None = None, policy: JoinPolicy = DEFAULT_POLICY) -> Selection:
    """Screen ``flags`` in order; ``scored_test`` holds ``rating, b_i, b_u`` and
    the flag columns.  The effects are a table per user (``userId, m_u,
    <flag>_up, <flag>_down``) or, without it, columns of ``scored_test``.

    A flag is kept iff the RMSE strictly falls.  A set with a NULL term in any
    row has RMSE NaN and is rejected."""
    if effects is None:
        terms = row_terms(scored_test, flags, mu)
    else:
        terms = materialize(pattern_terms(scored_test, effects, flags, mu, total=total, policy=policy), "table", "terms", lean=True)
    g = gram_sums(terms, len(flags))
    n = g["n"]
    if not n:
        return Selection(float("nan"))
    kept: list[int] = []
    best = subset_rmse(g, n, [])
    sel = Selection(best, n=n)
    for i, f in enumerate(flags):
        cand = subset_rmse(g, n, kept + [i])
        take = cand < best
        if take:
            kept.append(i)
            best = cand
        sel.steps.append({"step": i + 1, "flag": f, "rmse": cand,
                          "decision": "include" if take else "reject",
                          "kept": ",".join(flags[j] for j in kept)})
    sel.kept = [flags[j] for j in kept]
    x = " + ".join(["0.0D"] + [f"x{i}" for i in kept])
    sse = terms.agg(F.expr(_strict(f"see - 2 * se * ({x}) + n * ({x}) * ({x})"))).first()[0]
    sel.direct_rmse = sse if math.isnan(sse) else math.sqrt(max(sse, 0.0) / n)
    if abs(sel.direct_rmse - best) > 1e-9 * max(1.0, best):
        raise AssertionError(f"selection: RMSE {best} from the sums, {sel.direct_rmse} scored directly")
    return sel
