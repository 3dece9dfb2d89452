"""Hand-computed values of the golden mini fixture (FIXTURES.md section 2)."""

import pytest

from biasfit.functions.flags import add_flags
from biasfit.functions.metrics import rmse_columns
from biasfit.operators.effects import (attach_bias, fit_bias, global_mean, predict_bias, predict_flags,
                                       residuals, user_flag_effects, user_flag_stats)
from biasfit.operators.select import forward_select
from biasfit.operators.sweep import best_lambda, sweep_bias, sweep_bias_naive, sweep_flags

FLAGS = {"Comedy": "Comedy", "Action": "Action", "Drama": "Drama"}


def _rmse(df):
    return df.agg(*rmse_columns()).first()["rmse"]


def test_bias_fit_values(mini):
    _items, train, test = mini
    mu, n = global_mean(train)
    assert (mu, n) == (3.0, 6)
    m = fit_bias(train, 1.0, mu)
    bi = {r.movieId: r.b_i for r in m.items.collect()}
    bu = {r.userId: r.b_u for r in m.users.collect()}
    assert bi == pytest.approx({10: 1.0, 20: -2 / 3, 30: -1 / 3})
    assert bu == pytest.approx({1: 5 / 9, 2: -2 / 9, 3: -1 / 3})
    pred = {(r.userId, r.movieId): r.pred for r in predict_bias(test, m).collect()}
    assert pred == pytest.approx({(1, 30): 3.222222, (2, 20): 2.111111, (3, 10): 3.666667}, abs=1e-6)
    assert _rmse(predict_bias(test, m)) == pytest.approx(0.463703, abs=1e-6)


def test_bias_sweep_vectorised_equals_naive_and_golden(mini):
    _items, train, test = mini
    grid = [0.0, 1.0, 2.0, 5.0]
    vec = {r["lambda"]: r["rmse"] for r in sweep_bias(train, test, grid, 3.0).collect()}
    naive = dict(sweep_bias_naive(train, test, grid, 3.0))
    for l in grid:
        assert vec[l] == pytest.approx(naive[l], abs=1e-12)
    assert [round(vec[l], 6) for l in grid] == [0.677003, 0.463703, 0.517908, 0.661116]
    best = best_lambda(sweep_bias(train, test, grid, 3.0)).first()
    assert best["lambda"] == 1.0


def test_best_lambda_first_minimum(spark):
    sw = spark.createDataFrame([(0.0, 0.5), (0.5, 0.5), (1.0, 0.7), (1.5, None)], "lambda DOUBLE, rmse DOUBLE")
    assert best_lambda(sw).first()["lambda"] == 0.0


def _flagged(mini):
    items, train, test = mini
    tr = add_flags(train.join(items, "movieId", "left"), FLAGS)
    te = add_flags(test.join(items, "movieId", "left"), FLAGS)
    return tr, te


def test_flag_effects_and_selection(mini):
    tr, te = _flagged(mini)
    m = fit_bias(tr, 1.0, 3.0)
    stats = user_flag_stats(residuals(tr, m), list(FLAGS))
    eff = {r.userId: r for r in user_flag_effects(stats, list(FLAGS), 30.0).collect()}
    assert eff[1]["Comedy_down"] == pytest.approx(0.003584, abs=1e-6)
    assert eff[1]["Comedy_up"] == pytest.approx(0.014337, abs=1e-6)
    assert eff[2]["Comedy_down"] == 0.0            # no rows: 0, not NULL
    assert eff[2]["Comedy_up"] == pytest.approx(-0.006944, abs=1e-6)
    assert eff[3]["Action_up"] == pytest.approx(-0.010417, abs=1e-6)
    assert eff[3]["Drama_up"] == 0.0
    scored = attach_bias(te, m)
    effs = user_flag_effects(stats, list(FLAGS), 30.0)
    single = {}
    for f in FLAGS:
        single[f] = _rmse(predict_flags(scored, 3.0, effs, [f]))
    assert single["Comedy"] == pytest.approx(0.464469, abs=1e-6)
    assert single["Action"] == pytest.approx(0.466527, abs=1e-6)
    assert single["Drama"] == pytest.approx(single["Action"], abs=1e-12)   # complementary flags
    sel = forward_select(scored.join(effs, "userId", "left"), list(FLAGS), 3.0)
    assert sel.kept == []
    assert [s["decision"] for s in sel.steps] == ["reject"] * 3
    assert sel.base_rmse == pytest.approx(0.463703, abs=1e-6)
    for s in sel.steps:   # Gram RMSE equals the direct RMSE
        assert s["rmse"] == pytest.approx(single[s["flag"]], abs=1e-12)


def test_flag_sweep_is_projection_of_one_stats_table(mini):
    tr, te = _flagged(mini)
    m = fit_bias(tr, 1.0, 3.0)
    stats = user_flag_stats(residuals(tr, m), list(FLAGS))
    scored = attach_bias(te, m)
    sw = {r["lambda"]: r["rmse"] for r in sweep_flags(scored, stats, ["Comedy"], [30.0, 60.0], 3.0).collect()}
    for l in (30.0, 60.0):
        direct = _rmse(predict_flags(scored, 3.0, user_flag_effects(stats, ["Comedy"], l), ["Comedy"]))
        assert sw[l] == pytest.approx(direct, abs=1e-12)


def test_strict_rmse_null_when_prediction_missing(mini):
    items, train, test = mini
    m = fit_bias(train, 1.0, 3.0)
    extra = test.unionByName(test.sparkSession.createDataFrame([(9, 99, 1.0)], test.schema))
    r = predict_bias(extra, m).agg(*rmse_columns()).first()
    assert r["rmse"] is None and r["n_null_pred"] == 1 and r["n_rows"] == 4


def test_null_genres_give_null_flags_and_prediction(spark, mini):
    items, train, test = mini
    df = spark.createDataFrame([(1, 99, 3.0, None)], "userId INT, movieId INT, rating DOUBLE, genres STRING")
    out = add_flags(df, FLAGS).first()
    assert out["Comedy"] is None


def test_compat_flag_map_keeps_documentary_slip(spark):
    from biasfit import schemas as S
    df = spark.createDataFrame([("Documentary",), ("Children|Comedy",)], "genres STRING")
    d = add_flags(df, S.GENRE_FLAGS, drop=()).collect()
    c = add_flags(df, S.COMPAT_GENRE_FLAGS, drop=()).collect()
    assert [r.Documentary for r in d] == [1, 0]
    assert [r.Documentary for r in c] == [r.Children for r in c] == [0, 1]


def test_gram_of_rows_equals_plain_sums(mini):
    from biasfit.operators.select import gram_sums, row_terms
    tr, te = _flagged(mini)
    m = fit_bias(tr, 1.0, 3.0)
    stats = user_flag_stats(residuals(tr, m), list(FLAGS))
    scored = attach_bias(te, m).join(user_flag_effects(stats, list(FLAGS), 30.0), "userId", "left")
    terms = row_terms(scored, list(FLAGS), 3.0)
    got = gram_sums(terms, 3)
    assert len(got) == 1 + 10 and got["n"] == 3
    plain = terms.selectExpr("sum(see)", "sum(se * x0)", "sum(se * x2)", "sum(x0 * x0)", "sum(x0 * x1)", "sum(x1 * x2)").first()
    assert [got[c] for c in ("g_e_e", "g_e_0", "g_e_2", "g_0_0", "g_0_1", "g_1_2")] == pytest.approx(list(plain), abs=1e-12)


def test_gram_of_200_flags_repeats_no_row(spark):
    """Lines per user and pattern, missing flags and unknown users, against numpy."""
    import math

    import numpy as np

    from biasfit.operators.select import forward_select, gram_sums, pattern_terms
    rng = np.random.default_rng(5)
    users, n, k = 30, 600, 200
    flags = [f"f{i}" for i in range(k)]
    up, down = rng.normal(0, 0.05, (users, k)), rng.normal(0, 0.05, (users, k))
    eff = spark.createDataFrame([(u, 20, *map(float, up[u]), *map(float, down[u])) for u in range(users)],
                                "userId INT, m_u BIGINT, " + ", ".join(f"{f}_{d} DOUBLE" for d in ("up", "down") for f in flags))
    u, pattern = rng.integers(0, users, n), rng.integers(0, 2, (40, k))
    f = pattern[rng.integers(0, 40, n)]
    e = rng.normal(0, 1, n)
    rows = [(int(a), float(3 + b), 0.0, 0.0, *[int(x) for x in c[:-1]], None if i == 7 else int(c[-1]))
            for i, (a, b, c) in enumerate(zip(u, e, f))]
    test = spark.createDataFrame(rows, "userId INT, rating DOUBLE, b_i DOUBLE, b_u DOUBLE, " + ", ".join(f"{x} INT" for x in flags))
    terms = pattern_terms(test, eff, flags, 3.0)
    plan = terms._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan
    terms = terms.cache()
    assert terms.count() < n
    g = gram_sums(terms, k)
    x = (2 * f - 1) * (up[u] - down[u]) / 2
    want = x.T @ x
    assert g["n"] == n and g["g_e_e"] == pytest.approx(e @ e)
    for a in range(k - 1):
        assert g[f"g_e_{a}"] == pytest.approx(e @ x[:, a], abs=1e-9)
        for b in range(a, k - 1, 7):
            assert g[f"g_{a}_{b}"] == pytest.approx(want[a, b], abs=1e-9)
    assert math.isnan(g["g_199_199"])
    some = flags[:6] + flags[-1:]
    sel = forward_select(test, some, 3.0, eff)
    base, kept = math.sqrt(np.mean(e ** 2)), []
    for i, name in enumerate(some[:-1]):
        cand = math.sqrt(np.mean((e - x[:, kept + [i]].sum(axis=1)) ** 2))
        assert sel.steps[i]["rmse"] == pytest.approx(cand, abs=1e-9)
        if cand < base:
            base, kept = cand, kept + [i]
    assert sel.kept == [some[i] for i in kept] and sel.steps[-1]["decision"] == "reject"
