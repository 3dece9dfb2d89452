"""The planted-effects trial of FIXTURES.md section 3 (sf0.01, one split, salt '1').

Expected: per-stratum sample 1852/2118/909/1123; best bias lambda 3.5 with
RMSE 0.826069 (0.829100 at lambda 0, 0.831739 at 10); screening at lambda 30
in the order STANDARD, ECONOMY, MEDIUM, PROMO, SMALL, LARGE, red, hot,
plate, rod with the listed RMSEs and decisions.
"""

import pytest

from biasfit import schemas as S
from biasfit.functions.flags import add_flags
from biasfit.operators.effects import attach_bias, fit_bias, global_mean, residuals, user_flag_effects, user_flag_stats
from biasfit.operators.sampling import exact_stratified_sample, semi_join_keys
from biasfit.operators.select import forward_select
from biasfit.operators.sweep import best_lambda, sweep_bias
from biasfit.sources.testdata import KEY_COLS, TIE_COLS, TestdataViews

from conftest import SF01

ORDER = ["t_STANDARD", "t_ECONOMY", "t_MEDIUM", "t_PROMO", "t_SMALL", "t_LARGE", "w_red", "w_hot", "w_plate", "w_rod"]
EXPECTED = [0.825192, 0.823962, 0.824552, 0.800295, 0.799308, 0.797370, 0.798557, 0.797726, 0.797448, 0.798326]
DECISIONS = ["include", "include", "reject", "include", "include", "include", "reject", "reject", "reject", "reject"]


def test_fixture_trial(spark):
    facts = add_flags(TestdataViews(spark, SF01).facts(), S.TESTDATA_FLAGS)
    s = exact_stratified_sample(facts, "rating", 0.1, "1", KEY_COLS, TIE_COLS).persist()
    train = s.where("NOT sampled")
    test = semi_join_keys(s.where("sampled"), train)
    mu, n = global_mean(train)
    grid = S.grid_values(S.BIAS_LAMBDA_GRID)
    sw = {r["lambda"]: r["rmse"] for r in sweep_bias(train, test, grid, mu).collect()}
    assert round(sw[0.0], 6) == 0.829100 and round(sw[10.0], 6) == 0.831739
    best = best_lambda(sweep_bias(train, test, grid, mu)).first()
    assert best["lambda"] == 3.5 and round(best["rmse"], 6) == 0.826069
    m = fit_bias(train, 3.5, mu)
    stats = user_flag_stats(residuals(train, m), ORDER)
    scored = attach_bias(test, m).join(user_flag_effects(stats, ORDER, 30.0), "userId", "left")
    sel = forward_select(scored, ORDER, mu)
    assert [round(x["rmse"], 6) for x in sel.steps] == pytest.approx(EXPECTED, abs=1e-6)
    assert [x["decision"] for x in sel.steps] == DECISIONS
