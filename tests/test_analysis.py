"""Whole-pipeline metamorphic checks on sf0.001."""

import pytest

from biasfit.operators.joins import JoinPolicy
from biasfit.plans.catalog import analysis

from conftest import SF001


@pytest.fixture(scope="module")
def base(spark):
    p = analysis(spark, SF001)
    return p, p.final_score().first()


def test_forced_salting_changes_nothing(spark, base):
    p0, want = base
    tiny = JoinPolicy(rows_per_bucket=20, max_hot_keys=50)
    p = analysis(spark, SF001, policy=tiny)
    got = p.final_score().first()
    assert p.best_bias == pytest.approx(p0.best_bias, abs=1e-12)
    assert p.selection.kept == p0.selection.kept
    assert got["rmse"] == pytest.approx(want["rmse"], abs=1e-12)
    assert got["n_rows"] == want["n_rows"]
    # the salted plan really is salted
    plan = p.bias_sweep._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan and "xxhash64" in plan


def test_split_roles_partition_the_input(spark, base):
    p0, _ = base
    n_in = p0.facts.count()
    roles = {r["role"]: r["count"] for r in p0.split.groupBy("role").count().collect()}
    assert sum(roles.values()) == n_in
    assert set(roles) <= {"train", "test", "validation", "dropped"}
    # hold-out keys are known to train
    for part in ("test", "validation"):
        for k in ("movieId", "userId"):
            assert p0.validation.select(k).subtract(p0.train.select(k)).count() == 0
            assert p0.test.select(k).subtract(p0.train.select(k)).count() == 0


def test_ledger_is_consistent(base):
    p0, fin = base
    led = p0.ledger().collect()
    assert led[0]["decision"] == "baseline" and led[-1]["decision"] == "final"
    assert led[-1]["rmse"] == pytest.approx(fin["rmse"], abs=1e-12)
    kept = [r["model"][1:] for r in led[1:-2] if r["decision"] == "include"]
    assert kept == p0.selection.kept


def test_write_reports_sink(spark, base, tmp_path):
    p0, _ = base
    paths = p0.write_reports(str(tmp_path / "reports"))
    got = {k: spark.read.parquet(v).count() for k, v in paths.items()}
    assert got["bias_sweep"] == 41 and got["flag_sweep"] == 9
    assert got["flag_boxstats"] == 2 * len(p0.cfg.screen)
    assert got["ledger"] == len(p0.cfg.screen) + 3


def test_split_by_joins_equals_split_by_bits(spark, base):
    p0, _ = base
    p = analysis(spark, SF001, max_bits=64)
    assert p.split.exceptAll(p0.split).count() == 0 and p.split.count() == p0.split.count()
    assert p.role_counts == p0.role_counts == {r["role"]: r["count"] for r in p0.split.groupBy("role").count().collect()}
    assert p0.mu == pytest.approx(p0.train.agg({"rating": "avg"}).first()[0], abs=1e-12)
