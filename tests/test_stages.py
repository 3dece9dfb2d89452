"""Runs that are taken up again, reports that appear whole."""

import json
import os

import pytest

from biasfit.operators.sampling import ROW_ID
from biasfit.plans.analysis import RatingsPipeline
from biasfit.plans.catalog import testdata_config as config
from biasfit.plans.stages import Stages
from biasfit.sources.testdata import TestdataViews

from conftest import SF001

INPUTS = [f"{SF001}/{t}.parquet" for t in ("lineitem", "orders", "part")]


def pipeline(spark, root, **kw):
    cfg = config(**kw)
    return RatingsPipeline(spark, TestdataViews(spark, SF001).facts(), cfg, Stages(spark, str(root), INPUTS, cfg))


def test_a_stopped_run_is_taken_up(spark, tmp_path, monkeypatch):
    root = tmp_path / "run"
    first = pipeline(spark, root)
    first.split
    written = {f: os.stat(f).st_mtime_ns for d, _, names in os.walk(root) for f in [os.path.join(d, n) for n in names]}
    assert first.stages.made == ["facts", "split"]

    def lost(*a, **k):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr("biasfit.plans.analysis.residuals", lost)
        with pytest.raises(RuntimeError):
            first.train_residuals
    second = pipeline(spark, root)
    again = second.final_score().first()
    assert second.stages.made == ["residuals"]
    assert written.items() <= {f: os.stat(f).st_mtime_ns for f in written}.items()
    plain = RatingsPipeline(spark, TestdataViews(spark, SF001).facts(), config()).final_score().first()
    assert again["rmse"] == pytest.approx(plain["rmse"], abs=1e-12) and again["flags"] == plain["flags"]
    assert second.role_counts == first.role_counts and second.mu == first.mu
    assert second.prepared.nulls == first.prepared.nulls and set(first.prepared.nulls) == set(first.work.columns) - {"_h0", "_h1", *ROW_ID}


def test_a_half_written_stage_is_made_again(spark, tmp_path):
    a = Stages(spark, str(tmp_path), INPUTS, "x")
    a.run("t", lambda write: {"n": write(spark.range(5)).count()})
    os.remove(f"{tmp_path}/t-{a.fingerprint}/_published")
    b = Stages(spark, str(tmp_path), INPUTS, "x")
    df, info = b.run("t", lambda write: {"n": write(spark.range(7)).count()})
    assert df.count() == info["n"] == 7 and b.made == ["t"]


def test_other_parameters_or_inputs_are_another_run(spark, tmp_path):
    a, b = Stages(spark, str(tmp_path), INPUTS, 1), Stages(spark, str(tmp_path), INPUTS, 2)
    (tmp_path / "in").mkdir()
    c = Stages(spark, str(tmp_path), INPUTS + [str(tmp_path / "in")], 1)
    assert len({a.fingerprint, b.fingerprint, c.fingerprint}) == 3
    (tmp_path / "in" / "f").write_text("new")
    assert Stages(spark, str(tmp_path), INPUTS + [str(tmp_path / "in")], 1).fingerprint != c.fingerprint
    for s in (a, b):
        s.run("t", lambda write: (write(spark.range(3)), {})[1])
    gone = b.clean()
    assert f"t-{a.fingerprint}" in gone and os.listdir(tmp_path) == [f"t-{b.fingerprint}"]


def test_reports_appear_whole(spark, tmp_path, monkeypatch):
    p = pipeline(spark, tmp_path / "run")
    path = str(tmp_path / "reports")
    first = p.write_reports(path)
    assert json.load(open(f"{path}/manifest.json")) == first
    with monkeypatch.context() as m:
        m.setattr(RatingsPipeline, "ledger", lambda self: spark.range(1).selectExpr("raise_error('lost') AS x"))
        with pytest.raises(Exception, match="lost"):
            p.write_reports(path)
    assert json.load(open(f"{path}/manifest.json")) == first and all(os.path.isdir(x) for x in first.values())
    second = p.write_reports(path)
    assert json.load(open(f"{path}/manifest.json")) == second and not any(os.path.isdir(x) for x in first.values())
    n = spark.read.parquet(second["flag_outliers"]).count()
    assert n == spark.read.parquet(second["flag_boxstats"]).agg({"n_outliers": "sum"}).first()[0]
