"""Missing values, bad lines and odd distributions."""

import math

import pytest

from biasfit.operators.effects import fit_bias, global_mean, predict_bias
from biasfit.functions.metrics import rmse_columns
from biasfit.operators.order_stats import exact_percentiles
from biasfit.operators.sampling import strata_breaks
from biasfit.operators.select import forward_select
from biasfit.operators.sweep import best_lambda, sweep_bias
from biasfit.sources.text import (read_items_text, read_ratings_text, rejected_ratings, write_items_text,
                                  write_ratings_text)

RATINGS = "userId LONG, movieId LONG, rating DOUBLE"


def test_null_item_is_an_item(spark):
    train = spark.createDataFrame([(1, 10, 5.0), (1, None, 3.0), (2, 10, 4.0), (2, None, 2.0), (3, 20, 1.0)], RATINGS)
    m = fit_bias(train, 1.0)
    b_u = {r.userId: r.b_u for r in m.users.collect()}
    assert b_u[1] == pytest.approx(0.4444, abs=1e-4)
    test = spark.createDataFrame([(1, None, 3.0), (2, 10, 2.0)], RATINGS)
    assert predict_bias(test, m).agg(*rmse_columns()).first()["n_null_pred"] == 0
    mu, _ = global_mean(train)
    assert best_lambda(sweep_bias(train, test, [0.0, 1.0], mu)).first()["rmse"] is not None


def test_null_cells_are_observed_on_the_write(spark):
    from biasfit.operators.diagnostics import null_cells_by_column
    from biasfit.operators.sampling import prepare

    facts = spark.createDataFrame([(1, 10, 5.0), (None, None, 3.0), (2, None, None), (2, 10, float("nan"))], RATINGS)
    for df in (facts, facts.where("false"), facts.repartition(3)):
        got = prepare(df, "nulls", "rating", {}, keys=("movieId", "userId"))
        assert got.nulls == {r["column"]: r["n_null"] for r in null_cells_by_column(df).collect()}
        assert got.n_rows == df.count()
    assert got.nulls == {"userId": 1, "movieId": 2, "rating": 1}


def test_null_rating_makes_everything_null(spark):
    train = spark.createDataFrame([(1, 10, None), (1, 20, 3.0), (2, 10, 4.0)], RATINGS)
    m = fit_bias(train, 1.0)
    assert m.mu is None
    assert predict_bias(train, m).where("pred is not null").count() == 0


def test_a_flag_missing_in_one_row_is_rejected(spark):
    rows = [(4.0, 0.0, 0.0, 1, 1.0, 0.0, 1, 1.0, 0.0), (2.0, 0.0, 0.0, 0, 1.0, 0.0, None, 1.0, 0.0)]
    t = spark.createDataFrame(rows, "rating DOUBLE, b_i DOUBLE, b_u DOUBLE, a INT, a_up DOUBLE, a_down DOUBLE, "
                                    "b INT, b_up DOUBLE, b_down DOUBLE")
    sel = forward_select(t, ["a", "b"], 3.0)
    assert sel.kept == ["a"] and math.isnan(sel.steps[1]["rmse"]) and sel.steps[1]["decision"] == "reject"


def test_equal_rmse_is_not_kept(spark):
    t = spark.createDataFrame([(4.0, 0.0, 0.0, 1, 0.0, 0.0)], "rating DOUBLE, b_i DOUBLE, b_u DOUBLE, a INT, a_up DOUBLE, a_down DOUBLE")
    assert forward_select(t, ["a"], 3.0).kept == []


@pytest.mark.parametrize("values", [
    [10.0 ** (k / 10 - 150) for k in range(3000)], [1.0] * 500 + [2.0] * 500, [-(2.0 ** k) for k in range(-500, 500)]])
def test_percentiles_of_any_spread(spark, values):
    import numpy as np
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE").repartition(3)
    got = exact_percentiles(df, "v", [0.1, 0.5, 0.9], final_rows=50)[(0,)]
    assert got == pytest.approx(list(np.quantile(values, [0.1, 0.5, 0.9])), rel=1e-12)


def test_nan_takes_no_part_in_strata(spark):
    df = spark.createDataFrame([(float(k),) for k in range(200)] + [(float("nan"),), (None,)], "v DOUBLE")
    assert strata_breaks(df, "v") == [0.0, 49.75, 99.5, 149.25, 199.0]


def test_bad_lines_are_told(spark, tmp_path):
    lines = ["3000000000::1::5::9", "1::2::3.5::7::EXTRA", "1::2", "x::2::3::4", "1::2::::4"]
    (tmp_path / "r.dat").write_text("\n".join(lines) + "\n")
    got = sorted(map(tuple, read_ratings_text(spark, str(tmp_path / "r.dat")).collect()), key=str)
    assert got == sorted([(3000000000, 1, 5.0, 9), (None, 2, 3.0, 4), (1, 2, None, 4)], key=str)
    bad = {r.line: r.reason for r in rejected_ratings(spark, str(tmp_path / "r.dat")).collect()}
    assert bad == {lines[1]: "fields", lines[2]: "fields", lines[3]: "value"}


def test_writers_keep_nulls(spark, tmp_path):
    r = spark.createDataFrame([(1, 10, None, 99), (None, 2, 3.0, None)], RATINGS + ", timestamp LONG")
    write_ratings_text(r, str(tmp_path / "r"))
    assert sorted(read_ratings_text(spark, str(tmp_path / "r")).collect(), key=str) == sorted(r.collect(), key=str)
    i = spark.createDataFrame([(1, None, "A|B"), (2, "T", None)], "movieId LONG, title STRING, genres STRING")
    write_items_text(i, str(tmp_path / "i"))
    assert sorted(map(tuple, read_items_text(spark, str(tmp_path / "i")).collect())) == [(1, "", "A|B"), (2, "T", "")]


def test_selection_with_missing_flags_on_the_tables(spark):
    import duckdb

    import __spark_entry__ as entry
    from conftest import SF001
    con = duckdb.connect()
    for t in ("part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    df = entry.queries()["forward_selection_nulls"](spark, SF001)
    got = {r.flag: tuple(r) for r in df.collect()}
    res = con.execute(entry.oracle_sql()["forward_selection_nulls"])
    assert [d[0] for d in res.description] == df.columns
    want = {r[1]: r for r in res.fetchall()}
    assert got.keys() == want.keys()
    for f, r in got.items():
        assert (r[0], *r[3:]) == (want[f][0], *want[f][3:]) and r[2] == pytest.approx(want[f][2], abs=2e-6)
    missing = [r for r in got.values() if r[2] is None]
    assert len(missing) == (len(got) + 1) // 2 and all(r[3] == "reject" for r in missing)
    assert any(r[3] == "include" for r in got.values())


WIDE = [0.0, -0.0, math.inf, -math.inf, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308,
        1.0, math.nextafter(1.0, 0), math.nextafter(1.0, 2), -1.0, 8.0, math.nextafter(8.0, 0), 1e-300, 1e300, -1e-300, 3.0, 0.1]


def test_image_is_the_ordered_bit_pattern(spark):
    import random

    from biasfit.operators.order_stats import image_of, with_image
    rng = random.Random(4)
    vals = WIDE + [rng.choice([-1, 1]) * 2.0 ** rng.randint(-1074, 1023) * rng.choice([1.0, 1.0, rng.random() + 1]) for _ in range(3000)]
    vals = [v for v in vals if math.isfinite(v)] + [math.inf, -math.inf]
    got = with_image(spark.createDataFrame([(v,) for v in vals], "v DOUBLE"), "v", "i").collect()
    assert all(r.i == image_of(r.v + 0.0) for r in got)
    by = sorted({(r.v, r.i) for r in got})
    assert all(a[1] < b[1] for a, b in zip(by, by[1:]) if a[0] < b[0])


@pytest.mark.parametrize("final_rows", [5, 1])
def test_at_most_six_passes_for_any_spread(spark, final_rows):
    import numpy as np
    rng = np.random.default_rng(8)
    sign = np.where(rng.random(4000) < 0.3, -1.0, 1.0)
    vals = list(sign * 10.0 ** rng.uniform(-300, 300, 4000)) + [0.0, -0.0] * 50 + [math.inf] * 3 + [-math.inf] * 2 + [7.5] * 700
    vals += [1e-300, math.nextafter(1e-300, 1), 1e300, math.nextafter(1e300, 0)] * 5
    df = spark.createDataFrame([(float(v),) for v in vals], "v DOUBLE").repartition(4)
    ranks = [0.001, 0.2, 0.25, 0.37, 0.5, 0.61, 0.9, 0.999]
    info: dict = {}
    got = exact_percentiles(df, "v", ranks, final_rows=final_rows, info=info)[(0,)]
    assert got == pytest.approx(list(np.quantile(vals, ranks)), rel=1e-12)
    assert 1 <= info["passes"] <= 6


def test_outlier_points_of_the_box_plots(spark):
    import numpy as np

    from biasfit.operators.diagnostics import boxplot_outliers, boxplot_stats
    rng = np.random.default_rng(2)
    rows = [(float(v), int(a), None if i % 9 == 0 else int(b)) for i, (v, a, b) in enumerate(
        zip(rng.standard_t(2, 1500), rng.integers(0, 2, 1500), rng.integers(0, 2, 1500)))]
    df = spark.createDataFrame(rows + [(None, 1, 1), (float("nan"), 0, 1)], "resid DOUBLE, a INT, b INT")
    stats = boxplot_stats(df, ["a", "b"])
    got = sorted(map(tuple, boxplot_outliers(df, stats, ["a", "b"]).collect()))
    want = []
    for k, f in ((1, "a"), (2, "b")):
        for lvl in (0, 1):
            x = np.array([r[0] for r in rows if r[k] == lvl])
            q1, q3 = np.quantile(x, [0.25, 0.75])
            want += [(f, lvl, v) for v in x if v < q1 - 1.5 * (q3 - q1) or v > q3 + 1.5 * (q3 - q1)]
    assert got == sorted(want)
    counts = {(r.flag, r.level): r.n_outliers for r in stats.collect()}
    assert sum(counts.values()) == len(got) > 20
