"""Exact stratified sample and leak-free hold-outs: definition, properties, metamorphic checks."""

import math

import pytest
from pyspark.sql import functions as F

from biasfit.operators.sampling import (ROW_ID, STRATUM, anti_join_all, assign_holdout_roles, exact_stratified_sample,
                                        semi_join_keys, strata_breaks, window_stratified_sample, written_rows)
from biasfit.sources.testdata import KEY_COLS, TIE_COLS, TestdataViews

from conftest import SF001, SF01


@pytest.fixture(scope="module")
def ratings(spark):
    return TestdataViews(spark, SF01).ratings().persist()


def test_breaks_match_fixture(ratings):
    assert strata_breaks(ratings, "rating") == [0.5, 1.5, 2.5, 3.0, 5.0]


def test_scalable_sample_equals_window_definition(ratings):
    a = exact_stratified_sample(ratings, "rating", 0.1, "1", KEY_COLS, TIE_COLS)
    b = window_stratified_sample(ratings, "rating", 0.1, "1", KEY_COLS, TIE_COLS)
    sa = a.where("sampled").drop("sampled")
    sb = b.where("sampled").drop("sampled")
    assert sa.count() == 6002
    assert sa.exceptAll(sb).count() == 0 and sb.exceptAll(sa).count() == 0


def test_refinement_pass_gives_same_sample(ratings):
    """Force the histogram refinement (tiny final_rows) and compare."""
    a = exact_stratified_sample(ratings, "rating", 0.1, "7", KEY_COLS, TIE_COLS, final_rows=50)
    b = exact_stratified_sample(ratings, "rating", 0.1, "7", KEY_COLS, TIE_COLS)
    assert a.where("sampled").exceptAll(b.where("sampled")).count() == 0


def test_exact_size_per_stratum_and_fixture_counts(ratings):
    s = exact_stratified_sample(ratings, "rating", 0.1, "1", KEY_COLS, TIE_COLS, keep_stratum=True)
    rows = s.groupBy(STRATUM).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("sampled"), 1)).alias("k"))
    got = {r[STRATUM]: (r["n"], r["k"]) for r in rows.collect()}
    for n, k in got.values():
        assert k == math.ceil(n * 0.1)
    assert [got[i][1] for i in (1, 2, 3, 4)] == [1852, 2118, 909, 1123]


def test_sample_independent_of_partitioning(ratings):
    a = exact_stratified_sample(ratings, "rating", 0.1, "3", KEY_COLS, TIE_COLS).where("sampled")
    b = exact_stratified_sample(ratings.repartition(13), "rating", 0.1, "3", KEY_COLS, TIE_COLS).where("sampled")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_duplicate_key_tie_break_sf0001(spark):
    """sf0.001 has one duplicated key 4-tuple: tie columns keep the size exact."""
    r = TestdataViews(spark, SF001).ratings()
    a = exact_stratified_sample(r, "rating", 0.1, "1", KEY_COLS, TIE_COLS).where("sampled")
    b = window_stratified_sample(r, "rating", 0.1, "1", KEY_COLS, TIE_COLS).where("sampled")
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0


def test_single_value_target_is_one_stratum(spark):
    df = spark.range(95).select(F.col("id"), F.lit(4.0).alias("rating"))
    s = exact_stratified_sample(df, "rating", 0.1, "1", ["id"], ["id"])
    assert s.where("sampled").count() == 10


def test_holdout_properties(ratings):
    s = exact_stratified_sample(ratings, "rating", 0.1, "1", KEY_COLS, TIE_COLS)
    r = assign_holdout_roles(s, "sampled", orphan="return", held_role="validation", rest_role="pool")
    train, held = r.where("role = 'pool'"), r.where("role = 'validation'")
    # multiset: train + held = input
    assert r.drop("role", "sampled").exceptAll(ratings).count() == 0
    assert r.count() == ratings.count()
    # held keys are known to train
    for k in ("movieId", "userId"):
        assert held.select(k).subtract(train.select(k)).count() == 0


def test_orphans_returned_or_dropped(spark):
    df = spark.createDataFrame(
        [(1, 10, True), (1, 20, False), (2, 10, False), (3, 30, True), (3, 30, True), (None, 20, True)],
        "userId INT, movieId INT, sampled BOOLEAN")
    ret = {tuple(r) for r in assign_holdout_roles(df, "sampled", orphan="return").collect()}
    assert (1, 10, True, "held") in ret            # both keys known
    assert (3, 30, True, "rest") in ret            # orphan user/item returned
    assert (None, 20, True, "rest") in ret         # NULL user unknown -> returned
    drop = assign_holdout_roles(df, "sampled", orphan="drop")
    assert drop.where("role = 'dropped'").count() == 3   # both orphan copies and the NULL-key row


def test_literal_composition_equals_roles(spark):
    """semi, semi, null-safe anti join, union (the reference's steps) == one role pass."""
    df = spark.createDataFrame(
        [(1, 10, "a", True), (1, 20, None, False), (2, 10, "b", False), (3, 30, None, True), (3, 30, None, True),
         (2, 20, None, True)],
        "userId INT, movieId INT, genres STRING, sampled BOOLEAN")
    rest, temp = df.where("NOT sampled"), df.where("sampled")
    validation = semi_join_keys(temp, rest)
    removed = anti_join_all(temp, validation)
    pool = rest.unionByName(removed)
    roles = assign_holdout_roles(df, "sampled", orphan="return")
    assert pool.exceptAll(roles.where("role = 'rest'").drop("role")).count() == 0
    assert roles.where("role = 'rest'").drop("role").exceptAll(pool).count() == 0
    assert validation.exceptAll(roles.where("role = 'held'").drop("role")).count() == 0


def test_anti_join_removes_every_copy_null_safe(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k INT, g STRING")
    b = spark.createDataFrame([(1, None)], "k INT, g STRING")
    assert sorted(tuple(r) for r in anti_join_all(a, b).collect()) == [(2, "x")]


@pytest.mark.parametrize("p", [0.1, 0.3, 0.5, 0.7])
def test_identical_copies_straddling_the_threshold(spark, p):
    """A run of identical rows (a third of the data) around the cut: exactly
    ceil(n*p) rows, same multiset as the window definition, no copy-sized window."""
    rows = [(i, 4.0) for i in range(200)] + [(7, 4.0)] * 100
    df = spark.createDataFrame(rows, "id INT, rating DOUBLE").repartition(5)
    a = exact_stratified_sample(df, "rating", p, "s", ["id"], ["id"], final_rows=5).where("sampled")
    b = window_stratified_sample(df, "rating", p, "s", ["id"], ["id"]).where("sampled")
    assert a.count() == math.ceil(300 * p)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_all_rows_identical(spark):
    df = spark.createDataFrame([(1, 4.0)] * 300, "id INT, rating DOUBLE")
    a = exact_stratified_sample(df, "rating", 0.1, "s", ["id"], ["id"], final_rows=5)
    assert a.where("sampled").count() == 30


def test_cut_by_number_needs_no_join(spark):
    """No tie at the cut: the sample is a predicate on the rating and the order key."""
    rows = written_rows(spark.range(500).select("id", F.lit(4.0).alias("rating")), "rows")
    s = exact_stratified_sample(rows, "rating", 0.1, "1", ["id"], ["id"], row_id=ROW_ID).where("sampled")
    plan = s._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    assert s.count() == 50


def test_copies_cut_by_their_place_in_the_file(spark):
    df = spark.createDataFrame([(i, 4.0) for i in range(50)] + [(7, 4.0)] * 100, "id INT, rating DOUBLE").repartition(4)
    rows = written_rows(df, "copies")
    for p in (0.2, 0.5, 0.8):
        s = exact_stratified_sample(rows, "rating", p, "s", ["id"], ["id"], final_rows=5, row_id=ROW_ID).where("sampled")
        first = {(r["_file"], r["_row"]) for r in s.collect()}
        assert len(first) == math.ceil(150 * p)
        again = s.sparkSession.createDataFrame(s.repartition(3).collect(), s.schema)
        assert {(r["_file"], r["_row"]) for r in again.collect()} == first


@pytest.mark.parametrize("kind", ["discrete", "continuous", "mixed"])
def test_one_path_for_all_targets(spark, kind):
    """Brackets, searches within them and smaller strata than the hash bracket
    expects all give the window definition's sample."""
    import numpy as np
    rng = np.random.default_rng(6)
    n = 20_000
    vals = {"discrete": rng.integers(1, 11, n) / 2, "continuous": rng.lognormal(0, 3, n),
            "mixed": np.where(rng.random(n) < 0.7, 3.0, rng.normal(3, 1e-7, n))}[kind]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)] + [(-1, None), (-2, float("nan"))], "id INT, rating DOUBLE").repartition(4)
    a = exact_stratified_sample(df, "rating", 0.1, "s", ["id"], ["id"]).where("sampled")
    b = window_stratified_sample(df, "rating", 0.1, "s", ["id"], ["id"]).where("sampled")
    assert a.count() == b.count() > 1990
    assert a.exceptAll(b).count() == 0
    assert strata_breaks(df, "rating") == sorted(set(np.quantile(vals, [0, 0.25, 0.5, 0.75, 1.0])))


def test_wrong_brackets_change_nothing(spark):
    """Brackets only guide the pass: its exact counts decide."""
    df = spark.range(3000).selectExpr("id", "CAST(id % 97 AS DOUBLE) AS rating")
    want = exact_stratified_sample(df, "rating", 0.2, "s", ["id"], ["id"]).where("sampled")
    for bounds, total in (([1.0, 1.0, 2.0, 2.0, 96.0, 96.0], 3000), ([-5.0, -4.0, 500.0, 600.0, 20.0, 70.0], 10), (None, 10 ** 9)):
        got = exact_stratified_sample(df, "rating", 0.2, "s", ["id"], ["id"], bounds=bounds, total=total).where("sampled")
        assert got.exceptAll(want).count() == 0 and got.count() == want.count()
