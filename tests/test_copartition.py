"""Layout by user: repeated joins without an exchange, hot users split."""

import pytest
from pyspark.sql import functions as F

from biasfit.operators.copartition import Placement
from biasfit.operators.effects import predict_flags, user_flag_effects
from biasfit.operators.joins import JoinPolicy, keyed_join, place_cols
from biasfit.plans.analysis import RatingsPipeline
from biasfit.plans.catalog import analysis

from conftest import SF001

FACTS = "userId BIGINT, movieId INT, rating DOUBLE, note MAP<STRING, INT>"


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(df) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning") + plan.count("BroadcastExchange")


def rows(spark):
    hot = [(7, i, float(i % 5), {"a": i}) for i in range(300)]
    none = [(None, i, 1.0, None) for i in range(130)]
    few = [(u, i, 2.0, {}) for u in (0, 1, 2, -1, 99) for i in range(3)]
    return spark.createDataFrame(hot + none + few + few, FACTS)


@pytest.fixture
def placement(spark):
    p = Placement(rows(spark), "userId", 8, JoinPolicy(rows_per_bucket=50))
    yield p
    p.release()


def test_joins_of_placed_tables_move_nothing(spark, placement, no_broadcast):
    facts = rows(spark)
    stats = facts.groupBy("userId").agg(F.sum("rating").alias("s"), F.count(F.lit(1)).alias("n"))
    left = placement.write(placement.place(facts), "facts")
    right = placement.write(placement.copies(stats), "stats")
    for how in ("left", "inner"):
        for null_safe in (True, False):
            got = keyed_join(left, right, "userId", how, null_safe=null_safe)
            assert exchanges(got) == 0
            want = keyed_join(facts, stats, "userId", how, null_safe=null_safe)
            assert exchanges(want) > 0
            cols = ["userId", "movieId", "rating", "s", "n"]
            assert got.count() == want.count()
            assert got.select(cols).exceptAll(want.select(cols)).count() == 0
    # a chain of joins and projections stays in place
    again = keyed_join(keyed_join(left, right, "userId", null_safe=True), right.withColumnsRenamed({"s": "s2", "n": "n2"}),
                       "userId", null_safe=True)
    assert exchanges(again) == 0 and again.where("s2 <=> s AND n2 = n").count() == facts.count()
    assert keyed_join(left, right, "userId", "left_anti").select("userId").distinct().collect()[0][0] is None
    assert keyed_join(left, right, "userId", "left_semi").columns == left.columns


def test_hot_and_missing_users_are_split(spark, placement):
    placed = placement.place(rows(spark))
    parts = {r["userId"]: r["n"] for r in placed.groupBy("userId").agg(F.countDistinct("_part_userId").alias("n")).collect()}
    assert parts[7] == 6 and parts[None] == 3 and parts[0] == parts[99] == 1
    assert placed.groupBy("_at_userId", "_part_userId").count().agg(F.max("count")).first()[0] < 100
    # user 0 and the missing user share no place
    assert placed.where("userId = 0 AND _part_userId < 0 OR userId IS NULL AND _part_userId >= 0").count() == 0


def test_empty_table_and_keys_of_other_types(spark):
    none = spark.createDataFrame([], FACTS)
    p = Placement(none, "userId", 4)
    left = p.write(p.place(none), "none")
    assert left.count() == 0 and keyed_join(left, p.write(p.copies(none.select("userId")), "nostats"), "userId").count() == 0
    p.release()
    with pytest.raises(ValueError, match="integers or strings"):
        Placement(none, "rating", 4)
    names = spark.createDataFrame([("0", 1), (None, 2), ("", 3)], "userId STRING, x INT")
    p = Placement(names, "userId", 4)
    own = p.copies(names.select("userId", F.col("x").alias("y")))
    got = keyed_join(p.place(names), own, "userId", null_safe=True).collect()
    assert sorted((r["x"], r["y"]) for r in got) == [(1, 1), (2, 2), (3, 3)]


def test_analysis_laid_out_by_user(spark, no_broadcast):
    """Same result, and no join with users moves a row of the facts."""
    p0 = analysis(spark, SF001)
    p = analysis(spark, SF001, user_buckets=8, policy=JoinPolicy(rows_per_bucket=60))
    assert p.layout.n_hot > 0
    assert p.best_bias == pytest.approx(p0.best_bias, abs=1e-12)
    users, flags = p.joined_model.users, p.joined_flag_stats
    assert users.count() > p.bias_model.users.count()                     # hot users: a line for every part
    for rows in (p.train, p.test, p.part("validation"), p.train_residuals):
        assert exchanges(keyed_join(rows, users.select("userId", F.col("b_u").alias("_b"), *place_cols("userId")), "userId",
                                    null_safe=True)) == 0
    placed = p.train_residuals.select("userId", *place_cols("userId"), *p.cfg.screen, "rating", "b_i", "b_u")
    assert exchanges(predict_flags(placed, p.mu, user_flag_effects(flags, p.cfg.screen, 30.0), p.cfg.screen)) == 0
    assert p.selection.kept == p0.selection.kept
    assert p.best_flag == pytest.approx(p0.best_flag, abs=1e-12)
    assert p.final_score().first()["rmse"] == pytest.approx(p0.final_score().first()["rmse"], abs=1e-12)
    p.release()
    assert not p.layout.tables
    with pytest.raises(ValueError, match="stages"):
        RatingsPipeline(spark, p.facts, p.cfg, stages=object())
