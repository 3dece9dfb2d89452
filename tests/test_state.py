"""Merged states and sketched hot keys."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from biasfit.operators import state as ST
from biasfit.operators.effects import user_flag_stats
from biasfit.operators.joins import JoinPolicy, hot_keys, keyed_join

ROWS = "userId LONG, movieId LONG, rating DOUBLE"


def test_lots_merge_to_the_whole(spark):
    rng = np.random.default_rng(1)
    rows = [(int(u) if u else None, int(m) if m else None, float(r)) for u, m, r in
            zip(rng.integers(0, 9, 400), rng.integers(0, 6, 400), rng.integers(1, 11, 400) / 2)]
    a, b = spark.createDataFrame(rows[:250], ROWS), spark.createDataFrame(rows[250:], ROWS)
    whole = ST.state(a.unionByName(b), ["userId", "movieId"], "rating")
    merged = ST.merge(ST.state(a, ["userId", "movieId"], "rating"), ST.state(b, ["userId", "movieId"], "rating"))
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, merged.collect()), key=str)
    assert ST.mean_of(whole) == (pytest.approx(np.mean([r[2] for r in rows])), 400)


def test_missing_ratings_come_and_go(spark):
    s = lambda *rows: ST.state(spark.createDataFrame(list(rows), ROWS), "movieId", "rating")          # noqa: E731
    base, bad = s((1, 1, 4.0), (1, None, 2.0)), s((2, 1, None), (2, 3, float("nan")), (4, 5, 1.0))
    both = ST.merge(base, bad)
    assert ST.mean_of(both) == (None, 5)
    eff = {r.movieId: r.b_i for r in ST.item_effects(both, 3.0, 1.0).collect()}
    assert eff == {1: None, None: -0.5, 3: None, 5: -1.0}
    back = ST.merge(both, ST.withdrawn(bad))
    assert {r.movieId: (r.b_i, r.n_i) for r in ST.item_effects(back, 3.0, 1.0).collect()} == {1: (0.5, 1), None: (-0.5, 1)}
    assert ST.mean_of(ST.merge(base, ST.withdrawn(base))) == (None, 0)


def test_many_flags_go_in_several_aggregates(spark):
    rng = np.random.default_rng(2)
    flags = [f"g{i}" for i in range(30)]
    rows = [(int(u) if u else None, float(e), *map(int, f)) for u, e, f in
            zip(rng.integers(0, 4, 200), rng.normal(size=200), rng.integers(0, 2, (200, 30)))]
    df = spark.createDataFrame(rows, "userId LONG, resid DOUBLE, " + ", ".join(f"{f} INT" for f in flags))
    stats = {r.userId: r for r in user_flag_stats(df, flags).collect()}
    states = {(r.userId, r.flag, r.level): r for r in ST.flag_states(df, flags).collect()}
    assert set(stats) == {r[0] for r in rows}
    for u in stats:
        for k, f in enumerate(flags):
            for lvl in (0, 1):
                e = [r[1] for r in rows if r[0] == u and r[2 + k] == lvl]
                assert stats[u][f"{f}__n{lvl}"] == len(e)
                if e:
                    assert stats[u][f"{f}__s{lvl}"] == pytest.approx(sum(e)) == states[(u, f, lvl)].total


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_join_salted_from_the_sketch(spark, how, null_safe):
    fact = spark.createDataFrame([(k, i) for i in range(400) for k in (1, 1, 1, 2, 3, None, i)], "k INT, i INT").repartition(5)
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n"), (4, "d"), (77, "e")], "k INT, v STRING")
    hot = hot_keys(fact, "k", JoinPolicy(rows_per_bucket=100))
    found = {r[0]: r[1] for r in hot.collect()}
    assert found == {1: 13, 2: 5, 3: 5}
    got, want = keyed_join(fact, dim, "k", how, null_safe=null_safe, hot=hot), keyed_join(fact, dim, "k", how, null_safe=null_safe)
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_hot_rows_are_spread(spark):
    fact = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    hot = hot_keys(fact, "k", JoinPolicy(rows_per_bucket=300))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = keyed_join(fact, spark.range(9000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")), "k", "left", hot=hot)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 9000 and max(sizes) < 9000 / 2
