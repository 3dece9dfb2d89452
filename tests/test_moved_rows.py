"""What the joins and aggregates of the analysis move between tasks."""

import glob
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from biasfit.functions.flags import pack_flags, unpack_flags
from biasfit.operators import state as ST
from biasfit.operators.effects import attach_bias, fit_bias, global_mean, item_stats, user_flag_stats
from biasfit.operators.joins import JoinPolicy, key_counts, keyed_join
from biasfit.operators.sampling import TiesNeeded, exact_stratified_sample
from biasfit.operators.sweep import sweep_bias, sweep_bias_naive
from biasfit.plans import edge_cases
from biasfit.plans.analysis import PipelineConfig, RatingsPipeline
from biasfit.plans.catalog import analysis
from biasfit.session import SHUFFLE_CLEANUP, materialize
from biasfit.sources.testdata import TestdataViews

SF001 = "/root/testdata/sf0.01"
ROWS = "userId LONG, movieId LONG, rating DOUBLE, f INT, g INT"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def wide_partials(df):
    """Exchanges by key above a partial aggregate of more than eight sums."""
    lines = plan(df).splitlines()
    return [a for a, b in zip(lines, lines[1:]) if "hashpartitioning" in a and b.count("partial_sum") > 8]


def rows(spark):
    data = [(u if u else None, (u * 7 + i) % 11 or None, float((u + i) % 9) / 2, (i % 3) or None, (u + i) % 2)
            for u in range(20) for i in range(u % 5 + 3)]
    data += [data[3]] * 3
    return spark.createDataFrame(data, ROWS).withColumn("f", F.col("f") - 1)


def test_sums_of_the_sweep_are_not_moved_half_done(spark):
    df = rows(spark)
    mu, _ = global_mean(df)
    grid = [0.5 * k for k in range(12)]
    got = sweep_bias(df, df, grid, mu)
    assert not wide_partials(got)
    assert [r["rmse"] for r in got.orderBy("lambda").collect()] == pytest.approx([r for _, r in sweep_bias_naive(df, df, grid, mu)], abs=1e-12)
    # an item without a whole sum leaves its users, and the result, without a value
    gone = item_stats(df, mu).withColumn("s_i", F.when(F.col("movieId") != 3, F.col("s_i")))
    assert {r["rmse"] for r in sweep_bias(df, df, grid, mu, stats=gone).collect()} == {None}


def test_sums_of_flag_states_are_not_moved_half_done(spark):
    df = rows(spark).withColumn("resid", F.when(F.col("rating") != 2.5, F.col("rating")))
    got = ST.flag_states(df, ["f", "g"])
    each = [ST.state(df.where(f"{x} is not null").select("userId", F.lit(x).alias("flag"), F.col(x).alias("level"), "resid"),
                     ["userId", "flag", "level"], "resid") for x in ("f", "g")]
    want = each[0].unionByName(each[1])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))
    flags = [f"x{k}" for k in range(12)]
    assert not wide_partials(ST.flag_states(df.select("userId", "resid", *[F.col("g").alias(x) for x in flags]), flags))


def test_flags_are_moved_as_bits(spark):
    df = rows(spark)
    assert sorted(map(str, unpack_flags(pack_flags(df, ["f", "g"]), ["f", "g"], df.columns).collect())) == sorted(map(str, df.collect()))
    model = fit_bias(df, 2.0)
    packed = attach_bias(df, model, flags=["f", "g"])
    plain = attach_bias(df, model)
    assert packed.schema.simpleString() == plain.schema.simpleString()
    assert sorted(map(str, packed.collect())) == sorted(map(str, plain.collect()))
    many = [f"x{k}" for k in range(70)]
    wide = df.select("userId", *[F.when(F.col("f") == 1, F.col("g")).alias(x) for x in many[:-1]], F.col("g").alias(many[-1]))
    assert unpack_flags(pack_flags(wide, many), many, wide.columns).exceptAll(wide).count() == 0


def test_ratings_move_only_what_is_read(spark):
    r = TestdataViews(spark, SF001).ratings().select("userId", "movieId", "rating", "l_orderkey", "l_linenumber")
    assert "l_extendedprice" not in plan(r) and "l_returnflag" not in plan(r)


def test_facts_of_the_edge_cases_are_joined_once(spark):
    train, test = edge_cases._null_parts(spark, SF001)
    for df in (train, test, edge_cases.by_order(spark, SF001)):
        assert "Join" not in plan(df)


def tied(spark, n=240):
    """Rows of which four each share the order key, told apart by ``a`` (and ``timestamp``, the other way round) alone."""
    data = [(i % 12, i % 7, float(i // 4 % 5) / 2, 1000 - i % 4, i // 4, i % 4, "x" if i % 3 else "y") for i in range(n)]
    return spark.createDataFrame(data, "userId LONG, movieId LONG, rating DOUBLE, timestamp LONG, k LONG, a LONG, genres STRING")


def split_of(spark, facts, **kw):
    p = RatingsPipeline(spark, facts, PipelineConfig(flags={"f": "x"}, key_cols=("k",), tie_cols=("k", "a", "timestamp"), p=0.3, **kw))
    return p, sorted(map(str, p.split.select("userId", "movieId", "rating", "timestamp", "k", "f", "role").collect()))


def test_columns_that_only_break_ties_are_not_moved(spark):
    p = analysis(spark, SF001, max_bits=1 << 20)
    assert p.only_ties == ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    p.split
    assert not set(p.only_ties) & set(p.work.columns)
    assert RatingsPipeline(spark, p.facts, PipelineConfig(tie_cols=p.cfg.tie_cols)).only_ties == []


@pytest.mark.parametrize("copies", [1, 3])
def test_ties_at_the_cut_are_broken_all_the_same(spark, copies):
    facts = tied(spark)
    for _ in range(copies - 1):
        facts = facts.unionByName(tied(spark))
    keep = ["userId", "movieId", "rating", "timestamp", "k", "f"]
    p, got = split_of(spark, facts, keep_cols=keep)
    q, want = split_of(spark, facts)
    assert p.only_ties == ["a"] and "a" in p.work.columns       # asked for after all
    assert got == want and p.role_counts == q.role_counts
    s = exact_stratified_sample(facts.drop("a"), "rating", 1.0, "1", ["k"], ["k", "a", "timestamp"], late_ties=True)
    assert s.where("sampled").count() == 240 * copies            # no cut, no ties
    with pytest.raises(TiesNeeded):
        exact_stratified_sample(facts.drop("a"), "rating", 0.3, "1", ["k"], ["k", "a", "timestamp"], late_ties=True)


def test_one_exchange_by_user_serves_join_and_sums(spark):
    p = analysis(spark, SF001, max_bits=1 << 21)
    # neither is a small table of users broadcast, which would leave the rows apart
    assert plan(user_flag_stats(p._residual_rows, p.cfg.screen)).count("hashpartitioning(userId") == 1
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert p.policy.plain == {"userId", "movieId"} and not p.cfg.policy.plain
        text = plan(user_flag_stats(p._residual_rows, p.cfg.screen))
        assert "train_residuals" not in p.__dict__ and "biasfit-residuals" not in text
        assert text.count("hashpartitioning(userId") == 1 and "l_linenumber" not in text
        sweep = plan(p.bias_sweep)
        assert sweep.count("hashpartitioning(userId") == 2 and "_salt" not in sweep           # train and test
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_keys_with_null_or_hot_keys_are_joined_with_care(spark):
    facts = rows(spark).withColumns({"timestamp": F.lit(1), "k": F.monotonically_increasing_id(), "genres": F.lit("x")}).drop("f", "g")
    cfg = PipelineConfig(flags={"f": "x"}, key_cols=("k",), tie_cols=("k",), policy=JoinPolicy(rows_per_bucket=3, max_hot_keys=1000))
    p = RatingsPipeline(spark, facts, cfg)
    assert p.policy.plain == frozenset()
    only = RatingsPipeline(spark, facts.where("userId is not null"), replace(cfg, policy=JoinPolicy()))
    assert only.policy.plain == {"userId"}
    # the same join either way
    left, right = rows(spark).where("userId is not null"), key_counts(rows(spark), "userId")
    a, b = (keyed_join(left, right, "userId", "left", null_safe=True, policy=x) for x in (JoinPolicy(), JoinPolicy(plain=frozenset({"userId"}))))
    assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_written_tables_leave_no_shuffle_files(spark):
    def shuffled():
        dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*")}

    df = spark.range(1000).repartition(3).groupBy(F.col("id") % 7).count()
    old = shuffled()
    sums = materialize(df, "table", "sums", lean=True)
    for _ in range(50):
        if not shuffled() - old:
            break
        time.sleep(0.1)
    assert not shuffled() - old and sums.count() == 7
    assert spark.conf.get(SHUFFLE_CLEANUP, "false") == "false"
