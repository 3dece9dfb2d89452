"""Key bitmaps against plain joins."""

import pytest
from pyspark.sql import functions as F

from biasfit.operators.bitmaps import key_extents, known_keys, layouts
from biasfit.operators.sampling import assign_holdout_roles, mark_known, semi_join_keys
from biasfit.plans.edge_cases import by_order
from biasfit.session import materialize

from conftest import SF01

FACTS = "userId LONG, movieId INT, tag STRING, n INT"
REST = [(1, 10, "a", 1), (2, 11, "b", 2), (-5, 40_000, None, 3), (None, 12, "c", 4), (9_000_000_000, None, "d", 5)] * 3
ASKED = [(1, 10, "a", 1), (1, 13, "a", 2), (3, 10, "x", 3), (None, 12, "c", 4), (None, None, None, 5), (-5, 40_000, None, 6),
         (-6, 10, "a", 7), (9_000_000_000, 11, "d", 8), (9_000_000_001, 11, "d", 9), (2, 39_999, "b", 10), (2, -7, "b", 11)]


def known(rows, keys):
    at = {"userId": 0, "movieId": 1, "tag": 2}
    sets = {k: {r[at[k]] for r in REST} for k in keys}
    return {r[3]: all(r[at[k]] in sets[k] for k in keys) for r in rows}


@pytest.mark.parametrize("keys", [["movieId"], ["userId", "movieId"], ["tag"], ["movieId", "tag", "userId"]])
@pytest.mark.parametrize("max_bits", [1 << 27, 1 << 20, 3])
def test_known_keys(spark, keys, max_bits):
    """Wide ranges, strings and tiny bitmaps (all rows unsettled) by hash, others exactly."""
    rest, asked = spark.createDataFrame(REST, FACTS), spark.createDataFrame(ASKED, FACTS)
    got = known_keys(asked, rest, keys, max_bits=max_bits)
    assert got.columns == asked.columns + ["_known"]
    assert {r.n: r._known for r in got.collect()} == known(ASKED, keys)
    tables = {k: rest.select(k, "n") for k in keys}
    assert {r.n: r._known for r in known_keys(asked, tables, keys, max_bits=max_bits, written=True).collect()} == known(ASKED, keys)


def test_empty_sides(spark):
    rest, asked = spark.createDataFrame(REST, FACTS), spark.createDataFrame(ASKED, FACTS)
    assert known_keys(asked.where("n < 0"), rest, ["userId", "tag"]).count() == 0
    assert known_keys(asked, rest.where("n < 0"), ["movieId", "tag"]).where("_known").count() == 0


def test_range_decides_the_layout(spark):
    rest = spark.createDataFrame(REST, FACTS)
    lay = layouts(key_extents(rest, ["userId", "movieId", "tag"]), rest.schema)
    assert [lay[k].exact for k in ("userId", "movieId", "tag")] == [False, True, False]
    assert (lay["movieId"].low, lay["movieId"].bits) == (10, 39_991)


def shuffled(df):
    """Exchanges that move rows of the side asked about: those above its own columns."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in plan.split("\n") if "Exchange hashpartitioning" in x and ("userId" in x or "movieId" in x)]


def test_held_rows_are_not_shuffled(spark):
    # written first: the joins that make the facts have exchanges of their own
    f = materialize(by_order(spark, SF01).where("movieId is not null"), "table", "by-order")
    rest = f.where("not sampled")
    for df in (semi_join_keys(f.where("sampled"), rest), mark_known(f.where("sampled"), rest)):
        assert not shuffled(df)
    assert shuffled(mark_known(f.where("sampled"), rest, max_bits=64))
    roles = assign_holdout_roles(f, "sampled")
    assert roles.where("sampled").count() == f.where("sampled").count()


def test_unsettled_rows_meet_the_exact_join_with_salt(spark):
    from biasfit.operators.joins import JoinPolicy
    f = by_order(spark, SF01)
    rest, held = f.where("not sampled"), f.where("sampled")
    want = mark_known(held, rest)
    got = mark_known(held, rest, max_bits=1000, total=60_000, policy=JoinPolicy(rows_per_bucket=20, max_hot_keys=500))
    assert want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0
    assert 0 < got.where(F.col("_known")).count() < got.count()
