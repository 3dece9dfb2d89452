"""Rating-model views over the driver's TPC-H-like parquet tables.

The tables hold no ratings, so a fixed mapping turns them into one:

* user   = ``orders.o_custkey`` of the line's order
* item   = ``lineitem.l_partkey``; title ``p_name``; tags = ``p_type`` and the
  words of ``p_name``, joined by ``|``
* rating = a deterministic function of the line with planted structure
  (item, user and PROMO-by-user-parity effects), on the 0.5 .. 5.0 scale
* row identity for sampling: the line's key columns, then the rest of the
  line as tie-break (lines are unique as whole rows).
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from biasfit.operators.joins import DEFAULT_POLICY, JoinPolicy, hot_keys, keyed_join

# Columns hashed to order rows for sampling, and the tie-break order after it.
KEY_COLS = ("l_orderkey", "l_linenumber", "movieId", "l_suppkey")
TIE_COLS = ("l_orderkey", "l_linenumber", "movieId", "l_suppkey", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "timestamp")


def planted_rating(quantity, partkey, custkey, ptype):
    promo = F.when(ptype == F.lit("PROMO"),
                   F.when(custkey % 2 == 0, F.lit(40)).otherwise(F.lit(-40))).otherwise(F.lit(0))
    raw = F.floor((quantity * 2 + (partkey % 7) * 10 + (custkey % 5) * 10 + promo) / 20)
    return (F.least(F.lit(10), F.greatest(F.lit(1), raw)) / 2).cast("double")


def plain_rating(quantity):
    return (F.ceil(quantity / 5) / 2).cast("double")


def epoch_seconds(ts_ntz):
    """Seconds since epoch of a TIMESTAMP_NTZ, independent of the session time zone."""
    return (F.unix_date(ts_ntz.cast("date")).cast("bigint") * 86400
            + F.hour(ts_ntz) * 3600 + F.minute(ts_ntz) * 60 + F.second(ts_ntz)).cast("bigint")


@dataclass
class TestdataViews:
    __test__ = False   # not a pytest class
    spark: SparkSession
    sf_dir: str
    planted: bool = True
    hot_item: bool = False
    policy: JoinPolicy = field(default=DEFAULT_POLICY)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))

    def items(self) -> DataFrame:
        """``movieId, title, genres`` (the item dimension)."""
        return self._parts().drop("p_type")

    def _parts(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("movieId"), "p_type",
            F.col("p_name").alias("title"),
            F.concat_ws("|", F.col("p_type"), F.regexp_replace(F.col("p_name"), " ", "|")).alias("genres"),
        )

    def lines(self) -> DataFrame:
        """The lines; every third one is of part 1 if ``hot_item``."""
        li = self.table("lineitem")
        if self.hot_item:
            li = li.withColumn("l_partkey", F.when(F.col("l_linenumber") % 3 == 0, F.lit(1)).otherwise(F.col("l_partkey")).cast("bigint"))
        return li

    def ratings(self, with_identity: bool = True, item_cols: tuple[str, ...] = ()) -> DataFrame:
        """``userId, movieId, rating, timestamp`` (+ identity and item columns)."""
        li = self.lines().select(
            "l_orderkey", "l_linenumber", F.col("l_partkey").alias("movieId"), "l_suppkey",
            "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
            "l_linestatus", epoch_seconds(F.col("l_shipdate")).alias("timestamp"))
        orders = self.table("orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                             F.col("o_custkey").alias("userId"))
        # two large tables on a unique, unskewed key
        r = li.join(orders, "l_orderkey", "inner")
        # one join with the item table gives the rating's input and, if wanted, the item columns
        items = self._parts()
        if self.planted or item_cols:
            # popular items are the skewed key: listed by a sketch of the one column.  Salted by
            # the line's key alone, so that columns which a query doesn't read aren't moved
            r = keyed_join(r, items.select("movieId", "p_type", *item_cols), "movieId", "left", policy=self.policy,
                           hot=hot_keys(li, "movieId", self.policy), salt_cols=["l_orderkey", "l_linenumber"])
        if self.planted:
            rating = planted_rating(F.col("l_quantity"), F.col("movieId"), F.col("userId"), F.col("p_type"))
        else:
            rating = plain_rating(F.col("l_quantity"))
        cols = ["userId", "movieId", rating.alias("rating"), "timestamp"]
        if with_identity:
            cols += [c for c in TIE_COLS if c not in ("movieId", "timestamp")]
        return r.select(*cols, *item_cols)

    def facts(self, with_identity: bool = True) -> DataFrame:
        """Ratings left-joined with the item dimension (title, genres)."""
        return self.ratings(with_identity, ("title", "genres"))
