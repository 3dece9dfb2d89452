"""Tables kept side by side by one key, so that repeated joins move no row.

A :class:`Placement` gives every row two plain columns, ``_at_<key>`` (the key,
or a stand-in where it is missing) and ``_part_<key>`` (below zero for a
missing key), and writes tables bucketed by both.  Facts and the statistics of
their keys written by the same placement meet bucket by bucket:
:func:`biasfit.operators.joins.keyed_join` joins them by the two columns, which
hold no NULL, without an exchange on either side.

Hot keys stay split.  A key with more than ``rows_per_bucket`` rows, the
missing key included, has its rows in ``ceil(n / rows_per_bucket)`` parts by a
hash of the row, and its line of statistics is written once for every part.
The hot keys are listed by the sketch of ``joins.hot_keys`` (at most ``LISTED``
of them); a wrong estimate only changes the balance.

Defined results: a missing key matches a missing key; repeated rows stay
together and count each; an empty table gives an empty table; keys are
integers or strings; other columns are kept, and those that can't be hashed
(maps) don't take part in the salt.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegralType, MapType, StringType, VariantType

from biasfit.operators.joins import DEFAULT_POLICY, JoinPolicy, hot_keys, place_cols
from biasfit.session import scratch_path, shuffles_removed

_PARTS, _KEY = "_parts", "_placed_key"


class Placement:
    """How rows with one key column are laid out over ``buckets`` buckets."""

    def __init__(self, facts: DataFrame, key: str, buckets: int, policy: JoinPolicy = DEFAULT_POLICY):
        kind = facts.schema[key].dataType
        if not isinstance(kind, (IntegralType, StringType)):
            raise ValueError(f"{key}: keys of a placement are integers or strings, not {kind.simpleString()}")
        self.spark, self.key, self.buckets = facts.sparkSession, key, buckets
        self.at, self.part = place_cols(key)
        self.kind = kind.simpleString()
        listed = [tuple(r) for r in hot_keys(facts, key, policy).collect()]
        missing = facts.where(F.col(key).isNull()).count()
        if missing > policy.rows_per_bucket:
            listed.append((None, math.ceil(missing / policy.rows_per_bucket)))
        self.n_hot = len(listed)
        self.hot = self.spark.createDataFrame(listed, f"{_KEY} {self.kind}, {_PARTS} INT")
        self.tables: list[str] = []

    def _with_parts(self, df: DataFrame) -> DataFrame:
        """``df`` + the number of parts of its row's key."""
        hot = F.broadcast(self.hot)       # at most LISTED + 1 rows
        out = df.join(hot, df[self.key].eqNullSafe(hot[_KEY]), "left").drop(_KEY)
        return out.withColumn(_PARTS, F.coalesce(_PARTS, F.lit(1)))

    def _placed(self, df: DataFrame, salt) -> DataFrame:
        key = F.col(self.key)
        return df.withColumns({self.at: F.coalesce(key, F.lit("0").cast(self.kind)),
                               self.part: F.when(key.isNull(), -1 - salt).otherwise(salt).cast("int")})

    def place(self, facts: DataFrame) -> DataFrame:
        """Facts + the two columns of their place."""
        cols = [f.name for f in facts.schema if not isinstance(f.dataType, (MapType, VariantType))]
        return self._placed(self._with_parts(facts), F.pmod(F.xxhash64(*cols), F.col(_PARTS))).drop(_PARTS)

    def copies(self, stats: DataFrame) -> DataFrame:
        """A table with one row per key, its rows of hot keys once for every part."""
        each = self._with_parts(stats).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col(_PARTS) - 1)))
        return self._placed(each, F.col("_salt")).drop("_salt", _PARTS)

    def write(self, placed: DataFrame, name: str, partition_by: list[str] = ()) -> DataFrame:
        """Write under the shared checkpoint folder, one file per bucket (and
        partition); the catalog's entry only tells readers of the buckets."""
        table = f"biasfit_{name}_{uuid.uuid4().hex[:12]}"
        w = placed.repartition(self.buckets, self.at, self.part).write.option("path", scratch_path(self.spark, name)).option("compression", "zstd")
        if partition_by:
            w = w.partitionBy(*partition_by)
        with shuffles_removed(self.spark):
            w.bucketBy(self.buckets, self.at, self.part).sortBy(self.at, self.part).saveAsTable(table)
        self.tables.append(table)
        return self.spark.table(table)

    def release(self) -> None:
        """Take the tables out of the catalog; files stay like all written tables."""
        for t in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS `{t}`")
        self.tables.clear()
