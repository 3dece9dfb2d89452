"""Helpers shared by the operators: word rules, written tables, global order."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..operators.bitmaps import MAX_BITS, Layout, segments, with_bits
from ..session import materialize

#: Words are runs of anything but these six characters.
SPACE = " \t\n\x0b\x0c\r"
#: The same class as a Java regular expression.
SPACE_CLASS = r"[\x20\x09-\x0D]"
#: Found in anything that holds a word.
WORD = r"[^\x20\x09-\x0D]"
TMP = "__llm_"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later jobs neither
    recompute it nor depend on the executors that made it."""
    return materialize(df, "table", f"llm-{name}")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    Inside a higher-order function an outer *expression* would be evaluated
    again for each element; a lambda variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Array of words of a text; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), "")


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """Only the named columns, under the operator's own names, so that other
    columns of the input can't clash with the operator's."""
    return df.select(*[df[c].alias(new) for new, c in cols.items()])


def may_be_among(docs: DataFrame, key: Column, keys: DataFrame, flag: str) -> DataFrame:
    """Add boolean ``flag``: false where ``key`` (a hash) is certainly not among
    those of ``keys`` (its one column), by a broadcast bitmap of bounded size.

    Rows that the few keys don't concern can stay where they are; the others,
    false hits included, go on to the exact join."""
    name = TMP + "key"
    layout = {name: Layout(name, None, MAX_BITS)}
    bits = table(segments(keys.toDF(name), layout), "bits")
    return with_bits(docs.withColumn(name, key), bits, layout, flag).drop(name)


def global_index(df: DataFrame, order: Iterable[str], name: str, weight: str | None = None,
                 parts: int | None = None) -> DataFrame:
    """Add the number of rows before each row (or the sum of ``weight`` before
    it) in the global order of ``order``, without a one-task window.

    Rows are range-partitioned by ``order`` (which must be unique), summed per
    partition, and each partition continues from the sum of those before it.
    The sorted rows are written first, so partition numbers can't change
    between the two uses.
    """
    order = list(order)
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    w = F.col(weight) if weight else F.lit(1).cast("long")
    part = TMP + "part"
    placed = table(df.repartitionByRange(parts, *order).withColumn(part, F.spark_partition_id()), "ordered")
    sums = placed.groupBy(part).agg(F.sum(w).alias(TMP + "sum"))
    # one row per partition of a fixed number: bounded
    before = sums.withColumn(TMP + "from", F.coalesce(
        F.sum(TMP + "sum").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    run = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (placed.join(F.broadcast(before.drop(TMP + "sum")), part)
            .withColumn(name, F.coalesce(F.sum(w).over(run), F.lit(0)) + F.col(TMP + "from"))
            .drop(part, TMP + "from"))
