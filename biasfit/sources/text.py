"""'::'-delimited text files (the ratings.dat / movies.dat layout).

Both readers split files on executors (no driver-side line reading).  A rating
line must have four fields; an empty field is NULL.  Lines with another number of
fields are left out; a field that doesn't parse is NULL.  ``rejected_ratings``
returns both kinds of line, with the reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from biasfit.schemas import ITEMS_SCHEMA, RATINGS_SCHEMA

DELIM = "::"


def parse_ratings(lines: DataFrame) -> DataFrame:
    """``value`` lines -> typed fields, ``line`` and ``reason`` (NULL for good lines)."""
    parts = F.split(F.col("value"), DELIM, -1)
    text = [F.nullif(F.trim(F.get(parts, F.lit(i))), F.lit("")) for i in range(len(RATINGS_SCHEMA.fields))]
    typed = [t.try_cast(f.dataType) for t, f in zip(text, RATINGS_SCHEMA.fields)]
    unread = F.lit(False)
    for t, c in zip(text, typed):
        unread = unread | (t.isNotNull() & c.isNull())
    reason = F.when(F.size(parts) != len(RATINGS_SCHEMA.fields), "fields").when(unread, "value")
    return lines.select(*[c.alias(f.name) for c, f in zip(typed, RATINGS_SCHEMA.fields)],
                        F.col("value").alias("line"), reason.alias("reason"))


def read_ratings_text(spark: SparkSession, path: str) -> DataFrame:
    """``userId::movieId::rating::timestamp`` lines -> typed ratings, without the
    lines that haven't four fields."""
    return parse_ratings(spark.read.text(path)).where("reason IS DISTINCT FROM 'fields'").drop("line", "reason")


def rejected_ratings(spark: SparkSession, path: str) -> DataFrame:
    """``line, reason`` of the bad lines: ``fields`` (not four of them, left out
    by :func:`read_ratings_text`) or ``value`` (one doesn't parse, NULL there)."""
    return parse_ratings(spark.read.text(path)).where("reason IS NOT NULL").select("line", "reason")


def read_items_text(spark: SparkSession, path: str) -> DataFrame:
    """``movieId::title::genres`` lines -> typed items.

    Splits into at most 3 pieces, the remainder staying in the last one
    (``2::A::B::C`` -> genres ``B::C``); missing pieces become ``''``; an id
    that does not parse becomes NULL.
    """
    p = F.split(F.col("value"), DELIM, 3)
    piece = [F.coalesce(F.get(p, i), F.lit("")) for i in range(3)]
    return spark.read.text(path).select(
        F.trim(piece[0]).try_cast(ITEMS_SCHEMA["movieId"].dataType).alias("movieId"),
        piece[1].alias("title"),
        piece[2].alias("genres"),
    )


def _line(cols: list[Column]) -> Column:
    """Fields joined by the delimiter; a NULL is an empty field."""
    out = []
    for c in cols:
        out += [F.coalesce(c.cast("string"), F.lit("")), F.lit(DELIM)]
    return F.concat(*out[:-1]).alias("value")


def write_ratings_text(df: DataFrame, path: str) -> None:
    df.select(_line([F.col(f.name) for f in RATINGS_SCHEMA.fields])).write.mode("overwrite").text(path)


def write_items_text(df: DataFrame, path: str) -> None:
    df.select(_line([F.col(f.name) for f in ITEMS_SCHEMA.fields])).write.mode("overwrite").text(path)
