"""Data-quality counts, previews and residual distribution summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from biasfit.functions.literals import dlit
from biasfit.operators.order_stats import bucket_sql, linear, radix, ranked_values, type7_ranks, with_image


def null_cells(df: DataFrame) -> DataFrame:
    """Total NULL cells of the table: one row ``n_null``."""
    total = None
    for c in df.columns:
        e = F.count(F.when(F.col(c).isNull(), 1))
        total = e if total is None else total + e
    return df.agg(total.cast("bigint").alias("n_null"))


def null_cells_by_column(df: DataFrame) -> DataFrame:
    """``column, n_null`` for every column, from a single aggregate."""
    wide = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(f"_n{i}") for i, c in enumerate(df.columns)])
    items = [F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").cast("bigint").alias("n_null"))
             for i, c in enumerate(df.columns)]
    return wide.select(F.explode(F.array(*items)).alias("_x")).select("_x.column", "_x.n_null")


def null_counters(columns: Sequence[str]) -> list[Column]:
    """Aggregates for ``DataFrame.observe``: NULL cells by column, counted while
    the rows pass by on their way to a write."""
    return [F.count(F.when(F.col(c).isNull(), 1)).alias(f"null_{c}") for c in columns]


def counted_nulls(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    """``column, n_null`` from counts that were observed."""
    return spark.createDataFrame(list(counts.items()), "column STRING, n_null BIGINT")


def row_counts(df: DataFrame, by: str) -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"))


def preview(df: DataFrame, order: Sequence[str], n: int = 6) -> DataFrame:
    """First ``n`` rows in a total order (a top-k, not a full sort)."""
    return df.orderBy(*order).limit(n)


def unpivot_flags(df: DataFrame, flags: Sequence[str], value: str) -> DataFrame:
    """``flag, level, value`` rows: one per (row, flag)."""
    items = [F.struct(F.lit(f).alias("flag"), F.col(f).cast("int").alias("level")) for f in flags]
    return df.select(F.col(value).alias("value"), F.explode(F.array(*items)).alias("_x")).select(
        "_x.flag", "_x.level", "value")


BINS = 4096
LEVELS = (0, 1)


def _level_counts(flags: Sequence[str]) -> list:
    return [F.count(F.when(F.col(f) == v, 1)).alias(f"{f}__{v}") for f in flags for v in LEVELS]


def flag_quantiles(df: DataFrame, flags: Sequence[str], value: str, probs: Sequence[float],
                   final_rows: int = 10_000) -> dict[tuple[str, int], tuple[int, list[float]]]:
    """``{(flag, level): (n, type-7 quantiles)}`` of the rows at each level of each 0/1 flag.

    One histogram over the images of the values (see ``order_stats``) counts
    every (flag, level) in its own column, so rows are not repeated by flag;
    only rows of the buckets that hold a wanted rank are, for the exact search
    among them.
    """
    d = df.where(F.col(value).isNotNull() & ~F.isnan(value)).select(F.col(value).alias("value"), *flags)
    lo, hi = d.agg(F.min("value"), F.max("value")).first()
    if lo is None:
        return {}
    shift, base = radix(lo, hi, BINS)
    bucket = F.expr(bucket_sql("value", dlit(lo), dlit(linear(lo, hi, BINS)), str(shift), f"{base}L", BINS))
    d = with_image(d, "value").select("value", *flags, bucket.alias("_b"))
    hist = d.groupBy("_b").agg(F.min("value").alias("_mn"), F.max("value").alias("_mx"),
                                             *_level_counts(flags)).orderBy("_b").toArrow().to_pylist()   # at most 2 BINS rows
    plan, ranks, bounds, wanted = {}, {}, {}, set()
    for f in flags:
        for v in LEVELS:
            col = f"{f}__{v}"
            n = sum(r[col] for r in hist)
            if n == 0:
                continue
            pl = plan[(f, v)] = [type7_ranks(n, p) for p in probs]
            for rank in {r for a, b, _w in pl for r in (a, b)}:
                before = 0
                for r in hist:
                    if before + r[col] > rank:
                        break
                    before += r[col]
                ranks.setdefault((f, v), []).append(rank)
                bounds[(f, v, rank)] = (rank - before, r["_mn"], r["_mx"], r[col])
                wanted.add(r["_b"])
    near = unpivot_flags(d.where(F.col("_b").isin(sorted(wanted))), flags, "value").where(F.col("level").isNotNull())
    at = ranked_values(near, "value", ["flag", "level"], bounds, final_rows=final_rows)
    out = {}
    for g, pl in plan.items():
        qs = []
        for a, b, w in pl:
            x, y = at[(*g, a)], at[(*g, b)]
            qs.append(x if w == 0 else x + w * (y - x))
        out[g] = (sum(r[f"{g[0]}__{g[1]}"] for r in hist), qs)
    return out


def boxplot_stats(df: DataFrame, flags: Sequence[str], value: str = "resid", coef: float = 1.5) -> DataFrame:
    """Per flag and level: ``n, q1, median, q3, whisker_low, whisker_high, n_outliers``.

    Quartiles are exact type-7 (radix selection, no group gathered in one
    task); whiskers are the most extreme values within ``coef * IQR`` of the
    hinges; outliers lie beyond.  Rows with a NULL flag are left out.  Flags go
    in chunks, whose aggregates stay under the whole-stage-codegen field limit.
    """
    v = F.col(value)
    rows = df.where(v.isNotNull() & ~F.isnan(v))
    stats = {}
    for i in range(0, len(flags), COUNTED):
        stats |= flag_quantiles(df, list(flags[i:i + COUNTED]), value, [0.25, 0.5, 0.75])
    parts = []
    for some in (list(stats.items())[i:i + WHISKERS] for i in range(0, len(stats), WHISKERS)):
        aggs, cells = [], []
        for k, ((f, lvl), (n, (q1, q2, q3))) in enumerate(some):
            at = F.col(f) == lvl
            inside = (v >= F.lit(q1 - coef * (q3 - q1))) & (v <= F.lit(q3 + coef * (q3 - q1)))
            aggs += [F.min(F.when(at & inside, v)).alias(f"_lo{k}"), F.max(F.when(at & inside, v)).alias(f"_hi{k}"),
                     F.count(F.when(at & ~inside, 1)).alias(f"_out{k}")]
            cells.append(F.struct(
                F.lit(f).alias("flag"), F.lit(lvl).alias("level"), F.lit(q1).alias("q1"), F.lit(q2).alias("median"),
                F.lit(q3).alias("q3"), F.lit(n).cast("bigint").alias("n"), F.col(f"_lo{k}").alias("whisker_low"),
                F.col(f"_hi{k}").alias("whisker_high"), F.col(f"_out{k}").alias("n_outliers")))
        parts.append(rows.agg(*aggs).select(F.inline(F.array(*cells))))
    if not parts:
        return df.sparkSession.createDataFrame([], BOX_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def boxplot_outliers(df: DataFrame, stats: DataFrame, flags: Sequence[str], value: str = "resid", coef: float = 1.5) -> DataFrame:
    """``flag, level, value``: every point beyond the whiskers of ``stats``.

    ``stats`` is :func:`boxplot_stats` of the same rows: at most two rows per
    flag, which become conditions; a row is repeated only for the flags at
    whose level it lies outside.  The result grows with the data: write it."""
    fences = {}
    for r in stats.select("flag", "level", "q1", "q3").collect():
        fences[(r["flag"], r["level"])] = (r["q1"] - coef * (r["q3"] - r["q1"]), r["q3"] + coef * (r["q3"] - r["q1"]))
    v = F.col(value)
    cells = []
    for f in flags:
        out = F.lit(False)
        for lvl in LEVELS:
            if (f, lvl) in fences:
                lo, hi = fences[(f, lvl)]
                out = out | ((F.col(f) == lvl) & ((v < F.lit(lo)) | (v > F.lit(hi))))
        cells.append(F.when(out, F.struct(F.lit(f).alias("flag"), F.col(f).cast("int").alias("level"))))
    rows = df.where(v.isNotNull() & ~F.isnan(v))
    return rows.select(F.explode(F.filter(F.array(*cells), lambda x: x.isNotNull())).alias("_x"), v.alias("value")).select(
        "_x.flag", "_x.level", "value")


#: Flags counted in one histogram and (flag, level) cells in one whisker
#: aggregate: below the codegen field limit.
COUNTED, WHISKERS = 40, 30
BOX_SCHEMA = ("flag STRING, level INT, q1 DOUBLE, median DOUBLE, q3 DOUBLE, n BIGINT, whisker_low DOUBLE, "
              "whisker_high DOUBLE, n_outliers BIGINT")
