"""Exact order statistics per group, without gathering a group into one task.

``percentile`` (exact) sorts every value of a group inside one task, and a
window ordered within a group does the same; with a handful of groups over
billions of rows neither scales.  Here the k-th smallest value of a group is
found by radix selection on an image of the values:

1. one aggregate gives ``count, min, max`` per group (or bounds are known);
2. the image of a double is its 64-bit pattern read as an ordered integer, so
   equal steps of the image follow the values whatever their spread.  Each
   pass takes the leading 12 bits in which the ends of a search's range
   differ, and beside them the value's place among equal widths of the range
   (both grow with the value, so together they only cut finer); it counts rows
   per bucket with a partial-aggregated ``groupBy`` (the driver receives at most
   ``2 x searches x bins`` small rows), and goes on in the bucket that holds
   the wanted rank, from its least to its largest value: at most six passes for
   any values, and few rows left after one where they spread evenly;
3. once a range holds at most ``final_rows`` rows (or a single value),
   the few remaining candidates are ranked with ``row_number`` inside their
   search, a window over a bounded set.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

_G0 = "_grp0"
IMAGE = "_img"
_A, _E = "_abs", "_exp"


def image_of(x: float) -> int:
    """The image of a value that :func:`with_image` gives it."""
    bits = struct.unpack("<q", struct.pack("<d", x))[0]
    return bits if bits >= 0 else -(bits & 0x7FFFFFFFFFFFFFFF)


def with_image(df: DataFrame, key: str, name: str = IMAGE) -> DataFrame:
    """Add the order-preserving BIGINT image of a DOUBLE (no NaN; -0 as 0): its
    exponent from a logarithm, put right by comparison, and its mantissa, both
    by exact steps."""
    two = lambda e: f"pow(2.0D, {e})"                                                   # noqa: E731
    d = df.withColumn(_A, F.abs(F.col(key).cast("double")))
    d = d.withColumn(_E, F.expr(f"CASE WHEN {_A} > 0 AND {_A} < double('inf') THEN floor(log2({_A})) ELSE 0L END"))
    d = d.withColumn(_E, F.expr(f"CASE WHEN {_A} = 0 THEN 0L WHEN {_A} < {two(_E)} THEN {_E} - 1 "
                                f"WHEN {_A} >= {two(_E + ' + 1')} THEN {_E} + 1 ELSE {_E} END"))
    size = (f"CASE WHEN {_A} = double('inf') THEN {0x7FF << 52}L "
            f"WHEN {_A} < {two('-1022')} THEN CAST({_A} * {two('537')} * {two('537')} AS BIGINT) "
            f"ELSE ({_E} + 1022) * {1 << 52}L + CAST({_A} / {two(_E)} * {two('52')} AS BIGINT) END")
    return d.withColumn(name, F.expr(f"CASE WHEN `{key}` < 0 THEN -1L ELSE 1L END * ({size})")).drop(_A, _E)


def radix(lo: float, hi: float, bins: int) -> tuple[int, int]:
    """``(shift, base)``: the bucket of ``x`` in [lo, hi] is ``(image >> shift) - base``,
    from 0 to ``bins``; two buckets at least if the ends differ."""
    span = image_of(hi) - image_of(lo)
    shift = max(0, span.bit_length() - max(1, bins.bit_length() - 1))
    return shift, image_of(lo) >> shift


def linear(lo: float, hi: float, bins: int) -> float:
    """Buckets per unit of the value; 0 where they can't be told in doubles."""
    scale = bins / (hi - lo) if hi > lo else 0.0
    return scale if math.isfinite(scale) and math.isfinite(lo) else 0.0


def bucket_sql(x: str, lo: str, scale: str, shift: str, base: str, bins: int) -> str:
    """The bucket of ``x`` by both cuts, ascending with it (needs the image)."""
    width = f"CASE WHEN {scale} = 0 THEN 0L ELSE least({bins - 1}L, floor(({x} - {lo}) * {scale})) END"
    return f"({width}) * {4 * bins}L + (shiftright({IMAGE}, {shift}) - {base})"


@dataclass
class _Search:
    sid: int
    group: tuple
    rank: int          # wanted rank, 0-based, within the rows of [lo, hi]
    lo: float
    hi: float
    cnt: int           # rows of the group inside [lo, hi]
    value: float | None = None
    done: bool = False
    orig: int = -1     # the rank asked for, within the whole group


def _prep(df: DataFrame, key: str, group_cols: Sequence[str]) -> tuple[DataFrame, list[str]]:
    groups = list(group_cols)
    if not groups:
        df = df.withColumn(_G0, F.lit(0))
        groups = [_G0]
    return df.where(F.col(key).isNotNull() & ~F.isnan(F.col(key).cast("double"))), groups


def group_extents(df: DataFrame, key: str, group_cols: Sequence[str], max_groups: int = 100_000):
    """``{group: (n, min, max)}`` of non-null ``key`` values."""
    d, groups = _prep(df, key, group_cols)
    rows = (d.groupBy(*groups)
            .agg(F.count(F.lit(1)).alias("_n"), F.min(key).alias("_lo"), F.max(key).alias("_hi"))
            .limit(max_groups + 1).collect())
    if len(rows) > max_groups:
        raise ValueError(f"more than {max_groups} groups; order statistics need a bounded group count")
    return {tuple(r[g] for g in groups): (r["_n"], float(r["_lo"]), float(r["_hi"])) for r in rows}


def _ranges_frame(d: DataFrame, groups: list[str], rows: list[tuple], extra: Sequence[tuple[str, T.DataType]] = ()):
    fields = [T.StructField("_rid", T.IntegerType(), False)]
    fields += [T.StructField(g, d.schema[g].dataType, True) for g in groups]
    fields += [T.StructField("_lo", T.DoubleType(), False), T.StructField("_hi", T.DoubleType(), False)]
    fields += [T.StructField(n, t, False) for n, t in extra]
    schema = T.StructType(fields)
    names = [f.name for f in fields]
    # by way of Arrow a small table is part of the plan, without a job of its own
    return d.sparkSession.createDataFrame(
        pa.Table.from_pylist([dict(zip(names, r)) for r in rows], schema=to_arrow_schema(schema)), schema)


def _refine(d: DataFrame, key: str, groups: list[str], searches: list[_Search],
            bins: int, final_rows: int, settle_equal: bool, info: dict | None = None) -> None:
    """Narrow every search until it is small (or resolved when ``settle_equal``).

    ``info["passes"]`` counts the histogram passes."""
    d = with_image(d.select(*groups, key), key)
    while True:
        open_ = [s for s in searches if not s.done and s.cnt > final_rows and s.hi > s.lo]
        if not open_:
            break
        if info is not None:
            info["passes"] = info.get("passes", 0) + 1
        # searches sharing a range share one histogram
        rid_of: dict[tuple, int] = {}
        for s in open_:
            rid_of.setdefault((s.group, s.lo, s.hi), len(rid_of))
        frame = _ranges_frame(d, groups, [(rid, *g, lo, hi, *radix(lo, hi, bins), linear(lo, hi, bins))
                                          for (g, lo, hi), rid in rid_of.items()],
                              extra=[("_shift", T.IntegerType()), ("_base", T.LongType()), ("_scale", T.DoubleType())])
        x = F.col(key)
        bucket = F.expr(bucket_sql(f"`{key}`", "_lo", "_scale", "_shift", "_base", bins))
        hist = (d.join(F.broadcast(frame), on=groups)
                .where((x >= F.col("_lo")) & (x <= F.col("_hi")))
                .groupBy("_rid", bucket.alias("_b"))
                .agg(F.count(F.lit(1)).alias("_n"), F.min(key).alias("_mn"), F.max(key).alias("_mx"))
                .collect())
        by_rid: dict[int, list] = {}
        for r in hist:
            by_rid.setdefault(r["_rid"], []).append((r["_b"], r["_n"], float(r["_mn"]), float(r["_mx"])))
        for s in open_:
            buckets = sorted(by_rid.get(rid_of[(s.group, s.lo, s.hi)], []))
            before = 0
            for _b, n, mn, mx in buckets:
                if before + n > s.rank:
                    s.rank -= before
                    s.lo, s.hi, s.cnt = mn, mx, n
                    break
                before += n
            else:  # rank beyond the data: cannot happen for valid ranks
                raise AssertionError("rank outside of the histogram")
    if settle_equal:
        for s in searches:
            if not s.done and s.lo == s.hi:
                s.value, s.done = s.lo, True


def _final_rows(d: DataFrame, key: str, groups: list[str], searches: list[_Search],
                tie_cols: Sequence[str]) -> DataFrame:
    """The wanted row of every search: ``_sid, groups..., key, tie_cols..., _take, _copies, _same``.

    Candidates are first collapsed to distinct order values with their copy
    counts (partial aggregation), so even a value repeated on a third of all
    rows is one line here; the bounded set of distinct values is then ranked
    with a running sum of copies.  ``_copies`` is how many rows carry the
    wanted value, ``_take`` how many of them fall at or before the rank, and
    ``_same`` how many rows share its ``key``, whatever their ties.
    """
    rows = [(s.sid, *s.group, s.lo, s.hi, s.rank) for s in searches]
    frame = _ranges_frame(d, groups, rows, extra=[("_r", T.LongType())]).withColumnRenamed("_rid", "_sid")
    x = F.col(key)
    order = [key, *[c for c in tie_cols if c not in groups and c != key]]
    # constant bounds reach the scan, before costly tie columns are computed
    d = d.where(x.between(min(s.lo for s in searches), max(s.hi for s in searches))).select(*groups, *order)
    vals = (d.join(F.broadcast(frame), on=groups)
            .where((x >= F.col("_lo")) & (x <= F.col("_hi")))
            .groupBy("_sid", "_r", *groups, *order).agg(F.count(F.lit(1)).alias("_copies")))
    w = Window.partitionBy("_sid").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    vals = vals.withColumns({"_cum": F.sum("_copies").over(w),
                             "_same": F.sum("_copies").over(Window.partitionBy("_sid", key))})
    before = F.col("_cum") - F.col("_copies")
    return (vals.where((before <= F.col("_r")) & (F.col("_r") < F.col("_cum")))
            .select("_sid", *groups, *order, (F.col("_r") - before + 1).alias("_take"), "_copies", "_same"))


def _make_searches(extents: Mapping[tuple, tuple], ranks: Mapping[tuple, Sequence[int]]) -> list[_Search]:
    out = []
    for g, rs in ranks.items():
        n, lo, hi = extents[g]
        for r in sorted(set(rs)):
            if not 0 <= r < n:
                raise ValueError(f"rank {r} outside 0..{n - 1} for group {g}")
            out.append(_Search(len(out), g, r, lo, hi, n, orig=r))
    return out


def type7_ranks(n: int, p: float) -> tuple[int, int, float]:
    """0-based ranks and weight of the linear-interpolation (type 7) quantile."""
    h = (n - 1) * p
    lo = math.floor(h)
    hi = min(lo + 1, n - 1) if h > lo else lo
    return lo, hi, h - lo


def _values(d, key, groups, searches, bins, final_rows, info=None) -> dict[tuple, float]:
    """``{(group, rank asked for): value}`` of every search."""
    _refine(d, key, groups, searches, bins, final_rows, settle_equal=True, info=info)
    pending = [s for s in searches if not s.done]
    if pending:
        for r in _final_rows(d, key, groups, pending, ()).collect():
            s = searches[r["_sid"]]
            s.value, s.done = float(r[key]), True
    return {(s.group, s.orig): s.value for s in searches}


def ranked_values(df: DataFrame, key: str, group_cols: Sequence[str], bounds: Mapping[tuple, tuple], *,
                  bins: int = 4096, final_rows: int = 10_000) -> dict[tuple, float]:
    """Values at ranks whose whereabouts are known: ``{(*group, rank): value}``.

    ``bounds[(*group, rank)]`` is ``(rank within the range, low, high, rows of
    the group in the range)``; ``df`` may hold the rows of those ranges only.
    """
    d, groups = _prep(df, key, group_cols)
    searches = [_Search(i, k[:-1], r, float(lo), float(hi), n, orig=k[-1])
                for i, (k, (r, lo, hi, n)) in enumerate(bounds.items())]
    found = _values(d, key, groups, searches, bins, final_rows)
    return {(*g, r): v for (g, r), v in found.items()}


def exact_percentiles(df: DataFrame, key: str, probs: Sequence[float],
                      group_cols: Sequence[str] = (), *, bins: int = 4096,
                      final_rows: int = 10_000, info: dict | None = None) -> dict[tuple, list[float | None]]:
    """Type-7 quantiles of ``key`` (DOUBLE) per group: ``{group: [q(p) for p]}``.

    Groups with no non-null value are absent.  For no grouping the single
    key is ``(0,)``.
    """
    d, groups = _prep(df, key, group_cols)
    extents = group_extents(df, key, group_cols)
    plan = {g: [type7_ranks(ext[0], p) for p in probs] for g, ext in extents.items()}
    ranks = {g: [r for lo, hi, _w in pl for r in (lo, hi)] for g, pl in plan.items()}
    searches = _make_searches(extents, ranks)
    value = _values(d, key, groups, searches, bins, final_rows, info)
    out = {}
    for g, pl in plan.items():
        qs = []
        for lo, hi, w in pl:
            a, b = value[(g, lo)], value[(g, hi)]
            qs.append(a if w == 0 else a + w * (b - a))
        out[g] = qs
    return out


def kth_rows(df: DataFrame, key: str, tie_cols: Sequence[str], group_cols: Sequence[str],
             ranks: Mapping[tuple, int], extents: Mapping[tuple, tuple] | None = None, *,
             bins: int = 4096, final_rows: int = 100_000) -> DataFrame:
    """The row at 0-based ``rank`` of each group in the order ``(key, *tie_cols)``.

    Returns ``groups..., key, tie_cols..., _take, _copies, _same`` with one row
    per group in ``ranks`` (``_copies`` rows share that order value, ``_same``
    its key; the first ``_take`` of the copies lie at or before the rank); a
    lazy plan.
    """
    d, groups = _prep(df, key, group_cols)
    extents = extents if extents is not None else group_extents(df, key, group_cols)
    searches = _make_searches(extents, {g: [r] for g, r in ranks.items()})
    _refine(d, key, groups, searches, bins, final_rows, settle_equal=False)
    out = _final_rows(d, key, groups, searches, tie_cols).drop("_sid")
    return out.drop(_G0) if not group_cols else out

