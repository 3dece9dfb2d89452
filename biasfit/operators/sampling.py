"""Exact-size stratified samples and leak-free hold-outs.

Sample definition (checked against a plain window in the tests and against
DuckDB in the oracle): cut the target at its type-7 quantiles
``0, 1/(g-1), ..., 1`` (duplicate breaks removed, intervals right-closed,
lowest included); within each stratum order rows by
``(md5(seed | key...), tie...)`` and take the first ``ceil(n * p)``.

Scalable form: a mergeable quantile sketch (KLL) of the target brackets the
strata's cuts, and the order hash, which is uniform, brackets the wanted row of
each stratum; one exact counting pass over (place in the brackets, bucket of the
hash) then gives breaks, stratum sizes and cuts together
(:func:`_one_pass`).  What it leaves open -- cuts within a bracket that holds
many different values, identical rows at the cut -- is found by the radix search
of :mod:`biasfit.operators.order_stats`.  The sample is then the predicate
``(hash, tie...) <= threshold(stratum)`` -- a filter evaluated row by row with
at most one threshold per stratum.  No window over a stratum, no shuffle of the
rows themselves.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from itertools import takewhile

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from biasfit.functions.hashing import hash_prefix_number, order_hash
from biasfit.operators.bitmaps import INTEGERS, MAX_BITS, known_keys
from biasfit.operators.diagnostics import null_counters
from biasfit.operators.joins import DEFAULT_POLICY, JoinPolicy
from biasfit.operators.order_stats import IMAGE, kth_rows, radix, ranked_values, type7_ranks, with_image
from biasfit.session import materialize

STRATUM = "_stratum"
_H = "_h"
_HX = "_hx"
_U = "_u"
_THR = "_thr"
#: Place of a row in a written table: file and row number.
ROW_ID = ("_file", "_row")


class TiesNeeded(ValueError):
    """The cut of a sample falls among rows of one order key, which only the missing tie columns tell apart."""


# The order key's leading 52 bits are uniform on [0, 16**13 - 1], so the
# threshold search starts on that range without a min/max pass.
HASH_RANGE = (0.0, float(16 ** 13 - 1))


def quantile_probs(groups: int) -> list[float]:
    g = max(int(groups), 2)
    return [i / (g - 1) for i in range(g)]


#: Size of the sketch, and a bound of its rank error: a few times the one that
#: it keeps with 99 % probability.  Brackets are checked by exact counts.
SKETCH_K, RANK_ERROR = 4096, 0.002
#: Buckets of a bracket of values; buckets of the bracket of the order hash: at
#: most as many as rows are expected there, or so many that two seldom share one.
VALUE_BINS, HASH_BINS, FINE_BINS = 64, 1 << 17, 1 << 22


def bracket_probs(groups: int, slack: float = RANK_ERROR) -> list[float]:
    """Ranks whose sketched values bracket the inner cuts (pairwise)."""
    inner = quantile_probs(groups)[1:-1]
    return [min(1.0, max(0.0, p + d)) for p in inner for d in (-slack, slack)]


def bracket_column(target: str | Column, groups: int = 5) -> Column:
    """The brackets as one aggregate: partial sketches, merged; usable in ``observe``."""
    t = (F.col(target) if isinstance(target, str) else target).cast("double")
    t = F.when(~F.isnan(t), t)
    sketch = F.kll_sketch_agg_double(t, F.lit(SKETCH_K))
    at = F.array(*[F.lit(p) for p in bracket_probs(groups)])
    return F.when(F.count(t) > 0, F.kll_sketch_get_quantile_double(sketch, at))


def intervals(bounds: Sequence[float] | None) -> list[tuple[float, float]]:
    """Disjoint intervals, ascending, that cover the brackets."""
    out: list[tuple[float, float]] = []
    for lo, hi in sorted(zip(bounds[::2], bounds[1::2])) if bounds else []:
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


@dataclass
class _Cell:
    """Rows of one place of the target: their ends, number, and hashes."""
    least: float
    most: float
    n: int = 0
    by_hash: dict[int, tuple[int, float, float]] = field(default_factory=dict)    # bucket: rows, least and largest hash


def _hash_bracket(p: float, total: int) -> tuple[float, float]:
    """Where the hash of the last row taken is, within eight standard
    deviations of a stratum with a 64th of the rows; a smaller stratum's row may
    lie outside, which the pass shows."""
    n = max(total / 64, 1)
    d = 8 * math.sqrt(p * (1 - p) / n) + 2 / n
    return max(0.0, p - d) * HASH_RANGE[1], min(1.0, p + d) * HASH_RANGE[1]


def _cells(d: DataFrame, target: str, hash_col: str | None, bounds: list[tuple[float, float]], p: float, total: int) -> list[_Cell]:
    """The counting pass over the population (no NULL, no NaN): one
    partial-aggregated job, whose result has a row per place and bucket of the
    hash bracket that has rows."""
    d = d.select(F.col(target).cast("double").alias("_x"), (F.col(hash_col) if hash_col else F.lit(0.0)).alias("_hash"))
    wide = any(hi > lo for lo, hi in bounds)
    if wide:
        d = with_image(d, "_x")
    x, h = F.col("_x"), F.col("_hash")
    place, sub = F.lit(0), F.lit(0)
    for lo, hi in bounds:
        place = place + (x >= F.lit(lo)).cast("int") + (x > F.lit(hi)).cast("int")
        if hi > lo:
            shift, base = radix(lo, hi, VALUE_BINS)
            sub = F.when((x >= F.lit(lo)) & (x <= F.lit(hi)), F.expr(f"CAST(shiftright({IMAGE}, {shift}) - {base}L AS INT)")).otherwise(sub)
    low, high = _hash_bracket(p, total)
    bins = FINE_BINS if total * (high - low) / HASH_RANGE[1] <= HASH_BINS else HASH_BINS // VALUE_BINS
    bucket = F.when(h < F.lit(low), -1).when(h > F.lit(high), bins + 1).otherwise(
        F.floor((h - F.lit(low)) * F.lit(bins / max(high - low, 1.0)))).cast("int")
    rows = (d.select(place.alias("_c"), sub.alias("_s"), bucket.alias("_b"), "_x", "_hash").groupBy("_c", "_s", "_b")
            .agg(F.count(F.lit(1)).alias("n"), F.min("_x").alias("x0"), F.max("_x").alias("x1"),
                 F.min("_hash").alias("h0"), F.max("_hash").alias("h1")).toArrow().to_pylist())
    cells: dict[tuple[int, int], _Cell] = {}
    for r in rows:
        c = cells.setdefault((r["_c"], r["_s"]), _Cell(r["x0"], r["x1"]))
        c.n += r["n"]
        c.least, c.most = min(c.least, r["x0"]), max(c.most, r["x1"])
        c.by_hash[r["_b"]] = (r["n"], r["h0"], r["h1"])
    return [cells[k] for k in sorted(cells)]


def _quantiles(d: DataFrame, target: str, cells: list[_Cell], probs: Sequence[float]) -> list[float]:
    """Type-7 quantiles: ranks at an end of a cell are known, the others are
    searched within their cell."""
    total = sum(c.n for c in cells)
    plan = [type7_ranks(total, q) for q in probs]
    value: dict[int, float] = {}
    open_: dict[tuple, tuple] = {}
    for rank in {r for lo, hi, _w in plan for r in (lo, hi)}:
        before = 0
        for c in cells:
            if rank < before + c.n:
                break
            before += c.n
        if c.least == c.most or rank == before:
            value[rank] = c.least
        elif rank == before + c.n - 1:
            value[rank] = c.most
        else:
            open_[(0, rank)] = (rank - before, c.least, c.most, c.n)
    if open_:
        found = ranked_values(d.select(F.col(target).cast("double").alias("_x"), F.lit(0).alias("_all")), "_x", ["_all"], open_)
        value |= {r: v for (_g, r), v in found.items()}
    return [value[lo] if w == 0 else value[lo] + w * (value[hi] - value[lo]) for lo, hi, w in plan]


def _stratum_of(v: float, breaks: Sequence[float]) -> int:
    return 1 + sum(1 for b in breaks[1:-1] if v > b)


def _by_stratum(d: DataFrame, target: str, hash_col: str | None, p: float, groups: int, bounds: Sequence[float] | None,
                total: int) -> tuple[list[float], dict[int, list[_Cell]]]:
    """The breaks, and the cells of each stratum."""
    cells = _cells(d, target, hash_col, intervals(bounds), p, total)
    if not cells:
        return [], {}
    breaks = sorted(set(_quantiles(d, target, cells, quantile_probs(groups))))
    if any(_stratum_of(c.least, breaks) != _stratum_of(c.most, breaks) for c in cells):
        # a break inside a cell: count again, at the breaks themselves
        cells = _cells(d, target, hash_col, [(b, b) for b in breaks[1:-1]], p, total)
    out: dict[int, list[_Cell]] = {}
    for c in cells:
        out.setdefault(_stratum_of(c.least, breaks), []).append(c)
    return breaks, out


def _place_of(cells: list[_Cell], k: int) -> tuple[float | None, tuple[int, int, float, float]]:
    """The hash up to which exactly ``k`` rows of a stratum lie, if a bucket
    ends there; and the bucket of the k-th row as (rank in it, rows, least, largest hash)."""
    merged: dict[int, tuple[int, float, float]] = {}
    for c in cells:
        for b, (n, lo, hi) in c.by_hash.items():
            m, l0, h0 = merged.get(b, (0, lo, hi))
            merged[b] = (m + n, min(l0, lo), max(h0, hi))
    before = 0
    for b in sorted(merged):
        n, lo, hi = merged[b]
        if before + n >= k:
            return (hi if before + n == k else None), (k - 1 - before, n, lo, hi)
        before += n
    raise AssertionError("rank outside of the stratum")


def _sketched(pop: DataFrame, target: str, groups: int) -> tuple[Sequence[float] | None, int]:
    """Brackets of the cuts and the rows of the population, by one aggregate."""
    r = pop.agg(bracket_column(target, groups).alias("b"), F.count(F.lit(1)).alias("n")).first()
    return r["b"], r["n"]


def strata_breaks(df: DataFrame, target: str, groups: int = 5) -> list[float]:
    """Sorted distinct type-7 quantiles of ``target`` (exact)."""
    pop = df.where(F.col(target).isNotNull() & ~F.isnan(F.col(target).cast("double")))
    bounds, total = _sketched(pop, target, groups)
    return _by_stratum(pop, target, None, 0.5, groups, bounds, total)[0]


def stratum_column(target: str | Column, breaks: Sequence[float]) -> Column:
    """1-based stratum of right-closed intervals, lowest value included.

    NULL or NaN target -> NULL stratum (never sampled).
    """
    t = F.col(target) if isinstance(target, str) else target
    s = F.lit(1)
    for b in breaks[1:-1]:
        s = s + (t > F.lit(float(b))).cast("int")
    return F.when(t.isNotNull() & ~F.isnan(t.cast("double")), s)


def with_row_id(written: DataFrame) -> DataFrame:
    """Add the ``ROW_ID`` of every row of a table just read from files: the same
    however often, and by whichever executor, it is read."""
    return written.select("*", F.col("_metadata.file_name").alias(ROW_ID[0]), F.col("_metadata.row_index").alias(ROW_ID[1]))


def written_rows(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back, with the ``ROW_ID`` of every row."""
    return with_row_id(materialize(df, "table", name, lean=True))


@dataclass
class SampleInput:
    """Rows written once, with all that the samples and hold-outs need to know
    of them beforehand, observed while they were written."""
    df: DataFrame
    n_rows: int
    bounds: Sequence[float] | None
    extents: dict[str, tuple]
    nulls: dict[str, int]       # NULL cells by column


def prepare(df: DataFrame, name: str, target: str, hashes: Mapping[str, Column], *, groups: int = 5,
            keys: Sequence[str] = (), stage=None) -> SampleInput:
    """Write ``df`` with the order hashes ``hashes`` (column name: number); the
    brackets of the strata, the ranges of the keys and the NULL cells of every
    column of ``df`` cost no job of their own.

    ``stage(name, make)`` (:class:`biasfit.plans.stages.Stages`) keeps the table
    and what was observed beyond this run."""
    whole = [k for k in keys if isinstance(df.schema[k].dataType, INTEGERS)]

    def make(write) -> dict:
        seen = Observation(f"biasfit-{name}")
        write(df.withColumns(dict(hashes)).observe(
            seen, F.count(F.lit(1)).alias("n"), bracket_column(target, groups).alias("bounds"),
            *[f(k).alias(f"{i}_{k}") for k in whole for i, f in enumerate((F.min, F.max))], *null_counters(df.columns)))
        return {**seen.get, "bounds": seen.get["bounds"] and list(seen.get["bounds"])}

    if stage is None:
        kept = []
        got = make(lambda rows: kept.append(materialize(rows, "table", name, lean=True)))
        out = kept[0]
    else:
        out, got = stage(name, make)
    extents = {k: (got[f"0_{k}"], got[f"1_{k}"]) if k in whole else (None, None) for k in keys}
    return SampleInput(with_row_id(out), got["n"], got["bounds"], extents, {c: got[f"null_{c}"] for c in df.columns})


def exact_stratified_sample(df: DataFrame, target: str, p: float, seed: str,
                            key_cols: Sequence[str], tie_cols: Sequence[str] = (), *,
                            groups: int = 5, flag: str = "sampled",
                            eligible: Column | None = None, keep_stratum: bool = False,
                            final_rows: int = 100_000,
                            info: dict | None = None, hash_col: str | None = None,
                            row_id: Sequence[str] = (), bounds: Sequence[float] | None = None,
                            total: int | None = None, late_ties: bool = False) -> DataFrame:
    """Add boolean ``flag``: is the row in the exact stratified sample?

    ``eligible`` restricts the population (others get ``False`` and take no
    part in the quantiles or counts).  Jobs: a sketch of the target, unless
    ``bounds`` (the brackets of :func:`prepare`) and ``total`` (its rows, or
    about as many) are given; one counting pass; and, where that leaves
    something open, a search within the buckets it names.  The returned plan
    itself is a filter, with a broadcast join with at most one row per stratum
    if identical rows are cut.  ``info`` (a dict) receives the population size,
    breaks and stratum counts.  ``hash_col`` names a column that already holds
    the leading digits of the order key as a number.  ``row_id`` names columns
    that tell identical copies apart (:func:`written_rows`); without them copies
    are told apart by their place in the plan, which is the same in each pass
    only if the input is read in a fixed order.  With ``late_ties``, ``df`` may
    lack tie columns: :class:`TiesNeeded` is raised if the sample depends on them.
    """
    spark = df.sparkSession
    without = late_ties and not set(tie_cols) <= set(df.columns)
    if without:      # the order as far as it is known
        tie_cols = list(takewhile(df.columns.__contains__, tie_cols))
    base = df if eligible is None else df.withColumn("_elig", eligible)
    pop = base.where(F.col(target).isNotNull() & ~F.isnan(F.col(target).cast("double")))
    if eligible is not None:
        pop = pop.where(F.col("_elig"))
    h = order_hash(seed, key_cols)
    number = F.col(hash_col) if hash_col else hash_prefix_number(h)
    if total is None:
        bounds, total = _sketched(pop, target, groups)
    breaks, strata = _by_stratum(pop.withColumn(_HX, number), target, _HX, p, groups, bounds, total)
    counts = {g: sum(c.n for c in cells) for g, cells in strata.items()}
    if info is not None:
        info.update(n=sum(counts.values()), breaks=breaks, counts=dict(counts))
    stratum = stratum_column(target, breaks)
    if eligible is not None:
        stratum = F.when(F.col("_elig"), stratum)
    d = base.withColumn(STRATUM, stratum)

    cuts: dict[int, float] = {}          # a number that ends a stratum's sample
    ranks, extents = {}, {}              # strata to be searched
    for g, cells in strata.items():
        k = min(math.ceil(counts[g] * p), counts[g])
        if k >= 1:
            last, (rank, n, lo, hi) = _place_of(cells, k)
            if last is not None:
                cuts[g] = last
            else:
                ranks[(g,)], extents[(g,)] = rank, (n, lo, hi)
    out, partly = d.withColumn(_HX, number), F.lit(False)
    if ranks:
        order = [_HX, _H, *[c for c in tie_cols if c not in (_HX, _H)]]
        d = out.withColumn(_H, h)
        # _u (with the ids behind it) orders identical copies; only used when a copy run straddles the threshold
        ids = list(row_id)
        if not ids:
            ids = ["_mid"]
            d = d.withColumn("_mid", F.monotonically_increasing_id())
        d = d.withColumn(_U, F.shiftright(F.xxhash64(*ids), 12).cast("double"))
        d_pop = d.where(F.col(STRATUM).isNotNull())
        row, place = F.struct(*order), F.struct(_U, *ids)
        thr = kth_rows(d_pop, _HX, order[1:], [STRATUM], ranks, extents, final_rows=final_rows)
        thr = thr.select(STRATUM, row.alias(_THR), "_take", "_copies", "_same")
        found = thr.collect()     # one row per stratum
        # no row beyond the cut shares its number: the number decides
        cuts |= {r[STRATUM]: float(r[_THR][_HX]) for r in found if r["_take"] == r["_same"]}
        found = [r for r in found if r["_take"] != r["_same"]]
        if without and any(r["_take"] < r["_copies"] for r in found):
            raise TiesNeeded("rows of one order key lie on both sides of a cut")
        if found:
            # strata whose threshold value is carried by several identical rows of
            # which only some are taken: pick exactly that many by the row id
            partial = {(r[STRATUM],): r["_take"] - 1 for r in found if r["_take"] < r["_copies"]}
            at_thr = row == F.col(_THR)
            thr = spark.createDataFrame(found, thr.schema)
            if partial:
                at = d_pop.join(F.broadcast(thr.select(STRATUM, _THR)), STRATUM).where(row == F.col(_THR))
                last = kth_rows(at, _U, ids, [STRATUM], partial, final_rows=final_rows)
                last = last.select(STRATUM, place.alias("_last"))
                last = spark.createDataFrame(last.collect(), last.schema)
                thr = thr.join(last, STRATUM, "left")
                at_thr = at_thr & (F.col("_last").isNull() | (place <= F.col("_last")))
            out = d.join(F.broadcast(thr), STRATUM, "left")
            partly = F.coalesce((row < F.col(_THR)) | at_thr, F.lit(False))
    chosen = partly
    for g, last in sorted(cuts.items()):
        chosen = chosen | ((F.col(STRATUM) == g) & (F.col(_HX) <= F.lit(last)))
    out = out.withColumn(flag, F.coalesce(chosen, F.lit(False)))
    drop = [_H, _HX, _U, _THR, "_take", "_copies", "_same", "_last", "_mid", "_elig"] + ([] if keep_stratum else [STRATUM])
    return out.drop(*[c for c in drop if c in out.columns])


def window_stratified_sample(df: DataFrame, target: str, p: float, seed: str,
                             key_cols: Sequence[str], tie_cols: Sequence[str] = (), *,
                             groups: int = 5, flag: str = "sampled") -> DataFrame:
    """Reference definition with ``row_number`` over each stratum.

    One task per stratum: use only on small data, to check the scalable form.
    """
    breaks = strata_breaks(df, target, groups)
    d = df.withColumn(STRATUM, stratum_column(target, breaks)).withColumn(_H, order_hash(seed, key_cols))
    w = Window.partitionBy(STRATUM).orderBy(_H, *tie_cols)
    n = F.count(F.lit(1)).over(Window.partitionBy(STRATUM))
    k = F.ceil(n.cast("double") * F.lit(float(p)))
    chosen = F.coalesce((F.col(STRATUM).isNotNull()) & (F.row_number().over(w) <= k), F.lit(False))
    return d.withColumn(flag, chosen).drop(STRATUM, _H)


# ---------------------------------------------------------------- hold-outs

def semi_join_keys(df: DataFrame, reference: DataFrame, keys: Sequence[str] = ("movieId", "userId"),
                   total: int | None = None, policy: JoinPolicy = DEFAULT_POLICY,
                   counts: Mapping[str, DataFrame] | None = None, max_bits: int = MAX_BITS,
                   extents: Mapping[str, tuple] | None = None) -> DataFrame:
    """Rows of ``df`` whose every key occurs in ``reference`` (NULL matches NULL).

    By bitmaps of the keys (:mod:`biasfit.operators.bitmaps`): rows of ``df``
    are shuffled only if a bitmap cannot settle them.  ``total`` bounds the rows
    of ``df`` (hot-key salting of that exact join); ``counts`` holds tables of
    ``reference``'s keys (``key, ...``) that exist already."""
    source = {k: counts[k] if counts and k in counts else reference for k in keys} if counts else reference
    return known_keys(df, source, keys, "_known", total=total, policy=policy, max_bits=max_bits,
                      extents=extents).where("_known").drop("_known")


def mark_known(df: DataFrame, reference: DataFrame, keys: Sequence[str] = ("movieId", "userId"),
               flag: str = "_known", total: int | None = None,
               policy: JoinPolicy = DEFAULT_POLICY, max_bits: int = MAX_BITS, **kw) -> DataFrame:
    """Add boolean ``flag``: every key of the row occurs in ``reference``
    (``kw``: of :func:`known_keys`)."""
    return known_keys(df, reference, keys, flag, total=total, policy=policy, max_bits=max_bits, **kw)


def anti_join_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` matching no row of ``right`` on all common columns,
    NULL equal to NULL; every copy of a matched row goes."""
    common = [c for c in left.columns if c in right.columns]
    r = right.select(*[F.col(c).alias(f"_r_{c}") for c in common]).distinct()
    cond = None
    for c in common:
        e = left[c].eqNullSafe(r[f"_r_{c}"])
        cond = e if cond is None else cond & e
    return left.join(r, cond, "left_anti")


def assign_holdout_roles(df: DataFrame, sampled: str, *, orphan: str = "return",
                         keys: Sequence[str] = ("movieId", "userId"),
                         held_role: str = "held", rest_role: str = "rest", role: str = "role",
                         total: int | None = None, policy: JoinPolicy = DEFAULT_POLICY, **kw) -> DataFrame:
    """Leak-free hold-out as one role column (``kw``: of :func:`known_keys`).

    A sampled row is held out only if its keys all occur among the
    *unsampled* rows; otherwise it goes back to ``rest_role``
    (``orphan='return'``) or is dropped (``orphan='drop'``, role ``dropped``).
    Only the sampled share of rows is asked about, and only those of them that
    the key bitmaps can't settle are joined.
    """
    if orphan not in ("return", "drop"):
        raise ValueError("orphan must be 'return' or 'drop'")
    s = F.col(sampled)
    rest = df.where(~s)
    held = mark_known(df.where(s), rest, keys, total=total, policy=policy, **kw)
    orphan_role = rest_role if orphan == "return" else "dropped"
    held = held.withColumn(role, F.when(F.col("_known"), F.lit(held_role)).otherwise(F.lit(orphan_role))).drop("_known")
    # only the sampled share is shuffled, into files of a good size when written by role
    held = held.hint("rebalance", role)
    return rest.withColumn(role, F.lit(rest_role)).unionByName(held)
