"""Hard negatives from Hilbert-ordered blocks with zone maps.

Vectors become integers (``floor(scale * x)``), so scores are exact.  All rows
are sorted by label and by their place on a Hilbert curve through the
dimensions that vary most, and written as a Parquet table of blocks: one row
has the ids and components of up to ``block_rows`` neighbours of one label,
and, in columns of their own, its zone map: the least and largest value of
each dimension, and the largest distance from the middle.

For an anchor, interval arithmetic on a zone map bounds the scores of the
block's rows from both sides.  Positives are read from the blocks of the
anchor's label that can beat the fifth score within its own block.  Each
positive gives a window of scores; of the other labels, the most promising
block is read first, then every block that can hold a row of a window not
below the third best found.  A block that is not read holds no row of the
result.

Zone maps and blocks meet anchors in streams: a task holds one part of the
zone maps (or one block) and the anchors pass by in Arrow batches, so nothing
is broadcast or collected that grows with the data.  Blocks that very many
anchors read are read by several tasks.

Defined results: rows with a null label, id or vector, with a null or
non-finite component, or with a component of 2^18 or more in size (scores must
fit 64 bits) take no part, nor do vectors of another length than the most
common (of equally common ones: the shorter); of rows that repeat an id the
least by label, then by components, stands for all; ties go to the smaller id;
an anchor without positives, and a positive without a row in its window, give
no rows; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import pick, table

CURVE_DIMS, CURVE_BITS = 12, 5
LARGEST = 2.0 ** 18
#: Zone maps held by one task; anchors that one task scores against one block.
ZONES, ANCHORS = 4096, 1 << 16


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve (below 2^(dims * bits)) of rows of cell
    numbers, by rotating and reflecting from the coarsest bit to the finest
    (Skilling's transform)."""
    x = cells.astype(np.int64).T.copy()
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for d in range(len(x)):
            high = (x[d] >> level & 1).astype(bool)
            swap = np.where(high, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(high, low, swap)
            if d:
                x[d] ^= swap
    for d in range(1, len(x)):
        x[d] ^= x[d - 1]
    flip = np.zeros(x.shape[1], dtype=np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] >> level & 1, (1 << level) - 1, 0)
    x ^= flip
    place = np.zeros(x.shape[1], dtype=np.int64)
    for level in range(bits - 1, -1, -1):
        for d in range(len(x)):
            place = place << 1 | (x[d] >> level & 1)
    return place


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def product(q: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Integer inner products; by floating point where every sum is exact there."""
    if not len(q) or not len(m):
        return np.zeros((len(q), len(m)), dtype=np.int64)
    if float(np.abs(q).max()) * float(np.abs(m).max()) * q.shape[1] < 2.0 ** 53:
        return (q.astype(np.float64) @ m.astype(np.float64).T).astype(np.int64)
    return q.astype(np.int64) @ m.astype(np.int64).T


def _extent_task(dim: int):
    """Per dimension: least, largest, sum, sum of squares and rows of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lo, hi = np.full(dim, np.inf), np.full(dim, -np.inf)
        total, square, n = np.zeros(dim), np.zeros(dim), 0
        for batch in batches:
            m = _matrix(batch.column("q"), dim).astype(np.float64)
            if len(m):
                lo, hi = np.minimum(lo, m.min(axis=0)), np.maximum(hi, m.max(axis=0))
                total, square, n = total + m.sum(axis=0), square + (m * m).sum(axis=0), n + len(m)
        if n:
            yield pa.RecordBatch.from_pydict({"d": pa.array(range(dim), pa.int32()), "lo": pa.array(lo), "hi": pa.array(hi),
                                              "total": pa.array(total), "square": pa.array(square), "n": pa.array([n] * dim, pa.int64())})
    return run


def _curve_task(dims: list[int], lo: np.ndarray, width: np.ndarray, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = (_matrix(batch.column("q"), dim)[:, dims] - lo) / width
            cells = np.clip(np.floor(x * (1 << CURVE_BITS)), 0, (1 << CURVE_BITS) - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hilbert(cells, CURVE_BITS))],
                                             names=[*batch.schema.names, "place"])
    return run


_BLOCK = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("label", pa.string()), ("n", pa.int32()),
                    ("ids", pa.list_(pa.int64())), ("m", pa.binary()), ("lo", pa.list_(pa.int32())), ("hi", pa.list_(pa.int32())),
                    ("radius", pa.float64()), ("floor", pa.int64())])
_BLOCK_SQL = ("kind int, block long, label string, n int, ids array<long>, m binary, lo array<int>, hi array<int>, radius double, "
              "floor long")


def _block_task(dim: int, block_rows: int, positives: int):
    """Rows of kind 0: blocks of a sorted partition with their zone maps; of
    kind 1: the anchors, with the score of their last positive if their block
    alone gave the positives (null if it has too few rows)."""
    def close(block: int, label: str, rows: list) -> list[tuple]:
        ids = np.array([r[0] for r in rows], dtype=np.int64)
        m = np.stack([r[1] for r in rows])
        by_id = np.argsort(ids)
        ids, m, anchor = ids[by_id], m[by_id], np.array([r[2] for r in rows])[by_id]
        lo, hi = m.min(axis=0), m.max(axis=0)
        radius = float(np.sqrt(((m - (lo.astype(np.float64) + hi) / 2) ** 2).sum(axis=1)).max())
        out = [(0, block, label, len(ids), ids, m.astype("<i4").tobytes(), lo, hi, radius * (1 + 1e-9) + 1e-6, None)]
        at = np.nonzero(anchor)[0]
        scores = product(m[at], m)
        for i, own in enumerate(at):
            rest = np.delete(scores[i], own)
            floor = int(np.partition(rest, len(rest) - positives)[len(rest) - positives]) if len(rest) >= positives else None
            out.append((1, block, label, 1, ids[own:own + 1], m[own].astype("<i4").tobytes(), lo[:0], hi[:0], 0.0, floor))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        n, label, rows = 0, None, []
        for batch in batches:
            done = []
            for r in zip(batch.column("label").to_pylist(), batch.column("id").to_pylist(), _matrix(batch.column("q"), dim),
                         batch.column("anchor").to_pylist()):
                if rows and (r[0] != label or len(rows) == block_rows):
                    done += close(first + n, label, rows)
                    n, rows = n + 1, []
                label = r[0]
                rows.append((r[1], np.array(r[2]), r[3]))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in done], f.type) for k, f in enumerate(_BLOCK)], schema=_BLOCK)
        done = close(first + n, label, rows) if rows else []
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in done], f.type) for k, f in enumerate(_BLOCK)], schema=_BLOCK)
    return run


# ----------------------------------------------------------- choice of blocks

def bounds(q: np.ndarray, lo: np.ndarray, hi: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least and largest score that each block's rows can have with each of
    ``q``, and the score of the block's middle: intervals per dimension, and the
    ball around the middle."""
    q, lo, hi = q.astype(np.float64), lo.astype(np.float64), hi.astype(np.float64)
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    mid = q @ ((lo + hi) / 2).T
    reach = np.sqrt((q * q).sum(axis=1))[:, None] * radius[None, :]
    slack = 1e-6 * (1 + np.abs(mid) + reach)
    most = np.minimum(up @ hi.T + down @ lo.T, mid + reach)
    least = np.maximum(up @ lo.T + down @ hi.T, mid - reach)
    return least - slack, most + slack, mid


#: An anchor on its way: its windows are parallel arrays (the positives with
#: their scores, the window's ends, and the score that a row must reach).
_ANCHOR_SQL = ("id long, label string, m binary, floor long, pid array<long>, ps array<long>, low array<long>, high array<long>, "
               "need array<long>, read array<long>")


def _choose_task(dim: int, mode: str):
    """Streams anchors past a part of the zone maps: ``blocks`` to be read."""
    def blocks_of(batch: pa.RecordBatch, i: int, zones, least, most, mid, q_label) -> np.ndarray:
        block, label, *_ = zones
        if mode == "positives":
            floor = batch.column("floor")[i].as_py()
            return block[(label == q_label) & (True if floor is None else most >= floor)]
        other = label != q_label
        low, high, need = (np.array(batch.column(c)[i].as_py(), dtype=np.float64) for c in ("low", "high", "need"))
        reach = np.zeros(len(block), dtype=bool)
        for a, b, c in zip(low, high, need):
            reach |= (least <= b) & (most >= max(a, c))
        reach &= other
        if mode == "first":
            at = np.nonzero(reach)[0]
            return block[at[np.argsort(-mid[at], kind="stable")[:1]]]
        return block[reach & ~np.isin(block, batch.column("read")[i].as_py() or [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, zones = None, [], None
        for batch in batches:
            kinds = batch.column("kind").to_numpy(zero_copy_only=False)
            parts = batch.column("part").to_numpy(zero_copy_only=False)
            cuts = np.concatenate([[0], np.nonzero((np.diff(parts) != 0) | (np.diff(kinds) != 0))[0] + 1, [len(parts)]])
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                run_ = batch.slice(a, b - a)
                if parts[a] != part:
                    part, held, zones = parts[a], [], None
                if kinds[a] == 0:
                    held.append(run_)
                    continue
                if not held and zones is None:
                    continue
                if zones is None:
                    zones = (np.concatenate([h.column("block").to_numpy(zero_copy_only=False) for h in held]),
                             np.concatenate([np.array(h.column("label").to_pylist(), dtype=object) for h in held]),
                             *(np.concatenate([_matrix(h.column(c), dim) for h in held]) for c in ("lo", "hi")),
                             np.concatenate([h.column("radius").to_numpy(zero_copy_only=False) for h in held]))
                    held = []
                for c in range(0, run_.num_rows, 256):
                    some = run_.slice(c, 256)
                    q = np.stack([np.frombuffer(x.as_py(), dtype="<i4") for x in some.column("m")])
                    least, most, mid = bounds(q, *zones[2:])
                    labels = some.column("label").to_pylist()
                    chosen = [blocks_of(some, i, zones, least[i], most[i], mid[i], labels[i]) for i in range(some.num_rows)]
                    names = [n.split()[0] for n in _ANCHOR_SQL.split(", ")]
                    yield pa.RecordBatch.from_arrays([*[some.column(n) for n in names], pa.array(chosen, pa.list_(pa.int64()))],
                                                     names=[*names, "blocks"])
    return run


def _choose(blocks: DataFrame, n_blocks: int, anchors: DataFrame, dim: int, mode: str) -> DataFrame:
    """One row per anchor and block to be read: the anchor's columns and ``block``."""
    parts = -(-n_blocks // ZONES)
    nulls = lambda *names: [F.lit(None).cast(t).alias(n) for n, t in (x.split() for x in names)]          # noqa: E731
    zones = blocks.select(F.lit(0).alias("kind"), F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int").alias("part"),
                          "block", "lo", "hi", "radius", "label",
                          *nulls(*[x for x in _ANCHOR_SQL.split(", ") if not x.startswith("label ")]))
    asked = anchors.select(F.lit(1).alias("kind"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
                           *nulls("block long", "lo array<int>", "hi array<int>", "radius double"), "label",
                           *[x.split()[0] for x in _ANCHOR_SQL.split(", ") if not x.startswith("label ")])
    both = zones.unionByName(asked).repartition("part").sortWithinPartitions("part", "kind")
    out = both.mapInArrow(_choose_task(dim, mode), _ANCHOR_SQL + ", blocks array<long>")
    return out.withColumn("block", F.explode("blocks")).drop("blocks")


# ------------------------------------------------------------ reading blocks

def _read_task(dim: int, mode: str, k: int):
    """Streams anchors past one block: their best rows, by positive or window."""
    def best(some: pa.RecordBatch, ids: np.ndarray, m: np.ndarray) -> list[tuple]:
        q = np.stack([np.frombuffer(x.as_py(), dtype="<i4") for x in some.column("m")])
        scores = product(q, m)
        out = []
        for i, own in enumerate(some.column("id").to_pylist()):
            order = np.argsort(-scores[i], kind="stable")       # ids ascend: ties to the smaller
            s = scores[i][order]
            if mode == "positives":
                top = [j for j in range(min(k + 1, len(order))) if ids[order[j]] != own][:k]
                out += [(own, None, None, int(ids[order[j]]), int(s[j])) for j in top]
                continue
            windows = zip(*(some.column(c)[i].as_py() for c in ("pid", "ps", "low", "high")))
            for pid, ps, low, high in windows:
                a = int(np.searchsorted(-s, -high, side="left"))
                out += [(own, pid, ps, int(ids[order[j]]), int(s[j])) for j in range(a, min(a + k, len(order))) if s[j] >= low]
        return out

    schema = pa.schema([(n, pa.int64()) for n in ("anchor_id", "positive_id", "positive_score", "id", "score")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, m = None, None, None
        for batch in batches:
            where = list(zip(batch.column("block").to_pylist(), batch.column("salt").to_pylist()))
            kinds = batch.column("kind").to_pylist()
            a = 0
            while a < len(where):
                if kinds[a] == 0:
                    key, ids = where[a], np.array(batch.column("ids")[a].as_py(), dtype=np.int64)
                    m = np.frombuffer(batch.column("m")[a].as_py(), dtype="<i4").reshape(-1, dim)
                    a += 1
                    continue
                b = a
                while b < len(where) and where[b] == key and kinds[b] == 1 and b - a < 512:
                    b += 1
                if b == a:
                    raise AssertionError("an anchor without its block")
                rows = best(batch.slice(a, b - a), ids, m)
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(5)], schema=schema)
                a = b
    return run


def _read(blocks: DataFrame, pairs: DataFrame, dim: int, mode: str, k: int) -> DataFrame:
    """anchor_id, positive_id, positive_score, id, score: the ``k`` best rows of
    each block for each anchor (or window) that reads it."""
    # a block read by very many anchors is given to several tasks
    asked = table(pairs, "pairs")
    load = asked.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / F.lit(ANCHORS)).cast("int").alias("copies"))
    most = load.agg(F.max("copies")).first()[0] or 1
    payload = blocks.select("block", "ids", "m").join(load, "block")
    payload = payload.select(F.lit(0).alias("kind"), "block", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("salt"), "ids", "m",
                             *[F.lit(None).cast(t).alias(n) for n, t in
                               (("id", "long"), *((c, "array<long>") for c in ("pid", "ps", "low", "high")))])
    salt = F.lit(0)
    if most > 1:
        asked = asked.join(load, "block")
        salt = F.pmod(F.xxhash64("id"), F.col("copies")).cast("int")
    asked = asked.select(F.lit(1).alias("kind"), "block", salt.alias("salt"), F.lit(None).cast("array<long>").alias("ids"), "m", "id",
                         "pid", "ps", "low", "high")
    both = payload.unionByName(asked).repartition("block", "salt").sortWithinPartitions("block", "salt", "kind")
    return both.mapInArrow(_read_task(dim, mode, k), "anchor_id long, positive_id long, positive_score long, id long, score long")


def _ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, anchors: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         scale: int = 256, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, block_rows: int = 1024,
         parts: int | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchors`` is a condition on ``id``.  A negative of another label belongs
    to a positive's window if its score is from ``low`` to ``high`` percent of
    the positive's."""
    spark = vectors.sparkSession
    out_schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = pick(vectors, id=id_col, v=vector_col, label=label_col).select(
        F.col("id").cast("long").alias("id"), F.col("label").cast("string").alias("label"), F.col("v").cast("array<double>").alias("v"))
    fits = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < LARGEST), F.lit(False)))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & fits)
    whole = F.transform("v", lambda x: F.when(F.abs(x) < LARGEST, F.floor(x * scale)).cast("int"))
    dims = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if dims is None:
        return spark.createDataFrame([], out_schema)
    dim = dims["d"]
    rows = rows.filter(F.size("v") == dim).select("id", F.struct("label", whole.alias("q")).alias("x"))
    rows = rows.groupBy("id").agg(F.min("x").alias("x")).select("id", "x.label", "x.q", F.coalesce(anchors, F.lit(False)).alias("anchor"))
    rows = table(rows, "integers")

    extent = (rows.select("q").mapInArrow(_extent_task(dim), "d int, lo double, hi double, total double, square double, n long")
              .groupBy("d").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                                (F.sum("square") / F.sum("n") - F.pow(F.sum("total") / F.sum("n"), 2)).alias("spread"))
              .orderBy(F.desc("spread"), "d").limit(CURVE_DIMS).collect())        # one row per dimension at most
    at = [r["d"] for r in extent]
    least = np.array([r["lo"] for r in extent])
    width = np.array([r["hi"] - r["lo"] + 1 for r in extent])
    placed = table(rows.mapInArrow(_curve_task(at, least, width, dim), "id long, label string, q array<int>, anchor boolean, place long"), "curve")
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["label", "place", "id"]
    built = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(
        _block_task(dim, block_rows, positives), _BLOCK_SQL)
    built = table(built, "blocks")
    blocks = built.filter("kind = 0")
    none = F.array().cast("array<long>")
    own = built.filter("kind = 1").select(F.col("ids")[0].alias("id"), "label", "m", "floor",
                                          *[none.alias(c) for c in ("pid", "ps", "low", "high", "need", "read")])
    n_blocks = blocks.count()

    chosen = _choose(blocks, n_blocks, own, dim, "positives")
    best = table(_ranked(_read(blocks, chosen, dim, "positives", positives), ["anchor_id"], positives).select(
        "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # ends of a window in whole scores; a positive below zero has none
    ends = best.filter("positive_score >= 0").select(
        "*", F.expr(f"({low} * positive_score + 99) div 100").alias("low"), F.expr(f"({high} * positive_score) div 100").alias("high"))

    def windows(need: Column, rest: DataFrame, read: Column) -> DataFrame:
        w = rest.groupBy("anchor_id").agg(
            F.sort_array(F.collect_list(F.struct("positive_id", "positive_score", "low", "high", need.alias("need")))).alias("w"),
            read.alias("read"))                                          # at most ``positives`` of them
        cols = {"pid": "positive_id", "ps": "positive_score", "low": "low", "high": "high", "need": "need"}
        return (own.select("id", "label", "m", "floor").join(w, F.col("id") == F.col("anchor_id"))
                .select("id", "label", "m", "floor", *[F.col("w")[c].alias(n) for n, c in cols.items()], "read"))

    chosen = table(_choose(blocks, n_blocks, windows(F.col("low"), ends, F.first(none)), dim, "first"), "chosen")
    by = ["anchor_id", "positive_id", "positive_score"]
    early = table(_ranked(_read(blocks, chosen, dim, "windows", negatives), by, negatives), "early")
    third = early.filter(F.col("rank") == negatives).select("anchor_id", "positive_id", F.col("score").alias("third"))
    done = chosen.groupBy("id").agg(F.collect_set("block").alias("blocks")).withColumnRenamed("id", "of")
    more = (ends.join(third, ["anchor_id", "positive_id"], "left").join(done, F.col("anchor_id") == F.col("of"), "left"))
    chosen = _choose(blocks, n_blocks, windows(F.coalesce("third", "low"), more, F.first("blocks")), dim, "rest")
    late = _read(blocks, chosen, dim, "windows", negatives)
    found = early.drop("rank").unionByName(late)
    return _ranked(found, by, negatives).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


ORACLE = """
with e as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end label,
         list_transform(embedding, lambda x: floor(256 * cast(x as double))) q
  from embeddings
  where label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id anchor_id, b.vec_id id, a.label = b.label same, cast(list_dot_product(a.q, b.q) as bigint) score
  from e a join e b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
p as (
  select anchor_id, id positive_id, score positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select anchor_id, positive_id,
       cast(row_number() over (partition by anchor_id, positive_id order by score desc, id) as integer) "rank",
       id negative_id, positive_score, score negative_score
from p join s using (anchor_id)
where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
qualify "rank" <= 3
"""
