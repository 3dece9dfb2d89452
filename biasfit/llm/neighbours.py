"""Approximate nearest neighbours by balanced posting lists.

A bounded sample of the vectors is halved again and again, at the median of
the direction between two means, into lists of equal size; their centroids
form an in-memory graph that every task searches best-first.  A vector is
posted to its nearest list and, where that pays, to others nearly as near
(boundary vectors).  A query reads the lists whose centroid is at most
``ratio`` times as far as its nearest.  How far boundary vectors are copied and
the ratio are chosen together: those that meet the wanted recall within the
sample, by the search and the limit of copies used later, at the least number
of scored pairs.

A list's vectors lie in chunks of bounded size.  The task that holds a chunk
halves it into lists of its own (so their number grows with the table, and
only the first level is broadcast), picks their ratio in the same way, and the
queries of the list stream past it in Arrow batches.  A list that very many
queries read is given to several tasks.  Queries that found fewer than ``k``
read all lists.

Defined results: vectors that are null, zero, or hold null or non-finite
components take no part, nor do vectors of another length than the most common;
rows that repeat an id are one candidate, at their best score; ties go to the
smaller id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import pick, table


def usable(v: Column) -> Column:
    """Not null, no null or non-finite component, not zero."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def unit(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(axis=1, keepdims=True)        # no overflow or underflow in the squares
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


@dataclass(frozen=True)
class Index:
    """Centroids and their graph: row i of ``graph`` has the lists near list i."""
    centroids: np.ndarray
    graph: np.ndarray
    entry: np.ndarray

    def near(self, x: np.ndarray, ratio: float, at_least: int) -> np.ndarray:
        """Distances of the vectors ``x`` to the lists met by a best-first
        search (infinite where not met): it goes on while a list not yet
        expanded is within ``ratio`` of the nearest or among the ``at_least``
        nearest."""
        n = len(self.centroids)
        square = (self.centroids ** 2).sum(axis=1)
        found = np.full((len(x), n), np.inf)
        done = np.zeros((len(x), n), dtype=bool)
        rows = np.repeat(np.arange(len(x)), len(self.entry))
        cols = np.tile(self.entry, len(x))
        while len(rows):
            for a in range(0, len(rows), 1 << 16):
                r, c = rows[a:a + (1 << 16)], cols[a:a + (1 << 16)]
                dot = np.einsum("ij,ij->i", x[r], self.centroids[c])
                found[r, c] = np.sqrt(np.maximum(1.0 + square[c] - 2 * dot, 1e-12))
            kth = np.partition(found, min(at_least, n) - 1, axis=1)[:, min(at_least, n) - 1]
            limit = np.maximum(found.min(axis=1) * ratio, kth)
            rows, nodes = np.nonzero((found <= limit[:, None]) & ~done & np.isfinite(found))
            done[rows, nodes] = True
            seen = np.unique(np.repeat(rows, self.graph.shape[1]) * np.int64(n) + self.graph[nodes].ravel())
            rows, cols = seen // n, seen % n
            new = np.isinf(found[rows, cols])
            rows, cols = rows[new], cols[new]
        return found


def build_index(sample: np.ndarray, n_lists: int, degree: int = 16, seed: int = 7) -> Index:
    """sample: unit vectors."""
    rng = np.random.default_rng(seed)
    parts = [np.arange(len(sample))]
    while len(parts) < n_lists:
        parts.sort(key=len)
        p = parts.pop()
        if len(p) < 2:
            parts.append(p)
            break
        x = sample[p]
        c = x[rng.choice(len(p), 2, replace=False)]
        for _ in range(6):
            d = ((x[:, None] - c[None]) ** 2).sum(axis=2) if len(p) < 4096 else np.stack([((x - y) ** 2).sum(axis=1) for y in c], 1)
            side = d[:, 0] - d[:, 1]
            cut = np.median(side)
            a, b = side <= cut, side > cut
            if not b.any():        # copies of one vector: any halving does
                a = np.arange(len(p)) < len(p) // 2
                b = ~a
            c = np.stack([x[a].mean(axis=0), x[b].mean(axis=0)])
        parts += [p[a], p[b]]
    centroids = np.stack([sample[p].mean(axis=0) for p in parts])
    n = len(parts)
    gram = 2 * centroids @ centroids.T - (centroids ** 2).sum(axis=1)[None, :]
    np.fill_diagonal(gram, np.inf)
    near = np.argsort(-gram, axis=1)[:, :min(degree, n)]
    # a ring and random long links keep the graph connected
    extra = np.stack([(np.arange(n) + 1) % n, *[rng.integers(0, n, n) for _ in range(3)]], axis=1)
    return Index(centroids, np.concatenate([near, extra], axis=1), rng.choice(n, min(n, 8), replace=False))


#: How much farther than the nearest list a copy may be posted, in question.
REACHES = (1.0, 1.01, 1.02, 1.04, 1.08)


def posted(found: np.ndarray, reach: float, most: int) -> np.ndarray:
    """The lists that vectors are posted to: within ``reach``, at most ``most``."""
    n = min(most, found.shape[1])
    kth = np.partition(found, n - 1, axis=1)[:, n - 1]
    ok = (found <= found.min(axis=1, keepdims=True) * reach) & (found <= kth[:, None])
    if most == 1:        # equal distances: one of them
        ok &= np.cumsum(ok, axis=1) == 1
    return ok


def calibrate(index: Index, sample: np.ndarray, k: int, recall: float, *, reaches: tuple = REACHES, most: int = 8,
              n_queries: int = 256, n_posted: int = 2048) -> tuple[float, float, float]:
    """``(reach, ratio, share)``: the pair that scores the least share of all
    pairs among those at which sample queries meet ``recall`` of their true
    neighbours in the sample.  The index is the one to be used, with its limit
    of copies; distances come from its own search."""
    if len(sample) < 2:
        return 1.0, 1.0, 1.0
    q = sample[:n_queries]
    s = q @ sample.T
    s[np.arange(len(q)), np.arange(len(q))] = -2
    k = min(k, len(sample) - 1)
    true = np.argpartition(-s, k - 1, axis=1)[:, :k]
    wide = 4.0
    dq = index.near(q, wide, 8)
    dq /= dq.min(axis=1, keepdims=True)
    dv = index.near(sample[true.ravel()], max(reaches), most)
    ds = index.near(sample[:n_posted], max(reaches), most)
    best = None
    for reach in reaches:
        m = most if reach > 1 else 1
        meets = posted(dv, reach, m).reshape(*true.shape, -1)
        need = np.where(meets, dq[:, None, :], np.inf).min(axis=2)
        ratio = float(np.quantile(need, recall, method="higher")) + 1e-9
        if not np.isfinite(ratio):
            continue
        sizes = posted(ds, reach, m).mean(axis=0)         # rows of each list, as a share of all
        share = float(((dq <= ratio) @ sizes).mean())
        if best is None or share < best[2] - 1e-12:
            best = (reach, ratio, share)
    return best or (1.0, 1e18, 1.0)


def _post_task(shared, dim: int, ratio: float, at_least: int, most: int | None):
    """Rows (list, id, v) for the lists within ``ratio`` of the nearest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = index.near(unit(matrix(part.column("v"), dim)), ratio, at_least)
                if most is None:
                    ok = found <= found.min(axis=1, keepdims=True) * ratio
                else:
                    ok = posted(found, ratio, most)
                rows, lists = np.nonzero(ok)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lists.astype(np.int32)), part.column("id").take(pa.array(rows)), part.column("v").take(pa.array(rows))],
                    names=["list", "id", "v"])
    return run


def exact(q: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Cosines in double precision on the vectors as they are; row by row, so
    that equal vectors score equally.  Scaling by powers of two, which changes
    no digit, keeps the squares from overflow and underflow."""
    m = np.ldexp(m, -np.frexp(np.abs(m).max(axis=1, keepdims=True))[1])
    q = np.ldexp(q, -np.frexp(np.abs(q).max())[1])
    return (m * q).sum(axis=1) / (np.sqrt((m * m).sum(axis=1)) * np.sqrt((q * q).sum()))


class Chunk:
    """Vectors of a list in one task, with lists of their own if there are many."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, k: int, list_rows: int, recall: float):
        self.ids, self.m, self.k, self.unit = ids, m, k, unit(m)
        self.repeats = len(np.unique(ids)) < len(ids)
        self.sub = None
        if len(ids) > 4 * list_rows:
            self.sub = build_index(self.unit, len(ids) // list_rows)
            of = np.concatenate([self._nearest(self.unit[a:a + 4096]) for a in range(0, len(ids), 4096)])
            order = np.argsort(of, kind="stable")
            self.members = np.split(order, np.cumsum(np.bincount(of, minlength=len(self.sub.centroids)))[:-1])
            seen = np.random.default_rng(1).permutation(len(ids))
            _, self.ratio, _ = calibrate(self.sub, self.unit[seen], k, recall, reaches=(1.0,), most=1, n_queries=128)

    def _nearest(self, x: np.ndarray) -> np.ndarray:
        c = self.sub.centroids
        return ((c ** 2).sum(axis=1)[None, :] - 2 * x @ c.T).argmin(axis=1)

    def _among(self, q: np.ndarray, qid: int, rough: np.ndarray, at: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """The best ``k`` of the rows ``at`` (None: all), by exact scores."""
        ids = self.ids if at is None else self.ids[at]
        other = ids != qid
        n = min(self.k, int(other.sum()))
        if not n:
            return np.zeros(0, np.int64), np.zeros(0)
        rough = np.where(other, rough, -3.0)
        # rows that repeat an id count once among the best: no floor then
        floor = -2.0 if self.repeats else np.partition(rough, len(rough) - n)[len(rough) - n] - 1e-9
        near = np.nonzero(rough >= floor)[0]
        rows = near if at is None else at[near]
        s = exact(q, self.m[rows])
        order = np.lexsort((self.ids[rows], -s))
        top = order[np.sort(np.unique(self.ids[rows][order], return_index=True)[1])[:self.k]]
        return self.ids[rows][top], s[top]

    def best(self, qids: np.ndarray, q: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids and scores found for each query; as many as ``k`` if the chunk has them."""
        u = unit(q)
        found = []
        if self.sub is None:
            rough = u @ self.unit.T
            found = [self._among(q[i], qids[i], rough[i], None) for i in range(len(q))]
        else:
            d = self.sub.near(u, self.ratio, 1)
            probed = d <= d.min(axis=1, keepdims=True) * self.ratio
            for i in range(len(q)):
                at = np.concatenate([self.members[j] for j in np.nonzero(probed[i])[0]])
                got = self._among(q[i], qids[i], self.unit[at] @ u[i], at) if len(at) else (np.zeros(0, np.int64),) * 2
                if len(got[0]) < self.k:
                    got = self._among(q[i], qids[i], self.unit @ u[i], None)
                found.append(got)
        return [f[0] for f in found], [f[1] for f in found]


def _visit_task(dim: int, k: int, list_rows: int, recall: float):
    """Streams queries past one chunk of a list at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, chunk = None, [], None
        for batch in batches:
            where = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("list", "chunk", "salt", "asks")], axis=1)
            cuts = np.concatenate([[0], np.nonzero((np.diff(where, axis=0) != 0).any(axis=1))[0] + 1, [len(where)]])
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if tuple(where[a][:3]) != key:
                    key, held, chunk = tuple(where[a][:3]), [], None
                if not where[a][3]:
                    held.append((part.column("id").to_numpy(zero_copy_only=False), matrix(part.column("v"), dim)))
                    continue
                if chunk is None:
                    if not held:
                        continue
                    chunk = Chunk(*(np.concatenate(x) for x in zip(*held)), k, list_rows, recall)
                    held = []
                for c in range(0, part.num_rows, 512):
                    some = part.slice(c, 512)
                    qids = some.column("id").to_numpy(zero_copy_only=False)
                    ids, scores = chunk.best(qids, matrix(some.column("v"), dim))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(qids, [len(x) for x in ids])), pa.array(np.concatenate(ids), pa.int64()),
                         pa.array(np.concatenate(scores), pa.float64())], names=["query_id", "vec_id", "score"])
    return run


#: Queries that one task scores against one chunk.
PROBES = 1 << 16


def _search(posts: DataFrame, queries: DataFrame, dim: int, k: int, chunk_rows: int, list_rows: int, recall: float) -> DataFrame:
    """query_id, vec_id, score: the ``k`` best that each chunk has for each query of its list."""
    def pieces(df: DataFrame, name: str, rows: int) -> DataFrame:
        return df.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias(name))

    # one row per list, and the number of lists is bounded by the sample
    sizes = table(pieces(posts, "chunks", chunk_rows).join(pieces(queries, "copies", PROBES), "list"), "lists")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))                      # noqa: E731
    one = lambda n: F.pmod(F.xxhash64("id", "v"), F.col(n)).cast("int")                 # noqa: E731
    held = posts.join(F.broadcast(sizes), "list").withColumn("chunk", one("chunks")).withColumn("salt", each("copies"))
    asked = queries.join(F.broadcast(sizes), "list").withColumn("salt", one("copies")).withColumn("chunk", each("chunks"))
    cols = ["list", "chunk", "salt", "asks", "id", "v"]
    both = held.withColumn("asks", F.lit(0)).select(*cols).unionByName(asked.withColumn("asks", F.lit(1)).select(*cols))
    both = both.repartition("list", "chunk", "salt").sortWithinPartitions("list", "chunk", "salt", "asks")
    return both.mapInArrow(_visit_task(dim, k, list_rows, recall), "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, queries: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5,
            sample_rows: int = 20_000, list_rows: int = 256, max_copies: int = 8, recall: float = 0.97,
            chunk_rows: int = 1 << 16) -> DataFrame:
    """query_id, rank, vec_id, score.  ``queries`` is a condition on ``id``.

    The first level is fitted on ``sample_rows`` vectors, least by a hash of
    the id, and has at most an eighth as many lists, so its broadcast is
    bounded; every vector is posted.  Longer lists are divided again, in tasks,
    down to about ``list_rows`` vectors.
    """
    spark = vectors.sparkSession
    rows = pick(vectors, id=id_col, v=vector_col).select(F.col("id").cast("long").alias("id"), F.col("v").cast("array<double>").alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("v")))
    dims = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if dims is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, total = dims["d"], dims["count"]
    rows = rows.filter(F.size("v") == dim)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("v").toArrow()
    sample = unit(matrix(sample.column("v").combine_chunks(), dim))
    index = build_index(sample, max(1, min(total // list_rows, len(sample) // 8)))
    reach, ratio, _ = calibrate(index, sample, k, recall, most=max_copies)
    shared = spark.sparkContext.broadcast(index)
    schema = "list int, id long, v array<double>"
    posts = table(rows.mapInArrow(_post_task(shared, dim, reach, max_copies, max_copies if reach > 1 else 1), schema), "posts")
    asked = rows.filter(queries)
    probes = table(asked.mapInArrow(_post_task(shared, dim, ratio, 8, None), schema), "probes")
    visit = dict(dim=dim, k=k, chunk_rows=chunk_rows, list_rows=list_rows, recall=recall)
    found = table(_search(posts, probes, **visit), "found")
    enough = found.groupBy("query_id").agg(F.count_distinct("vec_id").alias("n")).filter(F.col("n") >= min(k, total - 1))
    short = asked.join(enough, asked["id"] == enough["query_id"], "left_anti")
    if not short.isEmpty():        # these read all lists
        wide = short.mapInArrow(_post_task(shared, dim, float("1e18"), len(index.centroids), None), schema)
        found = found.unionByName(_search(posts, table(wide, "wide"), **visit))
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
