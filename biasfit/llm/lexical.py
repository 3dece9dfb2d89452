"""Ranked lexical search with bag deduplication.

Each document is restricted to the vocabulary of the items: its bag is the
vector of (term, frequency) pairs left over, with its length number m.  All
that a score depends on is the bag and m, so documents that agree in both form
a class: they are grouped by a hash and by the bytes themselves, which is the
verification.  Each class is scored once against all items; every task keeps
the ``k`` best classes of each item (by score, then by the class's least
doc_id; later ones can't hold a document among the ``k`` best).  Only the
classes that are left are expanded to their members, the ``k`` smallest ids of
each, and ranked again.

Items are taken in chunks whose (item, term) pairs are at most ``pairs`` (one
item may exceed it alone), so what is broadcast is bounded whatever their
number; documents are read once per chunk.  Counts of documents and of terms
are exact and cover all documents.

Defined results: a null text has no terms; documents without a term don't
count in N; items without a term that any document holds give no rows;
repeated rows of documents rank each on its own, null ids last; an item row
that repeats id and terms counts once, rows that share only the id are items
of their own; very long texts are whole; empty tables give no rows; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import pick, table

#: (item, term) pairs of a chunk of items; scores computed at a time.
PAIRS, CELLS = 1 << 20, 1 << 21
#: Bytes of UTF-8: term characters as they are (A-Z lowered), all else a blank.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
TOP_SCHEMA = "item int, score long, class long, first long"


def terms(text: str | None) -> list[bytes]:
    """Terms of a text: runs of letters, digits and all that isn't ASCII."""
    return (text or "").encode().translate(_FOLD).split()


def _items_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sorted(set(terms(t.as_py()))) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(found, pa.list_(pa.binary()))], names=["item_id", "terms"])


def _bags_task(shared):
    """doc_id, n (all terms), bag (term number and frequency, ascending) of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for batch in batches:
            n, bags = [], []
            for t in batch.column("text"):
                ws = terms(t.as_py())
                n.append(len(ws))
                at = np.array([i for w in ws if (i := number.get(w)) is not None], dtype="<u4")
                bags.append(np.stack(np.unique(at, return_counts=True), axis=1).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(bags, pa.binary())],
                                             names=["doc_id", "n", "bag"])
    return run


def _frequency_task(size: int):
    """Documents that hold each term, of one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for bag in batch.column("bag"):
                df[np.frombuffer(bag.as_py(), dtype="<u4")[::2]] += 1
        at = np.nonzero(df)[0]
        yield pa.RecordBatch.from_pydict({"term": pa.array(at.astype(np.int32)), "df": pa.array(df[at])})
    return run


def _better(score: np.ndarray, first: np.ndarray, cls: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` best by score, then least first id."""
    return np.lexsort((cls, first, -score))[:k]


def _score_task(shared, k: int):
    """The ``k`` best classes of each item among a task's."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, flat, starts = shared.value
        items = len(starts)
        best: list[tuple | None] = [None] * items
        floor = np.ones(items, dtype=np.int64)            # scores above 0 only
        step = max(1, CELLS // max(items, 1))
        dense = np.zeros(len(weight), dtype=np.int64)
        for batch in batches:
            first = batch.column("first").fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
            cls = batch.column("class").to_numpy(zero_copy_only=False)
            m = batch.column("m").to_numpy(zero_copy_only=False)
            for a in range(0, batch.num_rows, step):
                rows = range(a, min(a + step, batch.num_rows))
                scores = np.empty((len(rows), items), dtype=np.int64)
                for i in rows:
                    pairs = np.frombuffer(batch.column("bag")[i].as_py(), dtype="<u4").astype(np.int64)
                    at, tf = pairs[::2], pairs[1::2]
                    dense[at] = weight[at] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[i]))
                    scores[i - a] = np.add.reduceat(dense[flat], starts)
                    dense[at] = 0
                for j in np.nonzero((scores >= floor).any(axis=0))[0]:
                    hit = np.nonzero(scores[:, j] >= floor[j])[0]
                    new = (scores[hit, j], first[a + hit], cls[a + hit])
                    old = best[j]
                    s, f, c = new if old is None else (np.concatenate(x) for x in zip(old, new))
                    top = _better(s, f, c, k)
                    best[j] = (s[top], f[top], c[top])
                    if len(top) == k:
                        floor[j] = s[top[-1]]
        kept = [(j, b) for j, b in enumerate(best) if b is not None]
        cat = lambda x, kind: np.concatenate(x) if x else np.zeros(0, dtype=kind)                  # noqa: E731
        first = cat([b[1] for _, b in kept], np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cat([np.full(len(b[0]), j, dtype=np.int32) for j, b in kept], np.int32), pa.int32()),
             pa.array(cat([b[0] for _, b in kept], np.int64), pa.int64()), pa.array(cat([b[2] for _, b in kept], np.int64), pa.int64()),
             pa.array(first, pa.int64(), mask=first == np.iinfo(np.int64).max)], names=["item", "score", "class", "first"])
    return run


def _ranked_chunk(docs: DataFrame, chunk: pa.Table, k: int) -> DataFrame | None:
    """chunk: item_id, terms of some items."""
    spark = docs.sparkSession
    lists = chunk.column("terms").to_pylist()
    number: dict[bytes, int] = {}
    for ts in lists:
        for t in ts:
            number.setdefault(t, len(number))
    bags = table(docs.mapInArrow(_bags_task(spark.sparkContext.broadcast(number)), "doc_id long, n long, bag binary"), "bags")
    total, length = bags.filter("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    if not total:
        return None
    df = np.zeros(len(number), dtype=np.int64)
    for r in (bags.filter(F.length("bag") > 0).select("bag").mapInArrow(_frequency_task(len(number)), "term int, df long")
              .groupBy("term").agg(F.sum("df").alias("df")).collect()):           # the items' vocabulary
        df[r["term"]] = r["df"]
    weight = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * int(d) + 1))) for d in df], dtype=np.int64)

    m = F.expr(f"CAST(10 + (CAST(90 AS DECIMAL(20, 0)) * n * CAST({total} AS DECIMAL(18, 0))) DIV CAST({length} AS DECIMAL(20, 0)) AS BIGINT)")
    held = bags.filter(F.length("bag") > 0).select("doc_id", m.alias("m"), "bag")
    held = held.withColumn("h", F.xxhash64("bag", "m"))
    # equal hashes and equal bytes: a class, whose members are identical
    classes = held.groupBy("h", "m", "bag").agg(F.min("doc_id").alias("first"))
    classes = table(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    starts = np.cumsum([0] + [len(ts) for ts in lists[:-1]])
    flat = np.array([number[t] for ts in lists for t in ts], dtype=np.int64)
    shared = spark.sparkContext.broadcast((weight, flat, starts))
    tops = classes.select("class", "m", "bag", "first").mapInArrow(_score_task(shared, k), TOP_SCHEMA)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("first"), "class")
    tops = table(tops.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k).drop("r"), "tops")

    # at most k classes an item: their hashes are bounded by the chunk of items
    won = classes.join(tops.select("class").distinct(), "class").select("class", "h", "m", "bag")
    near = held.join(F.broadcast(won.select("h").distinct()), "h", "left_semi")
    least = Window.partitionBy("h", "m", "bag").orderBy(F.asc_nulls_last("doc_id"))
    near = near.withColumn("r", F.row_number().over(least)).filter(F.col("r") <= k)
    members = near.join(won, ["h", "m", "bag"]).select("class", "doc_id")
    rank = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    out = (tops.select("item", "score", "class").join(members, "class")
           .withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k))
    ids = spark.createDataFrame(pa.table({"item": pa.array(range(len(lists)), pa.int32()), "item_id": chunk.column("item_id")}))
    return out.join(ids, "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
           item_text_col: str = "text", k: int = 10, pairs: int = PAIRS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each item."""
    spark = docs.sparkSession
    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    asked = pick(items, item_id=item_id_col, text=item_text_col)
    kind = asked.schema["item_id"].dataType.simpleString()
    asked = table(asked.mapInArrow(_items_task, f"item_id {kind}, terms array<binary>").filter(F.size("terms") > 0).distinct(), "items")
    size = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    chunks = -(-size // pairs)
    out = None
    for c in range(chunks):
        part = asked.filter(F.pmod(F.xxhash64("item_id", "terms"), F.lit(chunks)) == c).toArrow()
        found = _ranked_chunk(rows, part, k) if part.num_rows else None
        if found is not None:
            out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")


ORACLE = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') ts from documents),
i as (
  select item_id, unnest(list_distinct(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) t from benchmark),
g as (select count(*) n_docs, cast(sum(len(ts)) as bigint) n_all from d where len(ts) > 0),
f as (
  select doc_id, t, count(*) tf, any_value(n) n
  from (select doc_id, len(ts) n, unnest(ts) t from d) group by doc_id, t),
w as (select t, cast(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) as bigint) w
      from f, g where t in (select t from i) group by t),
s as (
  select item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_all)))) as bigint) score
  from i join w using (t) join f using (t), g group by item_id, doc_id)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) "rank", doc_id, score
from s where score > 0 qualify "rank" <= 10
"""
