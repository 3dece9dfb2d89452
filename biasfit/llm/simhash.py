"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments (22, 21 and 21 bits).  With at
most two differing bits, some segment is equal and the one after it differs in
one bit at most: the key is the equal segment with the index of a codeword of
the perfect (23, 12) Golay code near the other.  One side of the join has the
nearest codeword, the other all codewords within four bits (one or six), so
segments one bit apart always share a key.  Pairs that share a key are
verified on all 64 bits.

Keys with many fingerprints are refined: the bits not fixed by the key are cut
in three parts, one of which must be equal, and each part extends the key;
repeatedly, until no key is large.  No link is lost and none is capped.

Defined results: a null or blank text has fingerprint zero, linked like any
other; equal fingerprints are one node, so groups of copies never meet pair by
pair; rows with the same id are kept each, and ``keep_one`` tells them apart by
their texts; a null id comes last in its component; an empty table gives no
rows; other columns are ignored (or kept, by ``keep_one``).
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from ..operators.joins import keyed_join
from .common import TMP, may_be_among, pick, table
from .components import components

SHINGLE, MAX_BITS, SEED = 3, 2, 42
#: Segments as (lowest bit, bits).
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Generator polynomial of the binary Golay code (a fixed value).
GENERATOR = 0b101011100011
#: Shingles counted at a time in a very long text.
CHUNK = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a text's word shingles, repeats included."""
    ws = (text or "").encode().lower().split()     # bytes: A-Z and the six ASCII spaces only
    if not ws:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(ws) < shingle:
        grams = iter([b" ".join(ws)])
    else:
        grams = map(b" ".join, zip(*[ws[k:] for k in range(shingle)]))
    n = max(1, len(ws) - shingle + 1)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, CHUNK):
        h = np.fromiter((digest(next(grams), SEED) for _ in range(min(CHUNK, n - at))), dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def _fingerprint_task(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column("text")), dtype=np.uint64,
                              count=batch.num_rows)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "th": batch.column("th"),
                                              "fp": pa.array(fps.view(np.int64))})
    return run


@functools.lru_cache(maxsize=1)
def golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes by byte (3 x 256), the error pattern of each syndrome, and for
    patterns of three bits the five codewords of weight seven that hold them."""
    def rest(v: int) -> int:
        for k in range(22, 10, -1):
            if v >> k & 1:
                v ^= GENERATOR << (k - 11)
        return v

    bit = [rest(1 << k) for k in range(23)]
    by_byte = np.zeros((3, 256), dtype=np.int64)
    for byte in range(3):
        for v in range(256):
            for k in range(8):
                if v >> k & 1 and 8 * byte + k < 23:
                    by_byte[byte, v] ^= bit[8 * byte + k]
    leader = np.zeros(2048, dtype=np.int64)
    for n in range(4):
        for c in combinations(range(23), n):
            leader[functools.reduce(int.__xor__, (bit[k] for k in c), 0)] = sum(1 << k for k in c)
    near = np.zeros((2048, 5), dtype=np.int64)
    filled = np.zeros(2048, dtype=np.int64)
    for m in range(1 << 12):
        word = m << 11 | rest(m << 11)
        if word.bit_count() == 7:
            for c in combinations([k for k in range(23) if word >> k & 1], 3):
                s = bit[c[0]] ^ bit[c[1]] ^ bit[c[2]]
                near[s, filled[s]] = word
                filled[s] += 1
    return by_byte, leader, near


def codeword_indices(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For 23-bit values: the index of the nearest codeword, and the five more
    indices at four bits (-1 where there are none)."""
    by_byte, leader, near = golay()
    s = by_byte[0, v & 255] ^ by_byte[1, v >> 8 & 255] ^ by_byte[2, v >> 16]
    c = v ^ leader[s]
    more = np.where(near[s] != 0, (c[:, None] ^ near[s]) >> 11, -1)
    return c >> 11, more


def _keys_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, fp, own, free): own is true for the nearest codeword; free
    has the bits that the key's equal segment leaves open."""
    for batch in batches:
        fp = batch.column("fp").to_numpy(zero_copy_only=False)
        u = fp.view(np.uint64)
        seg = [(u >> np.uint64(lo) & np.uint64((1 << n) - 1)).astype(np.int64) for lo, n in SEGMENTS]
        for i, (lo, n) in enumerate(SEGMENTS):
            free = np.uint64((1 << 64) - 1 ^ ((1 << n) - 1) << lo).astype(np.int64)
            first, more = codeword_indices(seg[(i + 1) % 3])
            base = np.int64(i) << 34 | seg[i] << 12
            rows, cols = np.nonzero(more >= 0)
            key = np.concatenate([base | first, base[rows] | more[rows, cols]])
            both = np.concatenate([fp, fp[rows]])
            own = np.arange(len(key)) < len(fp)
            yield pa.RecordBatch.from_pydict({"key": pa.array(key), "fp": pa.array(both), "own": pa.array(own),
                                              "free": pa.array(np.full(len(key), free, dtype=np.int64))})


def _refine_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row three times: the free bits in three parts, one part more in the key."""
    for batch in batches:
        fp = batch.column("fp").to_numpy(zero_copy_only=False)
        free = batch.column("free").to_numpy(zero_copy_only=False)
        for mask in np.unique(free):
            at = np.nonzero(free == mask)[0]
            bits = [k for k in range(64) if int(mask) >> k & 1]
            for part in np.array_split(bits, 3):
                m = np.array([sum(1 << int(k) for k in part)], dtype=np.uint64).view(np.int64)[0]
                yield pa.RecordBatch.from_pydict({
                    "key": batch.column("key").take(pa.array(at)), "fp": pa.array(fp[at]),
                    "own": batch.column("own").take(pa.array(at)), "part": pa.array(np.full(len(at), m)),
                    "value": pa.array(fp[at] & m), "free": pa.array(np.full(len(at), mask & ~m))})


def links(fps: DataFrame, *, max_bits: int = MAX_BITS, bucket: int = 256) -> DataFrame:
    """fps: distinct fp.  Returns a, b: all pairs at most ``max_bits`` apart."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"max_bits must be at most {MAX_BITS}")
    rows = table(fps.select("fp").mapInArrow(_keys_task, "key long, fp long, own boolean, free long"), "keys")
    found = None
    while True:
        large = rows.filter("own").groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > bucket).select("key")
        large = table(large, "large")
        rest = rows.join(large, "key", "left_anti")
        own = rest.filter("own").select("key", F.col("fp").alias("a"))
        near = rest.select("key", F.col("fp").alias("b"))
        pairs = (own.join(near, "key").filter("a < b")
                 .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).select("a", "b").distinct())
        found = pairs if found is None else found.unionByName(pairs)
        if large.isEmpty():
            return found
        finer = rows.join(large, "key", "left_semi").mapInArrow(
            _refine_task, "key long, fp long, own boolean, part long, value long, free long")
        # the key is a hash of the path; a clash only adds pairs, which are verified
        rows = table(finer.select(F.xxhash64("key", "part", "value").alias("key"), "fp", "own", "free"), "finer")


def _members(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, th, fp) per row, th the text's hash; and per fingerprint its
    component's first document: the smallest id, then the smallest hash."""
    rows = pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    rows = table(rows.mapInArrow(_fingerprint_task(shingle), "doc_id long, th long, fp long"), "fingerprints")
    document = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "th")
    nodes = table(rows.groupBy("fp").agg(F.min(document).alias("least"), F.count(F.lit(1)).alias("n")), "nodes")
    groups = components(links(nodes, max_bits=max_bits))
    rooted = nodes.join(groups, nodes["fp"] == groups["node"], "left").select(
        "fp", "least", "n", F.coalesce("root", "fp").alias("root"))
    roots = rooted.groupBy("root").agg(F.min("least").alias("first"))
    return rows, table(rooted.join(roots, "root").select("fp", "n", "first"), "components")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id per row."""
    rows, comps = _members(docs, id_col, text_col, shingle, max_bits)
    out = keyed_join(rows, comps, "fp", "inner", count_col="n", total=rows.count(), salt_cols=["doc_id"])
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.col("first.doc_id").alias("component_id"))


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component, with all columns of ``docs``: its first
    document (smallest id, null last, then smallest hash of the text)."""
    rows, comps = _members(docs, id_col, text_col, shingle, max_bits)
    first = comps.select("first.*").distinct().select(F.col("doc_id").alias(TMP + "id"), F.col("th").alias(TMP + "th"))
    copies = rows.groupBy("doc_id", "th").agg(F.count(F.lit(1)).alias(TMP + "copies"))
    same = copies["doc_id"].eqNullSafe(first[TMP + "id"]) & (copies["th"] == first[TMP + "th"])
    of = copies.join(first.withColumn(TMP + "first", F.lit(True)), same, "left").select(
        copies["doc_id"].alias(TMP + "id"), copies["th"].alias(TMP + "th"), TMP + "copies", F.col(TMP + "first").isNotNull().alias(TMP + "first"))
    of = table(of, "kept")
    cols = docs.columns
    # rows that are kept as they stand aren't moved: the rest, and false hits, are joined
    open_ = of.filter(~F.col(TMP + "first") | (F.col(TMP + "copies") > 1)).select(F.xxhash64(TMP + "id", TMP + "th"))
    rows = docs.withColumns({TMP + "i": docs[id_col].cast("long"), TMP + "t": F.xxhash64(docs[text_col])})
    rows = may_be_among(rows, F.xxhash64(TMP + "i", TMP + "t"), open_, TMP + "open")
    stay = rows.filter(~F.col(TMP + "open")).select(*cols)
    kept = of.filter(TMP + "first").select(TMP + "id", TMP + "th", TMP + "copies")
    # the kept ids grow with the corpus: one plan at every size
    out = rows.filter(TMP + "open").join(kept.hint("merge"), F.col(TMP + "i").eqNullSafe(F.col(TMP + "id")) & (F.col(TMP + "t") == F.col(TMP + "th")))
    once = out.filter(F.col(TMP + "copies") == 1).select(*cols)
    # any copy does; the least by a hash of all columns, so that reruns agree (columns of any type have a JSON form)
    order = Window.partitionBy(TMP + "id", TMP + "th").orderBy(F.xxhash64(F.to_json(F.struct(*cols))))
    more = out.filter(F.col(TMP + "copies") > 1).withColumn(TMP + "k", F.row_number().over(order))
    return stay.unionByName(once).unionByName(more.filter(F.col(TMP + "k") == 1).select(*cols))
