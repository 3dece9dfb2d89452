"""Document fingerprints by consistent weighted sampling.

A text's terms are its words (A-Z lower-cased), weighted by how often they
occur.  Each of ``samples`` draws gives every (term, weight) a number built
from two gamma variables and a uniform one, all hashes of the term and the
draw, and keeps the term with the least.  Two texts keep the same term at the
same step of the weight scale with a probability equal to the generalised
Jaccard similarity of their weights (sum of minima over sum of maxima), so
the share of equal places of two fingerprints estimates it.

``fingerprints`` is a narrow map.  ``edited_documents`` also compares each
document with the one after it: rows go to buckets of consecutive documents
by bounds taken from a bounded sample (which affects balance only), the first
document of each bucket also to the bucket before, so that one shuffle of the
texts and a stream over each sorted bucket give every row its successor.
Fingerprints are made in that stream, a text's beside its edited text's.

Defined results: a null or blank text has no terms and the fingerprint of
zeros; equal texts have equal fingerprints; rows are ordered by id (null
last), then by a hash of the text; a row that repeats id and text is followed
by its copy, and the last copy by the next document; the last row is followed
by the first (one row: by itself); an empty table gives no rows; other columns
are ignored.  Very long texts are whole: their terms are drawn in blocks.
"""

from __future__ import annotations

import bisect
import hashlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain, count, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import pick

SAMPLES = 64
SEED = 42
#: (term, weight) rows kept by a worker, and rows drawn at a time.
KEPT, BLOCK = 1 << 16, 1 << 8
#: Times that a pair is met before its draws are kept; a text's least draw is
#: above ln(REACH / weight) with a probability of exp(-REACH).
OFTEN, REACH = 8, 8.0
#: Documents, or code points if those are more, whose texts are sampled together.
GROUP, GROUP_CHARS = 32, 1 << 17
_PLACE = np.uint64(0xFFFF)
_FIRST, _SECOND, _THIRD = (np.uint32(c) for c in (0x3C6EF372, 0xDAA66D2B, 0x78DDE6E4))


def _mix(x: np.ndarray) -> np.ndarray:
    """A 32-bit finaliser (shifts, xors and odd multipliers), in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def _gamma(x: np.ndarray) -> np.ndarray:
    """Minus gamma variables of shape 2: two uniform numbers of 16 bits a hash."""
    u, v = (h.view(np.int32).astype(np.float32) for h in (x >> np.uint32(16), x & np.uint32(0xFFFF)))
    u += np.float32(0.5)
    v += np.float32(0.5)
    u *= v
    u *= np.float32(2.0 ** -32)
    return np.log(u, out=u)


def term_hashes(terms: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, terms, repeat(SEED)), dtype=np.uint64, count=len(terms))


def _own(h: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """The hash of a term and a draw that all its numbers are made from."""
    own = _mix((h & np.uint64(0xFFFFFFFF)).astype(np.uint32) + draw * np.uint32(0x9E3779B1))
    own ^= (h >> np.uint64(32)).astype(np.uint32)
    return own


def _draw(h: np.ndarray, weights: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """For each term (by its hash) with its weight and draw, the number whose
    least wins; its last 16 bits are what the fingerprint then holds, a hash of
    the term and the step of its weight."""
    own = _own(h, draw)
    first, second, place = (_mix(own + c) for c in (_FIRST, _SECOND, _THIRD))
    minus_r, minus_c = _gamma(first), _gamma(second)
    beta = (place >> np.uint32(9)).view(np.int32).astype(np.float32)
    beta += np.float32(0.5)
    beta *= np.float32(2.0 ** -23)
    t = np.floor(beta - np.log(weights.astype(np.float32)) / minus_r)
    place += t.astype(np.int32).view(np.uint32) * np.uint32(0x9E3779B1) + np.uint32(1)
    # ln c - r (t - beta) - r
    beta -= t
    beta -= np.float32(1)
    beta *= minus_r
    value = np.log(np.negative(minus_c, out=minus_c), out=minus_c)
    value -= beta
    # a single-precision number leaves the last 29 bits of a double free
    out = value.astype(np.float64)
    out.view(np.uint64)[...] |= _mix(place) & np.uint32(0xFFFF)
    return out


def draws(h: np.ndarray, weights: np.ndarray, samples: int = SAMPLES) -> np.ndarray:
    """``_draw`` of each term with its weight in every draw."""
    return _draw(h[:, None], weights[:, None], np.arange(samples, dtype=np.uint32)[None, :])


def floors(h: np.ndarray, samples: int = SAMPLES) -> np.ndarray:
    """2**32 times a number that is at most c exp(-r), in whole numbers alone.

    As r (t - beta) is at most the logarithm of the weight, no draw of the term
    with weight w is less than ln(floor / 2**32 / w).  With p and q the products
    of two uniform numbers, exp(-r) is q, and c = -ln p is at least 1 - p."""
    own = _own(h[:, None], np.arange(samples, dtype=np.uint32)[None, :])
    q, p = _mix(own + _FIRST), _mix(own + _SECOND)
    q = (q >> np.uint32(16)) * (q & np.uint32(0xFFFF))
    p = (p >> np.uint32(16)) * (p & np.uint32(0xFFFF))
    q >>= np.uint32(16)
    # halves are added to the uniform numbers: p is by up to 2**16 larger
    np.subtract(np.uint32(0xFFFEFFFF), p, out=p)
    p >>= np.uint32(16)
    p *= q
    return p


class Sampler:
    """Fingerprints of texts.  The draws of (term, weight) pairs met often are
    kept while there is room; when there is none, the half met least goes.

    Of other pairs, only draws that may be the least of a text are made: those
    whose floor is under a limit.  The limit is the largest of the text's least
    draws so far, or ``REACH`` through the text's weight, which the least is
    hardly ever above; where it is, the text is done again without the latter."""

    def __init__(self, samples: int = SAMPLES):
        self.samples = samples
        self.rows: dict[int, int] = {}
        self.drawn = np.empty((KEPT, samples))
        self.of = np.empty((KEPT, 2), dtype=np.uint64)
        self.met = np.zeros(KEPT, dtype=np.int64)
        self.seen = np.zeros(64 * KEPT, dtype=np.uint8)
        self.marks = 0

    def _find(self, h: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A number for each pair, and where its draws are kept (-1: nowhere)."""
        key = h + w.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        at = np.fromiter(map(self.rows.get, key.tolist(), repeat(-1)), dtype=np.int64, count=len(key))
        at[(self.of[at, 0] != h) | (self.of[at, 1] != w.astype(np.uint64))] = -1       # another pair of that number
        return key, at

    def _make_room(self) -> None:
        order = np.argsort(-self.met[:len(self.rows)], kind="stable")[:KEPT // 2]
        keys = list(self.rows)
        self.rows = {keys[i]: at for at, i in enumerate(order.tolist())}
        for kept in (self.drawn, self.of):
            kept[:len(order)] = kept[order]
        self.met[:len(order)] = self.met[order] // 2
        self.met[len(order):] = 0

    def _keep(self, key: np.ndarray, h: np.ndarray, w: np.ndarray) -> None:
        """Keep the draws of those pairs that were met often enough by now."""
        mark = key % np.uint64(len(self.seen))
        seen = self.seen[mark]
        self.seen[mark] = np.minimum(seen, OFTEN) + 1
        self.marks += int(np.count_nonzero(seen == 0))
        if self.marks > len(self.seen) // 4:
            self.seen >>= 1
            self.marks = int(np.count_nonzero(self.seen))
        often = np.array([i for i in np.flatnonzero(seen >= OFTEN).tolist() if int(key[i]) not in self.rows], dtype=np.int64)
        for a in range(0, len(often), BLOCK):
            some = often[a:a + BLOCK]
            if len(self.rows) + len(some) > KEPT:
                self._make_room()
            new = slice(len(self.rows), len(self.rows) + len(some))
            self.drawn[new] = draws(h[some], w[some], self.samples)
            self.of[new, 0], self.of[new, 1] = h[some], w[some]
            self.rows.update(zip(key[some].tolist(), range(new.start, new.stop)))

    def _lower_kept(self, best: np.ndarray, rows: np.ndarray, of: np.ndarray) -> None:
        """Lower ``best`` by kept draws, each of the text ``of`` (ascending)."""
        self.met[rows] += 1
        starts = np.flatnonzero(np.diff(of, prepend=-1)).tolist()
        for a, b in zip(starts, [*starts[1:], len(of)]):
            here = best[of[a]]
            for c in range(a, b, 16 * BLOCK):
                np.minimum(here, self.drawn[rows[c:min(b, c + 16 * BLOCK)]].min(axis=0), out=here)

    def _lower(self, best: np.ndarray, h: np.ndarray, w: np.ndarray, which: np.ndarray, of: np.ndarray, limit: np.ndarray) -> None:
        """Lower ``best`` by draws of pairs: of the pair ``which`` for the text ``of``."""
        under = np.zeros(len(h))
        np.maximum.at(under, which, np.minimum(np.exp(best.max(axis=1)), limit)[of])
        # the share added is above what rounding does to a draw
        under = np.minimum(1.01 * 2.0 ** 32 * under * w + 2, 0xFFFFFFFF).astype(np.uint32)[:, None]
        cells = np.concatenate([np.flatnonzero(floors(h[a:a + BLOCK], self.samples) < under[a:a + BLOCK]) + a * self.samples
                                for a in range(0, len(h), BLOCK)])
        row, draw = np.divmod(cells, self.samples)
        value = _draw(h[row], w[row], draw.astype(np.uint32))
        # each pair's cells to each text that has the pair
        start = np.searchsorted(row, np.arange(len(h) + 1))
        n = np.diff(start)[which]
        at = np.repeat(start[which] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        np.minimum.at(best.reshape(-1), np.repeat(of * self.samples, n) + draw[at], value[at])

    def many(self, texts: list[str | None]) -> list[np.ndarray]:
        """Fingerprints of some texts; pairs that several of them have are drawn once."""
        split = [(t or "").encode().lower().split() for t in texts]
        total = np.array([len(x) for x in split])
        best = np.full((len(texts), self.samples), np.inf)
        if total.any():
            ids: defaultdict[bytes, int] = defaultdict(count().__next__)
            word = np.fromiter(map(ids.__getitem__, chain.from_iterable(split)), dtype=np.int64, count=total.sum())
            here, times = np.unique(np.repeat(np.arange(len(texts)) * len(ids), total) + word, return_counts=True)
            of, term = np.divmod(here, len(ids))
            pair, which = np.unique(term * (times.max() + 1) + times, return_inverse=True)
            term, w = np.divmod(pair, times.max() + 1)
            h = term_hashes(list(ids))[term]
            key, rows = self._find(h, w)
            kept = rows[which] >= 0
            if kept.any():
                self._lower_kept(best, rows[which[kept]], of[kept])
            # the others, by pair
            new = np.flatnonzero(rows < 0)
            which, of = (np.cumsum(rows < 0) - 1)[which[~kept]], of[~kept]
            order = np.argsort(which, kind="stable")
            which, of, key, h, w = which[order], of[order], key[new], h[new], w[new]
            limit = REACH / np.maximum(total, 1)
            while len(which):
                ends = np.searchsorted(which, np.arange(0, len(h) + 16 * BLOCK, 16 * BLOCK)).tolist()
                for a, b, c in zip(ends, ends[1:], range(0, len(h), 16 * BLOCK)):
                    if a < b:
                        self._lower(best, h[c:c + 16 * BLOCK], w[c:c + 16 * BLOCK], which[a:b] - c, of[a:b], limit)
                again = ((best > np.log(limit)[:, None]).any(axis=1) & (total > 0))
                limit[again] = np.inf
                which, of = which[again[of]], of[again[of]]
            if len(new):
                self._keep(key, h, w)
        best[total == 0] = 0
        return list((best.view(np.uint64) & _PLACE).astype("<u2"))

    def __call__(self, text: str | None) -> np.ndarray:
        return self.many([text])[0]


def _groups(texts: Iterable[str | None]) -> Iterator[list[str]]:
    """Texts in groups for ``Sampler.many``: a few, or one that is long."""
    group, chars = [], 0
    for t in texts:
        group.append(t or "")
        chars += len(group[-1])
        if len(group) == GROUP or chars >= GROUP_CHARS:
            yield group
            group, chars = [], 0
    if group:
        yield group


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal places: the estimate of generalised Jaccard similarity."""
    return np.count_nonzero(a == b) / len(a)


def edited(text: str, after: str) -> str:
    """``text`` with its last half replaced by as much of the start of ``after``."""
    h = len(text) // 2
    return text[:len(text) - h] + after[:h]


def _string(fp: np.ndarray) -> str:
    return fp.astype(">u2").tobytes().hex()


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """doc_id, fingerprint (four hex digits a draw)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = Sampler(samples)
        for batch in batches:
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "fingerprint": pa.array([_string(fp) for group in _groups(t.as_py() for t in batch.column("text"))
                                         for fp in sample.many(group)], pa.string())})

    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, fingerprint string")


# ------------------------------------------------- a document and the next one

KEY = ("last", "doc_id", "th")
_KEY_SCHEMA = "last boolean, doc_id long, th long"


def _keys(batch: pa.RecordBatch) -> list[tuple[bool, int, int]]:
    return list(zip(batch.column("last").to_pylist(), (i or 0 for i in batch.column("doc_id").to_pylist()),
                    batch.column("th").to_pylist()))


def _first_task(bounds: list[tuple]):
    """The least key of each bucket among a task's rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[int, tuple] = {}
        for batch in batches:
            for key in _keys(batch):
                b = bisect.bisect_right(bounds, key)
                if b not in least or key < least[b]:
                    least[b] = key
        rows = list(least.values())
        yield pa.RecordBatch.from_arrays([pa.array(list(least), pa.int32()), pa.array([r[0] for r in rows], pa.bool_()),
                                          pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())],
                                         names=["bucket", *KEY])
    return run


_ROW = pa.schema([("bucket", pa.int32()), ("copy", pa.bool_()), ("last", pa.bool_()), ("doc_id", pa.int64()),
                  ("th", pa.int64()), ("times", pa.int64()), ("text", pa.string())])


def _bucket_task(bounds: list[tuple], before: dict[tuple, int]):
    """Rows with their bucket; a bucket's first row also as a copy for the
    bucket before it.  Repeated rows of a batch go as one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same: Counter = Counter()
            place = {}
            texts = batch.column("text")
            for i, key in enumerate(_keys(batch)):
                known = place.get(key)
                j = i if known is None or texts[known].as_py() != texts[i].as_py() else known
                place.setdefault(key, i)
                same[(key, j)] += 1
            out = {name: [] for name in _ROW.names}
            for (key, i), n in same.items():
                text = texts[i].as_py() or ""
                targets = [(bisect.bisect_right(bounds, key), False)]
                if key in before:
                    targets.append((before[key], True))
                for bucket, copy in targets:
                    for name, x in zip(_ROW.names, (bucket, copy, *key, n, text)):
                        out[name].append(x)
            yield pa.RecordBatch.from_pydict(out, schema=_ROW)
    return run


_OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                  ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
                  ("times", pa.int64())])


def _row_groups(batch: pa.RecordBatch) -> Iterator[list[dict]]:
    """Rows of a batch, divided as ``_groups`` divides their texts."""
    at = 0
    for texts in _groups(t.as_py() for t in batch.column("text")):
        yield [dict(r, text=t) for r, t in zip(batch.slice(at, len(texts)).drop_columns("text").to_pylist(), texts)]
        at += len(texts)


def _edited_task(samples: int):
    """A stream over sorted buckets: each row beside the row after it.  A text
    and its edited text, which is half the same, are sampled together."""
    def row(own: dict, after: dict, text: str, fp_edited: np.ndarray, times: int) -> tuple:
        return (None if own["last"] else own["doc_id"], len(own["text"]), hashlib.sha256(text.encode()).hexdigest(), _string(own["fp"]),
                _string(fp_edited), likeness(own["fp"], fp_edited), likeness(own["fp"], after["fp"]), times)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = Sampler(samples)
        own = None
        for batch in batches:
            out = []
            for group in _row_groups(batch):
                pairs = []
                for here in group:
                    if own is not None and not own["copy"]:
                        if own["bucket"] != here["bucket"]:
                            raise AssertionError("a bucket without the row that follows it")
                        pairs.append((own, here, 1))
                    if here["times"] > 1 and not here["copy"]:
                        pairs.append((here, here, here["times"] - 1))
                    own = here
                texts = [edited(a["text"], b["text"]) for a, b, _ in pairs]
                fps = sample.many([r["text"] for r in group] + texts)
                for r, fp in zip(group, fps):
                    r["fp"] = fp
                out += [row(a, b, text, fp, times) for (a, b, times), text, fp in zip(pairs, texts, fps[len(group):])]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(_OUT)], schema=_OUT)
        if own is not None and not own["copy"]:
            raise AssertionError("a bucket without the row that follows it")
    return run


def edited_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES,
                     parts: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next: each document, its text with the last half replaced
    by the start of the next document, and how alike they are."""
    spark = docs.sparkSession
    rows = pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").isNull().alias("last"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    keys = rows.select(*KEY)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(3 * parts, 2048)
    total = rows.count()
    if total:
        # some 50 keys a bucket, whatever the table's size; they only set the balance
        sample = sorted(tuple(k) for k in keys.select("last", F.coalesce("doc_id", F.lit(0)), "th")
                        .sample(min(1.0, 50 * buckets / total), seed=SEED).collect())
        bounds = sorted({sample[len(sample) * i // buckets] for i in range(1, buckets)}) if sample else []
        least = keys.mapInArrow(_first_task(bounds), f"bucket int, {_KEY_SCHEMA}")
        firsts = {r["bucket"]: tuple(r["k"]) for r in
                  least.groupBy("bucket").agg(F.min(F.struct(*KEY)).alias("k")).collect()}     # one row per bucket
        order = sorted(firsts)
        before = {firsts[b]: order[i - 1] for i, b in enumerate(order)}      # the first comes after the last
    else:
        bounds, before = [], {}
    placed = rows.mapInArrow(_bucket_task(bounds, before),
                             "bucket int, copy boolean, last boolean, doc_id long, th long, times long, text string")
    placed = placed.repartition(parts, "bucket").sortWithinPartitions("bucket", "copy", "last", "doc_id", "th")
    out = placed.mapInArrow(_edited_task(samples), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                            "edited_fingerprint string, near_edited double, near_next double, times long")
    once = F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))
    return out.withColumn("times", once).drop("times")
