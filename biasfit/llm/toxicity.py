"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes.

Features are hashed byte n-grams, present or not.  Each is scaled by its
log-count ratio between the classes and a logistic regression is fitted on the
scaled features.  The fit uses a bounded sample of labelled rows (``max_rows`` a
class among the ids that have a text, least by a hash of the id), whole texts of
any length.  Tasks count the features of each class; those that pass ``min_rows``
and ``min_ratio`` are kept, at most ``max_features`` by the strength of their
ratio, and only these columns of the sample reach the driver, in two bytes
each.  Every text is scored whole.

Defined results: null and empty texts score the classifier's intercept;
rows with a null id are scored but never trained on; repeated rows score alike;
without such texts of both classes every score is the share of toxic labels (0.5
without any); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import pick, table

BITS = 20
#: Lengths of the n-grams, in bytes.
ORDERS = (4, 5)
#: Bytes hashed at a time in a very long text.
CHUNK = 1 << 20
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def grams(text: str | None) -> Iterator[np.ndarray]:
    """Feature numbers of a text (with repeats), in chunks: A-Z lowered, white
    space as blanks, a blank at either end."""
    raw = np.frombuffer(b" " + (text or "").encode().lower().translate(_BLANKS) + b" ", dtype=np.uint8)
    for at in range(0, len(raw), CHUNK):
        part = raw[at:at + CHUNK + max(ORDERS) - 1].astype(np.uint64)
        for k, n in enumerate(ORDERS):
            if len(part) >= n:
                v = part[:len(part) - n + 1].copy()
                for j in range(1, n):
                    v |= part[j:len(part) - n + 1 + j] << np.uint64(8 * j)
                yield ((v + np.uint64(1)) * _MIX[k] >> np.uint64(64 - BITS)).astype(np.int32)


_BLANKS = bytes(32 if c in b"\t\n\x0b\x0c\r" else c for c in range(256))


def features(text: str | None) -> np.ndarray:
    return np.unique(np.concatenate([*grams(text), np.empty(0, np.int32)]))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _features_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "y": batch.column("y"), "x": pa.array([features(t.as_py()).tobytes() for t in batch.column("text")], pa.binary())})


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each class that hold each feature, of one task."""
    count = np.zeros((2, 1 << BITS), dtype=np.int64)
    for batch in batches:
        for y, x in zip(batch.column("y").to_pylist(), batch.column("x")):
            count[y, np.frombuffer(x.as_py(), dtype=np.int32)] += 1
    at = np.nonzero(count.any(axis=0))[0]
    yield pa.RecordBatch.from_pydict({"feature": pa.array(at.astype(np.int32)), "n0": pa.array(count[0, at]), "n1": pa.array(count[1, at])})


def _columns_task(shared):
    """Each row's kept features, by their place among them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(1 << BITS, -1, dtype=np.int32)
        place[shared.value] = np.arange(len(shared.value))
        for batch in batches:
            got = [place[np.frombuffer(x.as_py(), dtype=np.int32)] for x in batch.column("x")]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "y": batch.column("y"),
                                              "x": pa.array([p[p >= 0].astype(np.uint16).tobytes() for p in got], pa.binary())})
    return run


@dataclass
class Sample:
    """Labels of the training rows, their kept features, and the features' ratios;
    ``share``: of toxic labels in the population."""
    y: np.ndarray
    x: list[np.ndarray]
    features: np.ndarray
    ratio: np.ndarray
    share: float


def _sample(docs: DataFrame, labels: DataFrame, max_rows: int, *, alpha: float = 1.0, min_rows: int = 4, min_ratio: float = 1.0,
            max_features: int = 1 << 14) -> Sample:
    if max_features > 1 << 16:
        raise ValueError("max_features must be at most 65536")
    l = labels.filter("y is not null and doc_id is not null").filter(~held_out(F.col("doc_id")))
    l = l.groupBy("doc_id").agg(F.max("y").alias("y"))
    n = {int(r["y"]): r["count"] for r in l.groupBy("y").count().collect()}
    pos, neg = n.get(1, 0), n.get(0, 0)
    share = pos / (pos + neg) if pos + neg else 0.5
    texts = docs.filter("text is not null and doc_id is not null")
    # ids only: the classes are cut among the labels that have a text to learn from
    usable = table(l.join(texts.select("doc_id").distinct(), "doc_id", "left_semi"), "labelled")
    chosen = None
    for y in (0, 1):       # at most max_rows each: broadcast is bounded
        one = usable.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
        chosen = one if chosen is None else chosen.unionByName(one)
    texts = (texts.join(F.broadcast(chosen), "doc_id")
             .groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y")))
    rows = table(texts.select("doc_id", F.col("y").cast("int").alias("y"), "text").mapInArrow(
        _features_task, "doc_id long, y int, x binary"), "features")
    size = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    n0, n1 = size.get(0, 0), size.get(1, 0)
    counts = rows.mapInArrow(_count_task, "feature int, n0 long, n1 long").groupBy("feature").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    ratio = F.log((F.col("n1") + alpha) / (n1 + 2 * alpha)) - F.log((F.col("n0") + alpha) / (n0 + 2 * alpha))
    counts = counts.withColumn("ratio", ratio).filter((F.col("n0") + F.col("n1") >= min_rows) & (F.abs("ratio") >= min_ratio))
    strength = F.abs("ratio") * F.sqrt(F.col("n0") + F.col("n1"))
    kept = counts.orderBy(F.desc(strength), "feature").limit(max_features).select("feature", "ratio").toArrow().sort_by("feature")
    features = kept.column("feature").to_numpy()
    got = rows.mapInArrow(_columns_task(docs.sparkSession.sparkContext.broadcast(features)), "doc_id long, y int, x binary").toArrow()
    got = got.take(np.argsort(got.column("doc_id").to_numpy()))      # reruns add up in one order
    return Sample(got.column("y").to_numpy().astype(float), [np.frombuffer(x.as_buffer(), dtype=np.uint16) for x in got.column("x")],
                  features, kept.column("ratio").to_numpy(), share)


def fit(sample: Sample, *, l2: float = 1e-4, steps: int = 150, block: int = 256) -> tuple[np.ndarray, float]:
    """(weight by feature, intercept).  The share of class 1 in the population
    weighs the classes of the sample; rows are taken ``block`` at a time."""
    y, share, r = sample.y, sample.share, sample.ratio
    weights = np.zeros(1 << BITS, dtype=np.float32)
    prior = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    if len(set(y.tolist())) < 2 or not len(r):
        return weights, prior
    n0, n1 = (y == 0).sum(), (y == 1).sum()
    c = np.where(y == 1, share / n1, (1 - share) / n0)
    blocks = [(slice(a, a + block), np.concatenate(sample.x[a:a + block]), [len(x) for x in sample.x[a:a + block]])
              for a in range(0, len(y), block)]
    w, b = np.zeros(len(r)), prior
    m, s = np.zeros(len(r) + 1), np.zeros(len(r) + 1)
    for t in range(1, steps + 1):
        rw, g, total = r * w, np.zeros(len(r)), 0.0
        for at, col, sizes in blocks:
            row = np.repeat(np.arange(len(sizes)), sizes)
            z = b + np.bincount(row, weights=rw[col], minlength=len(sizes))
            err = c[at] * (1 / (1 + np.exp(-z)) - y[at])
            g += np.bincount(col, weights=err[row], minlength=len(r))
            total += err.sum()
        g = np.append(r * g + l2 * w, total)
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        step = 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    weights[sample.features] = r * w
    return weights, float(b)


def _score_task(shared, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, b = shared.value
        for batch in batches:
            scores = []
            for t in batch.column("text"):
                hit = [g[weights[g] != 0] for g in grams(t.as_py())]
                z = b + float(weights[np.unique(np.concatenate(hit))].sum(dtype=np.float64)) if hit else b
                scores.append(1 / (1 + np.exp(-min(max(z, -500.0), 500.0))))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                "score": pa.array(scores, pa.float64()), "predicted": pa.array([int(s >= threshold) for s in scores], pa.int32())})
    return run


def toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", threshold: float = 0.7, max_rows: int = 3000, max_features: int = 1 << 14) -> DataFrame:
    """doc_id, held_out, score, predicted per row.  Rows whose crc32 of the id
    as text leaves 1 modulo 3 are held out from training."""
    d = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    l = pick(labels, doc_id=id_col, y=label_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    sample = _sample(d, l.withColumn("y", F.when(F.col("y").isin(0, 1), F.col("y"))), max_rows, max_features=max_features)
    shared = docs.sparkSession.sparkContext.broadcast(fit(sample))
    d = d.withColumn("held_out", held_out(F.col("doc_id")))
    return d.mapInArrow(_score_task(shared, threshold), "doc_id long, held_out boolean, score double, predicted int")
