"""Token counts: map-side two-tier lookup.

Tier one is a compact table of the corpus' frequent pre-tokens (their UTF-8
bytes and token lengths, at most ``table_size`` of them and ``MAX_BYTES`` bytes
each), broadcast to all tasks.  Tier two encodes what the table misses, behind
a bounded cache per worker.  No pre-token is ever shuffled: the table comes
from bounded per-task summaries (Misra-Gries) of the whole corpus.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows
are counted each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .bpe import SPLIT, default_path, encoder, has_long_run
from .common import pick

#: Longest pre-token kept in the table or in a worker's cache.
MAX_BYTES = 64
#: Entries of a worker's cache of misses; at the bound it starts anew.
CACHE = 200_000


def _summaries(keep: int):
    """Misra-Gries counters of space-led alphabetic pre-tokens, ``keep`` per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column("text"):
                seen.update((text.as_py() or "").split(" "))
                if len(seen) > 8 * keep:
                    # dropping the lowest counters together keeps the error of each
                    # remaining count under the largest count dropped
                    floor = sorted(seen.values(), reverse=True)[4 * keep]
                    seen = Counter({w: n - floor for w, n in seen.items() if n > floor})
        top = [(" " + w, n) for w, n in seen.most_common(keep) if w.isalpha() and len(w) < MAX_BYTES // 4]
        yield pa.RecordBatch.from_pydict({"token": pa.array([w for w, _ in top], pa.string()),
                                          "n": pa.array([n for _, n in top], pa.int64())})
    return run


def _pack_table(path: str, tokens: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Compact form: joined bytes, end offsets, token lengths."""
    lengths = np.array([len(x) for x in encoder(path).ids(tokens)], dtype=np.uint8)
    raw = [t.encode() for t in tokens]
    return b"".join(raw), np.cumsum([len(r) for r in raw], dtype=np.uint32), lengths


_TABLES: dict[tuple, dict[str, int]] = {}


def _lookup(path: str, compact: tuple[bytes, np.ndarray, np.ndarray]) -> dict[str, int]:
    """The table as a dict, built once per worker."""
    blob, ends, lengths = compact
    key = (path, len(blob), zlib.crc32(blob))
    if key not in _TABLES:
        starts = np.concatenate([[0], ends[:-1]]).astype(int) if len(ends) else []
        _TABLES.clear()
        _TABLES[key] = {blob[a:b].decode(): int(n) for a, b, n in zip(starts, ends, lengths)}
    return _TABLES[key]


class Counting:
    """Token count of a text from the two tiers."""

    def __init__(self, path: str, frequent: dict[str, int]):
        self.enc, self.frequent, self.cache = encoder(path), frequent, {}
        self.split = regex.compile(SPLIT).findall
        core = self.enc.fast
        self.special = sorted(core.special_tokens_set) if core is not None else None

    def _miss(self, token: str) -> int:
        n = self.cache.get(token)
        if n is None:
            # no special string is in a token: count() has seen to that
            n = len(self.enc.ids([token])[0] if has_long_run(token) else self.enc.fast.encode_ordinary(token))
            if len(token) <= MAX_BYTES:
                if len(self.cache) >= CACHE:
                    self.cache.clear()
                self.cache[token] = n
        return n

    def count(self, text: str) -> int:
        if self.special is None or any(s in text for s in self.special):
            return len(self.enc.ids([text])[0])    # special strings split a text before the pattern does
        found = self.split(text)
        first = list(map(self.frequent.get, found))
        if None not in first:
            return sum(first)
        miss = self._miss
        return sum(n if n is not None else miss(t) for n, t in zip(first, found))


def _count_task(path: str, limit: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counting = Counting(path, _lookup(path, shared.value))
        for batch in batches:
            sizes, counts = [], []
            for text in batch.column("text"):
                t = text.as_py() or ""
                sizes.append(len(t.encode()))
                counts.append(counting.count(t))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_bytes": pa.array(sizes, pa.int64()),
                "n_tokens": pa.array(counts, pa.int64()),
                "over_limit": pa.array([n > limit for n in counts], pa.bool_())})
    return run


def frequent_pretokens(docs: DataFrame, *, text_col: str = "text", table_size: int = 65_536,
                        summary: int = 16_384) -> list[str]:
    """The ``table_size`` most frequent pre-tokens by the tasks' summaries."""
    got = (pick(docs, text=text_col).mapInArrow(_summaries(summary), "token string, n long")
           .groupBy("token").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "token").limit(table_size))
    return [r["token"] for r in got.select("token").collect()]


def token_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
                 limit: int = 512, table_size: int = 65_536) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) per row."""
    path = tokenizer or default_path()
    frequent = frequent_pretokens(docs, text_col=text_col, table_size=table_size)
    shared = docs.sparkSession.sparkContext.broadcast(_pack_table(path, frequent))
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(_count_task(path, limit, shared), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
