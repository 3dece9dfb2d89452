"""Packing: bounded-space online best fit.

Each task keeps at most ``open_windows`` unfinished windows.  A piece goes to
the open window that it fills best.  If none has room, a new window is opened;
at the bound the fullest window is emitted first, topped up with the head of
the piece where its gap holds at least ``min_cut`` ids.  Windows still open at
a task's end are merged in a second step, best fit over whole windows.

Defined results: a null or empty text has one id (the end id); repeated rows
are packed each on their own; texts longer than a window are cut into full
windows and a rest; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .bpe import default_path, encoder
from .common import pick, table

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, sequence_length long, open boolean")
NAMES = [c.split()[0] for c in PIECES.split(", ")]
#: Sequence ids of a task start at its partition number times this.
IDS_PER_TASK = 1 << 32
#: Texts encoded at a time within a task.
SLICE = 256
#: Open windows merged together by one task.
MERGE = 512


class Packer:
    """Open windows of one task.  ``out`` gets a row per finished piece."""

    def __init__(self, size: int, bound: int, min_cut: int, first_id: int):
        self.size, self.bound, self.min_cut, self.next_id = size, bound, min_cut, first_id
        self.free: list[tuple[int, int]] = []      # (room, sequence id), sorted
        self.held: dict[int, list[tuple]] = {}
        self.out: list[tuple] = []

    def _open(self) -> int:
        self.next_id += 1
        return self.next_id - 1

    def _put(self, seq: int, room: int, piece: tuple) -> int:
        """piece: doc_id, start, ids, doc_tokens.  Returns the room left."""
        doc, start, ids, total = piece
        self.held.setdefault(seq, []).append(
            (doc, start, len(ids), zlib.crc32(ids.tobytes()), total, seq, self.size - room))
        return room - len(ids)

    def _emit(self, seq: int, room: int, still_open: bool = False) -> None:
        self.out += [(*row, self.size - room, still_open) for row in self.held.pop(seq)]

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        total, start = len(ids), 0
        while total - start >= self.size:
            seq = self._open()
            self._emit(seq, self._put(seq, self.size, (doc, start, ids[start:start + self.size], total)))
            start += self.size
        if start == total:
            return
        need = total - start
        k = bisect_left(self.free, (need, -1))
        if k < len(self.free):
            room, seq = self.free.pop(k)
        else:
            if len(self.free) >= self.bound:
                gap, full = self.free.pop(0)
                if gap >= self.min_cut:    # no window has room, so gap < need
                    head = ids[start:start + gap]
                    start += len(head)
                    gap = self._put(full, gap, (doc, start - len(head), head, total))
                self._emit(full, gap)
            seq, room = self._open(), self.size
        room = self._put(seq, room, (doc, start, ids[start:], total))
        if room:
            insort(self.free, (room, seq))
        else:
            self._emit(seq, 0)

    def close(self) -> None:
        for room, seq in self.free:
            self._emit(seq, room, True)
        self.free = []


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.bool_() if n == "open" else pa.int64() for n in NAMES]
    cols = list(zip(*rows)) if rows else [()] * len(NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=NAMES)


def _pack_task(path: str, size: int, bound: int, min_cut: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(size, bound, min_cut, TaskContext.get().partitionId() * IDS_PER_TASK)
        enc = encoder(path)
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for k in range(0, batch.num_rows, SLICE):
                docs = ids.slice(k, SLICE).to_pylist()
                for doc, tokens in zip(docs, enc.ids([t or "" for t in texts.slice(k, SLICE).to_pylist()])):
                    tokens.append(end_id)
                    packer.add(doc, np.asarray(tokens, dtype="<u4"))
            if packer.out:
                yield _batch(packer.out)
                packer.out = []
        packer.close()
        yield _batch(packer.out)
    return run


def _merge_group(size: int):
    """Best fit over whole windows, the fullest first; ``open`` ends here."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["sequence_id", "offset"], kind="stable", ignore_index=True)
        fill = pdf.groupby("sequence_id")["sequence_length"].first().sort_index().sort_values(
            ascending=False, kind="stable")
        room: list[tuple[int, int]] = []
        to: dict[int, int] = {}
        shift: dict[int, int] = {}
        used: dict[int, int] = {}
        for seq, n in fill.items():
            k = bisect_left(room, (n, -1))
            left, target = room.pop(k) if k < len(room) else (size, seq)
            to[seq], shift[seq], used[target] = target, size - left, size - left + n
            insort(room, (left - n, target))
        old = pdf["sequence_id"]
        pdf["offset"] += old.map(shift)
        pdf["sequence_id"] = old.map(to)
        pdf["sequence_length"] = pdf["sequence_id"].map(used)
        pdf["open"] = False
        return pdf[NAMES[:-1] + ["open"]]
    return run


def pack(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
         size: int = 2048, open_windows: int = 64, min_cut: int = 128, end_id: int = 1) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, sequence_length."""
    path = tokenizer or default_path()
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    # encoded once: both the finished windows and the open ones come from this table
    first = table(rows.mapInArrow(_pack_task(path, size, open_windows, min_cut, end_id), PIECES), "packed")
    left = first.filter("open")
    windows = left.filter("offset = 0").count()
    groups = max(1, -(-windows // MERGE))
    merged = (left.withColumn("g", F.pmod(F.xxhash64("sequence_id"), F.lit(groups)))
              .groupBy("g").applyInPandas(lambda pdf: _merge_group(size)(pdf.drop(columns="g")), PIECES))
    return first.filter("not open").unionByName(merged).drop("open")
