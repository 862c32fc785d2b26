"""Packing: sum-of-squares placement of documents into fixed windows.

Every task packs the documents of its own input split, so nothing is shuffled
and a lost task is simply run again with the same result. A document's ids plus
the end id are cut at the window size; full windows leave at once and the rest
(shorter than a window) is placed online: with N(h) the number of open windows
filled to level h, the piece goes to the level that makes the sum of N(h)**2
least (level 0 is a new window). When the split ends, the windows still open are
emptied into each other from the least filled one, cutting pieces at the window
size, and the last remainder is laid out in sequences whose lengths are powers
of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import encoder
from .common import tidy
from .tokens import slices

COLUMNS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Packer:
    """Windows of one split. Pieces are (document, start, ids)."""

    def __init__(self, window: int):
        self.window = window
        self.level = np.zeros(window + 1, np.int64)  # N(h) for 0 < h < window
        self.open: dict[int, list[list]] = {}
        self.closed: list[list] = []
        self.score = np.empty(window + 1)

    def _level_for(self, size: int) -> int:
        most = self.window - size
        score = self.score[: most + 1]
        np.subtract(self.level[size : size + most + 1], self.level[: most + 1], out=score)
        score[: most + 1] += 1.0
        score[self.level[: most + 1] == 0] = np.inf
        score[most] = 0.5 - self.level[most] if self.level[most] else np.inf  # a window that becomes full leaves
        score[0] = self.level[size] + 0.5
        return int(np.argmin(score))

    def add(self, doc, ids: np.ndarray) -> None:
        full = len(ids) // self.window * self.window
        for at in range(0, full, self.window):
            self.closed.append([(doc, at, ids[at : at + self.window])])
        if full < len(ids):
            piece = (doc, full, ids[full:])
            size = len(ids) - full
            h = self._level_for(size)
            if h:
                pieces = self.open[h].pop()
                self.level[h] -= 1
            else:
                pieces = []
            pieces.append(piece)
            if h + size == self.window:
                self.closed.append(pieces)
            else:
                self.open.setdefault(h + size, []).append(pieces)
                self.level[h + size] += 1

    def finish(self) -> None:
        left = [(h, pieces) for h in sorted(self.open, reverse=True) for pieces in self.open[h]]
        self.open, a, b = {}, 0, len(left) - 1
        spare: list = []  # pieces of the least filled window, being dealt out
        while a <= b:
            h, pieces = left[a]
            a += 1
            while h < self.window and (spare or b >= a):
                if not spare:
                    spare = left[b][1]
                    b -= 1
                doc, start, ids = spare.pop()
                fits = self.window - h
                if len(ids) > fits:
                    spare.append((doc, start + fits, ids[fits:]))
                    ids = ids[:fits]
                pieces.append((doc, start, ids))
                h += len(ids)
            if h == self.window:
                self.closed.append(pieces)
            else:
                spare = pieces + spare
        while spare:  # less than a window, or pieces of the last opened one
            left_over = sum(len(x[2]) for x in spare)
            h, most, pieces = 0, min(self.window, 1 << (left_over.bit_length() - 1)), []
            while h < most:
                doc, start, ids = spare.pop()
                if len(ids) > most - h:
                    spare.append((doc, start + most - h, ids[most - h :]))
                    ids = ids[: most - h]
                pieces.append((doc, start, ids))
                h += len(ids)
            self.closed.append(pieces)
        self.level[:] = 0


def pack(docs: DataFrame, tokenizer: str, window: int = 4096, end_id: int = 2, with_ids: bool = False, by: str | None = None) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, text) in sequences of at most ``window`` ids.

    Null and empty texts are the end id alone. Repeated rows are packed each on
    its own; a null doc_id stays null. An empty table gives no rows. Other columns
    of ``docs`` are not read. ``with_ids`` adds the ids of each piece. With ``by`` a
    sequence holds documents of one value of that column only (null is a value). Results
    depend on the input's splits only, not on the order in which tasks run.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packers = encoder(tokenizer), {}
        first, number = TaskContext.get().partitionId() << 32, 0

        def out(packer: Packer) -> pa.RecordBatch:
            nonlocal number
            rows = []
            for pieces in packer.closed:
                offset = 0
                for (doc, total), start, ids in pieces:
                    rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, first + number, offset, ids))
                    offset += len(ids)
                number += 1
            packer.closed = []
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 8
            data = [pa.array(c, pa.int64()) for c in cols[:7]]
            return pa.RecordBatch.from_arrays(data + [pa.array(cols[7], pa.list_(pa.int32()))] * with_ids, names=[x.split()[0] for x in COLUMNS.split(", ")] + ["ids"] * with_ids)

        for batch in batches:
            ids_of, kinds = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for at, part in slices(batch.column(1), 4_000_000):
                for doc, kind, ids in zip(ids_of[at : at + len(part)], kinds[at : at + len(part)], encode(part), strict=True):
                    if kind not in packers:
                        packers[kind] = Packer(window)
                    packers[kind].add((doc, len(ids) + 1), np.append(ids, np.int32(end_id)))
                for packer in packers.values():
                    if packer.closed:
                        yield out(packer)
        for packer in packers.values():
            packer.finish()
            yield out(packer)
        tidy()

    one = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), (F.col(by).cast("string") if by else F.lit("")).alias("kind"))
    return one.mapInArrow(run, COLUMNS + ", ids array<int>" * with_ids)
