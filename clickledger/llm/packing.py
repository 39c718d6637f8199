"""Bounded-space online packing of tokenised documents into fixed windows."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickledger.llm.common import slices, stage
from clickledger.llm.words_bpe import encoder

CAPACITY = 4096
#: Open windows per partition.
SLOTS = 16
#: A document is cut to fill a window only where the piece has so many tokens at least.
LEAST_PIECE = 32
#: Leftovers of so many partitions meet in one task, round after round.
FAN_IN = 32
#: Texts are encoded in slices of so many bytes, whose words and ids a worker holds at once.
TEXT_BYTES = 1 << 20

_PIECE = [
    ("doc_id", pa.int64()),
    ("start", pa.int64()),
    ("length", pa.int64()),
    ("doc_tokens", pa.int64()),
    ("ids", pa.binary()),
    ("window", pa.int64()),
    ("offset", pa.int64()),
    ("open", pa.bool_()),
    ("part", pa.int64()),
]
_NAMES = [name for name, _ in _PIECE]
_DDL = (
    "doc_id long, start long, length long, doc_tokens long, ids binary, window long, offset long, "
    "open boolean, part long"
)


class Packer:
    """A fixed number of open windows; pieces of windows that close are handed out by ``taken``."""

    def __init__(self, part: int, capacity: int, slots: int, least: int):
        self.part, self.capacity, self.slots, self.least = part, capacity, slots, least
        self.gaps: list[tuple[int, int]] = []  # sorted (free tokens, window)
        self.held: dict[int, list[tuple]] = {}
        self.next = 0
        self.closed: list[tuple] = []

    def _put(self, window: int, used: int, piece: tuple) -> None:
        self.held.setdefault(window, []).append((*piece, window, used))

    def _close(self, window: int) -> None:
        self.closed += self.held.pop(window)

    def _open(self) -> int:
        self.next += 1
        return self.next - 1

    def place(self, doc_id: int | None, start: int, ids: np.ndarray, total: int) -> None:
        """Whole windows first, the rest best-fit; if none fits, the fullest is filled and closed."""
        at, n = 0, len(ids)

        def piece(size: int) -> tuple:
            return (doc_id, start + at, size, total, ids[at : at + size].tobytes())

        while n - at >= self.capacity:
            window = self._open()
            self._put(window, 0, piece(self.capacity))
            self._close(window)
            at += self.capacity
        while at < n:
            rest = n - at
            k = bisect_left(self.gaps, (rest, -1))
            if k < len(self.gaps):
                gap, window = self.gaps.pop(k)
                self._put(window, self.capacity - gap, piece(rest))
                if gap > rest:
                    insort(self.gaps, (gap - rest, window))
                else:
                    self._close(window)
                return
            if len(self.gaps) < self.slots:
                window = self._open()
                self._put(window, 0, piece(rest))
                insort(self.gaps, (self.capacity - rest, window))
                return
            gap, window = self.gaps.pop(0)
            if gap >= self.least:
                self._put(window, self.capacity - gap, piece(gap))
                at += gap
            self._close(window)

    def taken(self) -> list[tuple]:
        rows = [(*row, False, self.part) for row in self.closed]
        self.closed = []
        return rows

    def leftovers(self, last: bool = False) -> list[tuple]:
        return [(*row, not last, self.part) for window in sorted(self.held) for row in self.held[window]]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in _PIECE]
    arrays = [pa.array(c, kind) for c, (_, kind) in zip(columns, _PIECE)]
    return pa.RecordBatch.from_arrays(arrays, _NAMES)


def pack(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, slots: int = SLOTS, least: int = LEAST_PIECE
) -> DataFrame:
    """Pieces ``doc_id, start, length, doc_tokens, ids, sequence_id, offset`` of all documents.

    ``ids`` is the piece's tokens as little-endian 32-bit integers; ``doc_tokens`` counts the whole
    document with ``end_id``. Each input partition packs its documents in order with ``slots`` open
    windows of ``capacity`` tokens: best-fit; where none fits, the fullest is filled with the head of
    the document if that piece has ``least`` tokens, and emitted. Partitions' last open windows are then
    merged FAN_IN partitions at a time, round by round, so no task gets more than FAN_IN * slots
    windows; the last round fills one window after another, and only its last one stays short.

    Null texts are empty and give the end id alone. Null and repeated doc_ids are packed like others.
    Columns other than doc_id and text are ignored. An empty table gives no rows.
    """

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId(), capacity, slots, least)
        for part in slices(batches, "text", TEXT_BYTES):
            ids = encoder(tokenizer, end_id).encode(part.column("text"))
            for doc_id, tokens in zip(part.column("doc_id").to_pylist(), ids):
                packer.place(doc_id, 0, tokens, len(tokens))
            yield _batch(packer.taken())
        yield _batch(packer.leftovers())

    def merge(level: int, last: bool):
        def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            packer = Packer(int(key[0]), capacity, 1 if last else slots, 1 if last else least)
            for r in rows.sort_values(["length", "part", "window", "offset"], ascending=[False, True, True, True]).itertuples():
                doc_id = None if pd.isna(r.doc_id) else int(r.doc_id)
                packer.place(doc_id, r.start, np.frombuffer(r.ids, "<u4"), r.doc_tokens)
            rows = packer.taken() + packer.leftovers(last)
            out = pd.DataFrame(rows, columns=_NAMES)
            return out.astype({"doc_id": "Int64"})

        return run

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    placed = stage(texts.mapInArrow(first, _DDL), "packed")
    closed, level = [], 0
    parts = placed.agg(F.max("part")).first()[0]
    while True:
        number = F.lit(level << 56).bitwiseOR(F.shiftleft("part", 24)).bitwiseOR(F.col("window"))
        closed.append(placed.filter("NOT open").withColumn("sequence_id", number))
        if parts is None or (level and parts == 0):
            break
        level += 1
        parts //= FAN_IN
        group = F.floor(F.col("part") / FAN_IN).cast("long").alias("group")
        placed = stage(placed.filter("open").groupBy(group).applyInPandas(merge(level, parts == 0), _DDL), "merged")
    out = closed[0]
    for more in closed[1:]:
        out = out.unionAll(more)
    return out.select("doc_id", "start", "length", "doc_tokens", "ids", "sequence_id", "offset")
