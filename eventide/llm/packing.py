"""Packing: bounded-space online packing of token documents into windows.

Each partition keeps a fixed number of open windows.  A piece goes to the open
window whose gap it fills best.  When none can take it the fullest window is
emitted: filled by cutting the piece when its gap is worth a cut
(``min_piece``), padded otherwise.  What a partition leaves open is merged in a
tree of at most ``MERGE_FAN_IN`` groups a step, best-fit by falling length.  A
group passes its emptiest windows on, as many as a partition keeps, and pads
the others, so no task ever sees more than ``fan-in x windows`` open windows.

Texts never move: a partition tokenizes and packs in one pass, and only piece
rows (a few numbers each) are written or merged.

Defined cases: a null text is empty; an empty document is one piece holding
the end id; repeated rows are packed once per row; a null doc_id stays null;
an empty table gives no rows; a document longer than the window is cut in
whole windows and a rest; ties go to the oldest window.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import save
from eventide.llm.tokens import encoder

WINDOW = 2048
OPEN_WINDOWS = 48
MIN_PIECE = 48
END_ID = 1
MERGE_FAN_IN = 64

_COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class OpenWindows:
    """The open windows of one partition; closed ones go to ``closed``."""

    def __init__(self, window: int, count: int, min_piece: int, first_id: int):
        self.window, self.min_piece, self.next_id = window, min_piece, first_id
        self.gaps = np.zeros(count, np.int64)       # 0: the slot is free
        self.held: list[list[tuple]] = [[] for _ in range(count)]
        self.ids = [0] * count
        self.closed: list[tuple] = []

    def _new_id(self) -> int:
        self.next_id += 1
        return self.next_id - 1

    def _put(self, slot: int, piece: tuple, length: int) -> None:
        offset = self.window - int(self.gaps[slot])
        self.held[slot].append((*piece, self.ids[slot], offset))
        self.gaps[slot] -= length
        if self.gaps[slot] == 0:
            self._emit(slot)

    def _emit(self, slot: int) -> None:
        self.closed += self.held[slot]
        self.held[slot] = []
        self.gaps[slot] = 0

    def _open(self, slot: int) -> None:
        self.gaps[slot], self.ids[slot] = self.window, self._new_id()

    def add_document(self, doc_id, packed: np.ndarray) -> None:
        total, at = len(packed), 0
        raw = memoryview(packed.astype("<u4").tobytes())

        def piece(length: int) -> tuple:
            return doc_id, at, length, zlib.crc32(raw[4 * at:4 * (at + length)]), total

        while total - at >= self.window:
            self.closed.append((*piece(self.window), self._new_id(), 0))
            at += self.window
        while at < total:
            length = total - at
            fits = np.where(self.gaps >= length, self.gaps, self.window + 1)
            slot = int(fits.argmin())
            if fits[slot] <= self.window:
                self._put(slot, piece(length), length)
                return
            free = np.flatnonzero(self.gaps == 0)
            if len(free):
                self._open(int(free[0]))
                continue
            slot = int(self.gaps.argmin())          # none fits: the fullest goes
            gap = int(self.gaps[slot])
            if gap >= self.min_piece:
                self._put(slot, piece(gap), gap)
                at += gap
            else:
                self._emit(slot)

    def leftovers(self) -> list[tuple]:
        return [p for pieces in self.held for p in pieces]


def _batch(rows: list[tuple], *more) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
    arrays = [pa.array(c, pa.int64()) for c in columns]
    n = len(rows)
    names = [*_COLUMNS, *[k for k, _ in more]]
    return pa.RecordBatch.from_arrays([*arrays, *[pa.array([v] * n, pa.int64()) for _, v in more]], names)


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, open_windows: int = OPEN_WINDOWS,
         min_piece: int = MIN_PIECE, end_id: int = END_ID) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        bpe = encoder(tokenizer_path)
        state = OpenWindows(window, open_windows, min_piece, part << 32)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for at, ids, counts in bpe.batches(batch.column(1), end_id):
                for doc_id, packed in zip(doc_ids[at:at + len(counts)], np.split(ids, np.cumsum(counts)[:-1]), strict=True):
                    state.add_document(doc_id, packed)
                yield _batch(state.closed, ("ev_group", -1))
                state.closed = []
        yield _batch(state.leftovers(), ("ev_group", part))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = save(rows.mapInArrow(run, f"{_PIECE}, ev_group long"), "pack")
    parts = pieces.agg(F.max("ev_group")).first()[0]
    done = pieces.filter("ev_group = -1").select(*_COLUMNS)
    rest = pieces.filter("ev_group >= 0")
    groups, level = (parts or 0) + 1, 0
    while groups > 1 or level == 0:
        groups, level = -(-groups // MERGE_FAN_IN), level + 1
        rest = rest.withColumn("ev_group", F.floor(F.col("ev_group") / MERGE_FAN_IN).cast("long"))
        merged = save(rest.groupBy("ev_group").applyInPandas(
            _merger(window, min_piece, level, groups == 1, open_windows), f"{_PIECE}, ev_group long, ev_done boolean"), "pack-merge")
        done = done.unionByName(merged.filter("ev_done").select(*_COLUMNS))
        rest = merged.filter("not ev_done").drop("ev_done")
    return done


def _merger(window: int, min_piece: int, level: int, last: bool, open_windows: int = OPEN_WINDOWS):
    """Best-fit by falling length over the open pieces of a few partitions;
    all but the emptiest ``open_windows`` windows are done."""

    def merge(frame):
        group = int(frame["ev_group"].iloc[0])
        frame = frame.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True],
                                  kind="stable").reset_index(drop=True)
        first = (level << 56) | (group << 32)
        used: list[int] = []
        gaps = np.zeros(len(frame) + 1, np.int64)
        slots, offsets = [], []
        for length in frame["length"].to_numpy():
            fits = np.where(gaps[:len(used)] >= length, gaps[:len(used)], window + 1)
            slot = int(fits.argmin()) if len(used) else 0
            if not len(used) or fits[slot] > window:
                slot = len(used)
                used.append(0)
                gaps[slot] = window
            slots.append(slot)
            offsets.append(window - int(gaps[slot]))
            gaps[slot] -= length
        slots = np.array(slots, np.int64)
        left = np.flatnonzero(gaps[:len(used)] >= min_piece)
        passed = left[np.argsort(-gaps[left], kind="stable")[:0 if last else open_windows]]
        return frame.assign(sequence_id=first + slots, offset=np.array(offsets, np.int64),
                            ev_done=~np.isin(slots, passed))

    return merge
