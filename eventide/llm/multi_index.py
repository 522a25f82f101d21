"""Approximate nearest neighbours by an inverted multi-index.

Each vector is cut in halves and each half quantised to a centroid, fitted by
k-means on at most ``TRAIN_ROWS`` vectors (the first by a hash of vec_id).  The
pair of centroids is the vector's cell.  The centroids a half follow the number
of vectors, so that a cell of the grid stands for about ``CELL_ROWS`` of them,
up to ``CENTROIDS``.  A query walks cells by rising summed distance (here:
falling sum of the two halves' inner products) with a heap over the two sorted
centroid lists, until the cells it has reached hold enough vectors; the entries
of those cells are reranked by the exact inner product of the original vectors.

How many are enough is measured on the table itself: at most ``MEASURED``
queries (the first by a hash of vec_id) are compared with every vector, and the
bound is the least number of entries within which their cells hold ``RECALL``
of the true neighbours.  So structured vectors are searched in few cells, and
vectors without structure in as many as they need.

Entries stand in blocks of neighbouring cells, a sixteenth of the table up to
``BLOCK`` vectors; a crowded cell is spread over several blocks.  Queries come
in blocks too and are sent to the entry blocks that hold their cells, so a task
holds one entry block and one query block.  Only the table of cell counts (at
most CENTROIDS^2 rows), the centroids, the measured queries and their k
neighbours' cells reach the driver.

Defined cases: null, empty, zero and non-finite vectors, null vec_ids and
vectors whose length is not the commonest one (the shorter on a tie) take no
part; rows that repeat a vec_id count once, with the smallest vector; equal
scores rank by smaller vec_id; fewer candidates give fewer rows; an empty table
gives none.
"""

from __future__ import annotations

import heapq
import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventide.llm.common import save

TRAIN_ROWS = 16_384
CENTROIDS = 256
CELL_ROWS = 2.5
ROUNDS = 12
RECALL = 0.95
MEASURED = 256
BLOCK, LEAST_BLOCK = 8_192, 256
QUERY_BLOCK = 512
SEED = 3

_log = logging.getLogger(__name__)


# ------------------------------------------------------------------- the index

def k_means(rows: np.ndarray, count: int, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """At most ``count`` centroids by Lloyd rounds from seeded rows."""
    distinct = np.unique(rows, axis=0)
    start = np.random.default_rng(seed).permutation(len(distinct))[:count]
    centers = distinct[start].copy()
    for _ in range(rounds):
        nearest = closest(rows, centers)
        total = np.stack([np.bincount(nearest, rows[:, j], len(centers)) for j in range(rows.shape[1])], 1)
        members = np.bincount(nearest, minlength=len(centers))
        centers = np.where(members[:, None] > 0, total / np.maximum(members, 1)[:, None], centers)
    return centers


def closest(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    out = np.empty(len(rows), np.int64)
    for at in range(0, len(rows), 4096):
        part = rows[at:at + 4096]
        out[at:at + 4096] = (part @ centers.T - 0.5 * (centers * centers).sum(1)).argmax(1)
    return out


def walk(first: np.ndarray, second: np.ndarray, counts: np.ndarray, wanted: int) -> list[int]:
    """Cells (i * len(second) + j) by falling first[i] + second[j], until they
    hold ``wanted`` entries: the multi-sequence walk over two sorted lists."""
    by_first, by_second = np.argsort(-first, kind="stable").tolist(), np.argsort(-second, kind="stable").tolist()
    a, b, n = first.tolist(), second.tolist(), len(second)
    heap = [(-(a[by_first[0]] + b[by_second[0]]), 0, 0)]
    found, held = [], 0
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        cell = by_first[i] * n + by_second[j]
        if counts[cell]:
            found.append(cell)
            held += counts[cell]
        # Each pair enters once: along the second list, or from its start along the first.
        if j + 1 < n:
            heapq.heappush(heap, (-(a[by_first[i]] + b[by_second[j + 1]]), i, j + 1))
        if j == 0 and i + 1 < len(by_first):
            heapq.heappush(heap, (-(a[by_first[i + 1]] + b[by_second[0]]), i + 1, 0))
    return found


class Layout:
    """Which block holds a cell: cells in order, about ``block`` entries each."""

    def __init__(self, counts: np.ndarray, block: int):
        self.counts = counts
        self.first = np.zeros(len(counts), np.int64)
        self.spread = np.maximum(1, -(-counts // block))
        at, held = 0, 0
        for cell, n in enumerate(counts.tolist()):
            if held and held + n > block:
                at, held = at + 1, 0
            self.first[cell] = at
            if n > block:                       # a crowded cell has blocks of its own
                at, held = at + int(self.spread[cell]), 0
            else:
                held += n
        self.blocks = at + 1
        self.last = self.first + self.spread - 1

    def cells_of(self, block: int) -> np.ndarray:
        """Cells with entries in a block, in order: first and last blocks rise with the cells."""
        lo, hi = np.searchsorted(self.last, block), np.searchsorted(self.first, block, side="right")
        return lo + np.flatnonzero(self.counts[lo:hi] > 0)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector) rows that take part, one an id."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    good = rows.filter(
        F.col("vec_id").isNotNull() & (F.size("vector") > 0)
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0.0))
    return good.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def centroid_count(total: int) -> int:
    """Centroids a half for a table of ``total`` vectors."""
    return int(min(CENTROIDS, max(2, round((total / CELL_ROWS) ** 0.5))))


def fit(rows: DataFrame, limit: int = TRAIN_ROWS, count: int = CENTROIDS) -> tuple[np.ndarray, np.ndarray] | None:
    """Centroids of both halves, from a bounded sample, in one task."""
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(limit).repartition(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy(), _matrix(b.column(1))) for b in batches if b.num_rows]
        if parts:
            ids, x = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            x = x[np.argsort(ids)]
            half = (x.shape[1] + 1) // 2
            for k, side in enumerate((x[:, :half], x[:, half:])):
                centers = k_means(side, count) if side.shape[1] else np.zeros((1, 0))
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([len(centers)], pa.int32()),
                                                  pa.array([centers.tobytes()], pa.binary())], ["side", "n", "centers"])

    made = {r["side"]: np.frombuffer(bytes(r["centers"])).reshape(r["n"], -1)
            for r in sample.mapInArrow(run, "side int, n int, centers binary").collect()}
    return (made[0], made[1]) if made else None


def _with_cells(rows: DataFrame, centers: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    half = centers[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column(1))
                cell = closest(x[:, :half], centers[0]) * len(centers[1]) + closest(x[:, half:], centers[1])
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cell, pa.int32()), b.column(1)], ["vec_id", "cell", "vector"])

    return rows.mapInArrow(run, "vec_id long, cell int, vector array<double>")


# ---------------------------------------------------------- how far to walk

def true_cells(indexed: DataFrame, ids: np.ndarray, queries: np.ndarray, k: int) -> np.ndarray:
    """(query, cell) of the k nearest of each sampled query among all vectors.
    A task passes on k vectors a query, whatever it reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score, found, cells = np.empty((len(ids), 0)), np.empty((len(ids), 0), np.int64), np.empty((len(ids), 0), np.int32)
        for b in batches:
            if not b.num_rows:
                continue
            there = np.broadcast_to(b.column(0).to_numpy(), (len(ids), b.num_rows))
            new = np.where(there == ids[:, None], -np.inf, queries @ _matrix(b.column(2)).T)
            score, found = np.concatenate([score, new], 1), np.concatenate([found, there], 1)
            cells = np.concatenate([cells, np.broadcast_to(b.column(1).to_numpy(), there.shape)], 1)
            keep = np.lexsort((found, -score), axis=1)[:, :k]
            score, found, cells = (np.take_along_axis(v, keep, 1) for v in (score, found, cells))
        query, at = np.nonzero(np.isfinite(score))
        yield pa.RecordBatch.from_arrays([pa.array(query, pa.int32()), *(pa.array(v[query, at]) for v in (found, cells, score))],
                                         ["query", "vec_id", "cell", "score"])

    near = indexed.select("vec_id", "cell", "vector").mapInArrow(run, "query int, vec_id long, cell int, score double")
    place = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    rows = near.withColumn("place", place).filter(F.col("place") <= k).select("query", "cell").collect()
    return np.array([(r["query"], r["cell"]) for r in rows], np.int64).reshape(-1, 2)


def entries_needed(first: np.ndarray, second: np.ndarray, counts: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """Entries that a walk has reached when it has passed each of ``cells``."""
    order = np.argsort(-(first[:, None] + second).ravel(), kind="stable")
    held = np.empty(len(order), np.int64)
    held[order] = np.cumsum(counts[order])
    return held[cells]


def measure(indexed: DataFrame, asked: DataFrame, centers: tuple[np.ndarray, np.ndarray], counts: np.ndarray,
            k: int, recall: float = RECALL, sample: int = MEASURED) -> int:
    """Entries a query must reach for ``recall`` of the true neighbours, as
    measured on at most ``sample`` of the queries against all vectors."""
    rows = asked.select("vec_id", "vector").orderBy(F.xxhash64("vec_id", F.lit(2)), "vec_id").limit(sample).collect()
    if not rows:
        return 0
    ids, queries = np.array([r["vec_id"] for r in rows], np.int64), np.array([r["vector"] for r in rows])
    near, half = true_cells(indexed, ids, queries, k), centers[0].shape[1]
    needed = [entries_needed(q[:half] @ centers[0].T, q[half:] @ centers[1].T, counts, near[near[:, 0] == i, 1])
              for i, q in enumerate(queries)]
    every = np.concatenate(needed)
    return int(np.quantile(every, recall, method="higher")) if len(every) else 0


# ------------------------------------------------------------------ the search

def _packed(rows: DataFrame, key: str, size: int) -> DataFrame:
    """Rows (key, ids, cells, vectors) of at most ``size`` entries, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def out() -> pa.RecordBatch:
            ids, cells, x = (np.concatenate(c) for c in zip(*held, strict=True))
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), *[pa.array([v.tobytes()], pa.binary()) for v in (ids, cells, x)]],
                                              [key, "ids", "cells", "vectors"])

        for b in batches:
            if not b.num_rows:
                continue
            keys = b.column(0).to_numpy()
            ids, cells, x = b.column(1).to_numpy(), b.column(2).to_numpy().astype(np.int32), _matrix(b.column(3))
            edges = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for lo, hi in zip(edges, edges[1:], strict=False):
                if held and (keys[lo] != now or sum(len(h[0]) for h in held) >= size):
                    yield out()
                    held = []
                now = int(keys[lo])
                held.append((ids[lo:hi], cells[lo:hi], x[lo:hi]))
        if held:
            yield out()

    dealt = rows.repartition(key).sortWithinPartitions(key, "vec_id").select(key, "vec_id", "cell", "vector")
    return dealt.mapInArrow(run, f"{key} long, ids binary, cells binary, vectors binary")


def _router(centers: tuple[np.ndarray, np.ndarray], layout: Layout, wanted: int):
    """From packed queries: a row for each entry block that some of them reach,
    with the queries and, a bit a cell, which cells of the block each visits."""
    half, total = centers[0].shape[1], len(layout.counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = layout.counts.tolist()
        for b in batches:
            for raw_ids, raw in zip(b.column(1), b.column(3), strict=True):
                ids = np.frombuffer(raw_ids.as_py(), np.int64)
                x = np.frombuffer(raw.as_py()).reshape(len(ids), -1)
                visits = np.zeros((len(ids), total), bool)
                for i, (u, v) in enumerate(zip(x[:, :half] @ centers[0].T, x[:, half:] @ centers[1].T, strict=True)):
                    visits[i, walk(u, v, counts, wanted)] = True
                for block in range(layout.blocks):
                    bits = visits[:, layout.cells_of(block)]
                    there = np.flatnonzero(bits.any(1))
                    if len(there):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([block], pa.int64()), *[pa.array([v.tobytes()], pa.binary()) for v in (
                                ids[there], x[there], np.packbits(bits[there], axis=1))]],
                            ["block", "query_ids", "queries", "bits"])

    return run


def best(query: np.ndarray, query_id: int, ids: np.ndarray, x: np.ndarray, rough: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest of the entries whose ``rough`` score is finite, by the
    exact score: products added in order, so it is the same wherever a vector stands."""
    rough = np.where(ids == query_id, -np.inf, rough)
    seen = int(np.isfinite(rough).sum())
    if seen > k:
        edge = np.partition(rough, len(rough) - k)[len(rough) - k]
        near = np.flatnonzero(rough >= edge - 1e-9 * (1.0 + abs(edge)))
    else:
        near = np.flatnonzero(np.isfinite(rough))
    exact = np.zeros(len(near))
    for j in range(x.shape[1]):
        exact += x[near, j] * query[j]
    order = np.lexsort((ids[near], -exact))[:k]
    return ids[near][order], exact[order]


def _searcher(layout: Layout, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                block, *raw = (b.column(c)[i].as_py() for c in range(7))
                ids, cells = np.frombuffer(raw[0], np.int64), np.frombuffer(raw[1], np.int32)
                x = np.frombuffer(raw[2]).reshape(len(ids), -1)
                query_ids = np.frombuffer(raw[3], np.int64)
                queries = np.frombuffer(raw[4]).reshape(len(query_ids), -1)
                here = layout.cells_of(block)
                bits = np.unpackbits(np.frombuffer(raw[5], np.uint8).reshape(len(query_ids), -1), axis=1, count=len(here)).astype(bool)
                place = np.searchsorted(here, cells)
                found = [[], [], []]
                for at in range(0, len(queries), 64):
                    rough = np.where(bits[at:at + 64][:, place], queries[at:at + 64] @ x.T, -np.inf)
                    for q, query, row in zip(query_ids[at:at + 64], queries[at:at + 64], rough, strict=True):
                        near, score = best(query, int(q), ids, x, row, k)
                        for column, values in zip(found, (np.full(len(near), q), near, score), strict=True):
                            column.append(values)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in found], ["query_id", "vec_id", "score"])

    return run


def search(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
           visit: float | None = None, least: int = 0, block: int | None = None, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row whose
    ``vec_id`` meets ``is_query``, nearest first.  ``visit`` sets the share of
    all vectors that a query's cells hold, in place of the measured one."""
    spark = vectors.sparkSession
    shape = "query_id long, vec_id long, score double"
    rows = save(usable(vectors, id_col, vector_col), "index-vectors")
    # The commonest vector length: one row a length.
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if lengths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.filter(F.size("vector") == lengths["n"])
    centers = fit(rows, count=centroid_count(lengths["count"]))
    indexed = save(_with_cells(rows, centers), "index-cells")
    cells = indexed.groupBy("cell").count().collect()
    counts = np.zeros(len(centers[0]) * len(centers[1]), np.int64)
    for r in cells:
        counts[r["cell"]] = r["count"]
    total = int(counts.sum())
    layout = Layout(counts, block or min(BLOCK, max(LEAST_BLOCK, -(-total // 16))))
    queries = indexed.filter(is_query)
    share = measure(indexed, queries, centers, counts, k, recall) if visit is None else int(np.ceil(visit * total))
    # A query's own entry is among those reached.
    wanted = min(total, max(least, share, k + 1))
    _log.info("cells visited hold %d of %d vectors (%d x %d centroids)", wanted, total, *map(len, centers))

    places = spark.createDataFrame([(i, int(a), int(b)) for i, (a, b) in enumerate(zip(layout.first, layout.spread, strict=True))],
                                   "cell int, first long, spread long")
    placed = indexed.join(F.broadcast(places), "cell").withColumn(        # CENTROIDS^2 rows at most
        "block", F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("spread")))
    entries = _packed(placed, "block", 1 << 30)
    query_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    asked = _packed(queries.withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(query_blocks)).cast("long")), "part", QUERY_BLOCK)
    routed = asked.repartition(min(query_blocks, 2000)).mapInArrow(
        _router(centers, layout, wanted), "block long, query_ids binary, queries binary, bits binary")
    # The one entry row of a block is the side that a merge join buffers.
    pairs = routed.join(entries, "block").select("block", "ids", "cells", "vectors", "query_ids", "queries", "bits")
    near = pairs.mapInArrow(_searcher(layout, k), shape)
    place = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
