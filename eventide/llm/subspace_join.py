"""Embedding near-dedup by a subspace pigeonhole join.

Vectors of one label whose cosine reaches the threshold t lie within squared
distance T = 2 - 2t once scaled to length one.  A random rotation keeps
distances and spreads them over all coordinates; the rotated vectors are cut
in blocks of ``BLOCK_DIMS`` coordinates, each with its share of T.  If a pair
is within T, its squared distance in some block is within that block's share,
so the union of the blocks' range joins misses no pair:

1. Exact copies (same label, same vector) become one class with a count.
2. Each block is a self-join by radius r over a grid of cells 2r wide on its
   first coordinates; how many is set by the number of vectors, so that cells
   stay near ``CELL_ROWS``.  A vector stands in its own cell and, as a guest,
   in the later cells that its radius touches: each pair meets in one cell.
   Cells that are still crowded are cut in chunks, and every two chunks meet
   in a task of their own.
3. In a task the block's distances come from matrix products.  A pair that
   passes is kept only where no earlier block has it (all tasks compute the
   same bits of a rotated vector, so they agree), and is then verified by its
   cosine in double precision on the original vectors.
4. Tasks hand on link counts per class and a spanning forest of their links,
   never the pairs themselves; components come from star rounds.

Defined results: vectors that are null, empty, zero or hold null or
non-finite components, rows without a label and rows without a vec_id link
with nothing (n_links 0, component_id = vec_id).  Vectors of different sizes
do not link.  Each row is a vector: a repeated row counts as a link of its
other copies, and shares their component.  Rows of one vec_id with different
vectors share one node: their links are added up.  A null vec_id gives a null
component_id and kept = false.  Extra columns are not read.  An empty table
gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import save
from eventide.llm.simhash import components

THRESHOLD = 0.93
BLOCK_DIMS = 8
CELL_ROWS = 8192
SEED = 12
# Room for the rounding of rotated coordinates and of matrix products.
ROUNDING, PRODUCT = 1e-9, 1e-9
TILE = 1024
PAIRS = 1 << 18

KEYS = ["label", "size", "block", "cell"]


# ---------------------------------------------------------------- geometry

def blocks_of(size: int, block_dims: int = BLOCK_DIMS) -> list[slice]:
    """The coordinate blocks of rotated vectors of a size, as even as can be."""
    wide = width_of(size)
    parts = max(1, round(wide / block_dims))
    ends = [wide * i // parts for i in range(parts + 1)]
    return [slice(a, b) for a, b in zip(ends, ends[1:], strict=False)]


def budgets(size: int, threshold: float, block_dims: int = BLOCK_DIMS) -> list[float]:
    """Each block's share of the squared distance, in proportion to its width."""
    total = 2 - 2 * threshold + ROUNDING
    return [total * (b.stop - b.start) / width_of(size) for b in blocks_of(size, block_dims)]


def width_of(size: int) -> int:
    """Coordinates of a rotated vector: the next power of two."""
    return 1 << max(0, size - 1).bit_length()


def rotated(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, under a seeded random rotation: two rounds
    of sign flips and a Walsh-Hadamard transform.

    Every number comes from the same element-wise steps whatever rows stand
    beside it, so that all tasks get the same bits of a vector.
    """
    n, size = vectors.shape
    wide = width_of(size)
    out = np.zeros((n, wide))
    out[:, :size] = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    squares = np.zeros(n)
    for k in range(size):
        squares = squares + out[:, k] * out[:, k]
    out /= np.sqrt(squares)[:, None]
    for signs in np.random.default_rng([SEED, size]).choice([-1.0, 1.0], (2, wide)):
        out = out * signs
        step = 1
        while step < wide:
            pairs = out.reshape(n, -1, 2, step)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, wide)
            step *= 2
        out = out / math.sqrt(wide)
    return out


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each two rows, from the original values in double precision."""
    a, b = (x / np.abs(x).max(axis=1, keepdims=True) for x in (a, b))
    return (a * b).sum(axis=1) / np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))


# ----------------------------------------------------------------- classes

def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _marked(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vec): vec is null where a row takes no part; minus zero
    becomes zero, so that equal vectors are the same bits."""
    e = F.col("embedding")
    zero = F.lit(0.0).cast(vectors.schema["embedding"].dataType.elementType)
    part = usable(e) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label",
                          F.when(part, F.transform(e, lambda x: x + zero)).alias("vec"))


def _matrix(lists: pa.Array, size: int) -> np.ndarray:
    return lists.flatten().to_numpy().astype(np.float64).reshape(-1, size)


# -------------------------------------------------------------- range join

def _cells(coords: np.ndarray, radius: float) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(rows, cells, guest): every row's own cell, then the later cells within
    the radius.  Cells are 2 radii wide, so in each coordinate a row can only
    reach the cell on its nearer side."""
    width = 2 * radius
    own = np.floor(coords / width).astype(np.int32)
    yield np.arange(len(coords)), own, False
    inside = coords - own * width
    side = np.where(inside < radius, -1, 1).astype(np.int32)
    gap = np.minimum(inside, width - inside) ** 2
    dims = coords.shape[1]
    for mask in range(1, 1 << dims):
        taken = [k for k in range(dims) if mask >> k & 1]
        # The first cell coordinate that differs decides which cell is later.
        rows = np.flatnonzero((side[:, taken[0]] > 0) & (gap[:, taken].sum(axis=1) <= radius * radius))
        if len(rows):
            cells = own[rows].copy()
            cells[:, taken] += side[rows][:, taken]
            yield rows, cells, True


def _placed(classes: DataFrame, threshold: float, depth: int, block_dims: int, with_vectors: bool) -> DataFrame:
    """One row per class, block and cell: KEYS, guest, node, copies (and the vectors)."""
    carried = ["node", "copies", *(["vec"] if with_vectors else [])]
    schema = T.StructType([classes.schema["label"], classes.schema["size"], T.StructField("block", T.IntegerType()),
                           T.StructField("cell", T.BinaryType()), T.StructField("guest", T.BooleanType()),
                           *[classes.schema[c] for c in carried]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == size))
                turned = rotated(_matrix(part.column("vec"), size))
                shares = budgets(size, threshold, block_dims)
                for b, at in enumerate(blocks_of(size, block_dims)):
                    radius = math.sqrt(shares[b]) * (1 + 1e-6)
                    for rows, cells, guest in _cells(turned[:, at][:, :depth], radius):
                        taken = part.take(pa.array(rows))
                        key = np.ascontiguousarray(cells)
                        names = pa.FixedSizeBinaryArray.from_buffers(
                            pa.binary(4 * key.shape[1]), len(rows), [None, pa.py_buffer(key)]).cast(pa.binary())
                        yield pa.RecordBatch.from_arrays(
                            [taken.column("label"), taken.column("size"), pa.array(np.full(len(rows), b, np.int32)), names,
                             pa.array(np.full(len(rows), guest)), *[taken.column(c) for c in carried]], schema.fieldNames())

    return classes.select("label", "size", "node", "copies", "vec").mapInArrow(run, schema)


class Cell:
    """The members of one cell (or of two chunks of it) in one block."""

    def __init__(self, block: int, vectors: np.ndarray, guest: np.ndarray, chunk: np.ndarray, threshold: float, block_dims: int):
        self.block, self.vectors, self.guest, self.chunk, self.threshold = block, vectors, guest, chunk, threshold
        self.turned, size = rotated(vectors), vectors.shape[1]
        self.at, self.shares = blocks_of(size, block_dims), budgets(size, threshold, block_dims)

    def links(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Linked pairs of places, each once, in pieces."""
        for a, b in self._near():
            for i in range(0, len(a), PAIRS):
                x, y = a[i:i + PAIRS], b[i:i + PAIRS]
                # Where an earlier block has the pair, it is found there.
                for earlier in range(self.block):
                    apart = self._distance(x, y, earlier) > self.shares[earlier]
                    x, y = x[apart], y[apart]
                near = self._distance(x, y, self.block) <= self.shares[self.block]
                x, y = x[near], y[near]
                if len(x):
                    linked = cosines(self.vectors[x], self.vectors[y]) >= self.threshold
                    yield x[linked], y[linked]

    def _near(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs about within the block's share, by matrix products."""
        values = np.unique(self.chunk)
        left = np.flatnonzero(self.chunk == values[0])
        right = np.flatnonzero(self.chunk == values[-1])
        coords = self.turned[:, self.at[self.block]]
        squares = (coords * coords).sum(axis=1)
        limit = self.shares[self.block] + PRODUCT
        for i in range(0, len(left), TILE):
            a = left[i:i + TILE]
            for j in range(i if len(values) == 1 else 0, len(right), TILE):
                b = right[j:j + TILE]
                far = squares[a][:, None] + squares[b][None, :] - 2 * (coords[a] @ coords[b].T)
                x, y = np.nonzero(far <= limit)
                x, y = a[x], b[y]
                # Two guests meet in a cell of their own; a chunk meets itself once.
                keep = ~(self.guest[x] & self.guest[y])
                if len(values) == 1:
                    keep &= x < y
                yield x[keep], y[keep]

    def _distance(self, x: np.ndarray, y: np.ndarray, block: int) -> np.ndarray:
        """Squared distances in a block, by the same sums in every task."""
        total = np.zeros(len(x))
        for k in range(self.at[block].start, self.at[block].stop):
            d = self.turned[x, k] - self.turned[y, k]
            total = total + d * d
        return total


class Forest:
    """Smallest place reachable over the links seen so far."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, at: np.ndarray) -> np.ndarray:
        root = self.parent[at]
        while (self.parent[root] != root).any():
            root = self.parent[root]
        self.parent[at] = root
        return root

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.roots(a), self.roots(b)
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.parent, np.maximum(x, y), np.minimum(x, y))


FOUND = "node long, other long, links long"


def _found(placed: DataFrame, threshold: float, block_dims: int) -> DataFrame:
    """Per task: (node, null, links) counts and (node, smaller node, 0) edges."""

    def run(group: pa.Table) -> pa.Table:
        size, block = group.column("size")[0].as_py(), group.column("block")[0].as_py()
        col = lambda name: group.column(name).combine_chunks()
        node, copies = col("node").to_numpy(), col("copies").to_numpy()
        cell = Cell(block, _matrix(col("vec"), size), col("guest").to_numpy(zero_copy_only=False), col("chunk").to_numpy(),
                    threshold, block_dims)
        links, forest = np.zeros(len(node), np.int64), Forest(len(node))
        for x, y in cell.links():
            np.add.at(links, x, copies[y])
            np.add.at(links, y, copies[x])
            forest.join(x, y)
        root = forest.roots(np.arange(len(node)))
        least = np.full(len(node), np.iinfo(np.int64).max)
        np.minimum.at(least, root, node)
        least = least[root]
        some, edge = links > 0, node != least
        return pa.table({
            "node": pa.array(np.concatenate([node[some], node[edge]])),
            "other": pa.concat_arrays([pa.nulls(int(some.sum()), pa.int64()), pa.array(least[edge])]),
            "links": pa.array(np.concatenate([links[some], np.zeros(int(edge.sum()), np.int64)]))})

    return placed.groupBy(*KEYS, "lo", "hi").applyInArrow(run, FOUND)


def _chunked(placed: DataFrame, sizes: DataFrame, cell_rows: int) -> DataFrame:
    """Crowded cells cut in chunks: a row goes to each pair of chunks that its own is in."""
    crowded = save(sizes.filter(F.col("n") > cell_rows).withColumn("chunks", F.ceil(F.col("n") / cell_rows).cast("int")).drop("n"),
                   "subspace-crowded")
    chunks = F.coalesce("chunks", F.lit(1))
    return (placed.join(crowded, KEYS, "left")
            .withColumn("chunk", F.pmod(F.xxhash64("node"), chunks).cast("int"))
            .withColumn("with", F.explode(F.sequence(F.lit(0), chunks - 1)))
            .withColumn("lo", F.least("chunk", "with")).withColumn("hi", F.greatest("chunk", "with")).drop("chunks", "with"))


def depth_for(largest: int, cell_rows: int, block_dims: int = BLOCK_DIMS) -> int:
    """Grid coordinates of a block: each cuts a spread-out label about in two."""
    return min(block_dims, max(1, math.ceil(math.log2(max(largest, 1) / cell_rows))))


def near_copies(vectors: DataFrame, threshold: float = THRESHOLD, block_dims: int = BLOCK_DIMS,
                cell_rows: int = CELL_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    marked = _marked(vectors)
    classes = save(marked.filter("vec is not null").groupBy("label", "vec")
                   .agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
                   .withColumn("size", F.size("vec")), "subspace-classes")
    largest = classes.groupBy("label", "size").count().agg(F.max("count")).first()[0] or 0
    depth = depth_for(largest, cell_rows, block_dims)
    sizes = _placed(classes, threshold, depth, block_dims, False).groupBy(*KEYS).agg(F.count("*").alias("n"))
    placed = _chunked(_placed(classes, threshold, depth, block_dims, True), sizes, cell_rows)
    found = save(_found(placed, threshold, block_dims), "subspace-links")

    links = found.filter("other is null").groupBy("node").agg(F.sum("links").alias("links"))
    linked = components(found.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    of_class = classes.join(links, "node", "left").join(linked, "node", "left").select(
        F.xxhash64("vec").alias("hash"), F.col("label").alias("c_label"), F.col("vec").alias("c_vec"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component"))
    rows = marked.withColumn("h", F.xxhash64("vec"))
    same = (F.col("h") == F.col("hash")) & (F.col("label") == F.col("c_label")) & (F.col("vec") == F.col("c_vec"))
    component = F.coalesce("component", "vec_id")
    return rows.join(of_class, same, "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
