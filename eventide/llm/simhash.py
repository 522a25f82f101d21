"""SimHash near-dedup over a Gray-order hierarchical index.

Fingerprints.  Words are runs without ASCII white space, A-Z lower-cased; the
features are shingles of ``shingle`` words, repeats included, hashed by XXH64
(seed 42).  A bit is set when more than half the features set it.

Linking.  Distinct fingerprints (with their smallest doc_id) are linked when
they differ in at most ``distance`` bits:

1. *Upper nodes.*  A node is a masked bit pattern its members share.  The root's
   64 free bits are cut into ``distance + 1`` fields; two fingerprints within the
   distance agree on one field at least, so each goes to one child node per
   field.  A node with more than ``NODE_ROWS`` members is cut again in the same
   way over the bits still free (its members differ only there), until nodes
   are small; a node with at most ``FLOOR_BITS`` free bits cannot hold more than
   2^FLOOR_BITS members, so no node is unbounded and no pair is lost.
2. *Lower nodes.*  A small node's members are sorted by Gray rank, which places
   fingerprints that share long patterns side by side.  Runs of 2, 4, 8, ...
   members form a tree; each tree node keeps the mask and bits its members
   share.  Pairs of tree nodes are walked from the root, adding up the
   differences of their shared bits, and a pair of whole groups is dropped as
   soon as those exceed the distance.
3. Links found in a node are reduced to a spanning forest there (at most one
   edge per member), never emitted as all pairs.

Components come from alternating large-star / small-star rounds over those
edges, each round written to the shared folder.

Defined cases: a null or wordless text has fingerprint zero and is linked like
any other; fewer words than a shingle give one feature; exact copies and
repeated rows share a fingerprint and so a component; a null doc_id is kept
with the component of its fingerprint (null only if no linked row has an id);
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import save

SHINGLE = 3
DISTANCE = 2
SEED = 42
NODE_ROWS = 2048
FLOOR_BITS = 11

_CHUNK = 1 << 14


# --------------------------------------------------------------- fingerprints

def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of a UTF-8 text."""
    words = text.lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    firsts, lasts = starts[:n].tolist(), ends[-n:].tolist()
    if n == 1:
        firsts, lasts = [0], [len(flat)]
    set_bits = np.zeros(64, np.int64)
    hashed = xxhash.xxh64_intdigest
    for at in range(0, n, _CHUNK):
        h = np.array([hashed(flat[a:b], SEED) for a, b in zip(firsts[at:at + _CHUNK], lasts[at:at + _CHUNK], strict=True)], ">u8")
        set_bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n).view(">u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle)
                               for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def as_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def gray_rank(fp: Column) -> Column:
    """Rank of a bit string in Gray order: each bit is the parity of the bits
    from the top down to it."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp


# --------------------------------------------------------------- upper nodes

def _fields(free: int, parts: int) -> list[int]:
    """Cut the set bits of a mask into ``parts`` masks of about equal count."""
    bits = [b for b in range(64) if free >> b & 1]
    return [sum(1 << b for b in bits[i * len(bits) // parts:(i + 1) * len(bits) // parts]) for i in range(parts)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _leaf_nodes(prints: DataFrame, distance: int, node_rows: int) -> DataFrame:
    """(node, pattern, fp, label): members of every small upper node that
    holds two or more.  ``node`` names the path of masks taken."""
    done = None
    # (path, free mask) of the nodes to cut at this level, by path number.
    paths = [((1 << 64) - 1, 0)]
    level = prints.withColumn("ev_node", F.lit(0))
    number = 1
    while True:
        children, cut = [], []
        for free, path in paths:
            for field in _fields(free, distance + 1):
                # The child's members share what its parent's did and this field.
                children.append((number, free & ~field))
                cut.append((path, number, ~(free & ~field) & ((1 << 64) - 1)))
                number += 1
        options = F.lit(None)
        for path in {p for p, _, _ in cut}:
            made = F.array(*[F.struct(F.lit(c).alias("node"), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")).alias("pattern"))
                             for p, c, m in cut if p == path])
            options = F.when(F.col("ev_node") == path, made).otherwise(options)
        placed = level.select("fp", "label", F.explode(options).alias("n")).select("fp", "label", "n.node", "n.pattern")
        counts = placed.groupBy("node", "pattern").agg(F.count("*").alias("members")).filter("members > 1")
        small_enough = [c for c, free in children if bin(free).count("1") <= FLOOR_BITS]
        sized = save(placed.join(counts, ["node", "pattern"]), "simhash-nodes")
        crowded = (F.col("members") > node_rows) & ~F.col("node").isin(small_enough or [-1])
        leaves = sized.filter(~crowded).drop("members")
        done = leaves if done is None else done.unionByName(leaves)
        again = sized.filter(crowded)
        if again.isEmpty():
            return done
        paths = [(free, c) for c, free in children if c not in small_enough]
        level = again.select("fp", "label", F.col("node").alias("ev_node"))


# --------------------------------------------------------------- lower nodes

class GrayTree:
    """Shared masked patterns over runs of Gray-sorted fingerprints."""

    def __init__(self, prints: np.ndarray):
        self.levels = [(prints, np.full(len(prints), ~np.uint64(0)))]
        while len(self.levels[-1][0]) > 1:
            bits, mask = self.levels[-1]
            if len(bits) % 2:
                bits, mask = np.append(bits, bits[-1]), np.append(mask, mask[-1])
            shared = mask[::2] & mask[1::2] & ~(bits[::2] ^ bits[1::2])
            self.levels.append((bits[::2] & shared, shared))

    def links(self, distance: int, chunk: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of leaf places (i < j) within the distance, in pieces."""
        top = len(self.levels) - 1
        stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            level, a, b = stack.pop()
            if level == 0:
                keep = a < b
                yield a[keep], b[keep]
                continue
            bits, mask = self.levels[level - 1]
            count = len(bits)
            left = np.concatenate([2 * a, 2 * a, 2 * a + 1, 2 * a + 1])
            right = np.concatenate([2 * b, 2 * b + 1, 2 * b, 2 * b + 1])
            keep = (left <= right) & (right < count)
            left, right = left[keep], right[keep]
            far = np.bitwise_count((bits[left] ^ bits[right]) & mask[left] & mask[right])
            near = far <= distance
            left, right = left[near], right[near]
            for at in range(0, len(left), chunk):
                stack.append((level - 1, left[at:at + chunk], right[at:at + chunk]))


def _forest(prints: np.ndarray, labels: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(label, smallest label of its linked group in this node), without loops."""
    parent = np.arange(len(prints))
    for a, b in GrayTree(prints).links(distance):
        while len(a):
            ra, rb = _roots(parent, a), _roots(parent, b)
            apart = ra != rb
            if not apart.any():
                break
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            parent[np.maximum(ra, rb)] = np.minimum(ra, rb)
    root = _roots(parent, np.arange(len(prints)))
    least = np.full(len(prints), np.iinfo(np.int64).max)
    np.minimum.at(least, root, labels)
    return labels, least[root]


def _roots(parent: np.ndarray, at: np.ndarray) -> np.ndarray:
    root = parent[at]
    while True:
        up = parent[root]
        if (up == root).all():
            parent[at] = root
            return root
        root = up


def _edges(leaves: DataFrame, distance: int) -> DataFrame:
    """Spanning edges (a, b), a > b, of every node's links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            cols = [batch.column(i).to_numpy() for i in range(4)]
            if held is not None:
                cols = [np.concatenate([h, c]) for h, c in zip(held, cols, strict=True)]
            change = np.flatnonzero((np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0)) + 1
            cut = int(change[-1]) if len(change) else 0
            held = [c[cut:] for c in cols]
            if cut:
                yield from emit([c[:cut] for c in cols], change[:-1])
        if held is not None and len(held[0]):
            yield from emit(held, np.zeros(0, np.int64))

    def emit(cols: list[np.ndarray], bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        ends = [*bounds.tolist(), len(cols[0])]
        for lo, hi in zip([0, *ends[:-1]], ends, strict=True):
            la, lb = _forest(cols[2][lo:hi].view(np.uint64), cols[3][lo:hi], distance)
            a.append(la[la != lb])
            b.append(lb[la != lb])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    dealt = leaves.withColumn("ev_rank", gray_rank(F.col("fp"))).repartition("node", "pattern")
    # Unsigned order of the rank: flip the sign bit.
    ordered = dealt.sortWithinPartitions("node", "pattern", F.col("ev_rank").bitwiseXOR(F.lit(-(1 << 63))))
    return ordered.select("node", "pattern", "fp", "label").mapInArrow(run, "a long, b long")


# ---------------------------------------------------------------- components

def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every end of an edge (a > b): the smallest id
    reachable.  Alternating large-star and small-star rounds; each keeps at
    most one edge per pair of a node and its smallest neighbour, so a round
    never grows the edge set.  Stops when a round changes nothing."""
    edges = save(edges.distinct(), "star")
    seen = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        # Large star: neighbours above a node hang on its smallest neighbour.
        large = (both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .filter("a > b").distinct())
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        # Small star: a node and its lower neighbours hang on the smallest of them.
        small = (large.join(down, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b").filter("a > b").distinct())
        edges = save(small, "star")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == tuple(state):
            break
        seen = tuple(state)
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _answer(prints: DataFrame, distance: int, node_rows: int) -> DataFrame:
    """(fp, component, component_id) of every distinct fingerprint."""
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    # Links join distinct fingerprints, each named by its own bits; doc_ids
    # come in only at the end, so rows without an id link like any other.
    named = distinct.select("fp", F.col("fp").alias("label"))
    edges = _edges(_leaf_nodes(named, distance, node_rows), distance)
    linked = components(edges)
    of_print = distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    smallest = of_print.groupBy("component").agg(F.min("least").alias("component_id"))
    return of_print.join(smallest, "component").select("fp", "component", "component_id")


def groups(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, node_rows: int = NODE_ROWS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of docs."""
    prints = save(fingerprints(docs, shingle), "simhash-prints")
    answer = _answer(prints, distance, node_rows)
    return prints.join(answer, "fp").select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, node_rows: int = NODE_ROWS) -> DataFrame:
    """The rows of docs with one document of each group: the one of the
    smallest doc_id.  Rows that repeat the kept doc_id are reduced to the
    smallest (text, then other plain columns); so is a group without any id."""
    plain = [f.name for f in docs.schema if isinstance(f.dataType, T.AtomicType) and f.name not in ("doc_id", "text")]
    names = [F.col(f"`{c}`") for c in docs.columns]
    order = [F.col("text").asc_nulls_last(), *[F.col(f"`{c}`") for c in plain]]
    prints = save(fingerprints(docs, shingle), "simhash-prints")
    answer = save(_answer(prints, distance, node_rows), "simhash-answer")
    kept = (prints.join(answer, "fp").filter(F.col("doc_id") == F.col("component_id"))
            .select(F.col("doc_id").alias("ev_id")).distinct())
    with_id = docs.join(kept, docs["doc_id"].cast("long") == kept["ev_id"])
    without = _with_fingerprint(docs.filter("doc_id is null"), shingle).join(
        answer.filter("component_id is null").select(F.col("fp").alias("ev_fp"), F.col("component").alias("ev_id")), "ev_fp")
    one = lambda df: (df.withColumn("ev_n", F.row_number().over(W.partitionBy("ev_id").orderBy(*order)))
                      .filter("ev_n = 1").select(*names))
    return one(with_id).unionByName(one(without))


def _with_fingerprint(docs: DataFrame, shingle: int) -> DataFrame:
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint((t.as_py() or "").encode(), shingle) for t in batch.column(place)], np.uint64)
            yield batch.append_column("ev_fp", pa.array(prints.view(np.int64)))

    return docs.mapInArrow(run, T.StructType([*docs.schema, T.StructField("ev_fp", T.LongType())]))
