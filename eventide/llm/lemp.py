"""Ranked lexical search by length-ordered buckets of impact vectors.

A document is a sparse vector of term impacts and an item a sparse vector of
term weights, so a score is their inner product.  The k best documents of
every item are found as in maximum inner product search with length buckets:

1. Only terms of the items matter.  Items are taken in blocks of a bounded
   number of (item, term) pairs; one pass over the texts counts the block's
   terms in every document and all terms together (N, L, document frequency).
2. The counts become impact vectors, dealt out in the order of their length.
   Lengths within one bucket differ by a factor of ``SPREAD`` at most.
3. The longest ``HEAD`` of the vectors gives each item its first threshold,
   the k-th best score; the rest of the table is searched under it.  By
   Cauchy-Schwarz a bucket is passed over where |item| x its greatest length
   is below the threshold, and vectors shorter than every item needs are not
   even read.
4. Inside a bucket the item's coordinates are taken in the order of their
   bounds (weight x greatest impact in the bucket) until the others together
   stay below the threshold: a document without any of these focus
   coordinates cannot reach it.  Those with some keep their partial product;
   the rest of the product is bounded by the smaller of the coordinate bounds
   and Cauchy-Schwarz on what is left of both lengths.
5. Survivors are scored anew in 64-bit integers.  Nothing is approximate:
   only documents whose bound is below k known scores are left out.

Scores: m = 10 + (90 n N) div L for a document of n terms, impact =
(10^9 tf) div (1000 tf + 8 m), weight = floor(1000 ln((2N + 2) / (2df + 1))).

Defined results: null and term-less texts are no documents (they count
neither in N nor in L) and, as items, find nothing.  Rows of one item_id are
one item with all their terms; null item_ids are one item.  Repeated document
rows are documents of their own, and rank beside each other.  Equal scores
rank by ascending doc_id, null ids last.  Very long texts are counted whole.
Extra columns are not read.  An empty table on either side gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import save

TOP = 10
# (item, term) pairs searched at once: what the driver holds and tasks receive.
BLOCK_PAIRS = 500_000
# Greatest ratio of lengths inside a bucket, and rows scored at a time.
SPREAD = 0.9
BUCKET_ROWS = 2048
# Share of the vectors, the longest, that gives the first thresholds.
HEAD = 1 / 64

# Bytes of a UTF-8 text: A-Z in lower case, other ASCII but letters and digits
# as spaces, all else (every byte of a non-ASCII character) as it is.
_FOLD = bytes(b if b >= 0x80 else ord(chr(b).lower()) if chr(b).isalnum() else 0x20 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """All terms of a text, in order."""
    return (text or "").encode().translate(_FOLD).split()


# ------------------------------------------------------------------- items

def _item_terms(items: DataFrame) -> DataFrame:
    """Distinct (item_id, term) pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item_id, text in zip(*batch.columns, strict=True):
                found = list(dict.fromkeys(terms(text.as_py())))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item_id.as_py()] * len(found), pa.int64()), pa.array(found, pa.binary())], ["item_id", "term"])

    need = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return need.mapInArrow(run, "item_id long, term binary").distinct()


@dataclass(frozen=True)
class Item:
    """A weight vector: term numbers, integer weights, length."""

    item_id: int | None
    terms: np.ndarray
    weights: np.ndarray
    length: float


# ------------------------------------------------------------------- index

def _counted(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document that has a term; the two
    lists hold the numbered terms only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, ends, found, tfs = [], [], [0], [], []
            for doc_id, text in zip(*batch.columns, strict=True):
                words = terms(text.as_py())
                if not words:
                    continue
                counts = Counter(words)
                known = counts.keys() & numbers.keys()
                ids.append(doc_id.as_py())
                sizes.append(len(words))
                found.extend(map(numbers.__getitem__, known))
                tfs.extend(map(counts.__getitem__, known))
                ends.append(len(found))
            at = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(at, pa.array(found, pa.int32())), pa.ListArray.from_arrays(at, pa.array(tfs, pa.int32()))],
                ["doc_id", "n", "terms", "tfs"])

    need = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return need.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


def impacts(tfs: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tfs) // (1000 * tfs + 8 * m)


def bucket_of(length: np.ndarray) -> np.ndarray:
    return np.floor(np.log(length) / -math.log(SPREAD)).astype(np.int32)


def _vectors(counted: DataFrame, documents: int, all_terms: int) -> DataFrame:
    """(doc_id, terms, impacts, length, bucket) of the documents that hold a
    term of the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.compute.greater(pa.compute.list_value_length(batch.column(2)), 0))
            if not batch.num_rows:
                continue
            bounds = _bounds(batch.column(2))
            m = np.array([10 + 90 * n * documents // all_terms for n in batch.column(1).to_pylist()], np.int64)
            held = impacts(batch.column(3).flatten().to_numpy().astype(np.int64), np.repeat(m, np.diff(bounds)))
            length = np.sqrt(np.add.reduceat(held.astype(np.float64) ** 2, bounds[:-1]))
            some = length > 0
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(held, pa.int32())),
                 pa.array(length), pa.array(bucket_of(np.where(some, length, 1.0)))],
                ["doc_id", "terms", "impacts", "length", "bucket"])
            yield out.filter(pa.array(some))

    return counted.select("doc_id", "n", "terms", "tfs").mapInArrow(
        run, "doc_id long, terms array<int>, impacts array<int>, length double, bucket int")


def _bounds(lists: pa.ListArray) -> np.ndarray:
    """Where each list starts in ``flatten()``, and the end."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


# ------------------------------------------------------------------ search

class Bucket:
    """Vectors of similar length, by rows and by coordinates."""

    def __init__(self, doc_ids: np.ndarray, unknown: np.ndarray, bounds: np.ndarray, cols: np.ndarray, held: np.ndarray,
                 length: np.ndarray, width: int):
        self.doc_ids, self.unknown, self.bounds, self.cols, self.held, self.length = doc_ids, unknown, bounds, cols, held, length
        self.longest = float(length.max())
        order = np.argsort(cols, kind="stable")
        self.rows_of = np.repeat(np.arange(len(length)), np.diff(bounds))[order]
        self.held_of = held[order]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(cols, minlength=width))])
        self.greatest = np.zeros(width, np.int64)
        np.maximum.at(self.greatest, cols, held)

    def search(self, item: Item, threshold: int, weight_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of all rows that score above 0 and may reach the
        threshold; ``weight_of`` is a zeroed scratch array of the width."""
        if item.length * self.longest * (1 + 1e-9) < threshold:
            return _NOTHING
        bound = (item.weights * self.greatest[item.terms]).astype(np.float64)
        order = np.argsort(-bound, kind="stable")
        rest_bound = bound.sum() - np.cumsum(bound[order])
        if bound.sum() < max(threshold, 1):
            return _NOTHING
        # The fewest coordinates without which the threshold is out of reach.
        focus = int(np.argmax(rest_bound < max(threshold, 1))) + 1
        seen, left = item.terms[order[:focus]], order[focus:]
        spans = [slice(self.starts[t], self.starts[t + 1]) for t in seen]
        rows = np.concatenate([self.rows_of[s] for s in spans])
        held = np.concatenate([self.held_of[s] for s in spans]).astype(np.float64)
        weights = np.repeat(item.weights[order[:focus]], [s.stop - s.start for s in spans]).astype(np.float64)
        n = len(self.length)
        partial = np.bincount(rows, held * weights, minlength=n)
        used = np.bincount(rows, held * held, minlength=n)
        remaining = np.sqrt((item.weights[left].astype(np.float64) ** 2).sum()) * np.sqrt(np.maximum(self.length ** 2 - used, 0))
        bounds = (partial + np.minimum(remaining, rest_bound[focus - 1])) * (1 + 1e-9) + 1
        alive = np.flatnonzero((used > 0) & (bounds >= threshold))
        if not len(alive):
            return _NOTHING
        weight_of[item.terms] = item.weights
        scores = self._exact(alive, weight_of)
        weight_of[item.terms] = 0
        keep = scores >= max(threshold, 1)
        return alive[keep], scores[keep]

    def _exact(self, alive: np.ndarray, weight_of: np.ndarray) -> np.ndarray:
        sizes = np.diff(self.bounds)[alive]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(self.bounds[alive] - (ends - sizes), sizes)
        return np.add.reduceat(weight_of[self.cols[at]] * self.held[at], ends - sizes)


_NOTHING = np.zeros(0, np.int64), np.zeros(0, np.int64)


def _buckets(batch: pa.RecordBatch, width: int) -> Iterator[Bucket]:
    """Pieces of a batch whose rows stand in one bucket."""
    number = batch.column(4).to_numpy()
    edges = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(edges, edges[1:], strict=False):
        for at in range(lo, hi, BUCKET_ROWS):
            part = batch.slice(at, min(BUCKET_ROWS, hi - at))
            ids = part.column(0)
            yield Bucket(ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), _bounds(part.column(1)),
                         part.column(1).flatten().to_numpy(), part.column(2).flatten().to_numpy().astype(np.int64),
                         part.column(3).to_numpy(), width)


def _search(vectors: DataFrame, items: list[Item], thresholds: list[int], top: int, width: int) -> DataFrame:
    """(item, doc_id, score): each task's ``top`` best per item, without those
    below the thresholds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least, best = list(thresholds), [None] * len(items)
        scratch = np.zeros(width, np.int64)
        for batch in batches:
            for bucket in _buckets(batch, width):
                for i, item in enumerate(items):
                    rows, scores = bucket.search(item, least[i], scratch)
                    if not len(rows):
                        continue
                    found = [bucket.doc_ids[rows], bucket.unknown[rows], scores]
                    if best[i] is not None:
                        found = [np.concatenate(x) for x in zip(best[i], found, strict=True)]
                    first = np.lexsort((found[0], found[1], -found[2]))[:top]
                    best[i] = [x[first] for x in found]
                    if len(first) == top:
                        least[i] = max(least[i], int(best[i][2][-1]))
        for i, found in enumerate(best):
            if found is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found[0]), i, np.int32)), pa.array(found[0], mask=found[1]), pa.array(found[2])],
                    ["item", "doc_id", "score"])

    return vectors.select("doc_id", "terms", "impacts", "length", "bucket").mapInArrow(run, "item int, doc_id long, score long")


def _best(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _rank_block(docs: DataFrame, pairs: list, top: int) -> DataFrame | None:
    """(item_id, rank, doc_id, score) of the items of one block."""
    numbers = {t: i for i, t in enumerate(sorted({bytes(r["term"]) for r in pairs}))}
    counted = save(_counted(docs, numbers), "lemp-counts")
    documents, all_terms = counted.agg(F.count("*"), F.sum("n")).first()
    if not documents:
        return None
    # At most one row a numbered term.
    df = {r["t"]: r["df"] for r in counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect()}
    items = _weighted(pairs, numbers, df, documents)
    vectors = save(_vectors(counted, documents, all_terms)
                   .repartitionByRange(F.col("bucket").desc(), F.xxhash64("doc_id", "terms", "impacts")).sortWithinPartitions(F.desc("length")), "lemp-vectors")
    # Lengths span a bounded range, so buckets are some hundreds at most.
    sizes = sorted(vectors.groupBy("bucket").count().collect(), reverse=True)
    enough, head, cut = HEAD * sum(n for _, n in sizes), 0, None
    for cut, n in sizes:
        head += n
        if head >= max(enough, top):
            break
    if cut is None:
        return None
    first = save(_best(_search(vectors.filter(F.col("bucket") >= cut), items, [0] * len(items), top, len(numbers)), top)
                 .select("item", "doc_id", "score"), "lemp-head")
    # The k-th best so far, for items that have k: one number an item.
    full = first.groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("least")).filter(F.col("n") >= top).collect()
    thresholds = [0] * len(items)
    for r in full:
        thresholds[r["item"]] = r["least"]
    shortest = min((t / x.length for x, t in zip(items, thresholds, strict=True) if x.length), default=0.0) * (1 - 1e-9)
    rest = vectors.filter((F.col("bucket") < cut) & (F.col("length") >= shortest))
    ranked = _best(first.unionByName(_search(rest, items, thresholds, top, len(numbers))), top)
    ids = docs.sparkSession.createDataFrame([(i, x.item_id) for i, x in enumerate(items)], "item int, item_id long")
    return ranked.join(ids, "item").select("item_id", "rank", "doc_id", "score")


def _weighted(pairs: list, numbers: dict[bytes, int], df: dict[int, int], documents: int) -> list[Item]:
    of_item: dict[int | None, list[int]] = {}
    for r in pairs:
        t = numbers[bytes(r["term"])]
        held = of_item.setdefault(r["item_id"], [])
        if t in df:
            held.append(t)
    out = []
    for item_id in sorted(of_item, key=lambda x: (x is None, x)):
        t = np.array(sorted(of_item[item_id]), np.int64)
        w = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df[x] + 1))) for x in t.tolist()], np.int64)
        out.append(Item(item_id, t, w, float(np.sqrt((w.astype(np.float64) ** 2).sum()))))
    return out


def rank(docs: DataFrame, items: DataFrame, top: int = TOP, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of each item."""
    spark = docs.sparkSession
    pairs = save(_item_terms(items), "lemp-items")
    blocks = max(1, math.ceil(pairs.count() / block_pairs))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for b in range(blocks):
        found = _rank_block(docs, pairs.filter(block == b).collect(), top)
        out = out if found is None else out.unionByName(found)
    return out
