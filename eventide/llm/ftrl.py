"""Toxicity: FTRL-proximal logistic regression over hashed word features.

Features of a text, as a set: word unigrams, the same words cut to their first
three, four and five letters (inflected and compounded forms share these),
bigrams, and skip-grams over one word, hashed into 2^DIM_BITS places.  Training keeps
per-coordinate squared-gradient sums (its rates) and an L1 threshold that
leaves most weights exactly zero, so the model is a short list of (place,
weight) that is sent to every task.

The model is fitted in one task on at most ``TRAIN_ROWS`` labelled rows, the
first by a hash of doc_id; only their ids and labels (a table of that bounded
size) are broadcast to find their texts.  Every text is scored whole, in
pieces of bounded length.

Defined cases: a null or wordless text gets the score of the bias alone; null
labels teach nothing; a doc_id labelled twice is toxic if either label says
so; a null doc_id is scored, never learned from, and not held out; repeated
rows score alike; without any label to learn from every score is 0; an empty
table gives no rows.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import per_worker

TRAIN_ROWS = 10_000
EPOCHS = 10
DIM_BITS = 20
ALPHA, BETA, L1, L2 = 1.0, 1.0, 10.0, 0.0

# Words looked at in one piece, and words whose hashes a worker remembers.
PIECE_WORDS = 1 << 16
MEMO_WORDS = 100_000

_WORD = re.compile(r"\w+")
_MASK = np.uint64((1 << DIM_BITS) - 1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """Word -> hashes of the word, of its first 3 letters, of its first 4 and
    first 5, as 4 bytes each: a quarter of what a tuple of ints takes."""

    def __missing__(self, word: str) -> bytes:
        if len(self) >= MEMO_WORDS:
            self.clear()
        raw = zlib.crc32(word.encode())
        found = struct.pack("<4I", raw, *(zlib.crc32(b"%d" % k + word[:k].encode()) for k in (3, 4, 5)))
        self[word] = found
        return found


def _places(x: np.ndarray) -> np.ndarray:
    return ((x * _MIX) >> np.uint64(64 - DIM_BITS)) & _MASK


def feature_pieces(text: str) -> Iterator[np.ndarray]:
    """Feature places of a text, with repeats, piece by piece."""
    hashes = per_worker("toxicity_hashes", _Hashes)
    lowered = text.lower()
    carry: list[bytes] = []
    if len(lowered) < 8 * PIECE_WORDS:
        pieces = iter([_WORD.findall(lowered)])
    else:
        stream = (m.group() for m in _WORD.finditer(lowered))
        pieces = iter(lambda: list(islice(stream, PIECE_WORDS)), [])
    for words in pieces:
        if not words:
            return
        fresh = [hashes[w] for w in words]
        h = np.frombuffer(b"".join(carry + fresh), "<u4").reshape(-1, 4).astype(np.uint64)
        w, seen = h[:, 0], len(carry)
        pair = w[:-1] * np.uint64(3) + w[1:] * np.uint64(0x10001) + np.uint64(7)
        skip = w[:-2] * np.uint64(5) + w[2:] * np.uint64(0x1000003) + np.uint64(11)
        yield _places(np.concatenate([h[seen:].ravel(), pair[max(0, seen - 1):], skip[max(0, seen - 2):]]))
        carry = (carry + fresh)[-2:]


def features(text: str) -> np.ndarray:
    """Distinct feature places of a text."""
    pieces = list(feature_pieces(text))
    return np.unique(np.concatenate(pieces)) if pieces else np.zeros(0, np.uint64)


class Ftrl:
    """Per-coordinate state; the last place is the bias."""

    def __init__(self):
        self.z = np.zeros((1 << DIM_BITS) + 1)
        self.n = np.zeros((1 << DIM_BITS) + 1)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0.0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35)))
        g = p - label
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def train(docs: DataFrame, labels: DataFrame, eligible: Column, rows: int = TRAIN_ROWS,
          epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """(places, weights) other than zero.  ``eligible`` is a condition on
    ``doc_id`` (as a long) for rows whose label may be learned."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & eligible)
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)      # bounded by ``rows``
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = []
        for batch in batches:
            for key, text, label in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                places = np.append(features(text.as_py() or ""), 1 << DIM_BITS).astype(np.int32)
                examples.append((key, zlib.crc32(places.tobytes()), places, label))
        examples.sort(key=lambda e: e[:2])
        model = Ftrl()
        for epoch in range(epochs):
            for i in np.random.default_rng(epoch).permutation(len(examples)):
                model.learn(*examples[i][2:])
        every = model.weights(slice(None))
        used = np.flatnonzero(every)
        if examples and every[-1] == 0.0:
            used = np.append(used, 1 << DIM_BITS)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(every[used])], ["place", "weight"])

    fitted = (texts.join(F.broadcast(sample), "doc_id").select(F.xxhash64("doc_id").alias("key"), "text", "toxic")
              .repartition(1).mapInArrow(fit, "place int, weight double").toPandas())
    return fitted["place"].to_numpy(np.int32), fitted["weight"].to_numpy(np.float64)


def _scorer(model: tuple[np.ndarray, np.ndarray]):
    """Function from a text to its score; weights are laid out once per task."""
    places, values = model
    dense = np.zeros((1 << DIM_BITS) + 1)
    dense[places] = values
    bias = float(dense[-1])

    def score(text: str | None) -> float:
        if not len(places):
            return 0.0
        hit = [p[dense[p] != 0.0] for p in feature_pieces(text or "")]
        total = bias + (float(dense[np.unique(np.concatenate(hit))].sum()) if hit else 0.0)
        return float(1.0 / (1.0 + np.exp(-np.clip(total, -35, 35))))

    return score


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(doc_id, score) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _scorer(sent.value)
        for batch in batches:
            scores = [of(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def drop_toxic(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], limit: float = 0.5) -> DataFrame:
    """The rows of docs that score below ``limit``, unchanged."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _scorer(sent.value)
        for batch in batches:
            keep = pa.array([of(t.as_py()) < limit for t in batch.column(place)], pa.bool_())
            yield batch.filter(keep)

    return docs.mapInArrow(run, T.StructType(list(docs.schema)))


def fold(doc_id: str = "doc_id", parts: int = 5) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("long").cast("string")) % parts


def held_out(docs_scored: DataFrame) -> DataFrame:
    return docs_scored.select(
        "doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
