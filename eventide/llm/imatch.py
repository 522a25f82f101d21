"""I-Match document fingerprints over randomised lexicon subsets.

A corpus pass counts the documents that hold each term (lower-cased ``\\w+``
runs).  The lexicon is the terms whose document frequency lies in a band, as
shares of all documents.  Its size is bounded whatever the corpus: with d
distinct terms in a mean document, at most d / ``DF_LOW`` terms reach the lower
edge, so it is small enough to send to every task.

There are ``LEXICONS`` randomised subsets of the lexicon for each share 1/4,
1/16, ... 1/4^7 of its terms.  A text's distinct lexicon terms are sorted, and
its signature of a subset hashes, in that order, all of them that the subset
holds; a subset that holds none gives zero.  Signatures of subsets that hold
many terms change with any edit, so a fingerprint keeps those of two shares:
the greatest at which at most ``CROWDED`` of the text's subsets hold a term, and
the next.  Before them stand the signature of the whole lexicon and the share.

The likeness of two fingerprints is 1 if the whole signatures agree.  Otherwise
it is the share of equal signatures among the subsets that hold a term of
either text, at the greatest share both keep at which at most ``CROWDED`` of
the subsets do (else the smallest they keep).  Texts that keep no common share
differ in length more than fourfold: 0.

The edited texts of the contract need each document's successor: documents are
dealt into ranges of doc_id, compressed, sorted there, and the first document
of each range is also sent to the range before it.

Defined cases: a null text is empty; a text without lexicon terms uses all its
terms; one without any term has the zero fingerprint, alike (1.0) to another
such text; null doc_ids come last; rows of one doc_id stand in the order of
their compressed text; a lone document is its own successor; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import MAX_LONG, order_key, range_cuts

DF_LOW, DF_HIGH = 0.001, 0.15
LEXICONS = 32
SHARES = 7
CROWDED = 0.75
SEED = 7
# Terms a task holds before it passes its counts on.
FLUSH_TERMS = 400_000
RANGE_DOCS = 16_384
MAX_RANGES = 20_000

_TERM = re.compile(r"\w+")
# A term is in subset i of share 1/4^s if its hash times multiplier i is below 2^64 / 4^s.
_SUBSET = np.array([[xxhash.xxh64_intdigest(f"subset {i}", SEED) | 1] for i in range(LEXICONS)], np.uint64)
_BELOW = np.array([1 << (64 - 2 * share) for share in range(1, SHARES + 1)], np.uint64)
# A fingerprint: four 16-bit parts of the whole signature, the share, then the signatures of two shares.
_HEAD = 5


def terms(text: str) -> set[str]:
    return set(_TERM.findall(text.lower()))


def document_frequencies(docs: DataFrame) -> DataFrame:
    """(term, df) over all texts, counted per task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                             ["term", "df"])
            counts.clear()
            return out

        for batch in batches:
            for text in batch.column(0):
                counts.update(terms(text.as_py() or ""))
                if len(counts) >= FLUSH_TERMS:
                    yield flush()
        yield flush()

    found = docs.select(F.col("text").cast("string")).mapInArrow(run, "term string, df long")
    return found.groupBy("term").agg(F.sum("df").alias("df"))


def lexicon(docs: DataFrame, low: float = DF_LOW, high: float = DF_HIGH) -> list[str]:
    """Terms in the band, sorted.  Few (see above), so they are collected."""
    total = docs.count()
    found = document_frequencies(docs).filter((F.col("df") >= low * total) & (F.col("df") <= high * total))
    return sorted(found.select("term").toPandas()["term"])


class IMatch:
    """Fingerprints against one lexicon."""

    def __init__(self, words: list[str]):
        self.hash_of = {w: xxhash.xxh64_intdigest(w, SEED) for w in words}

    def fingerprint(self, text: str) -> np.ndarray:
        every = terms(text)
        known = sorted(every & self.hash_of.keys()) or sorted(every)
        h = np.array([self.hash_of.get(w) or xxhash.xxh64_intdigest(w, SEED) for w in known], np.uint64)
        out = np.zeros(_HEAD + 2 * LEXICONS, np.uint16)
        if not known:
            return out
        place = h * _SUBSET
        used = (place.min(1)[:, None] < _BELOW).sum(0)          # subsets of each share that hold a term
        share = min(SHARES - 1, 1 + int((used > CROWDED * LEXICONS).sum()))
        whole = xxhash.xxh64_intdigest(h.tobytes(), SEED)
        out[:_HEAD] = [whole >> 48, whole >> 32 & 0xFFFF, whole >> 16 & 0xFFFF, whole & 0xFFFF, share]
        for at in (0, 1):
            subset, term = np.nonzero(place < _BELOW[share - 1 + at])      # by subset, then in the terms' order
            held, there = h[term].tobytes(), np.unique(subset)
            starts, ends = (np.searchsorted(subset, there, side=side).tolist() for side in ("left", "right"))
            for i, lo, hi in zip(there.tolist(), starts, ends, strict=True):
                out[_HEAD + at * LEXICONS + i] = max(1, xxhash.xxh64_intdigest(held[8 * lo:8 * hi], SEED) >> 48)
        return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if (a[:_HEAD - 1] == b[:_HEAD - 1]).all():
        return 1.0
    shares, near = (int(a[_HEAD - 1]), int(b[_HEAD - 1])), 0.0
    for share in range(max(shares), min(shares) + 2):
        x, y = (f[_HEAD + (share - own) * LEXICONS:][:LEXICONS] for f, own in zip((a, b), shares, strict=True))
        held = int(((x > 0) | (y > 0)).sum())
        near = int(((x == y) & (x > 0)).sum()) / max(1, held)
        if held <= CROWDED * LEXICONS:
            break
    return near


def as_text(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u2").tobytes().hex()


def fingerprints(docs: DataFrame, words: list[str]) -> DataFrame:
    """(doc_id, fingerprint) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = IMatch(sent.value)
        for batch in batches:
            made = [as_text(maker.fingerprint(t.as_py() or "")) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())], ["doc_id", "fingerprint"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fingerprint string")


def edit_digests(docs: DataFrame, low: float = DF_LOW, high: float = DF_HIGH, range_docs: int = RANGE_DOCS) -> DataFrame:
    """The contract's row for every document: its fingerprint, that of its
    edited text, and how alike it is to that and to its successor."""
    spark = docs.sparkSession
    rows = docs.select(order_key().alias("ev_key"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    words = lexicon(rows, low, high)
    total = rows.count()
    cuts = range_cuts(rows, "ev_key", min(MAX_RANGES, -(-total // range_docs)))
    bins = np.array(cuts, np.int64)
    heads = _range_heads(rows, bins)

    sent = spark.sparkContext.broadcast(words)
    packed = rows.mapInArrow(_packer(bins, heads), "part int, halo int, ev_key long, doc_id long, packed binary")
    dealt = packed.repartitionById(len(cuts) + 1, F.col("part")).sortWithinPartitions("part", "halo", "ev_key", "packed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker, open_ = IMatch(sent.value), zstandard.ZstdDecompressor()
        part, before = None, None
        for batch in batches:
            out: list[tuple] = []
            ids, halos, parts = (batch.column(i).to_pylist() for i in (3, 1, 0))
            for i, data in enumerate(batch.column(4)):
                if parts[i] != part:
                    part, before = parts[i], None
                if before is None and halos[i]:
                    continue
                text = open_.decompress(data.as_py()).decode()
                made = maker.fingerprint(text)
                if before is not None:
                    out.append(_edited(maker, *before, text, made))
                # A successor from another range ends this one.
                before = None if halos[i] else (ids[i], text, made)
            columns = list(zip(*out, strict=True)) if out else [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                                              "near_edited", "near_next"])

    return dealt.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                 "edited_fingerprint string, near_edited double, near_next double")


def edited(text: str, successor: str) -> str:
    """The last half of a text replaced by as much of its successor's start."""
    half = len(text) // 2
    return text[:len(text) - half] + successor[:half]


def _edited(maker: IMatch, doc_id, text: str, made: np.ndarray, after: str, after_made: np.ndarray) -> tuple:
    new = edited(text, after)
    new_made = maker.fingerprint(new)
    return (doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), as_text(made), as_text(new_made),
            likeness(made, new_made), likeness(made, after_made))


def _range_heads(rows: DataFrame, bins: np.ndarray) -> dict[int, int]:
    """Range -> smallest order key in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = np.full(len(bins) + 1, MAX_LONG)
        seen = np.zeros(len(bins) + 1, bool)
        for batch in batches:
            key = batch.column(0).to_numpy()
            part = np.searchsorted(bins, key, side="right")
            np.minimum.at(least, part, key)
            seen[part] = True
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(least[used], pa.int64())], ["part", "key"])

    found = rows.select("ev_key").mapInArrow(run, "part int, key long").groupBy("part").agg(F.min("key").alias("key")).collect()
    return {r["part"]: r["key"] for r in found}


def _packer(bins: np.ndarray, heads: dict[int, int]):
    """Deal compressed documents to ranges; heads also go to the range before
    (halo 1) or, for the first of all, behind the last (halo 2)."""
    order = sorted(heads)
    previous = {part: order[i - 1] for i, part in enumerate(order)}
    keys = {heads[part]: part for part in order}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            key = batch.column(0).to_numpy()
            part = np.searchsorted(bins, key, side="right").tolist()
            ids = batch.column(1).to_pylist()
            data = [press.compress(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in batch.column(2)]
            rows = [(p, 0, k, i, d) for p, k, i, d in zip(part, key.tolist(), ids, data, strict=True)]
            rows += [(previous[p], 2 if p == order[0] else 1, k, i, d) for p, _, k, i, d in rows if keys.get(k) == p]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                             ["part", "halo", "ev_key", "doc_id", "packed"])

    return run
