"""Language identification by a linear-chain conditional random field on words.

Words (runs of letters, lower-cased) of a line form a chain.  A word's
emission sums the weights of its features: the word itself, its prefixes and
suffixes, its character bigrams and trigrams, and membership in each language's
lexicon of frequent words.  Transitions between the languages of neighbouring
words are learned; training chains join lines of several documents, so that
switches occur in them.  Forward-backward gives each word a distribution over
languages, also inside code-switched lines; a text's language is the one with
the largest mean over its words, and that mean is the score.

Fitting takes whole texts of at most ``TRAIN_PER_LANG`` rows a language, the
first by a hash of doc_id, in one task: AdaGrad on the log-likelihood.  Scoring
runs many chains in step; emissions are computed once per distinct word and
worker.  A line is one chain, however long.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
null languages and null ids teach nothing; without any language to learn every
text is ``und``; ties go to the language first in code-point order; repeated
rows score alike; a null doc_id is not held out; an empty table gives no rows.
"""

from __future__ import annotations

import io
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TRAIN_PER_LANG = 200
EPOCHS = 4
BATCH_WORDS = 40_000
RATE = 0.25
DECAY = 1e-6
FEATURE_BITS = 17
LEXICON_WORDS = 150
SWITCH_LINES = 4
UNDETERMINED = "und"

# Distinct words whose emissions a task remembers, and texts scored together.
MEMO_WORDS = 300_000
BATCH_TEXTS = 512

_TOKEN = re.compile(r"[^\W\d_]+|\n")
_MASK = (1 << FEATURE_BITS) - 1
_MIX = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: str) -> list[str]:
    """Words and line feeds."""
    return _TOKEN.findall(text.lower())


def has_letter(words: list[str]) -> bool:
    return any(c.isalpha() for w in words for c in w)


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashed place, word) of each word's own, n-gram and affix features, for
    many words at once over their UTF-8 bytes between ``^`` and ``$``."""
    raws = [b"^" + w.encode() + b"$" for w in words]
    sizes = np.array([len(r) for r in raws], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    buffer = np.frombuffer(b"".join(raws) + b"\0" * 8, np.uint8).astype(np.uint64)
    word = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(ends, sizes) - np.arange(len(word))        # bytes from here to the word's end

    def places(first: np.ndarray, count: int, kind: int) -> np.ndarray:
        code = np.full(len(first), kind, np.uint64)
        for j in range(count):
            code = (code << np.uint64(8)) | buffer[first + j]
        return ((code * _MIX) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)

    own = np.array([zlib.crc32(r) & _MASK for r in raws], np.int64)
    found = [(own, np.arange(len(words)))]
    for n in (2, 3):
        at = np.flatnonzero(left >= n)
        found.append((places(at, n, n), word[at]))
    for n in range(2, 6):
        long_ = np.flatnonzero(sizes > n)
        found.append((places(starts[long_], n, 16 + n), long_))
        found.append((places(ends[long_] - n, n, 32 + n), long_))
    return np.concatenate([f for f, _ in found]), np.concatenate([w for _, w in found])


# ------------------------------------------------------------------ inference

def chain_bounds(is_break: np.ndarray, limit: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs between breaks; with a limit, cut there."""
    edge = np.flatnonzero(np.diff(np.concatenate([[1], is_break.astype(np.int8), [1]])))
    starts, sizes = edge[::2], edge[1::2] - edge[::2]
    if limit is None:
        return starts, sizes
    pieces = -(-sizes // limit)
    first = np.repeat(starts, pieces)
    nth = np.arange(len(first)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    return first + nth * limit, np.minimum(limit, np.repeat(sizes, pieces) - nth * limit)


def forward_backward(emission: np.ndarray, transition: np.ndarray, starts: np.ndarray, sizes: np.ndarray,
                     pairs: bool = False) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals of every word (rows outside chains stay 0), and, if asked,
    the expected number of each transition and the log partition sum."""
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    labels = emission.shape[1]
    top = emission.max(1, keepdims=True)
    p = np.exp(emission - top)
    move = np.exp(transition)
    alpha, beta = np.zeros_like(p), np.zeros_like(p)
    steps = int(sizes[0]) if len(sizes) else 0
    live = [int(np.searchsorted(-sizes, -t, side="left")) for t in range(steps)]
    log_z = float(top.sum()) if pairs else 0.0
    for t in range(steps):
        at = starts[:live[t]] + t
        a = p[at] if t == 0 else (alpha[at - 1] @ move) * p[at]
        total = a.sum(1, keepdims=True)
        alpha[at] = a / total
        if pairs:
            log_z += float(np.log(total).sum())
    expected = np.zeros((labels, labels))
    for t in range(steps - 1, -1, -1):
        at = starts[:live[t]] + t
        b = np.ones((len(at), labels), p.dtype)
        if t + 1 < steps:
            n = live[t + 1]
            after = p[at[:n] + 1] * beta[at[:n] + 1]
            b[:n] = after @ move.T
            if pairs:
                joint = alpha[at[:n], :, None] * move * after[:, None, :]
                expected += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
        beta[at] = b / b.sum(1, keepdims=True)
    marginal = alpha * beta
    total = marginal.sum(1, keepdims=True)
    return np.divide(marginal, total, out=np.zeros_like(marginal), where=total > 0), expected, log_z


# ------------------------------------------------------------------- training

class Crf:
    """Languages, feature weights (a column a language), lexicon weights and transitions."""

    def __init__(self, labels: list[str], lexicons: dict[str, int]):
        k = len(labels)
        self.labels, self.lexicons = labels, lexicons       # word -> bits of the languages it is frequent in
        self.weights = np.zeros(((1 << FEATURE_BITS) + k, k), np.float32)
        self.transition = np.zeros((k, k), np.float32)

    def features(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(place, word) of hashed features and of lexicon membership."""
        place, word = word_features(words)
        bits = [self.lexicons.get(w, 0) for w in words]
        listed = [(i, j) for i, b in enumerate(bits) if b for j in range(len(self.labels)) if b >> j & 1]
        if listed:
            at, lang = np.array(listed).T
            place, word = np.append(place, (1 << FEATURE_BITS) + lang), np.append(word, at)
        return place, word

    def emissions(self, words: list[str]) -> np.ndarray:
        place, word = self.features(words)
        return np.stack([np.bincount(word, self.weights[place, j], len(words)) for j in range(len(self.labels))],
                        1).astype(np.float32)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(out, labels=np.array(self.labels, str), words=np.array(list(self.lexicons), str),
                            bits=np.array([str(b) for b in self.lexicons.values()], str),
                            weights=self.weights.astype(np.float32), transition=self.transition)
        return out.getvalue()

    @staticmethod
    def from_bytes(data: bytes) -> Crf:
        kept = np.load(io.BytesIO(data))
        model = Crf([str(x) for x in kept["labels"]],
                    {str(w): int(b) for w, b in zip(kept["words"], kept["bits"], strict=True)})
        model.weights, model.transition = kept["weights"], kept["transition"]
        return model


def fit(examples: list[tuple[str, str]], seed: int = 5) -> Crf:
    """A model from (text, language) rows, in a fixed order."""
    labels = sorted({lang for _, lang in examples})
    place = {lang: i for i, lang in enumerate(labels)}
    counts = [Counter() for _ in labels]
    lines: list[tuple[list[str], int]] = []
    for text, lang in examples:
        words = tokens(text)
        counts[place[lang]].update(w for w in words if w != "\n")
        line: list[str] = []
        for w in [*words, "\n"]:
            if w != "\n":
                line.append(w)
            elif line:
                lines.append((line, place[lang]))
                line = []
    lexicons: dict[str, int] = {}
    for i, c in enumerate(counts):
        for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:LEXICON_WORDS]:
            lexicons[w] = lexicons.get(w, 0) | 1 << i
    model = Crf(labels, lexicons)
    if not lines:
        return model
    ids: dict[str, int] = {}
    for line, _ in lines:
        for w in line:
            ids.setdefault(w, len(ids))
    feature, owner = model.features(list(ids))
    feature = feature[np.argsort(owner, kind="stable")]
    sizes = np.bincount(owner, minlength=len(ids))
    first = np.cumsum(sizes) - sizes
    rng = np.random.default_rng(seed)
    squares, t_squares = np.zeros_like(model.weights), np.full_like(model.transition, 1e-6)
    k = len(labels)
    for _ in range(EPOCHS):
        order = rng.permutation(len(lines))
        at = 0
        while at < len(order):
            batch_ids, batch_labels, ends, total = [], [], [], 0
            while at < len(order) and total < BATCH_WORDS:
                # A chain of up to SWITCH_LINES lines, of any documents.
                take = order[at:at + int(rng.integers(1, SWITCH_LINES + 1))]
                at += len(take)
                for i in take:
                    batch_ids += [ids[w] for w in lines[i][0]]
                    batch_labels += [lines[i][1]] * len(lines[i][0])
                total = len(batch_ids)
                ends.append(total)
            word, truth = np.array(batch_ids), np.array(batch_labels)
            starts, lengths = np.array([0, *ends[:-1]]), np.diff([0, *ends])
            kinds, local = np.unique(word, return_inverse=True)
            spans = np.concatenate([np.arange(first[i], first[i] + sizes[i]) for i in kinds])
            cut = np.cumsum(sizes[kinds]) - sizes[kinds]
            used = feature[spans]
            emission = np.add.reduceat(model.weights[used], cut, axis=0)[local].astype(np.float64)
            marginal, expected, _ = forward_backward(emission, model.transition.astype(np.float64), starts, lengths, pairs=True)
            error = marginal
            error[np.arange(len(truth)), truth] -= 1.0
            by_kind = np.stack([np.bincount(local, error[:, j], len(kinds)) for j in range(k)], 1)
            spread = np.repeat(np.arange(len(kinds)), sizes[kinds])
            rows, where = np.unique(used, return_inverse=True)
            grad = np.stack([np.bincount(where, by_kind[spread, j], len(rows)) for j in range(k)], 1) / len(truth)
            grad += DECAY * model.weights[rows]
            squares[rows] += grad.astype(np.float32) ** 2
            model.weights[rows] -= (RATE * grad / (np.sqrt(squares[rows]) + 1e-8)).astype(np.float32)
            inner = np.ones(len(truth), bool)
            inner[starts] = False
            seen = np.zeros((k, k))
            np.add.at(seen, (truth[np.flatnonzero(inner) - 1], truth[inner]), 1)
            t_grad = (expected - seen) / len(truth)
            t_squares += t_grad.astype(np.float32) ** 2
            model.transition -= (RATE * t_grad / np.sqrt(t_squares)).astype(np.float32)
    return model


def train(docs: DataFrame, eligible: Column, per_lang: int = TRAIN_PER_LANG) -> bytes:
    """A fitted model, packed.  ``eligible`` is a condition on ``doc_id``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    known = rows.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & eligible)
    key = F.xxhash64("doc_id")
    first = W.partitionBy("lang").orderBy(key, "doc_id")
    sample = known.select("doc_id", "lang").withColumn("ev_n", F.row_number().over(first)).filter(F.col("ev_n") <= per_lang)
    # At most per_lang ids a language: small enough to send to the text scan.
    texts = rows.drop("lang").join(F.broadcast(sample.select("doc_id", "lang").distinct()), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            found += [(k, t, g) for k, t, g in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True) if t]
        found.sort()
        yield pa.RecordBatch.from_arrays([pa.array([fit([(t, g) for _, t, g in found]).to_bytes()], pa.binary())], ["model"])

    made = texts.select(key.alias("key"), "text", "lang").repartition(1).mapInArrow(run, "model binary").collect()
    return bytes(made[0]["model"]) if made else Crf([], {}).to_bytes()


# -------------------------------------------------------------------- scoring

class Labeller:
    """Word distributions for batches of texts; emissions are remembered."""

    def __init__(self, model: Crf):
        self.model = model
        self.ids: dict[str, int] = {"\n": 0}
        self.rows = np.zeros((1, len(model.labels)), np.float32)

    def _look_up(self, lists: list[list[str]]) -> np.ndarray:
        fresh = set(chain.from_iterable(lists)) - self.ids.keys()
        if len(self.ids) + len(fresh) > MEMO_WORDS and len(self.ids) > 1:
            self.ids, self.rows = {"\n": 0}, self.rows[:1]
            fresh = set(chain.from_iterable(lists)) - self.ids.keys()
        if fresh:
            new = sorted(fresh)
            base = len(self.ids)
            self.ids.update(zip(new, range(base, base + len(new)), strict=True))
            self.rows = np.concatenate([self.rows, *(self.model.emissions(new[i:i + 10_000]) for i in range(0, len(new), 10_000))])
        get = self.ids.__getitem__
        return np.fromiter(map(get, chain.from_iterable(lists)), np.int64, sum(map(len, lists)))

    def marginals(self, lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Distributions of all tokens in a row (zero for line feeds) and the
        number of tokens of each list, plus one for the break between lists."""
        broken = [[*words, "\n"] for words in lists]
        at = self._look_up(broken)
        starts, sizes = chain_bounds(at == 0)
        marginal, _, _ = forward_backward(self.rows[at], self.model.transition, starts, sizes)
        return marginal, np.array([len(w) for w in broken], np.int64)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        lists = [tokens(t or "") for t in texts]
        letters = [has_letter(w) for w in lists]
        if not self.model.labels:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        marginal, counts = self.marginals(lists)
        sums = np.add.reduceat(marginal.astype(np.float64), np.cumsum(counts) - counts, axis=0) if len(texts) else marginal
        share = sums / np.maximum(sums.sum(1, keepdims=True), 1e-12)
        best = share.argmax(1)
        return ([self.model.labels[b] if ok else UNDETERMINED for b, ok in zip(best, letters, strict=True)],
                [min(1.0, float(share[i, b])) if ok else 0.0 for i, (b, ok) in enumerate(zip(best, letters, strict=True))])


def predict(docs: DataFrame, model: bytes) -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(Crf.from_bytes(sent.value))
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_TEXTS):
                part = batch.slice(at, BATCH_TEXTS)
                langs, scores = labeller.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                                 ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def label_words(text: str, model: bytes) -> list[tuple[str, str, float]]:
    """(word, language, probability) of the words of one text."""
    fitted = Crf.from_bytes(model)
    words = tokens(text)
    marginal, _ = Labeller(fitted).marginals([words])
    return [(w, fitted.labels[int(m.argmax())], float(m.max())) for w, m in zip(words, marginal, strict=False) if w != "\n"]


def fold(parts: int = 3) -> Column:
    return F.crc32(F.col("doc_id").cast("long").cast("string")) % parts


def held_out(predicted: DataFrame) -> DataFrame:
    return predicted.select("doc_id", F.coalesce(fold() == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
