"""Ranked lexical search against scores of every (item, document) pair."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from eventide.llm import lemp

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=10):
    """{item_id: [(doc_id, score)]}, best first."""
    counts = [(doc_id, Counter(words(text))) for doc_id, text in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, all_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for item_id, text in items:
        wanted.setdefault(item_id, set()).update(words(text))
    out = {}
    for item_id, found in wanted.items():
        scored = []
        for doc_id, c in counts:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // all_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in found if t in c)
            if score > 0:
                scored.append((doc_id, score))
        scored.sort(key=lambda x: (-x[1], x[0] is None, x[0]))
        if scored:
            out[item_id] = scored[:top]
    return out


def ranked(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        held = out.setdefault(r["item_id"], [])
        assert r["rank"] == len(held) + 1
        held.append((r["doc_id"], r["score"]))
    return out


def pairs(df, key):
    return [(r[key], r["text"]) for r in df.select(key, "text").collect()]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(
        [(1, "the of AND to"), (2, None), (3, "..."), (4, "é漢字 marks 12 the the"), (4, "word"), (None, "of id"), (5, "nowhere-found zzzz"),
         (6, "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an"), (7, "Word")],
        "item_id long, text string")


def test_edge_rows(spark, docs, items):
    assert ranked(lemp.rank(docs, items)) == brute(pairs(docs, "doc_id"), pairs(items, "item_id"))


def test_blocks_of_items(spark, docs, items):
    got = ranked(lemp.rank(docs, items, top=3, block_pairs=5))
    assert got == brute(pairs(docs, "doc_id"), pairs(items, "item_id"), 3)


@pytest.mark.parametrize(("head", "rows"), [(1 / 64, 2048), (0.3, 7), (1.0, 64)])
def test_random_texts_at_any_cut(spark, head, rows, monkeypatch):
    monkeypatch.setattr(lemp, "HEAD", head)
    monkeypatch.setattr(lemp, "BUCKET_ROWS", rows)
    rng = random.Random(7)
    lexicon = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    texts = [" ".join(rng.choices(lexicon, weights, k=rng.choice([1, 3, 10, 40, 200]))) for _ in range(600)]
    texts += texts[:50] + [texts[3]] * 40                     # copies: ties
    docs = list(enumerate(texts))
    items = [(i, " ".join(rng.choices(lexicon, k=rng.choice([1, 2, 8, 30])))) for i in range(20)] + [(20, texts[3]), (21, texts[7])]
    got = lemp.rank(spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
                    spark.createDataFrame(items, "item_id long, text string"))
    assert ranked(got) == brute(docs, items)


def test_bounds_leave_documents_out():
    """With a threshold, a bucket looks only at rows that can reach it."""
    rng = np.random.default_rng(3)
    width, n = 40, 500
    cols = np.concatenate([np.sort(rng.choice(width, 8, replace=False)) for _ in range(n)])
    held = rng.integers(1, 1_000_000, 8 * n)
    length = np.sqrt((held.reshape(n, 8).astype(float) ** 2).sum(1))
    bucket = lemp.Bucket(np.arange(n), np.zeros(n, bool), np.arange(0, 8 * n + 1, 8), cols, held, length, width)
    terms = np.arange(10)
    weights = rng.integers(1, 9000, 10)
    item = lemp.Item(0, terms, weights, float(np.sqrt((weights.astype(float) ** 2).sum())))
    full = np.zeros((n, width), np.int64)
    full[np.repeat(np.arange(n), 8), cols] = held
    scores = full[:, :10] @ weights
    threshold = int(np.sort(scores)[-10])
    rescored = []
    exact = bucket._exact
    bucket._exact = lambda alive, w: rescored.append(len(alive)) or exact(alive, w)
    rows, found = bucket.search(item, threshold, np.zeros(width, np.int64))
    assert dict(zip(rows.tolist(), found.tolist(), strict=True)) == {i: s for i, s in enumerate(scores.tolist()) if s >= threshold}
    assert rescored[0] < n / 2
    assert not len(bucket.search(item, int(item.length * length.max() * 2), np.zeros(width, np.int64))[0])


def test_whole_table(spark, sf_docs):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    assert ranked(lemp.rank(sf_docs, items)) == brute(pairs(sf_docs, "doc_id"), pairs(items, "item_id"))


def test_empty_tables(spark, docs, empty, items):
    assert lemp.rank(empty, items).collect() == []
    assert lemp.rank(docs, items.limit(0)).collect() == []
    assert lemp.rank(docs.filter("text is null"), items).collect() == []
