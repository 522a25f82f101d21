"""Operators and the whole pipeline against plain Python."""

import math
import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from eventide.llm import crf, ftrl, mixing, pii
from eventide.llm.tokens import vocabulary
from llm_fixtures import WORDS, sentence

SF = "/root/testdata/sf0.001"
M64 = (1 << 64) - 1


# ------------------------------------------------------------------- toxicity

def plain_features(text):
    """Hashed places of a text's words, prefixes, pairs and skips."""
    place = lambda x: (x * 0x9E3779B97F4A7C15 & M64) >> 44
    words = re.findall(r"\w+", (text or "").lower())
    h = [zlib.crc32(w.encode()) for w in words]
    found = {place(x) for x in h}
    for w in words:
        for k in (3, 4, 5):
            found.add(place(zlib.crc32(str(k).encode() + w[:k].encode())))
    found |= {place(a * 3 + b * 0x10001 + 7 & M64) for a, b in zip(h, h[1:])}
    found |= {place(a * 5 + b * 0x1000003 + 11 & M64) for a, b in zip(h, h[2:])}
    return found


BIAS = 1 << 20


def plain_ftrl(examples, epochs=ftrl.EPOCHS, alpha=1.0, beta=1.0, l1=10.0):
    """{place: weight} by FTRL-proximal over dicts."""
    z, n = defaultdict(float), defaultdict(float)
    weight = lambda i: 0.0 if abs(z[i]) <= l1 else -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha)
    for epoch in range(epochs):
        for k in np.random.default_rng(epoch).permutation(len(examples)):
            places, label = examples[k]
            w = {i: weight(i) for i in places}
            g = 1 / (1 + math.exp(-max(-35, min(35, sum(w.values()))))) - label
            for i in places:
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha
                z[i] += g - sigma * w[i]
                n[i] += g * g
    return {i: weight(i) for i in z if weight(i)}


def spark_hash(doc_id):
    """xxhash64 of a long, as Spark gives it."""
    x = xxhash.xxh64_intdigest(int(doc_id).to_bytes(8, "little", signed=True), 42)
    return x - (1 << 64) if x >> 63 else x


def plain_model(docs, labels):
    """Weights learned from (doc_id, text) rows and {doc_id: toxic}."""
    examples = []
    for doc_id, text in docs:
        if doc_id in labels:
            places = np.array([*sorted(plain_features(text)), BIAS], np.int32)
            examples.append(((spark_hash(doc_id), zlib.crc32(places.tobytes())), places.tolist(), labels[doc_id]))
    examples.sort(key=lambda e: e[0])
    return plain_ftrl([(p, y) for _, p, y in examples])


def plain_score(model, text):
    if not model:
        return 0.0
    total = sum(w for i, w in model.items() if i == BIAS) + sum(model[i] for i in plain_features(text) if i in model)
    return 1 / (1 + math.exp(-max(-35, min(35, total))))


def toxic_labels(rows):
    out = {}
    for r in rows:
        if r["doc_id"] is not None and r["toxic"] is not None:
            out[r["doc_id"]] = max(r["toxic"], out.get(r["doc_id"], 0))
    return out


def test_weights_and_scores_of_plain_ftrl(spark, sf_docs):
    # Rude words in a third of the rows, so that weights pass the threshold.
    docs = sf_docs.select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit(" you rotten blockhead"))).otherwise(F.col("text")).alias("text"))
    labels = docs.select("doc_id", F.lit(0).alias("quality"), (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    places, weights = ftrl.train(docs, labels, F.lit(True))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = plain_model(rows, toxic_labels(labels.collect()))
    got = {int(i): float(w) for i, w in zip(places, weights, strict=True) if w}
    assert got.keys() == want.keys() and len(want) > 3
    assert all(abs(got[i] - want[i]) < 1e-9 for i in want)
    for r in ftrl.score(docs, (places, weights)).collect():
        assert any(abs(r["score"] - plain_score(want, t)) < 1e-9 for d, t in rows if d == r["doc_id"])


# ------------------------------------------------------------------ languages

def test_a_long_line_is_one_chain():
    """A line of 1,500 words against forward and backward loops over all of it."""
    import random
    rng = random.Random(1)
    model = crf.fit([(sentence(lang, 60, rng) + "\n" + sentence(lang, 30, rng), lang) for _ in range(20) for lang in WORDS])
    text = " ".join(sentence(lang, 250, rng) for lang in ("en", "de", "en", "de", "en", "de"))
    words = crf.tokens(text)
    assert len(words) > 1_400 and "\n" not in words
    emission, move = model.emissions(words).astype(float), np.exp(model.transition.astype(float))
    score = np.exp(emission - emission.max(1, keepdims=True))
    forward, backward = np.zeros_like(score), np.ones_like(score)
    for t in range(len(words)):
        forward[t] = score[t] if t == 0 else (forward[t - 1] @ move) * score[t]
        forward[t] /= forward[t].sum()
    for t in range(len(words) - 2, -1, -1):
        backward[t] = move @ (score[t + 1] * backward[t + 1])
        backward[t] /= backward[t].sum()
    marginal = forward * backward
    marginal /= marginal.sum(1, keepdims=True)
    labelled = crf.label_words(text, model.to_bytes())
    assert [model.labels.index(lang) for _, lang, _ in labelled] == marginal.argmax(1).tolist()
    assert np.allclose([p for _, _, p in labelled], marginal.max(1), atol=1e-4)
    # The text-level answer: the language with the largest mean, and that mean.
    langs, scores = crf.Labeller(model).predict([text, "\n".join([text, text])])
    mean = marginal.mean(0)
    assert langs == [model.labels[int(mean.argmax())]] * 2 and abs(scores[0] - mean.max()) < 1e-4 and abs(scores[1] - mean.max()) < 1e-4


# ----------------------------------------------------------------- pseudonyms

def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10


def test_no_two_cards_share_a_pseudonym(spark):
    cards = [f"{4000000000000000 + 7 * i:016d}" for i in range(400)]
    rows = spark.createDataFrame(list(enumerate(cards)), "doc_id int, text string")
    got = {r["doc_id"]: r["text"] for r in pii.report(rows).collect()}
    assert len(set(got.values())) == len(cards)
    assert all(luhn(got[i]) == luhn(c) for i, c in enumerate(cards))        # valid stay valid, others do not become so


def test_secrets_of_letters_alone(spark):
    secret = "abcdefabcdefabcdefabcdefabcdefab"
    text = pii.report(spark.createDataFrame([(1, f"key {secret} end"), (2, "a cabbage facade")], "doc_id int, text string")).collect()
    got = {r["doc_id"]: (r["text"], r["n_replaced"]) for r in text}
    assert secret not in got[1][0] and got[1][1] == 1 and re.fullmatch(r"key [0-9a-f]{32} end", got[1][0])
    assert got[2] == ("a cabbage facade", 0)


# ------------------------------------------------------------------- pipeline

def plain_print(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    votes = np.zeros(64, int)
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        votes += [h >> b & 1 for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(grams))


def plain_kept(rows):
    """Ids that stay: the smallest of each group of prints within 2 bits."""
    prints = [(d, plain_print(t)) for d, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if group[i] != group[j] and (prints[i][1] ^ prints[j][1]).bit_count() <= 2:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for g, (d, _) in zip(group, rows, strict=True):
        if d is not None:
            least[g] = min(d, least.get(g, d))
    nameless = sum(g not in least for g in set(group))
    return set(least.values()), nameless


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_pipeline_against_a_plain_chain(spark, tmp_path):
    import corpus_pipeline as P
    from tokenizers import Tokenizer

    base = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 90")
    rude = F.concat("text", F.lit(" you rotten blockhead"))
    docs = base.withColumn("text", F.when(F.col("doc_id") % 7 == 3, rude).otherwise(F.col("text"))).withColumn("score", F.lit("clash"))
    odd = [(1000, None, "en", "src1", 0, "x"), (1001, "", None, None, 0, None), (None, "a row without any id, 10.0.0.1", "en", "src2", 30, "y"),
           (1002, "Card 4111 1111 1111 1111 on 2020-02-29.", "en", None, 39, None)]
    kinds = "doc_id long, text string, lang string, source string, n_chars long, score string"
    docs = docs.unionByName(spark.createDataFrame(odd, kinds)).unionByName(docs.filter("doc_id = 5"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = base.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 7 == 3).cast("int").alias("toxic"))
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]

    # Toxicity: every row that a plain model does not reject.
    stage = dict(P.STAGES)
    model = plain_model(rows, toxic_labels(labels.collect()))
    clean = stage["toxicity"](spark, docs, str(tmp_path)).cache()
    left = [(d, t) for d, t in rows if plain_score(model, t) < 0.5]
    order = lambda xs: sorted(xs, key=repr)
    assert order((r["doc_id"], r["text"]) for r in clean.collect()) == order(left) and len(left) < len(rows)

    # Near copies: the smallest id of each group.
    single = stage["near_dedup"](spark, clean, str(tmp_path)).cache()
    ids, nameless = plain_kept(left)
    got = [r["doc_id"] for r in single.collect()]
    assert Counter(got) == Counter([*ids, *[None] * nameless])
    assert all((r["doc_id"], r["text"]) in left for r in single.collect()) and len(got) < len(left)

    # Pseudonyms: the same rows; only texts that hold a value differ, as the operator reports.
    hidden = stage["pii"](spark, single, str(tmp_path)).cache()
    reported = Counter((r["doc_id"], r["text"]) for r in pii.report(single).collect())
    assert Counter((r["doc_id"], r["text"]) for r in hidden.collect()) == reported
    before = {r["doc_id"]: r for r in single.collect()}
    for r in hidden.collect():
        if not re.search(r"[0-9@]|[A-Fa-f]{32}", before[r["doc_id"]]["text"] or ""):
            assert r == before[r["doc_id"]]
    assert "4111 1111" not in {r["doc_id"]: r["text"] for r in hidden.collect()}[1002]

    # Mixing: every document's words as often as the mix takes them.
    mixed = stage["mixing"](spark, hidden, str(tmp_path)).cache()
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    taken, held = defaultdict(int), defaultdict(int)
    for r in mixing.mixed_sizes(hidden).collect():
        taken[r["doc_id"]] += r["taken"]
    for r in mixed.collect():
        held[r["doc_id"]] += len(words(r["text"]))
    assert {k: v for k, v in taken.items() if v} == dict(held)
    assert mixed.columns == docs.columns and mixed.dtypes == docs.dtypes

    # Packing, and the run as a whole: each id of each mixed row lies in one piece.
    bpe = Tokenizer.from_file(vocabulary())
    want = Counter()
    whole = defaultdict(list)
    for r in mixed.collect():
        made = np.array([*bpe.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        whole[r["doc_id"]].append(made)
        want[r["doc_id"], len(made)] += 1
    pieces = P.run(spark, str(tmp_path)).collect()
    starts = Counter((r["doc_id"], r["doc_tokens"]) for r in pieces if r["start"] == 0)
    assert starts == want
    length = defaultdict(int)
    for r in pieces:
        length[r["doc_id"]] += r["length"]
        assert any(zlib.crc32(m[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
                   for m in whole[r["doc_id"]] if len(m) == r["doc_tokens"])
    assert dict(length) == {d: sum(map(len, m)) for d, m in whole.items()}
    windows = defaultdict(list)
    for r in pieces:
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    for held_pieces in windows.values():
        at = 0
        for offset, n in sorted(held_pieces):
            assert offset == at
            at += n
        assert at <= 2048
