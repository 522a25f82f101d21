"""SimHash groups, I-Match fingerprints and the multi-index against brute force."""

import hashlib
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from eventide.llm import imatch, multi_index, simhash


def brute_print(text, shingle=3):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    votes = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(grams))


def brute_groups(rows, distance=2):
    """Component id of each (doc_id, print) row by comparing all pairs."""
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(rows):
        for j in range(i):
            if bin(a ^ rows[j][1]).count("1") <= distance:
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return [least.get(root(i)) for i in range(len(rows))]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r))


def check_groups(docs, **options):
    rows = [(r["doc_id"], brute_print(r["text"])) for r in docs.collect()]
    expected = [(d, f"{p:016x}", c) for (d, p), c in zip(rows, brute_groups(rows))]
    assert order(map(tuple, simhash.groups(docs, **options).collect())) == order(expected)


def test_groups_of_awkward_rows(docs):
    check_groups(docs)


def test_groups_of_the_table(sf_docs):
    check_groups(sf_docs)


def test_small_nodes_lose_no_link(sf_docs, docs):
    check_groups(sf_docs, node_rows=1)


def test_no_rows(empty):
    assert simhash.groups(empty).collect() == []
    assert simhash.keep_one(empty).collect() == []


def test_links_between_crowded_prints(spark):
    """Prints a few bits apart, far more than a node holds: exact components."""
    rng = np.random.default_rng(0)
    centers = rng.integers(0, 1 << 62, 6)
    prints = {int(c) ^ (1 << int(a)) ^ (1 << int(b)) for c in centers for a, b in rng.integers(0, 40, (60, 2))}
    rows = [(i, p) for i, p in enumerate(sorted(prints))]
    frame = spark.createDataFrame([(d, p) for d, p in rows], "doc_id long, fp long")
    answer = {r["fp"]: r["component_id"] for r in simhash._answer(frame, 2, node_rows=4).collect()}
    assert [answer[p] for _, p in rows] == brute_groups(rows)


def test_chains_reach_their_smallest_end(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, 60), (101, 100), (101, 61)]
    got = {r["node"]: r["component"] for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 60: 60, 61: 60, 100: 60, 101: 60}


def test_keep_one_of_each_group(docs):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    rows = [(r["doc_id"], brute_print(r["text"])) for r in docs.collect()]
    groups = {(c, None if c is not None else p) for (_, p), c in zip(rows, brute_groups(rows))}
    found = kept.collect()
    assert len(found) == len(groups)
    assert {r["doc_id"] for r in found if r["doc_id"] is not None} == {c for c, _ in groups if c is not None}


def test_gray_rank_orders_neighbours(spark):
    """Consecutive ranks differ in one bit."""
    codes = [i ^ (i >> 1) for i in range(64)]
    rows = spark.createDataFrame([(c,) for c in codes], "fp long").select("fp", simhash.gray_rank(F.col("fp")).alias("r")).collect()
    assert [r["fp"] for r in sorted(rows, key=lambda r: r["r"])] == codes


# ------------------------------------------------------------------- I-Match

def plain_terms(text, lexicon):
    found = set(re.findall(r"\w+", text.lower()))
    return sorted(found & lexicon) or sorted(found)


def plain_fingerprint(text, lexicon):
    """The definition, subset by subset, in Python integers."""
    words = plain_terms(text, lexicon)
    if not words:
        return "0" * 4 * 69
    code = {w: xxhash.xxh64_intdigest(w, 7) for w in words}

    def signature(held):
        return xxhash.xxh64_intdigest(b"".join(code[w].to_bytes(8, "little") for w in held), 7)

    def subset(i, share):
        times = xxhash.xxh64_intdigest(f"subset {i}", 7) | 1
        return [w for w in words if code[w] * times % 2 ** 64 < 2 ** 64 // 4 ** share]

    share = 1
    while share < 6 and sum(bool(subset(i, share)) for i in range(32)) > 24:
        share += 1
    parts = [max(1, signature(held) >> 48) if held else 0 for s in (share, share + 1) for held in (subset(i, s) for i in range(32))]
    return f"{signature(words):016x}{share:04x}" + "".join(f"{v:04x}" for v in parts)


def plain_likeness(a, b):
    """From the texts of two fingerprints."""
    if a[:16] == b[:16]:
        return 1.0
    parts = [{int(f[16:20], 16) + k: [f[20 + 4 * i:24 + 4 * i] for i in range(32 * k, 32 * k + 32)] for k in (0, 1)} for f in (a, b)]
    answer = 0.0
    for share in sorted(parts[0].keys() & parts[1].keys()):
        pairs = [(x, y) for x, y in zip(parts[0][share], parts[1][share]) if (x, y) != ("0000", "0000")]
        answer = sum(x == y for x, y in pairs) / max(1, len(pairs))
        if len(pairs) <= 24:
            return answer
    return answer


def check_edits(docs, **options):
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is None, r[0] or 0))
    out = imatch.edit_digests(docs, **options).collect()
    assert len(out) == len(rows)
    texts = {}
    for d, t in rows:
        texts.setdefault(d, []).append(t)
    df = {}
    for _, t in rows:
        for w in set(re.findall(r"\w+", t.lower())):
            df[w] = df.get(w, 0) + 1
    lexicon = {w for w, n in df.items() if 0.001 * len(rows) <= n <= 0.15 * len(rows)}
    prints = {t: plain_fingerprint(t, lexicon) for _, t in rows}
    for r in out:
        made = [t for t in texts[r["doc_id"]] if len(t) == r["n_chars"] and prints[t] == r["fingerprint"]]
        assert made
        assert 0.0 <= r["near_edited"] <= 1.0 and 0.0 <= r["near_next"] <= 1.0
    unique = [i for i, (d, _) in enumerate(rows) if len(texts[d]) == 1 and len(texts[rows[(i + 1) % len(rows)][0]]) == 1]
    by_id = {r["doc_id"]: r for r in out}
    for i in unique:
        d, t = rows[i]
        after = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        new = t[:len(t) - half] + after[:half]
        r = by_id[d]
        assert r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert r["edited_fingerprint"] == plain_fingerprint(new, lexicon)
        assert r["near_edited"] == plain_likeness(prints[t], r["edited_fingerprint"])
        assert r["near_next"] == plain_likeness(prints[t], prints[after])


def test_edits_of_awkward_rows(docs):
    check_edits(docs)


@pytest.mark.parametrize("range_docs", [7, 100_000])
def test_edits_over_ranges(sf_docs, range_docs):
    check_edits(sf_docs.repartition(3), range_docs=range_docs)


def test_edits_of_few_rows(spark, empty):
    assert imatch.edit_digests(empty).collect() == []
    one = spark.createDataFrame([(3, "abcdef")], "doc_id long, text string")
    assert imatch.edit_digests(one).first()["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest()


def test_document_frequencies(sf_docs):
    got = {r["term"]: r["df"] for r in imatch.document_frequencies(sf_docs).collect()}
    expected = {}
    for r in sf_docs.collect():
        for w in imatch.terms(r["text"] or ""):
            expected[w] = expected.get(w, 0) + 1
    assert got == expected


def test_likeness_follows_shared_text(sf_docs):
    out = imatch.edit_digests(sf_docs).toPandas()
    assert out.near_edited.mean() > 0.2 > 0.1 > out.near_next.mean()
    copies = out.groupby("fingerprint").size()
    assert (copies > 1).any()                                   # exact copies agree


# -------------------------------------------------------------- nearest vectors

def exact_top(rows, query_id, query, k):
    scored = []
    for vec_id, x in rows:
        if vec_id != query_id:
            total = 0.0
            for a, b in zip(x, query):
                total += a * b
            scored.append((-total, vec_id))
    return [(v, -s) for s, v in sorted(scored)[:k]]


def usable(rows):
    best = {}
    for vec_id, x in rows:
        if vec_id is not None and x and len(x) == 6 and all(v is not None and np.isfinite(v) for v in x) and any(x):
            best[vec_id] = min(best.get(vec_id, x), x)
    return sorted(best.items())


def awkward_vectors():
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).round(2).tolist()) for i in range(90)]
    rows += [(100, None), (101, []), (102, [0.0] * 6), (103, [1.0, None, 1, 1, 1, 1]), (104, [float("nan")] * 6),
             (105, [float("inf"), 0, 0, 0, 0, 0]), (None, [1.0] * 6), (120, [1.0, 2.0])]
    rows += [(i, [0.5, 0.5, 0.0, 0.0, 0.0, 0.5]) for i in range(200, 260)]         # many equal vectors
    rows += [rows[20], (40, [9.0] * 6)]                                             # a repeated row, a repeated id
    return [(a, None if b is None else [None if v is None else float(v) for v in b]) for a, b in rows]


def test_search_equals_brute_force_when_all_is_visited(spark):
    rows = awkward_vectors()
    frame = spark.createDataFrame([(a, b, 1) for a, b in rows], "vec_id long, embedding array<double>, rank int")
    got = multi_index.search(frame, F.col("vec_id") % 20 == 0, k=7, block=16, visit=1.0).collect()
    good = usable(rows)
    by_query = {}
    for r in got:
        by_query.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert by_query.keys() == {i for i, _ in good if i % 20 == 0}
    for i, x in good:
        if i % 20 == 0:
            assert [(v, s) for _, v, s in sorted(by_query[i])] == exact_top(good, i, x, 7)
            assert [r for r, _, _ in sorted(by_query[i])] == list(range(1, 8))


def test_search_of_few_vectors(spark):
    shape = "vec_id long, embedding array<double>"
    assert multi_index.search(spark.createDataFrame([], shape), F.col("vec_id") % 20 == 0).collect() == []
    two = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 1.0])], shape)
    assert [tuple(r) for r in multi_index.search(two, F.col("vec_id") % 20 == 0).collect()] == [(0, 1, 1, 5.0)]
    line = spark.createDataFrame([(0, [2.0]), (1, [3.0])], shape)
    assert [tuple(r) for r in multi_index.search(line, F.col("vec_id") % 20 == 0).collect()] == [(0, 1, 1, 6.0)]


def test_recall_where_cells_are_skipped(spark):
    """Unstructured vectors, the hard case, with the production share of visits."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(6000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = multi_index.search(frame, F.col("vec_id") % 100 == 0, k=10, least=100, block=1000).collect()
    hit = 0
    for q in range(0, 6000, 100):
        s = x @ x[q]
        s[q] = -9
        hit += len(set(np.argsort(-s)[:10].tolist()) & {r["vec_id"] for r in got if r["query_id"] == q})
    assert hit >= 0.9 * 600


@pytest.mark.parametrize("spread", [0.05, None])
def test_recall_with_production_parameters(spark, spread):
    """k = 20 and every default, on vectors in groups and on vectors without
    structure; groups need few cells."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 16)) if spread is None else rng.normal(size=(60, 16))[rng.integers(0, 60, 3000)] + spread * rng.normal(size=(3000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = multi_index.search(frame, F.col("vec_id") % 20 == 0).collect()
    assert len(got) == 150 * 20
    hit = 0
    for q in range(0, 3000, 20):
        s = x @ x[q]
        s[q] = -9
        hit += len(set(np.argsort(-s)[:20].tolist()) & {r["vec_id"] for r in got if r["query_id"] == q})
    assert hit >= 0.94 * 3000


def test_entries_needed_are_those_of_the_walk():
    rng = np.random.default_rng(5)
    a, b, counts = rng.normal(size=6), rng.normal(size=8), rng.integers(0, 4, 48)
    for cell in np.flatnonzero(counts):
        needed = int(multi_index.entries_needed(a, b, counts, np.array([cell]))[0])
        assert cell in multi_index.walk(a, b, counts.tolist(), needed)
        assert cell not in multi_index.walk(a, b, counts.tolist(), needed - int(counts[cell]))


def test_cells_of_a_block():
    counts = np.random.default_rng(6).integers(0, 9, 60) * np.where(np.arange(60) == 31, 20, 1)
    layout = multi_index.Layout(counts, 12)
    for block in range(layout.blocks):
        expected = [c for c in range(60) if counts[c] and layout.first[c] <= block < layout.first[c] + layout.spread[c]]
        assert layout.cells_of(block).tolist() == expected


def test_walk_visits_cells_by_summed_distance():
    rng = np.random.default_rng(3)
    a, b, counts = rng.normal(size=5), rng.normal(size=7), rng.integers(0, 4, 35)
    cells = multi_index.walk(a, b, counts.tolist(), 10 ** 9)
    sums = (a[:, None] + b).ravel()
    assert sorted(cells) == np.flatnonzero(counts).tolist()
    assert [sums[c] for c in cells] == sorted((sums[c] for c in cells), reverse=True)
