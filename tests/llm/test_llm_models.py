"""Learned operators: trees over pages, language chains, the toxicity model."""

import html
import itertools
import os
import re
import zlib

import numpy as np
import pytest
from llm_fixtures import WORDS, sentence
from pyspark.sql import functions as F

from eventide.llm import crf, ftrl, html_extract as H
from eventide.llm.tokens import BpeEncoder, vocabulary

SF = "/root/testdata/sf0.01"


def need(path):
    if not os.path.isdir(path):
        pytest.skip("driver test data not present")


# ------------------------------------------------------------------- HTML pages

@pytest.fixture(scope="module")
def extractor(spark):
    need(SF)
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    return pages, H.train(pages)


def marked_article(page):
    body = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
    body = re.sub(r"</?(p|h1|br)>", " ", body)
    return " ".join(html.unescape(re.sub(r"</?b>", "", body)).split())


def test_articles_of_the_table(extractor):
    pages, model = extractor
    got = {r["page_id"]: r for r in H.extract(pages, model).collect()}
    for r in pages.collect():
        assert got[r["page_id"]]["text"] == marked_article(r["html"])
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"]) and got[r["page_id"]]["url"] == r["url"]


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1><a href="/">Home</a></header>
<div class="cookie-consent">We use cookies. <button>OK</button></div>%s<form action="/s"><label>Search</label><input></form>
<footer>(c) 2020</footer><script>var a = "<p>no</p>";</script></body></html>"""
ARTICLE = ("<h1>My title</h1><p>First paragraph of text, long enough to matter for everyone.</p>"
           "<p>Second&nbsp;paragraph &amp; more text; it goes on and on, as text does.</p>")
TEXT = ("My title First paragraph of text, long enough to matter for everyone. "
        "Second paragraph & more text; it goes on and on, as text does.")
COMMENTS = '<section id="comments"><h3>Comments</h3><div class="comment"><p>I love this article very much, thanks a lot.</p></div></section>'
ASIDE = '<aside class="sidebar"><ul><li><a href="/a">Related one</a></li><li><a href="/b">Related two</a></li></ul></aside>'


@pytest.mark.parametrize("body", [
    f"<article>{ARTICLE}</article>", f"<main>{ARTICLE}</main>{COMMENTS}", f'<div id="content">{ARTICLE}</div>{ASIDE}',
    f"<article>{ARTICLE}{ASIDE}</article>", f'<main><div class="post">{ARTICLE}<div class="share"><a href="#">Share</a></div></div>{COMMENTS}</main>',
    f"<article>{ARTICLE.replace('</p>', '')}", f"<nav><ul><li><a href='/x'>X</a><li><a href='/y'>Y</a></ul></nav><article>{ARTICLE}</article>",
])
def test_page_shapes_outside_the_table(extractor, body):
    assert H.Extractor.from_bytes(extractor[1]).texts([PAGE % body]) == [TEXT]


def test_every_name_part_counts():
    utilities = " ".join(f"{a}-{b}" for a in ("flex", "grid", "block", "hidden") for b in ("wide", "tall", "small", "round"))
    page = H.Page(f'<div class="{utilities} flex-wide" id="footer">x</div>')
    assert page.names[1] == ("flex", "wide", "tall", "small", "round", "grid", "block", "hidden", "footer")
    page = H.Page('<div class="one two three four five six seven eight nine ten eleven twelve thirteen" id="comments">x</div>')
    assert page.names[1][-2:] == ("thirteen", "comment") and len(page.names[1]) == 14


@pytest.mark.parametrize("opened", ["<b>", "<font>", "<div>"])
def test_blocks_below_many_open_elements_are_nodes(opened):
    page = H.Page(opened * 3000 + "<article>main</article><footer>end</footer>")
    keep = np.ones(len(page.tag), bool)
    keep[page.tag.index("footer")] = False
    assert page.text_of(keep) == "main"


def test_awkward_pages(spark, extractor):
    rows = [(1, "u", None, 5), (2, None, "", 5), (None, "u", PAGE % f"<article>{ARTICLE}</article>", 5), (3, "u", "<", 5),
            (4, "u", "<p", 5), (5, "u", "<!-- open", 5), (6, "u", "<script>x", 5), (7, "u", "<div>" * 5000 + "deep", 5),
            (8, "u", PAGE % "<article><p>" + "long text, very long. " * 40_000, 5), (9, "u", "<a href='x\">", 5),
            (10, "u", "&amp;&bogus;&#65;", 5), (10, "u", "&amp;&bogus;&#65;", 5)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    got = H.extract(frame, extractor[1]).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    assert by[1]["text"] == "" and by[2]["text"] == "" and by[2]["url"] is None and by[None]["text"] == TEXT
    assert by[5]["text"] == by[6]["text"] == "" and by[8]["n_chars"] > 800_000
    assert H.extract(frame.limit(0), extractor[1]).collect() == []
    assert H.train(frame.limit(0))                          # trains on the fixed texts


def test_decoding_is_the_best_consistent_labelling():
    rng = np.random.default_rng(0)
    for _ in range(40):
        page = H.Page("")
        page.parent = [-1] + [int(rng.integers(i)) for i in range(1, 9)]
        odds = rng.normal(0, 2, 9)
        best = max((x for x in itertools.product([0, 1], repeat=9) if all(not x[i] or x[page.parent[i]] for i in range(1, 9))),
                   key=lambda x: float(np.dot(x, odds)))
        assert H.decode(page, odds).astype(int).tolist() == list(best)


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    assert ((H.Boosted.fit(x, y).log_odds(x) > 0) == y).mean() > 0.97


# -------------------------------------------------------------------- languages

def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(0)
    emission, transition = rng.normal(size=(9, 3)), rng.normal(size=(3, 3))
    starts, sizes = np.array([0, 4, 5]), np.array([4, 1, 4])
    marginal, expected, log_z = crf.forward_backward(emission, transition, starts, sizes, pairs=True)
    total_z, pair = 0.0, np.zeros((3, 3))
    for s, n in zip(starts, sizes):
        paths = list(itertools.product(range(3), repeat=int(n)))
        score = np.array([sum(emission[s + t, p[t]] for t in range(n)) + sum(transition[p[t], p[t + 1]] for t in range(n - 1)) for p in paths])
        weight = np.exp(score)
        total_z += np.log(weight.sum())
        weight /= weight.sum()
        for t in range(n):
            for k in range(3):
                assert abs(marginal[s + t, k] - sum(w for w, p in zip(weight, paths) if p[t] == k)) < 1e-9
        for w, p in zip(weight, paths):
            for t in range(n - 1):
                pair[p[t], p[t + 1]] += w
    assert np.allclose(pair, expected) and abs(total_z - log_z) < 1e-9


def test_chain_bounds():
    starts, sizes = crf.chain_bounds(np.array([1, 0, 0, 0, 1, 1, 0, 0, 0, 0, 0], bool), limit=2)
    assert list(zip(starts.tolist(), sizes.tolist())) == [(1, 2), (3, 1), (6, 2), (8, 2), (10, 1)]


def test_words_of_a_switching_line():
    import random
    rng = random.Random(0)
    examples = [(sentence(lang, 60, rng) + "\n" + sentence(lang, 30, rng), lang) for _ in range(40) for lang in WORDS]
    model = crf.fit(examples).to_bytes()
    labelled = crf.label_words("the of was from der nicht und auf his have but", model)
    assert [lang for _, lang, _ in labelled] == ["en"] * 4 + ["de"] * 4 + ["en"] * 3
    assert all(0.5 < p <= 1 for _, _, p in labelled)


def test_languages_of_awkward_rows(spark, docs, empty):
    model = crf.train(docs, F.lit(True))
    got = crf.held_out(crf.predict(docs, model)).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r for r in got}
    assert [by[i]["lang_pred"] for i in (12, 13, 14)] == ["und"] * 3
    assert by[0]["lang_pred"] == "de" and by[20]["lang_pred"] == "en"
    for r in got:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
    assert crf.predict(empty, model).collect() == []
    assert {r["lang_pred"] for r in crf.predict(docs, crf.train(empty, F.lit(True))).collect()} == {"und"}


def test_held_out_languages(spark):
    need(SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = crf.held_out(crf.predict(docs, crf.train(docs, crf.fold() != 1))).join(docs.select("doc_id", "lang"), "doc_id")
    rows = got.filter("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows) > 100


# --------------------------------------------------------------------- toxicity

def test_features_do_not_depend_on_pieces(monkeypatch):
    text = "One, two: three-four FIVE six, seven. eight " * 30
    whole = ftrl.features(text)
    monkeypatch.setattr(ftrl, "PIECE_WORDS", 7)
    assert ftrl.features(text).tolist() == whole.tolist()
    assert ftrl.features("").tolist() == [] and ftrl.features("!? ...").tolist() == []


def test_memos_of_a_worker_stay_small():
    """Many distinct words must not fill a worker's memory (hashes and token ids)."""
    import tracemalloc

    words = [f"w{i:x}q" for i in range(300_000)]
    bpe = BpeEncoder(vocabulary())
    tracemalloc.start()
    for at in range(0, len(words), 20_000):
        ftrl.features(" ".join(words[at:at + 20_000]))
    hashes = tracemalloc.get_traced_memory()[0]
    for at in range(0, len(words), 20_000):
        bpe.ids(" ".join(words[at:at + 20_000]))
    both = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert hashes < 40 << 20
    assert both - hashes < 40 << 20


def test_ftrl_is_sparse_and_learns():
    rng = np.random.default_rng(0)
    model = ftrl.Ftrl()
    for _ in range(2000):
        places = np.unique(np.append(rng.integers(0, 5000, 30), 1 << ftrl.DIM_BITS))
        label = int(rng.random() < 0.3)
        if label:
            places = np.unique(np.append(places, 9000 + rng.integers(3)))
        model.learn(places, label)
    w = model.weights(slice(None))
    assert (w[9000:9003] > 0.5).all() and (w[:5000] == 0).mean() > 0.5


def test_toxicity_of_awkward_rows(spark, docs, empty):
    labels = spark.createDataFrame([(i, i % 2, int(i in (2, 4, 6))) for i in range(12)] + [(1, 0, None), (None, 0, 1), (2, 0, 0), (999, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    model = ftrl.train(docs, labels, F.lit(True))
    got = ftrl.held_out(ftrl.score(docs, model)).collect()
    assert len(got) == docs.count()
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add(r["score"])
    assert len(by[12] | by[13] | by[14]) == 1               # no word: the bias alone
    kept = ftrl.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r["score"] < 0.5 for r in got)
    assert ftrl.score(empty, model).collect() == [] and ftrl.drop_toxic(empty, model).collect() == []
    none = ftrl.train(docs, labels.limit(0), F.lit(True))
    assert {r["score"] for r in ftrl.score(docs, none).collect()} == {0.0}


def test_held_out_toxicity(spark):
    path = "/root/testdata/sf0.1"
    need(path)
    docs, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    model = ftrl.train(docs, labels, ftrl.fold() != 0)
    rows = ftrl.held_out(ftrl.score(docs, model)).join(labels, "doc_id").filter("held_out").collect()
    toxic = [r["predicted"] for r in rows if r["toxic"]]
    clean = [r["predicted"] for r in rows if not r["toxic"]]
    # Some rows here are labelled toxic without a telling word, and the reverse.
    assert sum(toxic) >= 0.8 * len(toxic) and sum(clean) <= 0.01 * len(clean)
    assert len(model[0]) < 5_000                            # few weights are left
