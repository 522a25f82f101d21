"""Fill-in-the-middle against a plain slicing version."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eventide.llm import fim

sha = lambda text: hashlib.sha256(text.encode()).hexdigest()


def plain(doc_id, text, plain_from=90, spm_below=20):
    """(n, form, prefix, middle, output) by slices."""
    text = text or ""
    n = len(text)
    draw = sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(draw[i:i + 8], 16) for i in range(0, 32, 8))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= plain_from:
        return n, "plain", None, None, text
    if h4 % 100 < spm_below:
        return n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def expected(rows, **options):
    out = []
    for r in rows:
        n, form, pre, mid, output = plain(r["doc_id"], r["text"], **options)
        out.append((r["doc_id"], n, form, pre, mid, sha(output), sha(r["text"] or "")))
    return Counter(out)


def test_edge_rows(spark, docs):
    assert Counter(tuple(r) for r in fim.digests(docs).collect()) == expected(docs.collect())


def test_whole_table(spark, sf_docs):
    got = fim.digests(sf_docs).collect()
    assert Counter(map(tuple, got)) == expected(sf_docs.select("doc_id", "text").collect())
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_every_row_changed_comes_back(spark, docs):
    marked = docs.select("doc_id", "text").unionByName(spark.createDataFrame(
        [(100, "a <P> b"), (101, "<S>"), (102, "<<S> <"), (103, "<P"), (104, "<" * 50), (105, ">" * 50), (106, "\\E(.)*\n\r"),
         (107, "S>a<S"), (108, "x")], "doc_id long, text string"))
    for spm in (0, 100):
        out = fim.transform(marked, plain_from=101, spm_below=spm)
        got = out.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
        assert all(r["back"] == r["text"] for r in got)
        plain_ids = {r["doc_id"] for r in got if r["form"] == "plain"}
        assert {100, 101, 102} <= plain_ids and not {103, 104, 105, 106, 107, 108} & plain_ids
        assert Counter(map(tuple, fim.digests(marked, plain_from=101, spm_below=spm).collect())) == expected(
            marked.collect(), plain_from=101, spm_below=spm)


def test_other_units(spark):
    docs = spark.createDataFrame([(1, "e\u0301a\u0301o\u0301 u"), (2, "one two  three four"), (3, None)], "doc_id long, text string")
    by_word = {r["doc_id"]: r for r in fim.transform(docs, unit=r"\S+\s*", plain_from=101).collect()}
    assert (by_word[1]["n"], by_word[2]["n"], by_word[3]["n"]) == (2, 4, 0)
    assert by_word[2]["prefix_chars"] in (0, 4, 9, 15, 19)
    by_grapheme = {r["doc_id"]: r for r in fim.transform(docs, unit=r"\X", plain_from=101).collect()}
    assert by_grapheme[1]["n"] == 5 and by_grapheme[1]["prefix_chars"] in (0, 2, 4, 6, 7, 8)
    # A text that is no whole run of units is left as it is.
    assert {r["form"] for r in fim.transform(docs, unit=r"[0-9]", plain_from=101).collect()} == {"plain"}


def test_marks_that_could_be_mistaken(spark, docs):
    with pytest.raises(ValueError, match="mistaken"):
        fim.transform(docs, marks=("ab", "ba", "c"))


def test_very_long_text(spark):
    docs = spark.createDataFrame([(7, "\U0001f642\n" * 500_000)], "doc_id long, text string").repartition(1)
    got = fim.digests(docs).collect()[0]
    assert got["n"] == 1_000_000 and got["restored_sha256"] == sha("\U0001f642\n" * 500_000)


def test_empty_table(spark, empty):
    assert fim.digests(empty).collect() == []
