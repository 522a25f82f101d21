"""Mixing, pseudonyms and the pipeline."""

import os
import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from eventide.llm import mixing, pii

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# -------------------------------------------------------------------- mixing

def brute_quotas(votes, seats):
    """One seat at a time to the highest quotient."""
    won = [0] * len(votes)
    for _ in range(seats if sum(votes) > 0 else 0):
        best = max(range(len(votes)), key=lambda i: (votes[i] / (2 * won[i] + 1), -i))
        won[best] += 1
    return won


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 50), st.floats(0.1, 9e3)), min_size=1, max_size=9), st.integers(0, 120))
def test_quotas_are_highest_quotients(votes, seats):
    got = mixing.sainte_lague(np.array(votes, float), seats).tolist()
    expected = brute_quotas(votes, seats)
    assert sum(got) == (seats if sum(votes) > 0 else 0)
    if got != expected:                                     # equal quotients may go to either party
        last = lambda won: sorted(v / (2 * w - 1) for v, w in zip(votes, won) if w)
        assert np.allclose(last(got)[:1], last(expected)[:1], rtol=1e-9)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 10_000), min_size=1, max_size=12))
def test_targets_fill_to_the_cap(sizes):
    weights = [float(i % 3 + 1) for i in range(len(sizes))]
    got = mixing.targets(sizes, weights)
    assert abs(sum(got) - sum(sizes)) < 1e-6 * max(1, sum(sizes))
    assert all(g <= 3 * s + 1e-9 for g, s in zip(got, sizes))
    open_ = [g / w for g, s, w in zip(got, sizes, weights) if g < 3 * s - 1e-9]
    assert not open_ or max(open_) - min(open_) < 1e-6 * max(open_)
    level = open_[0] if open_ else 0
    assert all(g <= level * w + 1e-6 * max(1, g) for g, w in zip(got, weights)) or not open_


def check_mix(docs, **options):
    rows = docs.collect()
    out = [tuple(r) for r in mixing.mixed_sizes(docs, **options).collect()]
    assert out and sorted(out, key=str) == sorted((tuple(r) for r in mixing.mixed_sizes(docs, **options).collect()), key=str)
    sizes, ids = defaultdict(int), defaultdict(list)
    for r in rows:
        sizes[r["source"]] += len(words(r["text"]))
        ids[r["doc_id"]].append((len(words(r["text"])), r["source"]))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    aims = dict(zip(names, mixing.targets([sizes[s] for s in names], [i % 3 + 1.0 for i in range(len(names))])))
    taken = defaultdict(int)
    for doc_id, size, source_size, target, take in out:
        source = next(s for n, s in ids[doc_id] if n == size and sizes[s] == source_size and abs(aims[s] - target) < 1e-6)
        assert 0 <= take <= 3 * size
        taken[source] += take
    for s in names:
        assert abs(taken[s] - aims[s]) <= mixing.BLOCK_WORDS
    assert len(out) == len(rows)


def test_mix_of_awkward_rows(docs):
    check_mix(docs)


def test_mix_over_shards(sf_docs):
    check_mix(sf_docs)
    check_mix(sf_docs, shard_docs=3)


def test_rows_of_one_doc_id_spread_over_shards(spark):
    # Two thirds of the rows have a null or the same doc_id; their texts deal them.
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text {i} " + "w " * (i % 5), "a" if i % 4 else "b") for i in range(1200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = lambda: sorted((r["text"], r["source"], r["ev_taken"]) for r in mixing.mix(frame, shard_docs=40).collect())
    shards = mixing.mix(frame, shard_docs=40).groupBy("source", "ev_shard").count().collect()
    assert len(shards) > 25 and max(r["count"] for r in shards) < 100
    assert taken() == taken()
    check_mix(frame, shard_docs=40)


def test_mixed_documents_hold_the_words_taken(docs, sf_docs):
    for frame in (docs, sf_docs):
        out = mixing.mixed_documents(frame)
        assert out.columns == frame.columns
        taken, held = defaultdict(int), defaultdict(int)
        for r in mixing.mixed_sizes(frame).collect():
            taken[r["doc_id"]] += r["taken"]
        whole = defaultdict(list)
        for r in frame.collect():
            whole[r["doc_id"]].append(r["text"])
        for r in out.collect():
            held[r["doc_id"]] += len(words(r["text"]))
            assert any(r["text"] == t or " ".join(words(r["text"])) in " ".join(words(t)) for t in whole[r["doc_id"]])
            assert r["n_chars"] == len(r["text"])
        assert {k: v for k, v in taken.items() if v} == held


def test_mix_of_nothing(empty):
    assert mixing.mixed_sizes(empty).collect() == [] and mixing.mixed_documents(empty).collect() == []


# ---------------------------------------------------------------- pseudonyms

VALUES = ["4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1111", "371449635398431", "9807915762804495", "123-45-6789",
          "1980-02-29", "03/04/1999", "3/4/1999", "31.12.2001", "10.0.0.1", "255.255.255.255", "A.b-9@x.org", "und.34@mail7.example.com",
          "+44 20 7946 0958", "+1 (017) 555-7713", "(212) 555-0199", "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000",
          "b44e15e09fd311c3cf3163b66d5a9875b883d8ce"]
LEFT = ["2023-02-30", "31/02/2001", "GB82 WEST 1234 5698 7654 33", "999.999.999.999", "1.2.3", "v10.2", "12345", "a@b", "user@", "12:30:45"]


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def mod97(iban):
    flat = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in flat[4:] + flat[:4])) % 97


@pytest.fixture(scope="module")
def replaced(spark):
    rows = [(i, f"see {v}, or {v}.") for i, v in enumerate(VALUES + LEFT)]
    got = {r["doc_id"]: r for r in pii.report(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    return {v: got[i] for i, v in enumerate(VALUES + LEFT)}


def inner(text):
    return re.fullmatch(r"see (.*), or (.*)\.", text).groups()


@pytest.mark.parametrize("value", VALUES)
def test_value_is_replaced_in_its_format(replaced, value):
    first, second = inner(replaced[value]["text"])
    assert first == second != value and replaced[value]["n_replaced"] == 2
    shape = lambda s: re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub(r"\d", "9", s)))
    if "." not in value or "@" in value or value.count(".") == 2:
        if value != "3/4/1999" and not re.fullmatch("[0-9a-f]{32,}", value):
            assert shape(first) == shape(value)
    if value in VALUES[:4]:
        assert luhn(re.sub(r"\D", "", first))
    if value[:2] in ("GB", "DE"):
        assert first[:2] == value[:2] and mod97(first) == 1
    if re.fullmatch("[0-9a-f]{32,}", value):
        assert re.fullmatch("[0-9a-f]{40}", first)


@pytest.mark.parametrize("value", LEFT)
def test_invalid_values_stay(replaced, value):
    assert inner(replaced[value]["text"]) == (value, value) and replaced[value]["n_replaced"] == 0


def test_equal_cards_stay_linked_over_layouts(replaced):
    digits = {re.sub(r"\D", "", inner(replaced[v]["text"])[0]) for v in VALUES[:3]}
    assert len(digits) == 1


def reported(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return [(r["text"], r["n_replaced"]) for r in sorted(pii.report(rows).collect(), key=lambda r: r["doc_id"])]


def test_digit_runs_that_are_no_card_stay(spark):
    # Epoch milliseconds and microseconds, ISBN-13, EAN-13, numbers of 15 and 16 digits, tracking
    # numbers of 18 and 19, years and other numbers in the layouts of cards.
    runs = ["1700000000123", "1700000000123457", "9783161484100", "4006381333931", "123456789012345", "1234567890123456",
            "123456789012345678", "9999999999999999990", "9807915762804490", "2001-2002-2003-2004", "4111 1111 1111 1112",
            "3714-496353-98432"]
    assert not any(luhn(re.sub("[ -]", "", v)) for v in runs)
    assert reported(spark, [f"at {v}, {v}." for v in runs]) == [(f"at {v}, {v}.", 0) for v in runs]


def test_digit_runs_that_are_cards_go(spark):
    values = ["4222222222222", "371449635398431", "3714-496353-98431", "6304000000000000000", "4111 1111 1111 1111", "9807915762804495"]
    assert all(luhn(re.sub("[ -]", "", v)) for v in values)
    for value, (text, n) in zip(values, reported(spark, [f"at {v}." for v in values]), strict=True):
        assert n == 1 and value not in text and re.sub(r"\d", "9", text) == re.sub(r"\d", "9", f"at {value}.")
        assert luhn(re.sub(r"\D", "", text))


def test_versions_are_no_addresses(spark):
    stay = ["ver 1.2.3.4", "Ver. 1.2.3.4", "version 10.0.0.1", "v1.2.3.4", "build_1.2.3.4", "1.2.3.4.5"]
    assert reported(spark, stay) == [(t, 0) for t in stay]
    assert all(n == 1 and "10.0.0.1" not in text for text, n in reported(spark, ["at 10.0.0.1", "server 10.0.0.1:80", "10.0.0.1"]))


def test_key_of_the_session(spark):
    docs = spark.createDataFrame([(1, "card 4111111111111111")], "doc_id int, text string")
    told = lambda **key: pii.report(docs, **key).first()["text"]
    public = told()
    assert public == told(key=pii.KEY) != told(key="other")
    spark.conf.set(pii.KEY_SETTING, "other")
    try:
        assert told() == told(key="other")
    finally:
        spark.conf.unset(pii.KEY_SETTING)
    assert told() == public


IBANS = ["ES91 2100 0418 4502 0005 1332", "ES9121000418450200051332", "AT611904300234573201", "AT61 1904 3002 3457 3201",
         "SE45 5000 0000 0583 9825 7466", "PL61109010140000071219812874", "CZ65 0800 0000 1920 0014 5399", "BE68 5390 0754 7034",
         "NO93 8601 1117 947", "GB82 WEST 1234 5698 7654 32", "FR14 2004 1010 0505 0001 3M02 606", "MT84MALT011000012345MTLCAST001S"]


def test_ibans_go_before_any_word(spark):
    assert all(mod97(v) == 1 for v in IBANS)
    cases = [(v, after) for v in IBANS for after in (" EUR", " BIC", " NOW", " 1234", " 12 EUR", ".", "")]
    for (value, after), (text, n) in zip(cases, reported(spark, [f"to {v}{a}" for v, a in cases]), strict=True):
        made = text[3:len(text) - len(after)]
        assert n == 1 and made != value and mod97(made) == 1 and made[:2] == value[:2] and text.endswith(after), (value, after)
        assert [c == " " for c in made] == [c == " " for c in value]


def test_a_card_after_an_iban_goes_as_well(spark):
    (text, n), = reported(spark, ["BE68 5390 0754 7034 4111 1111 1111 1111"])
    assert n == 2 and "4111 1111 1111 1111" not in text


PHONES = ["+33 6 12 34 56 78", "+45 12 34 56 78", "+33.6.12.34.56.78", "+47 22 12 34 56", "+49 30 12 34 56 78", "+41 44 668 18 00",
          "+7 495 123-45-67", "+48 22 123 45 67", "+46 8 123 456 78", "+44 20 7946 0958", "+45 1234 5678"]


@pytest.mark.parametrize("after", ["", " or 3 more", ", 12", " 190.137.223.204", " 37.92.178.161", " 12:30", " x 4111 1111 1111 1111"])
def test_phones_in_groups_of_two_go(spark, after):
    for value, (text, n) in zip(PHONES, reported(spark, [f"call {v}{after}" for v in PHONES]), strict=True):
        code = re.match(r"\+\d+", value)[0]
        assert text.startswith(f"call {code}") and value not in text and n == 1 + any(x in after for x in (".1", "4111")), (value, text)
        assert re.sub(r"\d", "9", text[:5 + len(value)]) == re.sub(r"\d", "9", f"call {value}")
        if n == 1:
            assert text.endswith(after)


def test_signed_numbers_are_no_phones(spark):
    texts = ["from +12 34 to +5", "+1 2 3", "a+33 6 12 34 56 78", "1+45 12 34 56 78", "+12.5 and +33 6 12"]
    assert reported(spark, texts) == [(t, 0) for t in texts]


def feistel(value, key, kind, hexadecimal=False):
    """The network in plain Python."""
    import hashlib
    left, right = value[:len(value) // 2], value[len(value) // 2:]
    for k in range(1, pii.ROUNDS + 1):
        made = ""
        for i, c in enumerate(left, 1):
            by = int(hashlib.sha256("|".join([key, f"{kind}{k}", str(i), right]).encode()).hexdigest()[:12], 16)
            for base, size in (("0", 10), ("a", 6 if hexadecimal else 26), ("A", 6 if hexadecimal else 26)):
                if base <= c <= chr(ord(base) + (9 if size == 10 else 25)):
                    c = chr(ord(base) + (ord(c) - ord(base) + by) % size)
                    break
            made += c
        left, right = right, made
    return left + right


@pytest.mark.parametrize("value", ["0", "42", "123456789", "ab.C9-z", "0123456789abcdef"])
def test_network_equals_plain_python(spark, value):
    hexadecimal = value == "0123456789abcdef"
    sql = pii.feistel_text("v", "k", "t", hexadecimal)
    got = spark.createDataFrame([(value,)], "v string").select(F.expr(sql)).first()[0]
    assert got == feistel(value, "k", "t", hexadecimal)


def test_networks_are_permutations(spark):
    codes = spark.range(10_000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("v"))
    assert codes.select(F.expr(pii.feistel_text("v", "k", "t")).alias("p")).distinct().count() == 10_000
    days = spark.range(pii.DAY_ROWS * pii.DAY_COLS).select(
        F.expr(pii.feistel_pair(f"cast(id / {pii.DAY_COLS} as int)", f"id % {pii.DAY_COLS}", pii.DAY_ROWS, pii.DAY_COLS, "k", "d")).alias("p"))
    assert days.distinct().count() == pii.DAY_ROWS * pii.DAY_COLS


def test_pseudonyms_of_awkward_rows(docs, empty):
    out = pii.pseudonymised(docs)
    assert out.columns == docs.columns
    key = lambda r: str((r["doc_id"], r["text"], r["source"]))
    assert sorted(map(key, out.collect())) == sorted(map(key, docs.collect()))          # nothing private in them
    assert pii.report(empty).collect() == [] and pii.pseudonymised(empty).collect() == []


def test_long_texts_and_clean_texts(spark):
    card = "4111111111111111"
    long_ = ("word " * 50_000) + card + (" word" * 50_000)
    runs = "a" * 300_000 + " " + "1" * 300_000
    rows = spark.createDataFrame([(1, long_), (2, runs), (3, card * 2)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.report(rows).collect()}
    assert got[1]["n_replaced"] == 1 and card not in got[1]["text"] and len(got[1]["text"]) == len(long_)
    assert got[2]["text"] == runs


def test_no_python_runs_in_the_plan(sf_docs):
    plan = pii.report(sf_docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# ------------------------------------------------------------------ pipeline

@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_pipeline_stages(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in P.STAGES]
    assert names == ["toxicity", "near_dedup", "pii", "mixing", "packing"]
    frame = docs
    for name, stage in P.STAGES[:-1]:
        frame = stage(spark, frame, SF)
        assert frame.columns == docs.columns and frame.dtypes == docs.dtypes, name
    assert E.queries()["pipeline"](spark, SF).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_pipeline_of_nothing(spark, tmp_path):
    import corpus_pipeline as P

    for name in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []


def test_registered_operators():
    names = E.queries()
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
