"""Memoised encoding, packing and Huffman files against plain versions."""

import random
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from eventide.llm import huffman, packing, tokens
from eventide.llm.tokens import BpeEncoder, vocabulary

PARTS = [" ", "  ", "\n", "\n\n", "\t", "a", "Word", ".", ",", "'s", "don't", "12", "é", "!!", "<|endoftext|>", "x\ny", "漢字",
         "\r\n", "...", "🙂", "\x85", "\x00", "\xa0", "Straße", "#", "3.5%"]


@pytest.fixture(scope="module")
def bpe():
    return BpeEncoder(vocabulary())


def plain_ids(bpe, text):
    return bpe.tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=12).map("".join))
def test_encoding_equals_whole_text(text):
    bpe = test_encoding_equals_whole_text.__dict__.setdefault("bpe", BpeEncoder(vocabulary()))
    assert bpe.ids(text).tolist() == plain_ids(bpe, text)


@pytest.fixture(scope="module")
def library():
    """A tokenizer as the library loads it, that the encoder has not touched."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


SPACES = ["\u1680", "\u180e", "\u2003", "\u200b", "\u2028", "\u3000", "\x0b", "\x1c"]
SIGNS = ["'", "'ll", "’", "×", "÷", "ß", "ж", "ª", "½", "²", "\u0300", "_", "-"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.none() | st.lists(st.sampled_from(PARTS + SPACES + SIGNS), max_size=8).map("".join), max_size=6))
def test_texts_encoded_together_equal_whole_texts(texts):
    bpe = test_encoding_equals_whole_text.__dict__.setdefault("bpe", BpeEncoder(vocabulary()))
    out = [part for _, ids, counts in bpe.batches(pa.array(texts, pa.string()), 2) for part in np.split(ids, np.cumsum(counts)[:-1])]
    assert [x.tolist() for x in out] == [[*plain_ids(bpe, text), 2] for text in texts]


@pytest.mark.parametrize("form", ["a@ b", "a @b", "a@.b", "@\n\nb 1@2", "'s@'s @'ll", "x  @  y"])
def test_cuts_around_every_letter_and_space(bpe, form):
    texts = [form.replace("@", chr(c)) for c in range(0x3001)]
    out = [part for _, ids, counts in bpe.batches(pa.array(texts), 2) for part in np.split(ids, np.cumsum(counts)[:-1])]
    whole = bpe.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [t for t, ids, w in zip(texts, out, whole, strict=True) if ids.tolist() != [*w.ids, 2]] == []


def letters(i):
    return "".join(chr(97 + int(d)) for d in f"{i:06d}")


def test_frequent_words_stay_known_among_many_rare_ones(monkeypatch):
    """op8 and op10 spend their time on words the encoder has forgotten (finding of round 3)."""
    monkeypatch.setattr(tokens, "MEMO_PARTS", 2000)
    bpe, calls = BpeEncoder(vocabulary()), []

    class Counted:
        def tokenize(self, text, model=bpe.model):
            calls.append(text)
            return model.tokenize(text)

    bpe.model = Counted()
    common = " ".join("c" + letters(i) for i in range(500))
    texts = [f"{common}, " + ". ".join("r" + letters(400 * k + i) for i in range(400)) for k in range(50)]
    assert all(bpe.ids(t).tolist() == plain_ids(bpe, t) for t in texts)
    assert len(calls) < 1.1 * (500 + 50 * 400)


MARKED = ["<|endoftext|>", "x <|endoftext|> y", "a<|endoftext|>b", "one  <|endoftext|>\n\n<|endoftext|><|endoftext|> two.", "<|endoftext|", " <|endoftext|> "]


@pytest.mark.parametrize("text", MARKED)
def test_added_tokens_are_encoded_as_the_library_does(library, text):
    assert BpeEncoder(vocabulary()).ids(text).tolist() == library(text)
    assert text != MARKED[1] or library(text) == [87, 220, 50256, 331]


def test_files_and_windows_hold_the_ids_of_added_tokens(spark, library):
    texts = [*MARKED, "plain words"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    coded = {r["doc_id"]: r for r in huffman.round_trip(rows, vocabulary()).collect()}
    packed = {r["doc_id"]: r for r in packing.pack(rows, vocabulary()).collect()}
    at = 0
    for i, text in enumerate(texts):
        ids = library(text)
        assert (coded[i]["start"], coded[i]["n_tokens"], coded[i]["ids_crc32"]) == (at, len(ids) + 1, crc([*ids, huffman.END_ID]))
        assert (packed[i]["doc_tokens"], packed[i]["ids_crc32"]) == (len(ids) + 1, crc([*ids, packing.END_ID]))
        at += len(ids) + 1


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def keyed(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))


def test_packing_places_every_id_once(docs, bpe):
    rows = [tuple(r) for r in packing.pack(docs, vocabulary(), window=256, open_windows=3, min_piece=8).collect()]
    source = {}
    for r in docs.collect():
        source.setdefault(r["doc_id"], []).append(plain_ids(bpe, r["text"]) + [packing.END_ID])
    # Pieces of a document cover it, once for each row that has it.
    by_doc = {}
    for doc_id, start, length, check, total, _, _ in rows:
        by_doc.setdefault(doc_id, []).append((start, length, check, total))
    assert by_doc.keys() == source.keys()
    for doc_id, pieces in by_doc.items():
        assert sum(p[1] for p in pieces) == sum(map(len, source[doc_id]))
        for start, length, check, total in pieces:
            assert any(len(ids) == total and crc(ids[start:start + length]) == check for ids in source[doc_id])
    # Windows are gapless and never too long.
    windows = {}
    for _, _, length, _, _, window, offset in rows:
        windows.setdefault(window, []).append((offset, length))
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 256


def test_packing_merges_leftovers_over_levels(spark, sf_docs, monkeypatch):
    monkeypatch.setattr(packing, "MERGE_FAN_IN", 2)
    out = packing.pack(sf_docs.repartition(7), vocabulary()).toPandas()
    used = out.groupby("sequence_id").length.sum()
    assert used.max() <= packing.WINDOW
    assert 1 - used.sum() / (packing.WINDOW * len(used)) < 0.03           # little padding
    assert packing.pack(sf_docs.repartition(7), vocabulary()).count() == len(out)


@pytest.mark.parametrize("low, high", [(1100, 1900), (600, 900)])
def test_merge_passes_a_fixed_number_of_windows(low, high):
    rng = np.random.default_rng(3)
    lengths = rng.integers(low, high + 1, 4000)
    frame = pd.DataFrame({"doc_id": np.arange(4000), "start": 0, "length": lengths, "ids_crc32": 0, "doc_tokens": lengths,
                          "sequence_id": np.arange(4000), "offset": 0, "ev_group": 0})
    out = packing._merger(packing.WINDOW, packing.MIN_PIECE, 1, last=False)(frame)
    assert sorted(out.doc_id) == list(range(4000))
    used = out.groupby("sequence_id").length.sum()
    assert used.max() <= packing.WINDOW
    left = out[~out.ev_done].sequence_id.unique()
    assert len(left) == packing.OPEN_WINDOWS and used[left].max() <= used.drop(left).min()   # the emptiest
    assert not set(left) & set(out[out.ev_done].sequence_id)
    assert packing._merger(packing.WINDOW, packing.MIN_PIECE, 1, last=True)(frame).ev_done.all()


def test_packing_of_nothing(empty):
    assert packing.pack(empty, vocabulary()).collect() == []


def test_huffman_round_trip(spark, docs, bpe):
    out = keyed(tuple(r) for r in huffman.round_trip(docs, vocabulary()).collect())
    rows = docs.collect()
    assert len(out) == len(rows)
    expected = {}
    for r in rows:
        ids = plain_ids(bpe, r["text"]) + [huffman.END_ID]
        expected.setdefault(r["doc_id"], []).append((len(ids), crc(ids)))
    for doc_id, _, n, check in out:
        assert (n, check) in expected[doc_id]
    at = 0
    for _, start, n, _ in sorted(out, key=lambda r: r[1]):
        assert start == at
        at += n
    ids = [r[0] for r in sorted(out, key=lambda r: r[1])]
    assert ids == sorted(ids, key=lambda d: (d is None, d or 0))          # ascending, null last


def test_huffman_files_over_ranges(spark, sf_docs, bpe, monkeypatch, tmp_path):
    monkeypatch.setattr(huffman, "FILE_IDS", 20_000)
    monkeypatch.setattr(huffman, "BLOCK_IDS", 1_500)
    huffman.write_files(sf_docs.repartition(3), str(tmp_path), vocabulary())
    out = {r["doc_id"]: r for r in huffman.read_files(spark, str(tmp_path)).collect()}
    at = 0
    for r in sorted(sf_docs.collect(), key=lambda r: r["doc_id"]):
        ids = plain_ids(bpe, r["text"]) + [huffman.END_ID]
        assert (out[r["doc_id"]]["start"], out[r["doc_id"]]["ids"]) == (at, ids)
        at += len(ids)


def test_huffman_of_nothing(empty):
    assert huffman.round_trip(empty, vocabulary()).collect() == []


def brute_lengths(counts, limit):
    """Least total length of a prefix code of at most ``limit`` bits, by trying all."""
    best = [None]

    def search(i, room, cost, order):
        if best[0] is not None and cost >= best[0]:
            return
        if i == len(order):
            best[0] = cost
            return
        for n in range(1, limit + 1):
            if room >= 2 ** (limit - n) + (len(order) - i - 1):
                search(i + 1, room - 2 ** (limit - n), cost + n * order[i], order)

    search(0, 2 ** limit, 0, sorted(counts, reverse=True))
    return best[0]


@pytest.mark.parametrize("seed", range(8))
def test_code_lengths_are_optimal_and_prefix_free(seed):
    rng = random.Random(seed)
    counts = np.array([rng.choice([0, 1, 1, 2, 5, 40, 300]) for _ in range(7)] + [1, 2])
    lengths = huffman.code_lengths(counts, 4)
    used = counts > 0
    assert (lengths[~used] == 0).all() and lengths[used].max() <= 4 and sum(2.0 ** -int(n) for n in lengths[used]) <= 1
    assert int((lengths * counts).sum()) == brute_lengths(counts[used].tolist(), 4)


def test_one_symbol():
    assert huffman.code_lengths(np.array([0, 9, 0])).tolist() == [0, 1, 0]
