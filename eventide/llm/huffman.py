"""Token ids in a canonical, length-limited Huffman file format.

Writing takes two passes over the ids.  The first tokenizes, keeps the ids and
each task's counts in the shared scratch folder; the counts over all documents give
code lengths by package-merge (at most ``MAX_BITS``), and lengths alone fix the
canonical codes.  The second pass encodes.  Documents are dealt into ranges of
doc_id, one file a range, in ascending order.

A file is Parquet whose rows are independent blocks: the global position of
the block's first id, its documents' ids and lengths, the code bits (each
document starts on a byte), and a bit-offset checkpoint every ``LANE`` ids.
The code lengths are a second, small table beside the blocks.  Reading decodes
all lanes of a block in step through one lookup table of 2^MAX_BITS entries.

Defined cases: a null text is empty; every document ends with the end id, so
none is empty; null doc_ids come last; repeated doc_ids keep one entry per
row, in order of their code bits; an empty table gives an empty file set; a
document is never split over blocks, so a block is as long as its longest
document at least.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm.common import MAX_LONG, order_key, range_cuts, save
from eventide.llm.tokens import encoder
from eventide.session import scratch_path

MAX_BITS = 18
LANE = 64
BLOCK_IDS = 1 << 16
# Ids in a file; a file is one task's work.
FILE_IDS = 1 << 23
END_ID = 2
# Ids of the blocks that a reader decodes in step.
DECODE_IDS = 1 << 19

_BLOCK = ("ev_file int, block int, start long, doc_ids array<long>, doc_lengths array<long>, "
          "bits binary, checkpoints binary")


# ---------------------------------------------------------------- code table

def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal lengths of at most ``max_bits`` (package-merge); 0: unused id."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} ids in use need more than {max_bits} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used].astype(np.float64)
    row, is_leaf = weights, []
    for _ in range(max_bits):
        leaf = np.zeros(0, bool)
        pairs = row[:len(row) // 2 * 2].reshape(-1, 2).sum(1) if is_leaf else np.zeros(0)
        row = np.concatenate([weights, pairs])
        order = np.argsort(row, kind="stable")
        leaf = order < len(weights)
        row = row[order]
        is_leaf.append(leaf)
    take = 2 * (len(used) - 1)
    depth = np.zeros(len(used), np.int64)
    for leaf in reversed(is_leaf):
        leaves = int(leaf[:take].sum())
        depth[:leaves] += 1
        take = 2 * (take - leaves)
    lengths[used] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes by rising (length, id)."""
    codes = np.zeros(len(lengths), np.uint32)
    used = np.flatnonzero(lengths)
    used = used[np.lexsort((used, lengths[used]))]
    code, last = 0, 0
    for i in used:
        code <<= int(lengths[i]) - last
        last = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def decode_table(lengths: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(id, length) of the code that begins each ``max_bits``-bit window."""
    used = np.flatnonzero(lengths)
    used = used[np.lexsort((used, lengths[used]))]
    spans = 1 << (max_bits - lengths[used].astype(np.int64))
    ids = np.zeros(1 << max_bits, np.uint32)
    bits = np.ones(1 << max_bits, np.uint8)
    total = int(spans.sum())
    ids[:total] = np.repeat(used, spans)
    bits[:total] = np.repeat(lengths[used], spans)
    return ids, bits


# ------------------------------------------------------------ encode / decode

def encode_documents(ids: np.ndarray, doc_lengths: np.ndarray, codes: np.ndarray, lengths: np.ndarray):
    """Code bits of documents laid end to end.

    Returns (bytes, byte start of each document, bit offset of each checkpoint
    from its document's start); a document's checkpoints are its ids 0, LANE, ...
    """
    ends = np.cumsum(lengths[ids], dtype=np.int64)
    first = np.cumsum(doc_lengths) - doc_lengths
    doc_ends = ends[first + doc_lengths - 1]
    doc_bits = np.diff(doc_ends, prepend=0)
    doc_bytes = -(-doc_bits // 8)
    byte_start = np.cumsum(doc_bytes) - doc_bytes
    total = int(doc_bytes.sum())
    # Where each code starts: the codes before it, and the bits that fill up bytes.
    at = np.repeat(8 * byte_start - (doc_ends - doc_bits), doc_lengths)
    at[1:] += ends[:-1]
    # A code lies within 64 bits from the start of its first 32-bit word.  Codes
    # stand in order and share no bit, so a word is the sum of its codes' parts.
    word = at >> 5
    aligned = codes.astype(np.uint64) << (64 - lengths.astype(np.uint64))
    shifted = aligned[ids] >> (at & 31).astype(np.uint64)
    starts = np.flatnonzero(np.diff(word, prepend=-1))
    out = np.zeros(total // 4 + 3, np.uint64)
    out[word[starts]] = np.add.reduceat(shifted >> np.uint64(32), starts)
    out[word[starts] + 1] += np.add.reduceat(shifted & np.uint64(0xFFFFFFFF), starts)
    lanes = -(-doc_lengths // LANE)
    lane_of = np.arange(int(lanes.sum())) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    marks = at[np.repeat(first, lanes) + LANE * lane_of] - np.repeat(8 * byte_start, lanes)
    return out.astype(">u4").tobytes()[:total], byte_start, marks.astype("<u4")


def decode_lanes(bits: bytes, at: np.ndarray, lane_ids: np.ndarray, table: tuple[np.ndarray, np.ndarray],
                 max_bits: int = MAX_BITS) -> np.ndarray:
    """Ids of lanes that start at bit offsets ``at``; lanes advance in step.

    Each lane is a row of a matrix whose columns are the steps, so a step
    writes one column; the longest lanes stand first and shorter ones stop."""
    # One entry a window: the id above the code's length.
    entry_of = (table[0].astype(np.uint32) << 8) | table[1]
    raw = np.frombuffer(bits + b"\0\0\0\0", np.uint8)
    words = ((raw[:-3].astype(np.uint32) << 24) | (raw[1:-2].astype(np.uint32) << 16)
             | (raw[2:-1].astype(np.uint32) << 8) | raw[3:])
    order = np.argsort(-lane_ids, kind="stable")      # lanes that go on longest first
    pos, left = at[order].astype(np.int64), lane_ids[order]
    steps = int(left[0]) if len(left) else 0
    # How many lanes are still going at each step.
    live = np.searchsorted(-left, -np.arange(steps), side="left").tolist()
    grid = np.empty((steps, len(left)), np.uint32)
    shift = np.uint32(32 - max_bits)
    for step, n in enumerate(live):
        p = pos[:n]
        entry = entry_of[(words[p >> 3] << (p & 7).astype(np.uint32)) >> shift]
        grid[step, :n] = entry
        p += entry & 255
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    lanes = np.repeat(back, lane_ids)
    start = np.cumsum(lane_ids) - lane_ids
    return grid[np.arange(len(lanes)) - np.repeat(start, lane_ids), lanes] >> 8


# ------------------------------------------------------------------- writing

def _lane_sizes(doc_lengths: np.ndarray) -> np.ndarray:
    """Ids in each lane of documents in a row."""
    lanes = -(-doc_lengths // LANE)
    sizes = np.full(int(lanes.sum()), LANE, np.int64)
    sizes[np.cumsum(lanes) - 1] = doc_lengths - LANE * (lanes - 1)
    return sizes


def tokenize(docs: DataFrame, tokenizer_path: str, vocab: int, end_id: int = END_ID) -> DataFrame:
    """(doc_id, n_tokens, ids as packed little-endian integers), end id
    included; and from each task one row of n_tokens = -1 whose ids are the
    task's occurrences of every id of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(tokenizer_path)
        width = bpe.dtype.itemsize
        total = np.zeros(vocab, np.int64)
        names = ["doc_id", "n_tokens", "ids"]
        for batch in batches:
            for at, ids, counts in bpe.batches(batch.column(1), end_id):
                total += np.bincount(ids, minlength=vocab)
                bounds = (width * np.append(0, np.cumsum(counts))).astype(np.int32)
                packed = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(bounds), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(counts)), pa.array(counts, pa.int64()), packed], names)
        yield pa.RecordBatch.from_arrays(
            [pa.array([None], pa.int64()), pa.array([-1], pa.int64()), pa.array([total.tobytes()], pa.binary())], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def count_ids(counted: DataFrame, vocab: int) -> np.ndarray:
    """Occurrences of each id over all documents (a vector as long as the
    vocabulary), from the tasks' counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocab, np.int64)
        for batch in batches:
            for counts in batch.column(0):
                total += np.frombuffer(counts.as_py(), np.int64)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], ["id", "n"])

    found = counted.select("ids").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(vocab, np.int64)
    for r in found:
        counts[r["id"]] = r["n"]
    return counts


def write_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID) -> None:
    """Encode all documents into ``path``/blocks and ``path``/lengths."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    vocab = max(Tokenizer.from_file(tokenizer_path).get_vocab_size(), end_id + 1)
    width = 2 if vocab <= 1 << 16 else 4
    made = save(tokenize(docs, tokenizer_path, vocab, end_id), "huffman-ids", compression="zstd")
    tokens, counted = made.filter("n_tokens >= 0"), made.filter("n_tokens < 0")
    counts = count_ids(counted, vocab)
    lengths = code_lengths(counts)
    spark.createDataFrame([(lengths.tobytes(),)], "lengths binary").coalesce(1).write.parquet(f"{path}/lengths")

    files = max(1, -(-int(counts.sum()) // FILE_IDS))
    keyed = tokens.withColumn("ev_key", order_key())
    cuts = range_cuts(keyed.select("ev_key"), "ev_key", files)
    bins = np.array(cuts, np.int64)
    # The position of each file's first id: one sum per file.
    sums = _range_sums(keyed, bins)
    starts = np.concatenate([[0], np.cumsum([sums.get(i, 0) for i in range(len(cuts) + 1)])]).tolist()
    coded = tokens.select("doc_id", "n_tokens", "ids").mapInArrow(
        _encoder(lengths, width, bins), "ev_file int, ev_key long, doc_id long, n_tokens long, bits binary, checkpoints binary")
    dealt = coded.repartitionById(len(cuts) + 1, F.col("ev_file")).sortWithinPartitions("ev_file", "ev_key", "bits")
    dealt.mapInArrow(_assembler(starts), _BLOCK).write.option("compression", "none").parquet(f"{path}/blocks")


def _range_sums(keyed: DataFrame, bins: np.ndarray) -> dict[int, int]:
    """Ids in each range of the order key, summed per task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(bins) + 1, np.int64)
        for batch in batches:
            file = np.searchsorted(bins, batch.column(0).to_numpy(), side="right")
            np.add.at(total, file, batch.column(1).to_numpy())
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], ["f", "n"])

    sums = keyed.select("ev_key", "n_tokens").mapInArrow(run, "f int, n long")
    return {r["f"]: r["n"] for r in sums.groupBy("f").agg(F.sum("n").alias("n")).collect()}


def _encoder(lengths: np.ndarray, width: int, bins: np.ndarray):
    kind = np.dtype(f"<u{width}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = canonical_codes(lengths)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                n = part.column(1).to_numpy()
                ids = np.frombuffer(b"".join(x.as_py() for x in part.column(2)), kind)
                data, byte_start, marks = encode_documents(ids, n, codes, lengths)
                byte_end = np.append(byte_start[1:], len(data))
                lane_end = np.cumsum(-(-n // LANE))
                key = part.column(0).fill_null(MAX_LONG).to_numpy()
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.searchsorted(bins, key, side="right"), pa.int32()), pa.array(key, pa.int64()),
                    part.column(0), part.column(1),
                    pa.array([data[a:b] for a, b in zip(byte_start, byte_end, strict=True)], pa.binary()),
                    pa.array([m.tobytes() for m in np.split(marks, lane_end[:-1])], pa.binary()),
                ], ["ev_file", "ev_key", "doc_id", "n_tokens", "bits", "checkpoints"])

    return run


def _assembler(starts: list[int]):
    """Blocks of one file from its documents in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, at, block, held, size = None, 0, 0, [], 0

        def flush() -> pa.RecordBatch:
            nonlocal at, block, held, size
            bytes_before, marks = 0, []
            for _, n, bits, checks in held:
                marks.append(np.frombuffer(checks, "<u4").astype("<u8") + 8 * bytes_before)
                bytes_before += len(bits)
            row = pa.RecordBatch.from_arrays([
                pa.array([file], pa.int32()), pa.array([block], pa.int32()), pa.array([at], pa.int64()),
                pa.array([[h[0] for h in held]], pa.list_(pa.int64())),
                pa.array([[h[1] for h in held]], pa.list_(pa.int64())),
                pa.array([b"".join(h[2] for h in held)], pa.binary()),
                pa.array([np.concatenate(marks).tobytes()], pa.binary()),
            ], ["ev_file", "block", "start", "doc_ids", "doc_lengths", "bits", "checkpoints"])
            at, block, held, size = at + size, block + 1, [], 0
            return row

        for batch in batches:
            for f, doc_id, n, bits, checks in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5)), strict=True):
                if f != file:
                    if held:
                        yield flush()
                    file, at, block = f, starts[f], 0
                held.append((doc_id, n, bits, checks))
                size += n
                if size >= BLOCK_IDS:
                    yield flush()
        if held:
            yield flush()

    return run


# ------------------------------------------------------------------- reading

def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files, decoded."""
    return _decoded(spark, path, digest=False)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the decoded ids of the files."""
    return _decoded(spark, path, digest=True)


def _decoded(spark: SparkSession, path: str, digest: bool) -> DataFrame:
    packed = spark.read.parquet(f"{path}/lengths").first()[0]
    lengths = np.frombuffer(bytes(packed), np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, held, ids_held = decode_table(lengths), [], 0
        for batch in batches:
            for block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(block)
                ids_held += sum(block[2])
                if ids_held >= DECODE_IDS:
                    yield decoded(held, tables)
                    held, ids_held = [], 0
        if held:
            yield decoded(held, tables)

    def decoded(blocks: list[tuple], tables) -> pa.RecordBatch:
        """Some blocks together: all their lanes advance in step."""
        doc_ids = [d for block in blocks for d in block[1]]
        sizes = np.array([n for block in blocks for n in block[2]], np.int64)
        before = np.cumsum([0, *(len(block[3]) for block in blocks)])[:-1]
        marks = np.concatenate([np.frombuffer(block[4], "<u8").astype(np.int64) + 8 * int(b)
                                for block, b in zip(blocks, before, strict=True)])
        ids = decode_lanes(b"".join(block[3] for block in blocks), marks, _lane_sizes(sizes), tables)
        ends = np.cumsum(sizes)
        # A document's place: its block's start and the ids before it there.
        inside = np.concatenate([np.cumsum(block[2]) - block[2] for block in blocks])
        starts = np.repeat([block[0] for block in blocks], [len(block[2]) for block in blocks]) + inside
        raw, spans = memoryview(ids.astype("<u4", copy=False)).cast("B"), zip((4 * (ends - sizes)).tolist(), (4 * ends).tolist(), strict=True)
        if digest:
            last = pa.array([zlib.crc32(raw[a:b]) for a, b in spans], pa.int64())
        else:
            last = pa.array([ids[a // 4:b // 4] for a, b in spans], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays(
            [pa.array(doc_ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), last],
            ["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])

    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks").select("start", "doc_ids", "doc_lengths", "bits", "checkpoints")
    return blocks.mapInArrow(run, "doc_id long, start long, n_tokens long, " + ("ids_crc32 long" if digest else "ids array<long>"))


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Write the files of all documents and read their digests back."""
    path = scratch_path(docs.sparkSession, "huffman-files")
    write_files(docs, path, tokenizer_path, end_id)
    return read_digests(docs.sparkSession, path)
