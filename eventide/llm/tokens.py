"""Exact, batch-wise use of a byte-level BPE tokenizer inside tasks.

A batch's texts are cut into parts where the pre-tokenizer always cuts; parts
repeat far more often than texts do.  Arrow numbers the distinct parts of some
texts, those not met before are encoded by the tokenizers library, and numpy
lays the ids of all parts end to end.  Parts are kept from batch to batch as
Arrow and numpy arrays; those met least often go when there are too many.
``tests/llm/test_llm_tokens.py`` holds the result against encoding whole texts.
A text that holds the string of an added token is encoded whole.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from eventide.llm.common import per_worker

# Parts kept per worker (about 50 bytes each); the more frequent half stays when there are more.
MEMO_PARTS = 1 << 18
# Parts of more bytes are not kept.
MEMO_BYTES = 64
# Bytes of the texts that are encoded together; a longer text goes alone.
CHUNK_BYTES = 1 << 21

# Kinds of bytes.  _OTHER is any character beyond ASCII not known as letter or space.
_LETTER, _DIGIT, _MARK, _QUOTE, _OTHER, _SPACE, _BREAK, _WIDE = range(8)


def _kinds() -> bytes:
    kinds = bytearray([_MARK] * 128 + [_OTHER] * 128)
    for byte in range(128):
        char = chr(byte)
        if char.isalpha():
            kinds[byte] = _LETTER
        elif char.isdigit():
            kinds[byte] = _DIGIT
        elif char in "\t\n\v\f\r":
            kinds[byte] = _BREAK
    kinds[0x27], kinds[0x20] = _QUOTE, _SPACE
    return bytes(kinds)


def _pairs() -> bytes:
    """1 for a pair of kinds (8 * first + second) that the pattern always cuts between."""
    cuts = bytearray(256)
    spaces = (_SPACE, _BREAK, _WIDE)
    for a in range(8):
        for b in range(8):
            if a not in spaces and b in spaces:
                cuts[8 * a + b] = 1
            elif a == _BREAK and b not in spaces:       # a space would join what follows
                cuts[8 * a + b] = 1
            elif a < _OTHER and b < _OTHER and a != b:
                # Marks and quotes form one run; a quote may take letters ('s, 'll).
                cuts[8 * a + b] = not {a, b} == {_MARK, _QUOTE} and (a, b) != (_QUOTE, _LETTER)
    return bytes(cuts)


_KINDS, _CUTS = _kinds(), _pairs()
# Lead bytes of two-byte letters (U+00C0 to U+027F but for two signs, U+0400 to U+047F) and of white space.
_LETTER_LEADS = bytes(b in (*range(0xC3, 0xCA), 0xD0, 0xD1) for b in range(256))
_WIDE_LEADS = bytes(b in (0xC2, 0xE1, 0xE2, 0xE3) for b in range(256))
_WIDE_SPACES = [c.encode() for c in "\x85\xa0     　" + "".join(map(chr, range(0x2000, 0x200B)))]


def _byte_chars() -> dict[int, str]:
    """Byte -> character of byte-level BPE: printable bytes stand for
    themselves, the others take the code points from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _marked(raw: bytes, flags: bytes) -> np.ndarray:
    """Positions of the bytes that ``flags`` marks."""
    return np.flatnonzero(np.frombuffer(raw.translate(flags), bool))


def _byte_kinds(raw: bytes) -> np.ndarray:
    """The kind of each byte of UTF-8 text; all bytes of a character share it."""
    kinds = np.frombuffer(bytearray(raw.translate(_KINDS)), np.uint8)
    if raw.isascii():
        return kinds
    data = np.frombuffer(raw + b"\0\0", np.uint8)
    at = _marked(raw, _LETTER_LEADS)
    at = at[(data[at] != 0xC3) | ((data[at + 1] != 0x97) & (data[at + 1] != 0xB7))]
    kinds[at] = kinds[at + 1] = _LETTER
    at = _marked(raw, _WIDE_LEADS)
    for space in _WIDE_SPACES if len(at) else ():
        found = at[data[at] == space[0]]
        for i in range(1, len(space)):
            found = found[data[found + i] == space[i]]
        for i in range(len(space)):
            kinds[found + i] = _WIDE
    return kinds


def part_starts(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where parts of texts begin that stand end to end in ``raw``; ``starts``
    and ``ends`` are those of the texts that are not empty."""
    kinds = _byte_kinds(raw)
    cut = np.zeros(len(raw), bool)
    cut[1:] = np.frombuffer((kinds[:-1] << 3 | kinds[1:]).tobytes().translate(_CUTS), bool)
    # The last character of a run of white space stands alone or with what
    # follows it; at the end of a text it does not.
    space, last = kinds >= _SPACE, np.zeros(len(raw), bool)
    last[1:-1] = space[1:-1] & space[:-2] & ~space[2:] & (kinds[1:-1] != _WIDE)
    last[ends - 1] = False
    cut |= last
    cut[starts] = True
    return np.flatnonzero(cut)


class BpeEncoder:
    """Ids that equal ``Tokenizer.encode(text, add_special_tokens=False).ids``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # An added token's string in a text is that token, wherever it stands.
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.model = self.tokenizer.model
        shape = str(self.tokenizer.pre_tokenizer)
        self.splits = (self.tokenizer.normalizer is None and "ByteLevel(add_prefix_space=False" in shape
                       and "use_regex=True" in shape)
        self.chars = _byte_chars()
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        # Parts met before, their ids end to end, numbers of ids, and how often
        # they were met.  The first part is empty and stands for the end id.
        self.parts = pa.array([b""], pa.large_binary())
        self.part_ids = np.zeros(1, self.dtype)
        self.sizes, self.uses = np.ones(1, np.int64), np.zeros(1, np.int64)

    def _ids_of(self, part: bytes) -> bytes:
        """Ids of a part as little-endian integers of ``self.dtype``."""
        text = part.decode()
        body = text[1:] if text[0] == " " else text
        if self.splits and (body.isalpha() or (body.isascii() and body.isdigit())):       # one pre-token
            mapped = body if body.isascii() else body.encode().decode("latin-1").translate(self.chars)
            lead = self.chars[0x20] if text[0] == " " else ""
            return array(self.code, [t.id for t in self.model.tokenize(lead + mapped)]).tobytes()
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _bounds(self, raw: bytes, ends: np.ndarray) -> np.ndarray:
        """Bounds of the parts of texts that end at ``ends``; an empty part
        follows each text."""
        begins = np.append(0, ends[:-1])
        full = np.flatnonzero(ends > begins)
        starts = part_starts(raw, begins[full], ends[full]) if self.splits else begins[full]
        if self.splits and any(mark in raw for mark in self.added):
            inside = np.zeros(len(raw), bool)
            for a, b in zip(begins[full].tolist(), ends[full].tolist(), strict=True):
                inside[a + 1:b] = any(raw.find(mark, a, b) >= 0 for mark in self.added)
            starts = starts[~inside[starts]]
        return np.append(np.sort(np.concatenate([starts, ends])), len(raw))

    def _encode(self, raw: bytes, ends: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        bounds, known = self._bounds(raw, ends), len(self.parts)
        words, places = self.parts.buffers()[2], np.frombuffer(self.parts.buffers()[1], np.int64)[:known]
        words = words.to_pybytes() if words else b""
        # The known parts stand first, so a part's number is its place among them.
        offsets = np.concatenate([places, bounds + len(words)])
        numbered = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1,
                                         [None, pa.py_buffer(offsets), pa.py_buffer(words + raw)]).dictionary_encode()
        made = [self._ids_of(part) for part in numbered.dictionary[known:].to_pylist()]
        part_ids = np.concatenate([self.part_ids, np.frombuffer(b"".join(made), self.dtype)])
        part_ids[0] = end_id
        sizes = np.concatenate([self.sizes, np.array([len(m) for m in made], np.int64) // self.dtype.itemsize])
        at = numbered.indices.to_numpy()[known:]
        counts = sizes[at]
        stops = np.cumsum(counts)
        first = np.cumsum(sizes) - sizes
        ids = part_ids[np.repeat(first[at] - (stops - counts), counts) + np.arange(int(counts.sum()))]
        uses = np.bincount(at, minlength=len(sizes))
        uses[:known] += self.uses
        self._remember(numbered.dictionary, part_ids, sizes, uses)
        return ids, np.diff(stops[bounds[1:] == bounds[:-1]], prepend=0)

    def _remember(self, parts: pa.Array, part_ids: np.ndarray, sizes: np.ndarray, uses: np.ndarray) -> None:
        kept = pc.binary_length(parts).to_numpy() <= MEMO_BYTES
        if len(parts) > MEMO_PARTS:
            rank = np.empty(len(parts), np.int64)
            rank[np.argsort(-uses, kind="stable")] = np.arange(len(parts))
            kept &= rank < MEMO_PARTS // 2
            uses = uses >> 1
        kept[0] = True
        if not kept.all():
            parts, part_ids = parts.filter(pa.array(kept)), part_ids[np.repeat(kept, sizes)]
            sizes, uses = sizes[kept], uses[kept]
        self.parts, self.part_ids, self.sizes, self.uses = parts, part_ids, sizes, uses

    def batches(self, texts: pa.Array, end_id: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """The texts (null: empty), some at a time: the first one's place, the
        ids of all with ``end_id`` behind each, and each text's number of ids."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        places = np.frombuffer(texts.buffers()[1] or bytes(8), np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data, at = texts.buffers()[2] or pa.py_buffer(b""), 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(places, places[at] + CHUNK_BYTES, side="right")) - 1)
            to = min(to, len(texts))
            raw = data.slice(int(places[at]), int(places[to] - places[at])).to_pybytes()
            yield at, *self._encode(raw, places[at + 1:to + 1] - places[at], end_id)
            at = to

    def ids(self, text: str) -> np.ndarray:
        """The ids of one text, without an end id."""
        return next(self.batches(pa.array([text], pa.string()), 0))[1][:-1]


def encoder(path: str) -> BpeEncoder:
    """The worker's encoder for a vocabulary file."""
    return per_worker(f"bpe_{path}", lambda: BpeEncoder(path))


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
