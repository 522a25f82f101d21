"""Fill-in-the-middle transformation by one repeated-capture match a text.

``regex.fullmatch("(unit)*", text)`` keeps every repetition of its group, so
``match.ends(1)`` is the list of all unit ends: its length is the number of
units n, and the ends after the chosen numbers of units are the two cut
offsets.  No loop over the text is written anywhere.

The draw of a document depends on its id and the seed alone: four 32-bit
numbers h1 to h4, the first 8-digit groups of the hex SHA-256 of
``"<seed>:<doc_id>"``.  The cuts follow min and max of h1 % (n + 1) and
h2 % (n + 1) units; h3 leaves texts plain and h4 picks the order of the parts:

    psm   <P>prefix<S>suffix<M>middle
    spm   <S>suffix<P>prefix<M>middle
    plain the text

Defined results: a null text is an empty text; empty texts, texts that hold
a mark, and texts that are no whole run of units stay plain.  A null doc_id
draws as the empty string does (``"<seed>:"``).  Repeated rows give equal
rows.  Very long texts are matched whole; a task holds one text's captures at
a time.  Extra columns are not read.  An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKS = ("<P>", "<S>", "<M>")
CODE_POINT = "."
PLAIN_FROM = 90         # texts whose h3 % 100 reaches this stay plain
SPM_BELOW = 20          # texts whose h4 % 100 is lower put the suffix first
SEED = "1"
# Rows are sent on when this many characters are waiting.
OUT_CHARS = 8 << 20

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, text string, output string"


@dataclass(frozen=True)
class Cut:
    """The parts of one text: n units, offsets of the two cuts in code points."""

    n: int
    first: int
    second: int


def cut(unit, text: str, h1: int, h2: int) -> Cut | None:
    """Where a text is cut, or None if it is no whole run of units."""
    match = unit.fullmatch(text)
    if match is None:
        return None
    ends = match.ends(1)
    n = len(ends)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    return Cut(n, ends[low - 1] if low else 0, ends[high - 1] if high else 0)


def arrange(form: str, prefix: str, middle: str, suffix: str, marks: tuple[str, str, str] = MARKS) -> str:
    p, s, m = marks
    if form == "psm":
        return f"{p}{prefix}{s}{suffix}{m}{middle}"
    return f"{s}{suffix}{p}{prefix}{m}{middle}"


def check_marks(marks: tuple[str, str, str]) -> None:
    """Marks whose first characters stand nowhere else in a mark: then no part
    of a text can run with a mark beside it into another mark."""
    if any(not mark or mark[0] in "".join(m[1:] for m in marks) for mark in marks) or len(set(marks)) < 3:
        raise ValueError(f"marks {marks} could be mistaken for each other beside a text")


def draws(doc_id: str = "doc_id", seed: str = SEED) -> list[Column]:
    """h1 to h4 of a document."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def transform(docs: DataFrame, unit: str = CODE_POINT, seed: str = SEED, plain_from: int = PLAIN_FROM,
              spm_below: int = SPM_BELOW, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, text, output) of every row.

    ``unit`` is any pattern of the regex library without groups: ``.`` cuts
    between code points, ``\\X`` between graphemes, ``\\S+\\s*`` before words.
    n counts units; the two sizes are in code points, null where plain.
    """
    check_marks(marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        pattern = regex.compile(f"({unit})*", regex.DOTALL)
        out, chars = [], 0
        for batch in batches:
            for doc_id, text, *h in zip(*batch.columns, strict=True):
                text = text.as_py() or ""
                h1, h2, h3, h4 = (x.as_py() for x in h)
                at = cut(pattern, text, h1, h2)
                if at is None or not text or any(mark in text for mark in marks) or h3 % 100 >= plain_from:
                    out.append((doc_id.as_py(), at.n if at else 0, "plain", None, None, text, text))
                else:
                    form = "spm" if h4 % 100 < spm_below else "psm"
                    parts = text[:at.first], text[at.first:at.second], text[at.second:]
                    out.append((doc_id.as_py(), at.n, form, at.first, at.second - at.first, text,
                                arrange(form, *parts, marks)))
                chars += len(text)
                if chars >= OUT_CHARS:
                    yield _batch(out)
                    out, chars = [], 0
        if out:
            yield _batch(out)

    need = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *draws(seed=seed))
    return need.mapInArrow(run, SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "text", "output"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that an output came from: a changed text holds no mark, so
    each mark of its output stands once and the parts lie between them."""
    check_marks(marks)
    parts = F.split(output, "|".join(r"\Q" + mark + r"\E" for mark in marks), -1)
    one, two, middle = (F.get(parts, i) for i in (1, 2, 3))
    return (F.when(form == "psm", F.concat(one, middle, two))
             .when(form == "spm", F.concat(two, middle, one))
             .otherwise(output))


def digests(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256,
    restored_sha256) of every row."""
    out = transform(docs, **options)
    marks = options.get("marks", MARKS)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form"), marks), 256).alias("restored_sha256"))
