"""A5: an unbounded source of text lines, from files that grow.

``growing_lines`` is a streaming data source over the files of a folder to
which other processes append.  An offset holds the bytes of each file that are
whole lines, so a stream resumes exactly where it stood, a line that is still
being written waits, and no line is read twice.  A micro-batch is split into
byte ranges of at most ``pieceBytes``: a line belongs to the range in which it
starts.  Files only ever grow; a file that became shorter fails the stream.

An offset has one entry a file, so this source is for files that grow; a
folder of many finished files is what Spark's own file stream is for.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from eventide.sources.files import parse_key_ts_lines

PIECE_BYTES = 64 << 20
TAIL_BYTES = 64 << 10
LINES_PER_BATCH = 10_000


@dataclass(frozen=True)
class Piece(InputPartition):
    """Lines of ``name`` that start in [lo, hi); ``first`` says whether the
    micro-batch's lines start at ``lo``."""

    name: str
    lo: int
    hi: int
    first: bool


def open_folder(path: str):
    """(file system, folder) of a path or URI, on any store pyarrow reads."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not
                                      path.startswith("file://") else path)
    return fs.LocalFileSystem(), path


class LineReader(DataSourceStreamReader):
    def __init__(self, path: str, piece_bytes: int):
        self.path, self.piece_bytes = path, piece_bytes

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        from pyarrow import fs

        store, folder = open_folder(self.path)
        found = store.get_file_info(fs.FileSelector(folder, recursive=False, allow_not_found=True))
        names = {f.base_name: f.size for f in found if f.is_file and not f.base_name.startswith(("_", "."))}
        ends = {name: self._whole_lines(store, f"{folder}/{name}", size) for name, size in sorted(names.items())}
        return {name: end for name, end in ends.items() if end}

    @staticmethod
    def _whole_lines(store, file: str, size: int) -> int:
        """Bytes up to and with the last line feed."""
        with store.open_input_file(file) as f:
            hi = size
            while hi:
                lo = max(0, hi - TAIL_BYTES)
                at = f.read_at(hi - lo, lo).rfind(b"\n")
                if at >= 0:
                    return lo + at + 1
                hi = lo
        return 0

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        out = []
        for name, hi in sorted(end.items()):
            lo = start.get(name, 0)
            if hi < lo:
                raise RuntimeError(f"{self.path}/{name} had {lo} bytes of lines and now has {hi}")
            out += [Piece(name, at, min(at + self.piece_bytes, hi), at == lo) for at in range(lo, hi, self.piece_bytes)]
        return out

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        store, folder = open_folder(self.path)
        with store.open_input_file(f"{folder}/{partition.name}") as raw:
            at = partition.lo if partition.first else partition.lo - 1
            raw.seek(at)
            f = io.BufferedReader(raw, TAIL_BYTES)
            if not partition.first:                   # the line that runs into this range is the one before's
                at += len(f.readline())
            lines: list[str] = []
            while at < partition.hi:
                line = f.readline()
                at += len(line)
                lines.append(line.removesuffix(b"\n").removesuffix(b"\r").decode("utf-8", "replace"))
                if len(lines) >= LINES_PER_BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
                    lines = []
            if lines:
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])


class GrowingLines(DataSource):
    """``spark.readStream.format("growing_lines").load(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "growing_lines"

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> LineReader:
        return LineReader(self.options["path"], int(self.options.get("pieceBytes", PIECE_BYTES)))


def growing_lines(spark: SparkSession, path: str, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """A5: the lines of a folder's growing files, as a stream of ``value``."""
    spark.dataSource.register(GrowingLines)
    return spark.readStream.format("growing_lines").option("pieceBytes", piece_bytes).load(path)


def growing_key_ts_lines(spark: SparkSession, path: str, seconds: bool = True, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """A5: growing "key time" lines, parsed."""
    return parse_key_ts_lines(growing_lines(spark, path, piece_bytes), seconds=seconds)
