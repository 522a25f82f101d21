"""The document sink as a data source with task and job commit.

``json_documents`` takes rows (index, doc) from a batch or a stream.  A task
writes its documents in bulks to files of its own under ``_staged``; only the
commit of the whole micro-batch moves them to
``index=<index>/batch=<id>/``, after removing what an earlier attempt of the
same micro-batch left there.  So

* a failing task or job leaves no document (its staged files are removed, and
  readers never look under ``_staged``);
* a replayed micro-batch replaces its documents: there is one copy of each
  (micro-batch, document).

A batch write is micro-batch 0 of its folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage

from eventide.sources.growing import open_folder

BULK = 1000
# Spark's name of a folder for rows whose partition value is null.
UNKNOWN = "__HIVE_DEFAULT_PARTITION__"


@dataclass
class Staged(WriterCommitMessage):
    """(index, file) of each file that a task wrote."""

    files: list[tuple[str, str]]


class _Documents:
    """What the batch and the stream writer share."""

    def __init__(self, path: str, bulk: int):
        # Made by the driver and sent to the tasks: all files of this writer stand in one folder.
        self.path, self.bulk, self.staged = path, bulk, f"_staged/{uuid.uuid4().hex}"

    def write(self, rows: Iterator[Row]) -> Staged:
        store, folder = open_folder(self.path)
        store.create_dir(f"{folder}/{self.staged}", recursive=True)
        task, open_files, waiting, files = uuid.uuid4().hex, {}, {}, []

        def send(index: str) -> None:
            if index not in open_files:
                name = f"{folder}/{self.staged}/{task}-{len(open_files)}.json"
                files.append((index, name))
                open_files[index] = store.open_output_stream(name)
            open_files[index].write("".join(f"{doc}\n" for doc in waiting.pop(index)).encode())

        try:
            for row in rows:
                index = UNKNOWN if row["index"] is None else row["index"]
                held = waiting.setdefault(index, [])
                held.append(row["doc"])
                if len(held) >= self.bulk:
                    send(index)
            for index in list(waiting):
                send(index)
        finally:
            for f in open_files.values():
                f.close()
        return Staged(files)

    def publish(self, messages: list[Staged | None], batch: int) -> None:
        """Moves a micro-batch's files into place, instead of an earlier attempt's."""
        store, folder = open_folder(self.path)
        files = [f for m in messages if m is not None for f in m.files]
        place = lambda index: f"{folder}/index={quote(index, safe='')}/batch={batch}"
        for index in {index for index, _ in files} | self._indexes(store, folder):
            self._remove(store, place(index))
        for index, name in files:
            store.create_dir(place(index), recursive=True)
            store.move(name, f"{place(index)}/{name.rsplit('/', 1)[1]}")
        self.discard()

    def discard(self) -> None:
        """Removes what tasks have staged, those too that failed half-way."""
        store, folder = open_folder(self.path)
        self._remove(store, f"{folder}/{self.staged}")

    @staticmethod
    def _indexes(store, folder: str) -> set[str]:
        from pyarrow import fs
        found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        return {unquote(f.base_name[6:]) for f in found if f.base_name.startswith("index=")}

    @staticmethod
    def _remove(store, place: str) -> None:
        from pyarrow import fs
        if store.get_file_info(place).type != fs.FileType.NotFound:
            store.delete_dir(place)


class BatchDocuments(_Documents, DataSourceWriter):
    def commit(self, messages) -> None:
        self.publish(messages, 0)

    def abort(self, messages) -> None:
        self.discard()


class StreamDocuments(_Documents, DataSourceStreamWriter):
    def commit(self, messages, batchId: int) -> None:
        self.publish(messages, batchId)

    def abort(self, messages, batchId: int) -> None:
        self.discard()


class JsonDocuments(DataSource):
    """``df.write.format("json_documents").mode("append").save(folder)`` and
    ``df.writeStream.format("json_documents").option("path", folder)``."""

    @classmethod
    def name(cls) -> str:
        return "json_documents"

    def schema(self) -> str:
        return "index string, doc string"

    def writer(self, schema, overwrite: bool) -> BatchDocuments:
        return BatchDocuments(self.options["path"], int(self.options.get("bulk", BULK)))

    def streamWriter(self, schema, overwrite: bool) -> StreamDocuments:
        return StreamDocuments(self.options["path"], int(self.options.get("bulk", BULK)))


def register_documents(spark: SparkSession) -> None:
    spark.dataSource.register(JsonDocuments)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(index, doc) of the committed documents under ``path``."""
    back = spark.read.schema("value string, index string, batch long").option("basePath", path).text(path)
    return back.select("index", back["value"].alias("doc"))
