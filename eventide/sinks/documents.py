"""Document sink (A11) and simple outputs.

The reference sends each row to a search index as ``{"data": row.toString}``
with bulk size 1.  Here rows become JSON documents with an index name and
are written as JSON lines partitioned by index -- in bulk, by every task in
parallel.  A search-service connector, if one is on the classpath, takes the
same ``docs`` DataFrame through ``.format(...)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def to_documents(df: DataFrame, index: str, record: str, fields: Sequence[str]) -> DataFrame:
    """Rows -> (index, doc) with doc = ``{"data": "Record(f1,f2,...)"}``."""
    text = F.concat(F.lit(f"{record}("), F.concat_ws(",", *[F.coalesce(F.col(f).cast("string"), F.lit("null")) for f in fields]),
                    F.lit(")"))
    return df.select(F.lit(index).alias("index"), F.to_json(F.struct(text.alias("data"))).alias("doc"))


def write_documents(docs: DataFrame, path: str, mode: str = "append") -> None:
    """Bulk write: one folder per index, JSON text lines."""
    docs.write.mode(mode).partitionBy("index").text(path)


def document_stream_writer(path: str):
    """``foreachBatch`` function for streams: each micro-batch lands in its own
    ``batch=<id>`` folder and is overwritten on replay, so retries after a
    failure do not duplicate documents."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("index").text(f"{path}/batch={batch_id}")
    return write


def print_sink(df: DataFrame, label: str | None = None, n: int = 20) -> None:
    """A10: print rows, optionally behind a label (batch form of ``print``)."""
    if label:
        print(label)
    df.show(n, truncate=False)
