"""The growing-line source and the document sink as data sources."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from eventide.session import scratch_path
from eventide.sinks.document_source import BatchDocuments, StreamDocuments, read_documents, register_documents
from eventide.sources.growing import LineReader, growing_key_ts_lines, growing_lines
from eventide.streaming.runner import stream_settings

from helpers import rows


def append(folder, name, text):
    with open(os.path.join(folder, name), "ab") as f:
        f.write(text.encode())


def run_once(lines, base):
    """One ``availableNow`` run; (micro-batch, value) of what it brought."""
    got = []

    def write(batch, batch_id):
        got.extend((batch_id, r["value"]) for r in batch.collect())
    q = lines.writeStream.foreachBatch(write).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    assert q.exception() is None
    return got


def test_appended_lines_arrive_once(spark):
    folder, base = tempfile.mkdtemp(prefix="eventide-grow-"), scratch_path(spark, "grow")
    stream = lambda: growing_lines(spark, folder, piece_bytes=7)
    append(folder, "a.log", "one 1\ntwo 2\nunfini")
    append(folder, "_hidden", "never\n")
    append(folder, "b.log", "é漢字 3\r\n\nlast of b\n")
    first = run_once(stream(), base)
    assert sorted(v for _, v in first) == sorted(["one 1", "two 2", "é漢字 3", "", "last of b"])
    append(folder, "a.log", "shed 4\n")
    append(folder, "c.log", "x" * 50 + "\n" + "y\n" * 20)
    second = run_once(stream(), base)                    # resumed from the checkpoint
    assert sorted(v for _, v in second) == sorted(["unfinished 4", "x" * 50, *["y"] * 20])
    assert run_once(stream(), base) == []
    append(folder, "b.log", "again\n")
    assert [v for _, v in run_once(stream(), base)] == ["again"]


def test_a_failed_batch_reads_the_same_bytes_again(spark):
    folder, base = tempfile.mkdtemp(prefix="eventide-grow-"), scratch_path(spark, "grow")
    append(folder, "a.log", "1\n2\n")
    seen = []

    def failing(batch, batch_id):
        seen.append(sorted(r["value"] for r in batch.collect()))
        if len(seen) == 1:
            append(folder, "a.log", "3\n")               # comes while the batch fails
            raise RuntimeError("lost")
    for attempt in (1, 2, 3):                            # the second run takes up the failed batch
        q = (growing_lines(spark, folder).writeStream.foreachBatch(failing).option("checkpointLocation", f"{base}/checkpoint")
             .trigger(availableNow=True).start())
        if attempt == 1:
            with pytest.raises(Exception, match="lost"):
                q.awaitTermination()
        else:
            q.awaitTermination()
    assert seen == [["1", "2"], ["1", "2"], ["3"]]


@pytest.mark.parametrize("piece", [1, 2, 3, 5, 8, 100])
def test_pieces_hold_every_line_once(piece):
    folder = tempfile.mkdtemp(prefix="eventide-pieces-")
    text = ["", "a", "bb", "", "", "ccc dddd", "e" * 30, "f"]
    append(folder, "a.log", "".join(f"{x}\n" for x in text))
    reader = LineReader(folder, piece)
    end = reader.latestOffset()
    for start in ({}, {"a.log": 1}, {"a.log": 3}):        # offsets stand at line starts
        got = [v for p in reader.partitions(start, end) for b in reader.read(p) for v in b.column(0).to_pylist()]
        assert got == ["".join(f"{x}\n" for x in text)[start.get("a.log", 0):].split("\n")[:-1]][0]
    with pytest.raises(RuntimeError, match="had 999 bytes"):
        reader.partitions({"a.log": 999}, end)


def test_no_folder_and_no_lines():
    reader = LineReader(os.path.join(tempfile.mkdtemp(), "none"), 10)
    assert reader.latestOffset() == {} and reader.partitions({}, {}) == []


def test_parsed_key_time_lines(spark):
    folder, base = tempfile.mkdtemp(prefix="eventide-grow-"), scratch_path(spark, "grow")
    append(folder, "a.log", "sensor_1 12\nsensor_2 13\n")
    out = f"{base}/out"
    q = (growing_key_ts_lines(spark, folder).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    assert rows(spark.read.parquet(out), "key", "ts_ms") == [("sensor_1", 12_000), ("sensor_2", 13_000)]


# ------------------------------------------------------------------ documents

def docs(spark, n=25):
    return spark.range(n).select(
        F.when(F.col("id") % 5 == 0, "a/b c").when(F.col("id") % 5 == 1, F.lit(None)).otherwise("sensor").alias("index"),
        F.concat(F.lit('{"data":"'), F.col("id").cast("string"), F.lit('"}')).alias("doc")).repartition(3)


def written(path, spark):
    return sorted((repr(r["index"]), r["doc"]) for r in read_documents(spark, path).collect())


def test_batch_documents(spark):
    register_documents(spark)
    path = f"{scratch_path(spark, 'docs')}/data"
    want = sorted((repr(r["index"]), r["doc"]) for r in docs(spark).collect())
    for _ in range(2):                                   # the second write replaces the first: one copy each
        docs(spark).write.format("json_documents").option("bulk", 2).mode("append").save(path)
        assert written(path, spark) == want
    assert not os.listdir(f"{path.removeprefix('file://')}/_staged")


def test_a_failing_task_leaves_no_document(spark):
    register_documents(spark)
    path = f"{scratch_path(spark, 'docs')}/data"
    bad = docs(spark, 40).withColumn("doc", F.when(F.col("doc").contains('"37"'), F.raise_error(F.lit("bad row")).cast("string"))
                                     .otherwise(F.col("doc")))
    with pytest.raises(Exception, match="bad row"):
        bad.write.format("json_documents").option("bulk", 1).mode("append").save(path)
    folder = path.removeprefix("file://")
    assert [name for _, _, files in os.walk(folder) for name in files if name.endswith(".json")] == []
    assert not any(name.startswith("index=") for name in os.listdir(folder))


def test_a_replayed_batch_replaces_its_documents():
    path = tempfile.mkdtemp(prefix="eventide-docs-")
    from pyspark.sql import Row
    sink = StreamDocuments(path, 1)
    first = sink.write(iter([Row(index="a", doc="1"), Row(index="b", doc="2")]))
    sink.commit([first], 7)
    again = [sink.write(iter([Row(index="a", doc="1"), Row(index="b", doc="2")])), None]
    sink.commit(again, 7)                                # the same micro-batch, run again
    sink.commit([sink.write(iter([Row(index="a", doc="3")]))], 8)
    found = sorted((os.path.relpath(d, path), open(os.path.join(d, f)).read()) for d, _, fs in os.walk(path) for f in fs)
    assert found == [("index=a/batch=7", "1\n"), ("index=a/batch=8", "3\n"), ("index=b/batch=7", "2\n")]
    dropped = sink.write(iter([Row(index="c", doc="9")]))
    sink.abort([dropped, None], 9)
    assert not os.listdir(f"{path}/_staged")
    BatchDocuments(path, 5).abort([None])                # nothing was staged


def test_streamed_documents(spark):
    register_documents(spark)
    source, base = f"{scratch_path(spark, 'docs')}/in", scratch_path(spark, "docs")
    docs(spark, 30).write.parquet(source)
    with stream_settings(spark):
        for _ in range(2):                               # the second run finds nothing new
            q = (spark.readStream.schema("index string, doc string").option("maxFilesPerTrigger", 1).parquet(source)
                 .writeStream.format("json_documents").option("path", f"{base}/docs").option("checkpointLocation", f"{base}/checkpoint")
                 .trigger(availableNow=True).start())
            q.awaitTermination()
    assert written(f"{base}/docs", spark) == sorted((repr(r["index"]), r["doc"]) for r in docs(spark, 30).collect())
