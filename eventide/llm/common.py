"""Small helpers shared by the operators of this subpackage.

Operators select the columns they need before anything else, so extra columns
of any name pass by untouched; internal columns start with ``ev_``.
"""

from __future__ import annotations

import sys
import types

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.session import ensure_checkpoint_dir, scratch_path

# The word rule of the mixing, SimHash and size contracts: runs of anything
# but the six ASCII white-space characters.  bytes.split() cuts at exactly these.
ASCII_SPACE = " \t\n\x0b\f\r"

MAX_LONG = (1 << 63) - 1


def save(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """Write to the shared scratch root and read back: a lineage cut that
    survives lost executors (nothing is recomputed from the source)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, purpose)
    df.write.mode("overwrite").options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def per_worker(name: str, make):
    """An object made once per Python worker and shared by its tasks."""
    shelf = sys.modules.setdefault("ev_llm_worker_shelf", types.ModuleType("ev_llm_worker_shelf"))
    if not hasattr(shelf, name):
        setattr(shelf, name, make())
    return getattr(shelf, name)


def words_count(text):
    """Number of ``[^\\x20\\x09-\\x0D]+`` runs of a text, in the JVM and in
    memory proportional to the text; null counts 0.

    After trimming, each run with the white space behind it becomes one "x".
    """
    trimmed = F.btrim(text, F.lit(ASCII_SPACE))
    marks = F.regexp_replace(trimmed, r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", "x")
    return F.coalesce(F.length(marks), F.lit(0)).cast("long")


def order_key(doc_id="doc_id"):
    """doc_id as a long that sorts null ids last."""
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(MAX_LONG))


def range_cuts(df: DataFrame, column: str, parts: int) -> list[int]:
    """At most ``parts - 1`` increasing cut values that deal a long column into
    ranges of about equal row counts (a t-digest style sketch, not a sort)."""
    if parts <= 1:
        return []
    probs = [i / parts for i in range(1, parts)]
    cuts = df.stat.approxQuantile(column, probs, 0.25 / parts)
    return sorted({int(c) for c in cuts})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
