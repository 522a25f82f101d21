"""Mixing sources to target weights by Sainte-Lague apportionment.

Targets.  Sources, in code-point order with null last, weigh 1, 2, 3, 1, 2, ...
and share all words by weight; a source stops at ``MAX_REPEATS`` times its own
size and the excess is shared again by weight until none is above.

Quotas.  The total is cut into blocks of ``BLOCK_WORDS`` words, dealt to
sources by highest quotients target / (2 a + 1), then a source's blocks to its
shards by highest quotients size / (2 a + 1).  Both are found by bisecting the
common divisor and settling the last few blocks by their quotients.

Selection.  A shard's documents stand in a seeded order and form a ring of
blocks.  The shard takes its quota from a seeded place on: whole rounds repeat
every document, the rest is one run, so at most two documents a shard are cut.
Document words taken are counted exactly, and the same seed gives the same mix.

Skew: a source is spread over up to ``BUCKETS`` shards of about ``SHARD_DOCS``
documents by a hash of doc_id and text, so a hot source is many tasks, and so
are the rows of a null or repeated doc_id; only rows alike in both share one.  What reaches the
driver is one row a source; quotas of one source's shards (at most ``BUCKETS``
rows) are settled in one group.

Defined cases: a null or wordless text has size 0 and takes 0 words; a null
source is a source of its own, the last; repeated rows count as often as they
occur and stand side by side; rows of a null or repeated doc_id are dealt by
their texts; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import ASCII_SPACE, save, words_count

BLOCK_WORDS = 16
MAX_REPEATS = 3
WEIGHTS = (1.0, 2.0, 3.0)
SEED = 17
BUCKETS = 16384
SHARD_DOCS = 4096
# Source rows (a name and a number) that are sent to every task at most.
BROADCAST_SOURCES = 100_000


def targets(sizes: list[int], weights: list[float], repeats: int = MAX_REPEATS) -> list[float]:
    """Shares of sum(sizes) by weight, each at most ``repeats`` times its size."""
    left, share = float(sum(sizes)), [0.0] * len(sizes)
    open_ = set(range(len(sizes)))
    while open_:
        per = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if per * weights[i] > repeats * sizes[i]]
        if not full:
            for i in open_:
                share[i] = per * weights[i]
            break
        for i in full:
            share[i] = float(repeats * sizes[i])
        left -= sum(share[i] for i in full)
        open_ -= set(full)
    return share


def sainte_lague(votes: np.ndarray, seats: int) -> np.ndarray:
    """Seats by highest quotients votes / (2 a + 1); ties to the earlier party."""
    votes = np.asarray(votes, np.float64)
    won = np.zeros(len(votes), np.int64)
    total = votes.sum()
    if seats <= 0 or total <= 0:
        return won
    # Bisect the divisor d: a party holds round(votes / d) seats.
    low, high = total / (seats + len(votes) + 1), 2 * total / max(seats - len(votes), 1) + total
    for _ in range(200):
        mid = (low + high) / 2
        if mid in (low, high):
            break
        if np.floor(votes / mid + 0.5).sum() > seats:
            low = mid
        else:
            high = mid
    won = np.floor(votes / high + 0.5).astype(np.int64)
    while (short := seats - int(won.sum())) > 0:                 # equal quotients at the edge
        quotient = votes / (2 * won + 1)
        won[np.argsort(-quotient, kind="stable")[:min(short, int((quotient == quotient.max()).sum()))]] += 1
    return won


def _keyed(docs: DataFrame, seed: int) -> DataFrame:
    ident = F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), F.col("text").cast("string"))
    return docs.select(
        "*", words_count(F.col("text").cast("string")).alias("ev_size"),
        F.col("source").isNull().alias("ev_null"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("ev_source"),
        F.pmod(ident, F.lit(BUCKETS)).cast("int").alias("ev_bucket"), ident.alias("ev_order"))


def _plan(keyed: DataFrame, weights, repeats: int, block: int, shard_docs: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """A row for each (source, shard): words to take, shard size, source size and
    target; and the number of shards of each source."""
    spark = keyed.sparkSession
    buckets = save(keyed.groupBy("ev_null", "ev_source", "ev_bucket").agg(
        F.sum("ev_size").alias("size"), F.count("*").alias("n")), "mix-buckets")
    found = buckets.groupBy("ev_null", "ev_source").agg(F.sum("size").alias("size"), F.sum("n").alias("n")).collect()
    found.sort(key=lambda r: (r["ev_null"], r["ev_source"].encode("utf-32-be")))
    sizes = [r["size"] for r in found]
    aims = targets(sizes, [weights[i % len(weights)] for i in range(len(found))], repeats)
    quotas = sainte_lague(np.array(aims), round(sum(sizes) / block)) if found else np.zeros(0, np.int64)
    rows = []
    for r, aim, quota in zip(found, aims, quotas.tolist(), strict=True):
        rows.append((r["ev_null"], r["ev_source"], r["size"], aim, quota, min(BUCKETS, -(-r["n"] // shard_docs))))
    sources = spark.createDataFrame(rows, T.StructType([
        T.StructField("ev_null", T.BooleanType()), T.StructField("ev_source", T.StringType()),
        T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType()),
        T.StructField("quota", T.LongType()), T.StructField("shards", T.IntegerType())]))
    if len(rows) <= BROADCAST_SOURCES:      # a row for each source; beyond, an ordinary join
        sources = F.broadcast(sources)
    shards = (buckets.join(sources, ["ev_null", "ev_source"])
              .withColumn("ev_shard", (F.col("ev_bucket") % F.col("shards")).cast("int"))
              .groupBy("ev_null", "ev_source", "ev_shard", "shards", "source_size", "target", "quota")
              .agg(F.sum("size").alias("shard_size")))

    def settle(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("ev_shard", kind="stable").reset_index(drop=True)
        size = frame["shard_size"].to_numpy()
        take = np.minimum(block * sainte_lague(size, int(frame["quota"].iloc[0])), repeats * size)
        return frame.assign(take=take)[["ev_null", "ev_source", "ev_shard", "shards", "source_size", "target", "shard_size", "take"]]

    plan = shards.groupBy("ev_null", "ev_source").applyInPandas(
        settle, "ev_null boolean, ev_source string, ev_shard int, shards int, source_size long, target double, "
                "shard_size long, take long")
    return plan, sources.select("ev_null", "ev_source", F.col("shards").alias("ev_shards"))


def mix(docs: DataFrame, weights=WEIGHTS, repeats: int = MAX_REPEATS, block: int = BLOCK_WORDS,
        shard_docs: int = SHARD_DOCS, seed: int = SEED) -> DataFrame:
    """docs with ev_size, ev_source_size, ev_target and, of each document's
    words, ev_rounds (whole repeats) and the words [ev_from, ev_to) of the last
    one, or from ev_from2 = 0 to ev_to2 where the run wraps round the ring."""
    keyed = _keyed(docs, seed)
    plan, sources = _plan(keyed, weights, repeats, block, shard_docs, seed)
    plan = save(plan, "mix-plan")
    placed = (keyed.join(sources, ["ev_null", "ev_source"])
              .withColumn("ev_shard", (F.col("ev_bucket") % F.col("ev_shards")).cast("int")))
    plan = plan.drop("shards")
    for c in ("source_size", "target", "shard_size", "take"):
        plan = plan.withColumnRenamed(c, f"ev_{c}")
    key = ["ev_null", "ev_source", "ev_shard"]
    order = W.partitionBy(*key).orderBy("ev_order", "doc_id", "ev_size")
    before = F.sum("ev_size").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("ev_size")
    df = placed.withColumn("ev_at", before).join(plan, key)
    size, ring = F.col("ev_size"), F.greatest(F.col("ev_shard_size"), F.lit(1))
    # Whole rounds, then a run of ``rest`` words from a seeded block on.
    blocks = F.floor((ring + (block - 1)) / block)
    begin = F.pmod(F.xxhash64(F.lit(seed + 1), "ev_null", "ev_source", "ev_shard"), blocks) * block
    df = (df.withColumn("ev_rounds", F.floor(F.col("ev_take") / ring).cast("long"))
          .withColumn("ev_rest", (F.col("ev_take") % ring).cast("long"))
          .withColumn("ev_begin", F.least(begin, ring - 1).cast("long")))
    at, end, wrap = F.col("ev_at"), F.col("ev_begin") + F.col("ev_rest"), F.col("ev_begin") + F.col("ev_rest") - ring
    inside = lambda x: F.least(F.greatest(x - at, F.lit(0)), size).cast("long")
    df = (df.withColumn("ev_from", inside(F.col("ev_begin"))).withColumn("ev_to", inside(F.least(end, ring)))
          .withColumn("ev_to2", inside(wrap)))
    return df.withColumn("ev_taken", F.col("ev_rounds") * size + F.col("ev_to") - F.col("ev_from") + F.col("ev_to2"))


def mixed_sizes(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row."""
    rows = docs.select("doc_id", "text", "source")
    return mix(rows, **options).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("ev_size").alias("size"),
        F.col("ev_source_size").alias("source_size"), F.col("ev_target").alias("target"), F.col("ev_taken").alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, with the columns of docs: a row for every whole repeat
    of a document and one for each run of words taken beside; documents that
    give no word go.  A cut text holds the words of its run, one space between
    them; an ``n_chars`` column of cut rows is set to the new length."""
    df = mix(docs, **options)
    size, a, b, c = (F.col(f"ev_{x}") for x in ("size", "from", "to", "to2"))
    run = lambda lo, hi: F.struct(lo.alias("lo"), hi.alias("hi"))
    whole = run(F.lit(0).cast("long"), size)
    rounds = F.when(F.col("ev_rounds") > 0, F.array_repeat(whole, F.col("ev_rounds").cast("int")))
    none = F.array().cast("array<struct<lo:bigint,hi:bigint>>")
    runs = F.concat(F.coalesce(rounds, none), F.when(b > a, F.array(run(a, b))).otherwise(none),
                    F.when(c > 0, F.array(run(F.lit(0).cast("long"), c))).otherwise(none))
    df = df.filter("ev_taken > 0").withColumn("ev_run", F.explode(runs))
    lo, hi = F.col("ev_run.lo"), F.col("ev_run.hi")
    cut = hi - lo < size
    words = F.split(F.btrim(F.col("text").cast("string"), F.lit(ASCII_SPACE)), r"[\x20\x09-\x0D]+")
    part = F.array_join(F.slice(words, (lo + 1).cast("int"), (hi - lo).cast("int")), " ")
    text = F.when(cut, part).otherwise(F.col("text"))
    made = {"text": text}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        made["n_chars"] = F.when(cut, F.length(part).cast(kind)).otherwise(F.col("n_chars"))
    return df.select(*[made[x].alias(x) if x in made else F.col(f"`{x}`") for x in docs.columns])
