"""Looking at what a checkpointed stream holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_state(spark: SparkSession, checkpoint: str, variable: str, operator: int = 0, batch: int | None = None) -> DataFrame:
    """(key, value, partition_id) of one state variable of a stateful operator,
    as of a micro-batch (the last whole one by default)."""
    reader = (spark.read.format("statestore").option("stateVarName", variable).option("operatorId", operator))
    if batch is not None:
        reader = reader.option("batchId", batch)
    return reader.load(checkpoint)
