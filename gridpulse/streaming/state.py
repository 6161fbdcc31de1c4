"""The state of Gold queries as tables: which windows are open, what they hold, and how wide the state is.

Both read a checkpoint, so they also tell where a stopped or failed query stands.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridpulse.config import Granularity, Pipeline
from gridpulse.operators import gold


def open_windows(
    session: SparkSession, grain: Granularity, pipeline: Pipeline, *, batch_id: int | None = None
) -> DataFrame:
    """The windows that the watermark has not passed, with the means and peaks of the readings so far.

    As of the last finished batch, or of ``batch_id`` if the checkpoint still holds it. One task reads each
    partition of the state; nothing of the stored layers is read.
    """
    reader = session.read.format("statestore").option("operatorId", 0)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    state = reader.load(pipeline.checkpoint(f"gold_{grain.name}"))
    # The buffers of the state have the aggregates' names, which repeat: a cast names them anew, by place.
    buffers = zip(gold.partial_columns(pipeline.decimals), state.schema["value"].dataType.fields, strict=True)
    named = T.StructType([T.StructField(name, buffer.dataType) for name, buffer in buffers])
    keys = T.StructType.fromDDL("house_id STRING, slot STRUCT<start: TIMESTAMP, end: TIMESTAMP>")
    held = state.select(F.col("key").cast(keys).alias("key"), F.col("value").cast(named).alias("value"))
    flat = held.select("key.house_id", F.col("key.slot.start").alias("window_start"), F.col("key.slot.end").alias("window_end"), "value.*")
    return gold.finish(flat, pipeline.decimals)


def state_layout(session: SparkSession, grain: Granularity, pipeline: Pipeline) -> DataFrame:
    """(operator, partitions, first_batch, last_batch) of the stateful operators of a Gold query, as its checkpoint fixes them."""
    found = session.read.format("state-metadata").load(pipeline.checkpoint(f"gold_{grain.name}"))
    return found.select(
        F.col("operatorName").alias("operator"),
        F.col("numPartitions").alias("partitions"),
        F.col("minBatchId").alias("first_batch"),
        F.col("maxBatchId").alias("last_batch"),
    )
