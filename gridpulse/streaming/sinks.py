"""Streaming sinks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def append_parquet(
    df: DataFrame,
    name: str,
    path: str,
    partition_by: Sequence[str],
    checkpoint: str,
    trigger: dict,
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Append to a partitioned Parquet table, exactly once: readers follow the sink's commit log."""
    writer = df.writeStream.queryName(name).format("parquet").outputMode("append").options(**(options or {}))
    writer = writer.partitionBy(*partition_by).option("checkpointLocation", checkpoint).option("path", path)
    return (writer.trigger(**trigger) if trigger else writer).start()


def each_batch(
    df: DataFrame, name: str, write: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict
) -> StreamingQuery:
    """Hand each micro-batch to ``write``, at least once."""
    writer = df.writeStream.queryName(name).foreachBatch(write).outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
