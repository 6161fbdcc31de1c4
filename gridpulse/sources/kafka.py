"""The topic of JSON readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def topic_options(
    servers: str,
    topic: str,
    *,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source.

    ``starting_offsets`` counts on the first start only; afterwards the checkpoint
    decides. ``min_partitions`` splits a topic partition over several read tasks: a
    one-partition topic would otherwise be read by one task per batch.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def topic_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Envelopes (``value BINARY``) of a topic. Needs the Kafka connector on the classpath."""
    return spark.readStream.format("kafka").options(**options).load().select("value")
