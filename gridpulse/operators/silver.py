"""From JSON envelopes to clean readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.functions import wire
from gridpulse.functions.clock import local_date, local_hour, parse_instant


def parse(envelopes: DataFrame) -> DataFrame:
    """The declared fields of each payload; all null where the payload is no reading.

    ``inline`` of the one decoded struct, rather than a projection of its fields,
    keeps the JSON parser at one run per row: a filter on the fields would be pushed
    below a projection together with a copy of the parser for each field it tests.
    """
    return envelopes.select(F.inline(F.array(wire.decode("value"))))


def clean(parsed: DataFrame, *, observed_as: str | None = None) -> DataFrame:
    """Keep rows with a house and a readable time; add the time as an instant.

    ``observed_as`` names counts that Spark collects on the way: rows read, and of these the ones that are dropped for want of a house
    and for want of a time.
    """
    row = F.struct(*parsed.columns, parse_instant("timestamp").alias("event_time"))
    timed = parsed.select(F.inline(F.array(row)))  # as in parse: the filter reads the time, it does not parse it again
    if observed_as:
        no_house, no_time = F.col("house_id").isNull(), F.col("event_time").isNull()
        timed = timed.observe(
            observed_as,
            F.count(F.lit(1)).alias("read"),
            F.count(F.when(no_house & ~no_time, 1)).alias("no_house"),
            F.count(F.when(no_time, 1)).alias("no_time"),
        )
    return timed.dropna(subset=["house_id", "event_time"])


def with_partition_keys(readings: DataFrame, zone: str) -> DataFrame:
    """The local date and hour a reading is stored under."""
    return readings.withColumns(
        {"dt": local_date("event_time", zone), "hour": local_hour("event_time", zone)}
    )


def silver(envelopes: DataFrame, zone: str, *, observed_as: str | None = None) -> DataFrame:
    return with_partition_keys(clean(parse(envelopes), observed_as=observed_as), zone)
