"""The ``events`` test table seen as meter readings.

A house is an event type (five busy series), unless the caller picks another
column; ``value`` is the power drawn, a tenth of ``props.k`` the PV output, and a
reading at or above the charger's rating counts as charging.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.functions.profile import CHARGER_KW

# ``ts`` is stored as zone-less microseconds; declared as TIMESTAMP it is read as a
# UTC instant, with no work per row, and time filters still reach the scan.
EVENTS = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"

# Dense time runs 60 times faster from this instant on, so that the thin test data
# fills one-minute windows. Each clock keeps the order of the readings.
DENSE_ORIGIN_US = 1_704_067_200_000_000  # 2024-01-01T00:00:00Z
DENSE_FACTOR = 60
NOMINAL_VOLT = 230.0


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A glob, since a file stream takes a plain path for a folder and this may be one file.
    return spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/event[s].parquet")


def dense(ts: Column) -> Column:
    elapsed = F.unix_micros(ts) - F.lit(DENSE_ORIGIN_US)
    return F.timestamp_micros(F.lit(DENSE_ORIGIN_US) + F.floor(elapsed / F.lit(DENSE_FACTOR)))


def undense(ts: Column) -> Column:
    """The first instant of real time whose dense time is ``ts``."""
    return F.timestamp_micros(F.lit(DENSE_ORIGIN_US) + (F.unix_micros(ts) - F.lit(DENSE_ORIGIN_US)) * DENSE_FACTOR)


def readings(source: DataFrame, *, house: str = "event_type", clock: str = "dense") -> DataFrame:
    """Events as meter readings, in ``dense`` or ``real`` time."""
    ts = F.col("ts")
    return source.select(
        "event_id",
        F.col(house).alias("house_id"),
        (F.get_json_object("props", "$.k").try_cast("double") / F.lit(10.0)).alias("pv_panel_kw"),
        F.when(F.col("value") >= CHARGER_KW, F.lit(CHARGER_KW)).otherwise(F.lit(0.0)).alias("ev_charging_kw"),
        F.col("value").alias("power_kw"),
        F.lit(NOMINAL_VOLT).alias("voltage"),
        (dense(ts) if clock == "dense" else ts).alias("event_time"),
    )
