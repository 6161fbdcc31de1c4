"""What the registered queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridpulse.config import Granularity
from gridpulse.functions import wire
from gridpulse.functions.clock import iso_utc
from gridpulse.operators.gold import roll_up
from gridpulse.sources.events import events, readings

HOUSE = "click"  # the house the dashboards show
DECIMALS = 3  # resolution of the test readings


def portable(df: DataFrame) -> DataFrame:
    """Instants as epoch microseconds and dates as text, alike in every engine and zone."""
    shown = {T.TimestampType: F.unix_micros, T.DateType: lambda c: F.col(c).cast("string")}
    return df.withColumns({f.name: shown[type(f.dataType)](f.name) for f in df.schema if type(f.dataType) in shown})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dense_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(events(spark, sf_dir))


def real_readings(spark: SparkSession, sf_dir: str, house: str = "event_type") -> DataFrame:
    return readings(events(spark, sf_dir), house=house, clock="real")


def dense_gold(spark: SparkSession, sf_dir: str, grain: Granularity) -> DataFrame:
    return roll_up(dense_readings(spark, sf_dir), grain.width, decimals=DECIMALS)


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """The rows, dealt out by hash to as many tasks as the session has for them.

    A table may be one file of one row group, which one task reads. Whatever is made of its rows, and of the files they are landed in,
    would be that task's alone. A fixed number of tasks, so that adaptive execution does not merge them for being few bytes.
    """
    spark = rows.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(tasks, *keys)


def encoded(rows: DataFrame) -> DataFrame:
    """Readings as JSON envelopes."""
    rows = spread(rows, "event_id", "event_time")
    fields = ("house_id", "pv_panel_kw", "ev_charging_kw", "power_kw", "voltage")
    return rows.select(wire.encode(iso_utc("event_time").alias("timestamp"), *fields).alias("value"))


def mixed_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic with every kind of payload, from whole tables.

    Readings (numeric house ids); documents as they are, which are no JSON; documents
    filed as readings, with a text for a time and for a voltage; and JSON objects of
    other fields.
    """
    misfiled = wire.encode(
        F.col("doc_id").alias("house_id"),
        F.col("text").alias("timestamp"),
        F.col("n_chars").alias("power_kw"),
        F.col("lang").alias("voltage"),
    )
    both = F.array(F.col("text").cast("binary"), misfiled)
    documents = spread(table(spark, sf_dir, "documents"), "doc_id").select(F.explode(both).alias("value"))
    foreign = spread(table(spark, sf_dir, "conversations"), "conv_id", "turn").select(
        wire.encode("conv_id", "turn", "role", "text").alias("value")
    )
    sent = encoded(real_readings(spark, sf_dir, house="user_id"))
    return sent.unionAll(documents).unionAll(foreign)


def null_key_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings that each lack one thing: the house, with a readable time; a readable time, with a house; and a metric, for which
    they send a text, with both keys."""
    rows = spread(real_readings(spark, sf_dir), "event_id", "event_time")
    time = iso_utc("event_time").alias("timestamp")
    house = F.when(F.col("house_id") != HOUSE, F.col("house_id")).alias("house_id")
    no_house = wire.encode(house, time, "pv_panel_kw", "power_kw")
    no_time = wire.encode("house_id", F.col("house_id").alias("timestamp"), "power_kw", "voltage")
    no_metric = wire.encode("house_id", time, F.col("house_id").alias("pv_panel_kw"), "power_kw")
    return rows.select(F.explode(F.array(no_house, no_time, no_metric)).alias("value"))
