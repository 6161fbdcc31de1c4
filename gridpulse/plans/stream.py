"""Registered queries that run as streams over everything the tables hold."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse import schemas
from gridpulse.config import BUSINESS_ZONE, GRANULARITIES, QUARTER_HOUR, Granularity, Pipeline
from gridpulse.functions.clock import instant, iso_utc
from gridpulse.operators import gold, silver
from gridpulse.operators.layout import balance_for_write
from gridpulse.plans.common import DECIMALS, HOUSE, dense_gold, dense_readings, encoded, mixed_envelopes, portable
from gridpulse.session import job_session, shared_folder
from gridpulse.sources.events import events_stream, readings
from gridpulse.sources.files import envelope_stream, gold_table, silver_table
from gridpulse.streaming.backlog import run_backlog
from gridpulse.streaming.jobs import drain, start_gold, start_ingest, start_serving
from gridpulse.streaming.progress import throughput
from gridpulse.streaming.serving import LedgerServing
from gridpulse.streaming.state import open_windows


def backfill(spark: SparkSession, label: str) -> tuple[SparkSession, Pipeline]:
    pipeline = Pipeline(root=shared_folder(spark, label), decimals=DECIMALS).backfill()
    return job_session(spark, pipeline), pipeline


def land(envelopes: DataFrame, pipeline: Pipeline) -> str:
    """Envelopes as files, in place of a topic."""
    path = f"{pipeline.root}/landing"
    envelopes.write.parquet(path)
    return path


def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes -> Silver, read back as a table. Each landed file spans the whole month."""
    session, pipeline = backfill(spark, "ingest")
    landing = land(mixed_envelopes(session, sf_dir), pipeline)
    drain(start_ingest(envelope_stream(session, landing), pipeline, cluster=True))
    return portable(silver_table(spark, pipeline.silver).drop("timestamp"))


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read by each batch of the ingest query, added up."""
    session, pipeline = backfill(spark, "progress")
    landing = land(mixed_envelopes(session, sf_dir), pipeline)
    query = start_ingest(envelope_stream(session, landing), pipeline, cluster=True)
    drain(query)
    batches = [(name, rows) for name, _, rows, *_ in throughput(query)]
    seen = spark.createDataFrame(batches, "query STRING, input_rows BIGINT")
    return seen.groupBy("query").agg(F.sum("input_rows").alias("input_rows"))


def stream_gold_of(grain: Granularity):
    """Readings -> Gold. Windows the watermark has not passed stay open, unwritten."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        session, pipeline = backfill(spark, f"gold-{grain.name}")
        drain(start_gold(session, grain, pipeline, readings(events_stream(session, sf_dir))))
        return portable(gold_table(spark, pipeline.gold(grain)))

    return query


def stream_open_windows_of(grain: Granularity):
    """What the Gold query holds after it has read everything: the windows it has not written, read from its state."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        session, pipeline = backfill(spark, f"open-{grain.name}")
        drain(start_gold(session, grain, pipeline, readings(events_stream(session, sf_dir))))
        return portable(open_windows(session, grain, pipeline))

    return query


def gold_of_arrivals(spark: SparkSession, sf_dir: str, grain: Granularity, label: str, arrivals) -> DataFrame:
    """Gold after each arrival was appended to Silver and the query run again on its checkpoint."""
    session, pipeline = backfill(spark, f"{label}-{grain.name}")
    rows = dense_readings(session, sf_dir).drop("event_id")
    stored = silver.with_partition_keys(rows.withColumns({"timestamp": iso_utc("event_time")}), BUSINESS_ZONE)
    for arrival in arrivals(stored):
        arrived = balance_for_write(stored.filter(arrival), schemas.SILVER_PARTITIONS)
        arrived.write.mode("append").partitionBy(*schemas.SILVER_PARTITIONS).parquet(pipeline.silver)
        drain(start_gold(session, grain, pipeline))
    return portable(gold_table(spark, pipeline.gold(grain)))


def stream_late_of(grain: Granularity):
    """One house reports only after all others: most of its windows have closed by then."""

    def arrivals(stored: DataFrame):
        return F.col("house_id") != HOUSE, F.col("house_id") == HOUSE

    return lambda spark, sf_dir: gold_of_arrivals(spark, sf_dir, grain, "late", arrivals)


def stream_restart_of(grain: Granularity):
    """The first half of the time, then the second, with a restart in between."""

    def arrivals(stored: DataFrame):
        time = F.unix_micros("event_time")
        first, last = stored.agg(F.min(time), F.max(time)).first()
        middle = instant((first + last) // 2)
        return F.col("event_time") < middle, F.col("event_time") >= middle

    return lambda spark, sf_dir: gold_of_arrivals(spark, sf_dir, grain, "restart", arrivals)


APPENDS = 10


def stream_backlog_of(grain: Granularity):
    """Silver of ten appends, the last times first and every append all over the month, read in the order of time."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        session, pipeline = backfill(spark, f"backlog-{grain.name}")
        rows = dense_readings(session, sf_dir)
        dealt = F.pmod(F.floor(F.unix_micros("event_time") / F.lit(420_000_000)), F.lit(APPENDS))
        stored = silver.with_partition_keys(rows.drop("event_id").withColumns({"timestamp": iso_utc("event_time")}), BUSINESS_ZONE)
        for append in reversed(range(APPENDS)):
            arrived = balance_for_write(stored.filter(dealt == append), schemas.SILVER_PARTITIONS)
            arrived.write.mode("append").partitionBy(*schemas.SILVER_PARTITIONS).parquet(pipeline.silver)
        run_backlog(session, grain, pipeline, hours=2)
        return portable(gold_table(spark, pipeline.gold(grain)))

    return query


def stream_chain_of(grain: Granularity):
    """Envelopes -> Silver -> Gold -> serving, each query fed by the files of the one before."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        session, pipeline = backfill(spark, f"chain-{grain.name}")
        landing = land(encoded(dense_readings(session, sf_dir)), pipeline)
        serving = LedgerServing(pipeline.serving(grain), pipeline.zone).create(session)
        drain(start_ingest(envelope_stream(session, landing), pipeline))
        drain(start_gold(session, grain, pipeline))
        drain(start_serving(session, grain, pipeline, serving))
        return portable(serving.read(spark).select(*schemas.SERVING_COLUMNS))

    return query


def stream_all_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five queries; those of the two widths run side by side in one session."""
    session, pipeline = backfill(spark, "all")
    landing = land(encoded(dense_readings(session, sf_dir)), pipeline)
    tables = {g: LedgerServing(pipeline.serving(g), pipeline.zone).create(session) for g in GRANULARITIES}
    drain(start_ingest(envelope_stream(session, landing), pipeline))
    drain(*(start_gold(session, grain, pipeline) for grain in GRANULARITIES))
    drain(*(start_serving(session, grain, pipeline, table) for grain, table in tables.items()))
    served = (
        table.read(spark).select(F.lit(grain.name).alias("grain"), *schemas.SERVING_COLUMNS)
        for grain, table in tables.items()
    )
    return portable(reduce(DataFrame.unionAll, served))


def serving_replay_of(grain: Granularity):
    """Gold -> serving, then all of it again after the loss of the checkpoint."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        session, pipeline = backfill(spark, f"replay-{grain.name}")
        stored = gold.with_partition_keys(dense_gold(session, sf_dir, grain), BUSINESS_ZONE)
        rows = balance_for_write(stored, schemas.GOLD_PARTITIONS, schemas.SERVING_KEY)
        rows.write.partitionBy(*schemas.GOLD_PARTITIONS).parquet(pipeline.gold(grain))
        serving = LedgerServing(pipeline.serving(grain), pipeline.zone).create(session)
        drain(start_serving(session, grain, pipeline, serving))
        forgetful = replace(
            pipeline, root=f"{pipeline.root}/again", names={f"gold_{grain.name}": pipeline.gold(grain)}
        )
        drain(start_serving(session, grain, forgetful, serving))
        return portable(serving.read(spark).select(*schemas.SERVING_COLUMNS))

    return query


def queries() -> dict:
    registered = {
        "stream_silver": stream_silver,
        "stream_progress": stream_progress,
        "stream_all_layers": stream_all_layers,
        "stream_chain_15min": stream_chain_of(QUARTER_HOUR),
    }
    for grain in GRANULARITIES:
        registered |= {
            f"stream_gold_{grain.name}": stream_gold_of(grain),
            f"stream_open_windows_{grain.name}": stream_open_windows_of(grain),
            f"stream_backlog_{grain.name}": stream_backlog_of(grain),
            f"stream_late_{grain.name}": stream_late_of(grain),
            f"stream_restart_{grain.name}": stream_restart_of(grain),
            f"serving_replay_{grain.name}": serving_replay_of(grain),
        }
    return registered
