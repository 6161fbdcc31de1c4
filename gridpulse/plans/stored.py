"""Registered queries over stored Gold: dashboard questions, expiry, and the tables that follow it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse import schemas
from gridpulse.config import BUSINESS_ZONE, GRANULARITIES, ONE_MINUTE, Granularity, Pipeline
from gridpulse.functions.clock import instant, minus
from gridpulse.operators import gold, serve
from gridpulse.operators.retention import ExpiringTable
from gridpulse.plans.batch import PANEL_STATEMENT
from gridpulse.plans.common import DECIMALS, HOUSE, dense_gold, dense_readings, encoded, mixed_envelopes, null_key_envelopes, portable, real_readings
from gridpulse.plans.stream import backfill, land
from gridpulse.session import job_session, shared_folder
from gridpulse.sources.catalog import register, store_gold
from gridpulse.sources.files import envelope_stream, gold_table, house_table
from gridpulse.streaming.jobs import drain, start_gold, start_houses, start_ingest, start_serving
from gridpulse.streaming.progress import MetricsTable, metrics_table
from gridpulse.streaming.serving import LedgerServing


def stored_gold(spark: SparkSession, sf_dir: str, grain: Granularity) -> str:
    """Gold of the test readings, written by date and hour and in the order of houses; its path."""
    path = shared_folder(spark, f"stored-{grain.name}")
    session = job_session(spark, Pipeline(root=path))
    store_gold(gold.with_partition_keys(dense_gold(session, sf_dir, grain), BUSINESS_ZONE), path)
    return path


def stored_panel_of(grain: Granularity, metric: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(serve.panel(gold_table(spark, stored_gold(spark, sf_dir, grain)), HOUSE, metric))

    return query


def stored_range_of(grain: Granularity):
    """The default dashboard range, counted back from the latest stored window; other date folders are not read."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        table = gold_table(spark, stored_gold(spark, sf_dir, grain))
        until = instant(serve.latest(table))
        return portable(serve.panel(table, HOUSE, "power", since=minus(until, grain.dashboard_range), until=until))

    return query


def stored_peek_of(grain: Granularity):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        table = gold_table(spark, stored_gold(spark, sf_dir, grain))
        return portable(serve.to_serving(serve.peek(table, 10)))

    return query


def stored_sql_of(grain: Granularity):
    """A dashboard's own SQL over a table of the catalog."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = stored_gold(spark, sf_dir, grain)
        name = f"gold_{path.rsplit('-', 1)[1]}"
        register(spark, name, path)
        return portable(serve.panel_sql(spark, PANEL_STATEMENT.replace("readings_rolled_up", name), HOUSE))

    return query


def expire_of(grain: Granularity):
    """Gold of the whole month in real time, expired three days before its end and again at its end."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = shared_folder(spark, f"expire-{grain.name}")
        session = job_session(spark, Pipeline(root=path))
        rolled = gold.roll_up(real_readings(session, sf_dir), grain.width, decimals=DECIMALS)
        store_gold(gold.with_partition_keys(rolled, BUSINESS_ZONE), path)
        table = ExpiringTable(path, BUSINESS_ZONE).create(session)
        anchor = instant(serve.latest(gold_table(session, path)))
        table.expire(session, minus(anchor, "3 days"), grain.keep)
        table.expire(session, anchor, grain.keep)
        return portable(serve.to_serving(table.read(spark)))

    return query


def stream_houses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The house list, kept by a stream that follows Gold; Gold itself is not scanned for it."""
    session, pipeline = backfill(spark, "houses")
    rows = gold.with_partition_keys(dense_gold(session, sf_dir, ONE_MINUTE), BUSINESS_ZONE)
    middle = F.col("house_id") < HOUSE
    for arrival in (middle, ~middle, F.col("house_id") == HOUSE):  # houses come again, and a restart lies between arrivals
        store_gold(rows.where(arrival), pipeline.gold(ONE_MINUTE), mode="append")
        drain(start_houses(session, ONE_MINUTE, pipeline))
    return serve.house_list(house_table(spark, pipeline.houses))


def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the batches of an ingest and a Gold query reported, added up by query."""
    session, pipeline = backfill(spark, "metrics")
    metrics = MetricsTable(session, pipeline.metrics)
    session.streams.addListener(metrics)
    try:
        envelopes = mixed_envelopes(session, sf_dir).unionAll(null_key_envelopes(session, sf_dir))
        ingest = start_ingest(envelope_stream(session, land(envelopes, pipeline)), pipeline, cluster=True)
        drain(ingest)
        rolling = start_gold(session, ONE_MINUTE, pipeline)
        drain(rolling)
        metrics.wait_for(ingest, rolling)
    finally:
        session.streams.removeListener(metrics)
    counts = ("input_rows", "no_house", "no_time", "late_rows", "written")
    return metrics_table(spark, pipeline.metrics).groupBy("query").agg(*(F.sum(c).alias(c) for c in counts))


ARRIVALS = 3


def stream_live_of(grain: Granularity):
    """Gold and serving run on a trigger while Silver grows; each third of the time arrives as one batch of ingest."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        pipeline = Pipeline(root=shared_folder(spark, f"live-{grain.name}"), decimals=DECIMALS, gold_trigger="1 second")
        session, once = job_session(spark, pipeline), pipeline.backfill()
        rows = dense_readings(session, sf_dir)
        time = F.unix_micros("event_time")
        first, last = rows.agg(F.min(time), F.max(time)).first()
        third = F.least(F.lit(ARRIVALS - 1), F.floor((time - first) * ARRIVALS / (last - first + 1)))
        table, live = LedgerServing(pipeline.serving(grain), pipeline.zone).create(session), []
        try:
            for arrival in range(ARRIVALS):
                landing = f"{pipeline.root}/landing/{arrival}"
                encoded(rows.where(third == arrival)).write.parquet(landing)
                drain(start_ingest(envelope_stream(session, f"{pipeline.root}/landing/*"), once))
                if not live:  # a stream needs its folder to be there
                    live.append(start_gold(session, grain, pipeline))
                live[0].processAllAvailable()
                if len(live) == 1:
                    live.append(start_serving(session, grain, pipeline, table))
                live[1].processAllAvailable()
        finally:
            for running in live:
                running.stop()
        return portable(table.read(spark).select(*schemas.SERVING_COLUMNS))

    return query


def queries() -> dict:
    registered = {"stream_houses": stream_houses, "stream_metrics": stream_metrics}
    for grain in GRANULARITIES:
        registered |= {
            f"stored_range_{grain.name}": stored_range_of(grain),
            f"stored_peek_{grain.name}": stored_peek_of(grain),
            f"stored_sql_{grain.name}": stored_sql_of(grain),
            f"expire_{grain.name}": expire_of(grain),
            f"stream_live_{grain.name}": stream_live_of(grain),
        }
        registered |= {f"stored_panel_{m}_{grain.name}": stored_panel_of(grain, m) for m in serve.PANELS}
    return registered
