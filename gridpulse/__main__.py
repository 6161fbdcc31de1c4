"""Run the streaming queries: ``python -m gridpulse``, or ``spark-submit run_job.py``.

    ingest   topic -> Silver
    gold     Silver -> Gold, both widths
    serve    Gold -> serving tables, both widths, and the table of houses
    all      the six queries in one process
    expire   let go of windows that are past their retention, both widths; nothing is deleted
    tables   give Gold names in the catalog, for SQL users

Settings come from ``GRIDPULSE_*`` variables; see the README.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from gridpulse.config import GRANULARITIES, Granularity, Pipeline
from gridpulse.operators.retention import ExpiringTable
from gridpulse.operators.serve import latest
from gridpulse.session import job_session
from gridpulse.sources.catalog import register
from gridpulse.sources.files import envelope_stream
from gridpulse.sources.jdbc import Database
from gridpulse.sources.kafka import topic_options, topic_stream
from gridpulse.sources.objectstore import with_object_store
from gridpulse.streaming.backlog import run_backlog
from gridpulse.streaming.jobs import drain, start_gold, start_houses, start_ingest, start_serving, wait_any
from gridpulse.streaming.progress import MetricsTable, ThroughputReport
from gridpulse.streaming.serving import JdbcServing, LedgerServing, ServingTable


def _ingest(session: SparkSession, pipeline: Pipeline, args: argparse.Namespace) -> StreamingQuery:
    if args.landing:
        envelopes = envelope_stream(session, args.landing, pipeline.max_files_per_trigger)
    else:
        options = topic_options(
            os.environ["GRIDPULSE_KAFKA_SERVERS"],
            os.environ["GRIDPULSE_KAFKA_TOPIC"],
            starting_offsets=args.starting_offsets,
            max_offsets_per_trigger=args.max_offsets,
            min_partitions=args.min_partitions,
        )
        envelopes = topic_stream(session, options)
    return start_ingest(envelopes, pipeline, cluster=args.cluster)


def _serving(session: SparkSession, pipeline: Pipeline, grain: Granularity) -> ServingTable | LedgerServing:
    if "GRIDPULSE_JDBC_URL" in os.environ:
        table = os.environ.get(f"GRIDPULSE_TABLE_{grain.name.upper()}", f"readings_{grain.name}")
        return JdbcServing(Database.from_env(), table)
    return LedgerServing(pipeline.serving(grain), pipeline.zone).create(session)


def _expire(session: SparkSession, pipeline: Pipeline) -> None:
    """Retention counts back from the latest window of each table."""
    for grain in GRANULARITIES:
        table = ExpiringTable(pipeline.gold(grain), pipeline.zone).create(session)
        last = latest(table.read(session))
        if last is not None:
            table.expire(session, last, grain.keep)
        print(f"[{table.path}] folders no longer read: {', '.join(table.expired(session)) or 'none'}")


def _tables(session: SparkSession, pipeline: Pipeline) -> None:
    for grain in GRANULARITIES:
        name = os.environ.get(f"GRIDPULSE_GOLD_TABLE_{grain.name.upper()}", f"gold_readings_{grain.name}")
        register(session, name, pipeline.gold(grain))
        print(f"[{name}] {pipeline.gold(grain)}")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="gridpulse", description="Meter telemetry on Spark")
    parser.add_argument("job", choices=("ingest", "gold", "serve", "all", "expire", "tables"))
    parser.add_argument("--once", action="store_true", help="read what has arrived, then stop")
    parser.add_argument("--landing", help="folder of Parquet envelopes to ingest instead of a topic")
    parser.add_argument(
        "--starting-offsets", default="latest", help="of the first start; with --once take 'earliest' to read a topic"
    )
    parser.add_argument("--max-offsets", type=int, help="rows a batch takes from the topic")
    parser.add_argument("--min-partitions", type=int, help="read tasks per batch of the topic")
    parser.add_argument("--cluster", action="store_true", help="shuffle Silver by hour for fewer files")
    args = parser.parse_args(argv)

    spark = with_object_store(SparkSession.builder.appName(f"gridpulse-{args.job}")).getOrCreate()
    pipeline = Pipeline.from_env()
    pipeline = pipeline.backfill() if args.once else pipeline
    session = job_session(spark, pipeline)

    steps = {
        "ingest": lambda: [_ingest(session, pipeline, args)],
        "gold": lambda: [start_gold(session, grain, pipeline) for grain in GRANULARITIES],
        "serve": lambda: [
            *(start_serving(session, grain, pipeline, _serving(session, pipeline, grain)) for grain in GRANULARITIES),
            start_houses(session, GRANULARITIES[0], pipeline),
        ],
    }
    if args.job in ("expire", "tables"):
        return {"expire": _expire, "tables": _tables}[args.job](session, pipeline)
    metrics = MetricsTable(session, pipeline.metrics)
    report = ThroughputReport()
    for listener in (report, metrics):
        session.streams.addListener(listener)
    chosen = list(steps) if args.job == "all" else [args.job]
    try:
        for step in chosen:
            if args.once and step == "gold":  # as much state at a time as a few hours need, however long the backlog
                for grain in GRANULARITIES:
                    run_backlog(session, grain, pipeline)
                continue
            queries = steps[step]()
            if args.once:  # in order, so that each step sees all the files of the one before
                drain(*queries)
                metrics.wait_for(*queries)
        if not args.once:
            wait_any(session)
    finally:
        for listener in (report, metrics):
            session.streams.removeListener(listener)


if __name__ == "__main__":
    main()
