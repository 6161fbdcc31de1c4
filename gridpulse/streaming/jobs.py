"""The five streaming queries.

    envelopes -> Silver                     stateless
    Silver    -> Gold, once per width       stateful, exactly once
    Gold      -> serving, once per width    stateless, replay-safe

Each aggregate is computed and held in state once: the serving queries follow the
Gold files instead of aggregating Silver again, and so lag by up to one trigger.
The 15-minute roll-up reads Silver, not the 1-minute one: a mean of means would be
wrong, and a reading too late for its minute may still be in time for its quarter.

Start the queries of one process from the same ``job_session``, so that
``wait_any`` sees them all.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridpulse import schemas
from gridpulse.config import Granularity, Pipeline
from gridpulse.operators import gold
from gridpulse.operators.layout import balance_for_write, cluster_for_write, tasks_for
from gridpulse.operators.silver import silver
from gridpulse.sources.catalog import house_options
from gridpulse.sources.files import exists, gold_stream, silver_stream
from gridpulse.streaming.progress import metrics_table
from gridpulse.streaming.serving import LedgerServing, ServingTable, ledgered, replay_safe
from gridpulse.streaming.sinks import append_parquet, each_batch


#: Name of the counts that an ingest query reports with each batch.
INGESTED = "ingested"
#: And of those of a Gold query.
ROLLED = "rolled"


def start_ingest(envelopes: DataFrame, pipeline: Pipeline, *, cluster: bool = False) -> StreamingQuery:
    """Envelopes to Silver.

    Each task writes what it read, with no shuffle: the slice of a topic that one
    task reads spans few hours. ``cluster`` shuffles by hour instead, for sources
    whose slices each span many hours, where every task would leave a file in every
    hour. Adaptive execution, which covers stateless streams, splits a hot hour.
    """
    rows = silver(envelopes, pipeline.zone, observed_as=INGESTED)
    if cluster:
        rows = balance_for_write(rows, schemas.SILVER_PARTITIONS)
    return append_parquet(
        rows,
        "silver",
        pipeline.silver,
        schemas.SILVER_PARTITIONS,
        pipeline.checkpoint("silver"),
        pipeline.trigger(pipeline.ingest_trigger),
    )


def gold_rows(readings: DataFrame, grain: Granularity, pipeline: Pipeline) -> DataFrame:
    rolled = gold.roll_up(readings, grain.width, lateness=pipeline.lateness, decimals=pipeline.decimals)
    keyed = gold.with_partition_keys(rolled, pipeline.zone)
    if readings.isStreaming:
        keyed = keyed.observe(ROLLED, F.count(F.lit(1)).alias("written"))
    return cluster_for_write(
        keyed,
        schemas.GOLD_PARTITIONS,
        pipeline.write_width,
        salt=pipeline.write_salt,
        spread_by=schemas.SERVING_KEY,
    )


#: Batches of a query that say how much the next ones will write.
MEASURED_BATCHES = 60


def measured(session: SparkSession, grain: Granularity, pipeline: Pipeline) -> Pipeline:
    """The pipeline with as many writers of an hour as its last batches call for; unchanged where none is measured.

    A live batch writes windows of one hour, or two at the turn of an hour, so its rows are those of an hour. The greatest of the last
    batches counts: too many small files of a quiet hour cost less than one task that writes a busy one.
    """
    if not pipeline.write_width or not exists(session, pipeline.metrics):
        return pipeline
    mine = metrics_table(session, pipeline.metrics).where((F.col("query") == f"gold_{grain.name}") & (F.col("written") > 0))
    most = mine.orderBy(F.desc("day"), F.desc("at")).limit(MEASURED_BATCHES).agg(F.max("written")).first()[0]
    if most is None:
        return pipeline
    tasks = tasks_for(most, pipeline.rows_per_file, pipeline.most_writers)
    return replace(pipeline, write_salt=tasks, write_width=2 * tasks)  # hashes leave some tasks without an hour


def ready(session: SparkSession, path: str, schema: str, partition_by: tuple[str, ...]) -> None:
    """Make a folder that a stream will read, if no query has written to it yet."""
    if not exists(session, path):
        session.createDataFrame([], schema).write.mode("append").partitionBy(*partition_by).parquet(path)


def start_gold(
    session: SparkSession, grain: Granularity, pipeline: Pipeline, readings: DataFrame | None = None
) -> StreamingQuery:
    """Silver, or another stream of readings, to Gold.

    A batch takes all files that wait. Steps of a few files would move the watermark past rows of
    a backlog that was not written in the order of time, and lose them; ``backlog.run_backlog`` takes its folders in that order.
    """
    if readings is None:
        ready(session, pipeline.silver, schemas.SILVER, schemas.SILVER_PARTITIONS)
        readings = silver_stream(session, pipeline.silver)
    return append_parquet(
        gold_rows(readings, grain, measured(session, grain, pipeline)),
        f"gold_{grain.name}",
        pipeline.gold(grain),
        schemas.GOLD_PARTITIONS,
        pipeline.checkpoint(f"gold_{grain.name}"),
        pipeline.trigger(pipeline.gold_trigger),
        house_options(),
    )


def start_houses(session: SparkSession, grain: Granularity, pipeline: Pipeline) -> StreamingQuery:
    """Gold to the table of houses, each once: the state and the table hold a row per house, however much Gold there is."""
    ready(session, pipeline.gold(grain), schemas.GOLD, schemas.GOLD_PARTITIONS)
    seen = gold_stream(session, pipeline.gold(grain), pipeline.max_files_per_trigger).select("house_id")
    return append_parquet(
        seen.dropDuplicates(["house_id"]), "houses", pipeline.houses, (), pipeline.checkpoint("houses"), pipeline.trigger(pipeline.gold_trigger)
    )


def start_serving(
    session: SparkSession, grain: Granularity, pipeline: Pipeline, table: ServingTable | LedgerServing
) -> StreamingQuery:
    """Gold to a serving table."""
    checkpoint = pipeline.checkpoint(f"serving_{grain.name}")
    ready(session, pipeline.gold(grain), schemas.GOLD, schemas.GOLD_PARTITIONS)
    return each_batch(
        gold_stream(session, pipeline.gold(grain), pipeline.max_files_per_trigger),
        f"serving_{grain.name}",
        ledgered(table, checkpoint) if isinstance(table, LedgerServing) else replay_safe(table),
        checkpoint,
        pipeline.trigger(pipeline.gold_trigger),
    )


def wait_any(session: SparkSession) -> None:
    """Return when a query of the session stops; raise if one failed."""
    session.streams.awaitAnyTermination()


def drain(*queries: StreamingQuery) -> None:
    """Wait until queries with a bounded trigger have read everything; raise if one failed."""
    for query in queries:
        query.awaitTermination()
