"""Serving tables that a replayed micro-batch does not double."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse import schemas
from gridpulse.operators.gold import with_partition_keys
from gridpulse.operators.layout import balance_for_write
from gridpulse.operators.serve import in_range, to_serving
from gridpulse.sources.files import gold_table
from gridpulse.sources.jdbc import Database, serving_slice


class ServingTable(Protocol):
    """What the sink needs of a table. One writer per table."""

    def slice(self, spark: SparkSession, since: int, until: int) -> DataFrame:
        """The rows with window_start in [since, until], in epoch microseconds, filtered by the store."""

    def append(self, rows: DataFrame) -> None: ...


@dataclass(frozen=True)
class JdbcServing:
    """A table of a SQL database, created beforehand from ``sources.jdbc.serving_ddl``."""

    database: Database
    table: str

    def slice(self, spark: SparkSession, since: int, until: int) -> DataFrame:
        return serving_slice(spark, self.database, self.table, since, until)

    def append(self, rows: DataFrame) -> None:
        rows.write.format("jdbc").options(**self.database.write_options(self.table)).mode("append").save()


@dataclass(frozen=True)
class ParquetServing:
    """A Parquet folder with the same seven columns, stored by local date and hour."""

    path: str
    zone: str

    def create(self, spark: SparkSession) -> ParquetServing:
        empty = spark.createDataFrame([], schemas.GOLD)
        empty.write.mode("append").partitionBy(*schemas.GOLD_PARTITIONS).parquet(self.path)
        return self

    def read(self, spark: SparkSession) -> DataFrame:
        return gold_table(spark, self.path)

    def slice(self, spark: SparkSession, since: int, until: int) -> DataFrame:
        return in_range(self.read(spark), since, until)

    def append(self, rows: DataFrame) -> None:
        # Without this, each task of the join would leave a file in each hour.
        stored = balance_for_write(
            with_partition_keys(rows, self.zone), schemas.GOLD_PARTITIONS, schemas.SERVING_KEY
        )
        stored.write.mode("append").partitionBy(*schemas.GOLD_PARTITIONS).parquet(self.path)


LEDGER = "writer STRING, batch BIGINT, event_date DATE, hour INT, n_rows BIGINT"


@dataclass
class LedgerServing:
    """A Parquet table to which a replayed batch is written again in place, so that nothing is read back.

    Below each date and hour, every batch of every query has a folder of its own, which dynamic partition overwrite replaces as
    a whole. A ledger names the folders that a batch is about to write, before it does. A query whose checkpoint was lost starts
    anew under another name, and only then, and only in folders that the ledger says others have written, are keys compared.

    One query writes at a time; the ledger is read once, when it starts.
    """

    path: str
    zone: str
    _others: dict[str, set] = field(default_factory=dict, repr=False)

    def create(self, spark: SparkSession) -> LedgerServing:
        spark.createDataFrame([], LEDGER).write.mode("append").parquet(f"{self.path}/_ledger")
        return self

    def ledger(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(LEDGER).parquet(f"{self.path}/_ledger")

    def _stored(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"{schemas.GOLD}, writer STRING, batch BIGINT").parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._stored(spark).drop("writer", "batch")

    def others(self, spark: SparkSession, writer: str) -> set:
        """(date, hour) of folders that other queries have written."""
        if writer not in self._others:
            found = self.ledger(spark).where(F.col("writer") != writer).select(*schemas.GOLD_PARTITIONS).distinct()
            self._others[writer] = {tuple(r) for r in found.collect()}
        return self._others[writer]

    def held(self, spark: SparkSession, writer: str, folders: set) -> DataFrame:
        """Keys of other queries' rows in the given folders."""
        hours = defaultdict(list)
        for date, hour in folders:
            hours[date].append(hour)
        of_date = (((F.col("event_date") == F.lit(d)) & F.col("hour").isin(h)) for d, h in sorted(hours.items()))
        chosen = self._stored(spark).where(reduce(lambda a, b: a | b, of_date)).where(F.col("writer") != writer)
        return chosen.select(*schemas.SERVING_KEY)

    def store(self, batch: DataFrame, batch_id: int, writer: str) -> None:
        """Write a batch, which may be empty. The driver sees only its dates and hours."""
        spark = batch.sparkSession
        keyed = with_partition_keys(schemas.not_null(to_serving(batch), "window_start", "window_end"), self.zone)
        touched = [tuple(r) for r in keyed.groupBy(*schemas.GOLD_PARTITIONS).count().collect()]
        if not touched:
            return
        entry = spark.createDataFrame([(writer, batch_id, *folder) for folder in touched], LEDGER)
        entry.coalesce(1).write.mode("append").parquet(f"{self.path}/_ledger")
        if shared := {folder[:2] for folder in touched} & self.others(spark, writer):
            keyed = keyed.join(self.held(spark, writer, shared), list(schemas.SERVING_KEY), "left_anti")
        rows = keyed.withColumns({"writer": F.lit(writer), "batch": F.lit(batch_id).cast("bigint")})
        rows = balance_for_write(rows, schemas.GOLD_PARTITIONS, schemas.SERVING_KEY)
        saving = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        saving.partitionBy(*schemas.GOLD_PARTITIONS, "writer", "batch").parquet(self.path)


def ledgered(table: LedgerServing, checkpoint: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer for a table with a ledger. The query goes by the id in its checkpoint, which outlives restarts."""
    known = []

    def write(batch: DataFrame, batch_id: int) -> None:
        if not known:
            known.append(batch.sparkSession.read.schema("id STRING").json(f"{checkpoint}/metadata").first()["id"])
        table.store(batch, batch_id, known[0])

    return write


def replay_safe(table: ServingTable) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer that appends the rows the table does not hold yet.

    A batch that failed halfway, or one replayed after a lost checkpoint, adds only
    what is missing. Keys are compared within the time span of the batch, so the
    read back does not grow with the table. An empty batch has no span and writes
    nothing.

    The batch is read twice, so it has to come from a stateless stream such as the
    files of Gold.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        start = F.col("window_start")
        since, until = batch.agg(F.unix_micros(F.min(start)), F.unix_micros(F.max(start))).first()
        if since is None:
            return
        held = table.slice(batch.sparkSession, since, until).select(*schemas.SERVING_KEY)
        fresh = to_serving(batch).join(held, list(schemas.SERVING_KEY), "left_anti")
        table.append(schemas.not_null(fresh, "window_start", "window_end"))

    return write
