"""Expiry of old windows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from gridpulse import schemas
from gridpulse.functions.clock import Moment, instant, local_date, minus
from gridpulse.operators.layout import balance_for_write
from gridpulse.operators.serve import in_range
from gridpulse.sources.catalog import store_gold
from gridpulse.sources.files import gold_table


def retain(table: DataFrame, anchor: Moment, keep: str) -> DataFrame:
    """Windows that started at most ``keep`` before ``anchor``; old date folders are not read."""
    return in_range(table, minus(instant(anchor), keep), None)


def expire(gold: DataFrame, path: str, anchor: Moment, keep: str) -> None:
    """Write what ``retain`` keeps to a new table; the caller switches readers to it."""
    kept = balance_for_write(retain(gold, anchor, keep), schemas.GOLD_PARTITIONS, schemas.SERVING_KEY)
    kept.write.partitionBy(*schemas.GOLD_PARTITIONS).parquet(path)


# --- expiry by folder -----------------------------------------------------------------

EXPIRIES = "version BIGINT, cutoff BIGINT, boundary DATE, kept STRING"


@dataclass(frozen=True)
class ExpiringTable:
    """A stored Gold table whose old windows leave by whole days.

    Each expiry adds a row to a list beside the table: the earliest window start that stays, the local day it falls into, and where what
    stays of that one day was written anew. Days before it are no longer read, days after it are read from where they are, so what
    a stream still appends is seen at once. Nothing is deleted: ``expired`` names the days whose folders may be.
    """

    path: str
    zone: str

    def _list(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(EXPIRIES).parquet(f"{self.path}/_expiries")

    def create(self, spark: SparkSession) -> ExpiringTable:
        spark.createDataFrame([], EXPIRIES).write.mode("append").parquet(f"{self.path}/_expiries")
        return self

    def last(self, spark: SparkSession) -> Row | None:
        return self._list(spark).orderBy(F.desc("version")).first()

    def read(self, spark: SparkSession) -> DataFrame:
        """What has not expired: a scan of the days after the boundary, and one of what was kept of that day."""
        table, last = gold_table(spark, self.path), self.last(spark)
        if last is None:
            return table
        return table.where(F.col("event_date") > F.lit(last.boundary)).unionByName(gold_table(spark, last.kept))

    def expired(self, spark: SparkSession) -> list[str]:
        """Days that hold nothing that is still read from their own folders."""
        last = self.last(spark)
        if last is None:
            return []
        days = gold_table(spark, self.path).where(F.col("event_date") <= F.lit(last.boundary)).select("event_date").distinct()
        return sorted(str(r.event_date) for r in days.collect())

    def expire(self, spark: SparkSession, anchor: Moment, keep: str) -> int:
        """Let go of windows that started more than ``keep`` before ``anchor``; returns the version.

        Only the boundary day is read and written. An expiry that would bring windows back does nothing.
        """
        start = minus(instant(anchor), keep)
        row = spark.range(1).select(F.unix_micros(start).alias("cutoff"), local_date(start, self.zone).alias("boundary")).first()
        last = self.last(spark)
        if last is not None and row.cutoff <= last.cutoff:
            return last.version
        version = last.version + 1 if last is not None else 0
        kept = f"{self.path}/_kept/{version}"
        day = self.read(spark).where(F.col("event_date") == F.lit(row.boundary)).where(F.col("window_start") >= instant(row.cutoff))
        store_gold(day, kept, mode="overwrite")  # a run that failed before the list was written is done again
        entry = spark.createDataFrame([(version, row.cutoff, row.boundary, kept)], EXPIRIES)
        entry.coalesce(1).write.mode("append").parquet(f"{self.path}/_expiries")
        return version
