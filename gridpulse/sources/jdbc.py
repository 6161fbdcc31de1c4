"""Serving tables in a SQL database."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession

from gridpulse import schemas


@dataclass(frozen=True)
class Database:
    """A JDBC endpoint. ``connections`` bounds what the cluster opens at a time."""

    url: str
    user: str = ""
    password: str = field(default="", repr=False)
    driver: str = "org.postgresql.Driver"
    connections: int = 8
    batch_size: int = 10_000
    fetch_size: int = 10_000  # rows a read holds at once; some drivers fetch whole results by default

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> Database:
        return cls(
            url=env["GRIDPULSE_JDBC_URL"],
            user=env.get("GRIDPULSE_JDBC_USER", ""),
            password=env.get("GRIDPULSE_JDBC_PASSWORD", ""),
            driver=env.get("GRIDPULSE_JDBC_DRIVER", cls.driver),
        )

    def options(self, table: str) -> dict[str, str]:
        given = {"url": self.url, "dbtable": table, "driver": self.driver, "fetchsize": str(self.fetch_size)}
        if self.user:
            given |= {"user": self.user, "password": self.password}
        return given

    def write_options(self, table: str) -> dict[str, str]:
        # More partitions than connections are coalesced before the write.
        return self.options(table) | {
            "numPartitions": str(self.connections),
            "batchsize": str(self.batch_size),
            "isolationLevel": "READ_COMMITTED",
        }


def serving_ddl(table: str) -> str:
    """The serving table. The key makes a task that is retried after its commit fail
    rather than double its rows; the batch is then replayed without them."""
    columns = (
        schemas.SERVING.replace("house_id STRING", "house_id TEXT NOT NULL")
        .replace("TIMESTAMP NOT NULL", "TIMESTAMPTZ NOT NULL")
        .replace("DOUBLE", "DOUBLE PRECISION")
    )
    return f"CREATE TABLE IF NOT EXISTS {table} ({columns}, PRIMARY KEY ({', '.join(schemas.SERVING_KEY)}))"


def serving_table(spark: SparkSession, database: Database, table: str) -> DataFrame:
    """A serving table; a filter on the house runs in the database.

    For a time range take ``serving_slice``: Spark hands a timestamp down as text in
    its session zone, which the database may read in another zone.
    """
    return spark.read.format("jdbc").options(**database.options(table)).load()


def slice_predicates(since: int, until: int, parts: int) -> list[str]:
    """SQL conditions that divide window_start in [since, until], in epoch microseconds.

    The bounds carry their offset, so no zone setting matters: as plain text, both
    passes of an autumn hour would be one instant.
    """

    def literal(us: int) -> str:
        return f"TIMESTAMP WITH TIME ZONE '{datetime.fromtimestamp(0, timezone.utc) + timedelta(microseconds=us)}'"

    end = until + 1
    parts = min(parts, end - since)
    edges = [since + (end - since) * i // parts for i in range(parts)] + [end]
    return [
        f"window_start >= {literal(low)} AND window_start < {literal(high)}" for low, high in zip(edges, edges[1:])
    ]


def serving_slice(spark: SparkSession, database: Database, table: str, since: int, until: int) -> DataFrame:
    """The rows with window_start in [since, until], read over all connections."""
    options = database.options(table)
    predicates = slice_predicates(since, until, database.connections)
    return spark.read.jdbc(options.pop("url"), options.pop("dbtable"), predicates=predicates, properties=options)
