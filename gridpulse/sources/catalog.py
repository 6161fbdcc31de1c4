"""Stored Gold as a table that finds one house quickly, and as a name in the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridpulse import schemas
from gridpulse.operators.layout import balance_for_write

HOUSES_EXPECTED = 10_000  # of a row group, for its bloom filter: some 12 KB at most
ROW_GROUP_BYTES = 16 * 1024 * 1024


def house_options(row_group_bytes: int = ROW_GROUP_BYTES, houses: int = HOUSES_EXPECTED) -> dict[str, str]:
    """Writer options for questions about one house.

    A row group's dictionary tells which houses it cannot hold, and a bloom filter where the houses are too many for a dictionary; the range
    of its ids, which are text, tells little in files that a stream wrote. Row groups are small, so that a house in one of them costs little.
    """
    return {
        "parquet.bloom.filter.enabled#house_id": "true",
        "parquet.bloom.filter.expected.ndv#house_id": str(houses),
        "parquet.block.size": str(row_group_bytes),
    }


def store_gold(gold: DataFrame, path: str, *, mode: str = "errorifexists", **options: int) -> None:
    """Write Gold by date and hour, each file in the order of houses: a house lies in one row group of a file, or two."""
    rows = balance_for_write(gold, schemas.GOLD_PARTITIONS, schemas.SERVING_KEY)
    rows.write.mode(mode).options(**house_options(**options)).partitionBy(*schemas.GOLD_PARTITIONS).parquet(path)


def register(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Give a stored Gold table a name in the catalog, for SQL users; its files stay where they are.

    A catalog that keeps partitions (a metastore) learns those that are there; call again when there are new ones. What a
    stream writes is listed in the sink's own log, which names files and folders at every read: no partitions are kept then.
    """
    columns = ", ".join(f"{c} {schemas.GOLD_TYPES[c]}" for c in (*schemas.SERVING_COLUMNS, *schemas.GOLD_PARTITIONS))
    keys = ", ".join(schemas.GOLD_PARTITIONS)
    place = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({keys}) LOCATION '{place}'")
    if any(column.isPartition for column in spark.catalog.listColumns(name)):
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return spark.table(name).select(*schemas.SERVING_COLUMNS, *schemas.GOLD_PARTITIONS)
