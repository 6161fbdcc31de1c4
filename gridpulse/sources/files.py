"""Stored layers, as streams and as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridpulse import schemas


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a folder at a path; its files are not listed."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(place)


def parquet_stream(
    spark: SparkSession, path: str, schema: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """New files of a Parquet folder as they appear, with a declared schema."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def envelope_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Envelopes landed as Parquet files: the shape of the topic, without a broker."""
    return parquet_stream(spark, path, schemas.ENVELOPE, max_files_per_trigger)


def silver_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    return parquet_stream(spark, path, schemas.SILVER, max_files_per_trigger)


def gold_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    return parquet_stream(spark, path, schemas.GOLD, max_files_per_trigger)


def silver_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.SILVER).parquet(path)


def gold_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.GOLD).parquet(path)


def house_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.HOUSES).parquet(path)
