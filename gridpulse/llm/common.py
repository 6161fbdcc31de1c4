"""What the operators share."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.session import shared_folder

BATCH_ROWS = 512  # rows that a Python worker holds at once
BATCH_CHARS = 4_000_000  # characters that one numpy pass covers


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession) -> SparkSession:
    """Bound the rows of an Arrow batch, since one row may hold a whole book."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


@contextmanager
def arrow_bytes(spark: SparkSession, most: int) -> Iterator[None]:
    """Bound the bytes of an Arrow batch in what runs meanwhile, where rows differ much in size; the caller's setting comes back."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read again: lineage ends there, so a lost executor repeats nothing older."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def crc_remainder(doc_id: int, n: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % n


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BATCH_CHARS) -> Iterator[tuple]:
    """(rows without the text, texts) of at most about ``limit`` characters each; a longer text comes alone. Null texts come as empty."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        lengths = [x or 0 for x in pc.binary_length(batch.column(at)).to_pylist()]
        start = 0
        while start < batch.num_rows:
            end, total = start + 1, lengths[start]
            while end < batch.num_rows and total + lengths[end] <= limit:
                total += lengths[end]
                end += 1
            part = batch.slice(start, end - start)
            yield part, [x or "" for x in part.column(at).to_pylist()]
            start = end


def text_chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BATCH_CHARS) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Batches cut to texts of about ``limit`` bytes each, as (rows, texts), with no Python object made; a longer text comes alone."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            part = batch.slice(start, end - start)
            yield part, part.column(at)
            start = end


def added_arrays(partials: DataFrame, kind: type) -> DataFrame:
    """(i, products): arrays of ``kind`` of one number i, as bytes, added up. A task holds one array per number that falls to it."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, products in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                more = np.frombuffer(products, kind)
                sums[i] = sums[i] + more if i in sums else more
        yield rows(i=pa.array(list(sums), pa.int64()), products=pa.array([s.tobytes() for s in sums.values()], pa.binary()))

    return partials.repartition("i").mapInArrow(added, "i long, products binary")


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rows(**columns) -> pa.RecordBatch:
    """A record batch from arrays or lists; 64-bit unsigned ones are stored as signed."""
    made = {}
    for name, values in columns.items():
        if isinstance(values, np.ndarray) and values.dtype == np.uint64:
            values = values.view(np.int64)
        made[name] = values if isinstance(values, pa.Array) else pa.array(values)
    return pa.RecordBatch.from_arrays(list(made.values()), names=list(made))
