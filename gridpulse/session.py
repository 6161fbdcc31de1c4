"""Sessions for the jobs, and the shared folder their intermediate tables use."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

from gridpulse.config import Pipeline

PROGRESS_KEPT = 20_000  # batches whose progress a query keeps
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def job_session(spark: SparkSession, pipeline: Pipeline) -> SparkSession:
    """A sibling session with the settings of the jobs; the caller's is untouched.

    Timestamps are stored as INT64 microseconds: the INT96 default carries no
    statistics, so a time-range read could not skip row groups.
    """
    session = spark.newSession()
    partitions = pipeline.state_partitions or spark.conf.get("spark.sql.shuffle.partitions")
    session.conf.set("spark.sql.session.timeZone", pipeline.zone)
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    session.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    session.conf.set("spark.sql.adaptive.enabled", "true")  # sizes the files that are written
    session.conf.set("spark.sql.streaming.numRecentProgressUpdates", str(PROGRESS_KEPT))
    if pipeline.rocksdb_state:
        session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return session


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, which every executor can reach.

    Only a local master, where driver and executors are one process, may fall
    back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return f"{root.rstrip('/')}/gridpulse/{label}-{uuid.uuid4().hex}"
