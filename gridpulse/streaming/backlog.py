"""Gold from a backlog of Silver, in the order of event time.

Silver is stored by local date and hour, so its folders are an order of event time whatever the order in which they were
written. A backlog is read in steps of a few folders, each a run of the same Gold query on the same checkpoint: the watermark
follows the steps, closes the windows of one before the next is read, and the state never holds more than a step's
windows and the open ones before it. A live run goes on from the same checkpoint afterwards.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse import schemas
from gridpulse.config import Granularity, Pipeline
from gridpulse.sources.files import silver_table
from gridpulse.streaming.jobs import drain, ready, start_gold
from gridpulse.streaming.progress import throughput

_FOLDER = re.compile(r"/dt=([^/]+)/hour=(\d+)/([^/]+)$")
# A source forgets files older than its newest by this much, and ignores them: in a backlog, files may be of any age.
_NEVER = "36500d"

Folder = tuple[str, int]


class LateReadings(RuntimeError):
    """Readings of a backlog whose windows had closed: they are in Silver, but not in Gold."""


def folders(table: DataFrame) -> dict[Folder, set[str]]:
    """Names of the committed files of each (dt, hour), in order of time. The listing that plans any read is all this takes."""
    found: dict[Folder, set[str]] = defaultdict(set)
    for path in table.inputFiles():
        dt, hour, name = _FOLDER.search(path).groups()
        found[dt, int(hour)].add(name)
    return dict(sorted(found.items()))


def steps(stored: dict[Folder, set[str]], hours: int) -> list[dict[Folder, set[str]]]:
    """Runs of at most ``hours`` folders, in order of time."""
    keys = list(stored)
    return [{k: stored[k] for k in keys[i : i + hours]} for i in range(0, len(keys), hours)]


def step_stream(session: SparkSession, path: str, step: dict[Folder, set[str]]) -> DataFrame:
    """The readings of a step as a stream. Files that a failed batch of ingest left behind, which are not committed, are left out."""
    glob = f"{path}/{{{','.join(f'dt={dt}/hour={hour}' for dt, hour in step)}}}"
    there = folders(session.read.schema(schemas.SILVER).option("basePath", path).parquet(glob))
    orphans = sorted(set().union(*there.values()) - set().union(*step.values()))
    stream = session.readStream.schema(schemas.SILVER).option("basePath", path).option("maxFileAge", _NEVER).parquet(glob)
    return stream.where(~F.col("_metadata.file_name").isin(orphans)) if orphans else stream


def run_backlog(session: SparkSession, grain: Granularity, pipeline: Pipeline, *, hours: int | None = None) -> list[tuple]:
    """Bring Gold up to date with Silver, ``hours`` folders at a time; the throughput of each batch.

    A step that was cut off is finished by the next run, and files that an earlier run has read are not read again. Raises
    ``LateReadings`` when a step held readings of windows that had closed, which a file that was added to an old folder does: the
    other readings of that step are written, and later steps are not started.
    """
    once = replace(pipeline, available_now=True)
    ready(session, pipeline.silver, schemas.SILVER, schemas.SILVER_PARTITIONS)
    report = []
    for step in steps(folders(silver_table(session, pipeline.silver)), hours or pipeline.backlog_hours):
        query = start_gold(session, grain, once, step_stream(session, pipeline.silver, step))
        drain(query)
        batches = throughput(query)
        report += batches
        if late := sum(batch[5] for batch in batches):
            first, last = min(step), max(step)
            raise LateReadings(f"{late} late groups of readings between {first} and {last}; recompute these folders from Silver")
    return report
