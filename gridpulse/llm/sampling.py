"""Bounded samples of labelled rows, on which the classifiers are fitted."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


MOST_LABELS = 1_000  # different labels that a sample may hold, the most frequent ones


def bounded_sample(ids: DataFrame, label: str, per_label: int, rows: int) -> DataFrame:
    """(doc_id, label): at most ``per_label`` rows of each label and ``rows`` in all, chosen by a hash of doc_id.

    ``ids`` has no other columns, so no text is shuffled. A label of many rows is thinned to about four times
    what is wanted before the rest is ranked. The result, bounded by ``rows``, may be broadcast to fetch texts.
    """
    ids = ids.where(f"{label} is not null and doc_id is not null").select("doc_id", label)
    sizes = ids.groupBy(label).agg(F.count("*").alias("n")).orderBy(F.desc("n"), label).limit(MOST_LABELS)
    thinned = ids.join(F.broadcast(sizes), label).withColumn("pick", F.xxhash64("doc_id"))
    thinned = thinned.where(F.pmod("pick", F.lit(1 << 20)) * F.col("n") <= 4 * per_label * (1 << 20))
    rank = F.row_number().over(Window.partitionBy(label).orderBy("pick", "doc_id"))
    chosen = thinned.withColumn("rank", rank).where(F.col("rank") <= per_label).orderBy("rank", "pick", "doc_id").limit(rows)
    return chosen.select("doc_id", label).distinct()
