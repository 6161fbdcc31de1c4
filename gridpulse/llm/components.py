"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import stored


def state(edges: DataFrame) -> tuple:
    """A count and a checksum."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) of every node with an edge; the component is its smallest node.

    ``edges`` has two long columns a and b. Loops and repeated edges do no harm, rows
    with a null are ignored. Nothing is collected but a count and a checksum per round;
    a hub of many edges is pre-aggregated, and joins on it can be split.
    """
    plain = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a != b")
    now = stored(plain.distinct(), label)
    before = state(now)  # stars from the start take one round
    while True:
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
        now = stored(small.unionAll(low.select("a", F.col("m").alias("b"))).distinct(), label)
        after = state(now)
        if after == before:
            break
        before = after
    least = now.groupBy("b").agg(F.lit(1)).select(F.col("b").alias("node"), F.col("b").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(least)
