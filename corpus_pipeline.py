"""A training corpus from ``documents``: spoken in a known language, good, one of each group of near copies, packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.llm import binary_packing, byte_cnn, jaccard_tiles, quality_net
from gridpulse.llm.common import documents, stored
from gridpulse.llm.queries import BYTE_BPE

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
NEAR = jaccard_tiles.Rule(width=5, num=4, den=5)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in which the byte network finds a language, as surely as in texts it knows; a null text, or one without a letter, goes."""
    learned = docs.where(~byte_cnn.held_out())
    net = byte_cnn.fit(learned)
    return byte_cnn.keep_spoken(docs.select(*COLUMNS), net, byte_cnn.least_scores(learned, net))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality network, learned from the labels of what is left, scores 0.5 or more."""
    net = quality_net.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_net.keep_good(docs.select(*COLUMNS), net)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of 5-word similarity 0.8 connect, the one with the smallest doc_id.

    Rows of one doc_id stay or go together; a row with a null id stays.
    """
    found = jaccard_tiles.jaccard_components(docs, NEAR)
    copies = stored(found.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct(), "copies")
    if copies.count() <= jaccard_tiles.BROADCAST_MEMBERS:  # ids alone; beyond, the texts are shuffled to them
        copies = F.broadcast(copies)
    return docs.select(*COLUMNS).join(copies, "doc_id", "left_anti")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows as sequences whose lengths are powers of two."""
    return binary_packing.pack(docs, BYTE_BPE)


STAGES = [("language ID", language), ("quality classifier", quality), ("n-gram Jaccard join", near_duplicates), ("packing", packing)]

#: The stages' models are fitted numerically, which SQL cannot say; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again."""
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{i}")
    return docs
