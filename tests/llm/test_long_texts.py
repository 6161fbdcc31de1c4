"""Texts of a megabyte, of the kinds that are slow where an algorithm is not linear, through every operator on texts."""

import time

import public_tokenizers
import pytest
from gridpulse.llm import (
    batched_bpe,
    binary_packing,
    byte_cnn,
    collocations,
    divergence,
    jaccard_tiles,
    oneperm,
    pii,
    ppm,
    quality_net,
)

SIZE = 1_000_000
TEXTS = [
    " " * SIZE, "a" * SIZE, "a b " * (SIZE // 4), "\n" * SIZE, "é" * (SIZE // 2), "one line of words here\n" * (SIZE // 23),
    " ".join(map(str, range(SIZE // 7))),
]
BYTE_BPE, WORD_BPE = (public_tokenizers.path(f"{name}.json") for name in ("byte_bpe_50k", "word_bpe_49k"))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, text, ("en", "de", "fr")[i % 3]) for i, text in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)


def labels(spark):
    return spark.createDataFrame([(i, i % 2) for i in range(len(TEXTS))], "doc_id long, quality int")


OPERATORS = {
    "packing": lambda docs: binary_packing.pack(docs, BYTE_BPE),
    "encoding": lambda docs: batched_bpe.round_trip(docs, WORD_BPE),
    "language model": ppm.score_texts,
    "quality rules": divergence.judge,
    "fingerprints": oneperm.compare_edits,
    "quality": lambda docs: quality_net.score_quality(docs, quality_net.fit(docs, labels(docs.sparkSession))),
    "similarity": jaccard_tiles.jaccard_components,
    "language": lambda docs: byte_cnn.identify(docs, byte_cnn.fit(docs)),
    "personal data": pii.report,
    "phrases": collocations.collocations,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_megabyte(docs, name):
    start = time.perf_counter()
    found = OPERATORS[name](docs).collect()
    assert found and time.perf_counter() - start < 90
    if name not in ("packing", "phrases"):
        assert len(found) == len(TEXTS)
