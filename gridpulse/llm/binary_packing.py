"""Packing by power-of-two decomposition.

A document's tokens are cut into pieces whose lengths are powers of two: as many of the longest
as fit, then the binary digits of the rest from high to low. Each piece is a sequence of its
own; sequences of equal length form a bucket. No sequence crosses documents and none needs padding.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

from gridpulse.llm.common import chunks, rows, small_batches

LONGEST = 1024
END_ID = 0  # closes each document
#: How byte-level tokenizer files cut a text before they merge.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: White space as the pattern means it, in rows longer than any that texts of sense hold.
LONG_SPACE = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]{1000,}")


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level tokenizer files write bytes: printable Latin-1 stands for
    itself, the other bytes follow from U+0100 on in their order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def encoder(tokenizer_json: str) -> tiktoken.Encoding:
    """A byte-level BPE file whose ids follow the order of its merges, as a fast encoder.

    Added tokens in a text get their ids, as with the library that the file is made for.
    """
    file, letters = json.loads(tokenizer_json), byte_letters()
    special = {t["content"]: t["id"] for t in file["added_tokens"]}
    vocabulary = file["model"]["vocab"].items()
    ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary if token not in special}
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def token_ids(code: tiktoken.Encoding, text: str) -> np.ndarray:
    """The ids of a whole text.

    The pattern takes white space in a row, but for the last character if a word follows, as one piece, yet by trying every length, for
    which its matcher runs out of room on long rows. Those are cut out here and merged as the pieces they are.
    """
    made, at = [], 0
    for found in LONG_SPACE.finditer(text):
        start, end = found.span()
        if end < len(text) and not text.startswith(tuple(code.special_tokens_set), end):
            end -= 1
        made.append(code.encode_to_numpy(text[at:start], allowed_special="all"))
        made.append(np.array(code._core_bpe.encode_single_piece(text[start:end].encode()), np.uint32))
        at = end
    made.append(code.encode_to_numpy(text[at:], allowed_special="all"))
    return np.concatenate(made)


def piece_lengths(total: int, longest: int = LONGEST) -> list[int]:
    """Powers of two, at most ``longest``, not rising, that add up to ``total``."""
    rest = total % longest
    return [longest] * (total // longest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, tokenizer_path: str, longest: int = LONGEST, with_ids: bool = False) -> DataFrame:
    """A row per piece of each row of ``docs`` (doc_id, text).

    doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (0: a piece is a whole
    sequence) and bucket, the binary logarithm of its length; with_ids adds the ids themselves. A null or
    empty text is the closing id alone. Repeated rows and null ids are packed like any other; other columns
    play no part. sequence_id numbers the pieces of an input partition from partition * 2^33.
    """

    spark = small_batches(docs.sparkSession)
    file = spark.sparkContext.broadcast(Path(tokenizer_path).read_text(encoding="utf-8"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, sequence = encoder(file.value), TaskContext.get().partitionId() << 33
        for part, texts in chunks(batches, limit=1_000_000):
            which, starts, sizes, sums, totals, ids = [], [], [], [], [], []
            for i, text in enumerate(texts):
                found = np.append(token_ids(code, text), END_ID).astype("<u4")
                start = 0
                for size in piece_lengths(len(found), longest):
                    piece = found[start : start + size]
                    which.append(i)
                    starts.append(start)
                    sizes.append(size)
                    sums.append(zlib.crc32(piece.tobytes()))
                    totals.append(len(found))
                    if with_ids:
                        ids.append(piece.astype(np.int32))
                    start += size
            size = np.array(sizes, np.int64)
            made = {
                "doc_id": part.column("doc_id").take(pa.array(which, pa.int64())),
                "start": np.array(starts, np.int64),
                "length": size,
                "ids_crc32": np.array(sums, np.int64),
                "doc_tokens": np.array(totals, np.int64),
                "sequence_id": np.arange(sequence, sequence + len(size), dtype=np.int64),
                "offset": np.zeros(len(size), np.int64),
                "bucket": np.log2(size).astype(np.int32),
            }
            sequence += len(size)
            if with_ids:
                made["ids"] = pa.array(ids, pa.list_(pa.int32()))
            yield rows(**made)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, bucket int"
    return docs.select("doc_id", "text").mapInArrow(run, schema + ", ids array<int>" * with_ids)


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Store packed pieces with one folder per length, so that a reader draws batches of one length."""
    pieces.write.partitionBy("bucket").parquet(path)
