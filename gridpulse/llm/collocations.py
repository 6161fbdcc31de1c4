"""Phrase collocations by Misra-Gries summaries, one per hash partition, and an exact second count.

The mass of each hash partition is measured first: how many occurrences of phrases of one to four
words fall into it. Then every task sends, per hash partition, a summary of
what it read, and one task merges those of a partition into at most ``capacity`` counters, where
capacity exceeds mass / least count. Merging two summaries adds their counters, and where more than
capacity are left, takes the largest one left over off every counter. Each unit taken off is taken
from capacity + 1 counters, so less than the least count is ever taken off one of them: a phrase
with the least count cannot vanish. What is left may be frequent; the second pass counts it exactly.
Within a task phrases are told apart by 64-bit hashes, between tasks by their words.

The phrases that may be frequent reach the second pass as a bit map of bounded size. A phrase let
through by chance is counted like any other and falls short of the least count.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.llm.common import arrow_bytes, mix, rows, stored, text_chunks
from gridpulse.llm.jaccard_tiles import FACTOR, SEGMENT, STEP, powers, segment_end, text_bytes

LEAST = 30  # occurrences of a candidate
LONGEST = 4  # words of a phrase
CONTAINED = 80  # percent of a phrase's occurrences that lie within one longer candidate
SCALE = 2_000_000  # of scores
MOST_RANKED = 2_000  # phrases reported of each language
RANKED_AT_ONCE = 5_000  # phrases of a language that one task ranks, about, before the first of each task are ranked together
MOST_RANKS = 1_000  # such tasks of a language
CAPACITY = 100_000  # counters of a hash partition, about
MOST_PARTITIONS = 100_000
MOST_BITS = 1 << 29  # of the map of phrases that may be frequent: 64 MB
BITS_EACH = 64
CHUNK_WORDS = 400_000  # that a worker folds at once
CHUNK_BYTES = 1_500_000  # of texts that it reads at once; a longer text comes in segments
BATCH_BYTES = 6_000_000  # of texts or summaries that pass from Spark to a worker at once; Spark's 64 MB would be held several times over

TAB_TO_SPACE = bytes(32 if c == 9 else c for c in range(256))
END = np.isin(np.arange(256), list(b".,;:!?\n\v\f\r"))  # bytes that end a piece
BREAK = END | np.isin(np.arange(256), list(b" \t"))  # and those between words


def word_values() -> np.ndarray:
    """A random number per byte of a word, the same for a capital and its small letter of A-Z, 0 between words."""
    made = mix(np.arange(1, 257, dtype=np.uint64) * STEP)
    made[65:91] = made[97:123]
    made[BREAK] = 0
    return made


@dataclass
class Block:
    """Words of some texts, in order: hashes, piece (rising; words of one piece have one number), where they start and how long they are.

    Phrases that start at one of the first ``starts`` words are this block's; the others are the next one's.
    """

    hash: np.ndarray
    piece: np.ndarray
    start: np.ndarray
    size: np.ndarray
    text: np.ndarray  # number of the text
    starts: int

    def phrases(self, width: int) -> np.ndarray:
        """Places of the phrases of ``width`` words."""
        most = min(self.starts, len(self.piece) - width + 1)
        return np.flatnonzero(self.piece[:most] == self.piece[width - 1 : most + width - 1]) if most > 0 else np.empty(0, np.int64)

    def phrase_hashes(self, width: int, at: np.ndarray) -> np.ndarray:
        x = np.full(len(at), width, np.uint64)
        for j in range(width):
            x = x * STEP + self.hash[at + j]
        return mix(x)


@dataclass
class Scanner:
    """Texts to blocks of words, whose 64-bit hashes tell languages apart. All words of a segment are found and hashed at once, and no
    word is made a Python object."""

    chunk: int = CHUNK_WORDS
    up: np.ndarray = field(default_factory=lambda: powers(FACTOR, SEGMENT))
    down: np.ndarray = field(default_factory=lambda: powers(pow(FACTOR, -1, 2**64), SEGMENT))
    value: np.ndarray = field(default_factory=word_values)

    def segment(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, ...]:
        """Hash, start and size of the words of a segment, and how many ends of pieces lie before each; texts begin at the cuts."""
        if len(data) > len(self.up):
            self.up, self.down = powers(FACTOR, len(data)), powers(pow(FACTOR, -1, 2**64), len(data))
        full = ~BREAK[data]
        first = full.copy()
        first[1:] &= ~full[:-1]
        cuts = cuts[cuts < len(data)]
        first[cuts] = full[cuts]
        start = np.flatnonzero(first)
        ends = np.cumsum(END[data], dtype=np.int64)
        if not len(start):
            return np.empty(0, np.uint64), start, start, start, int(ends[-1])
        size = np.add.reduceat(full, start, dtype=np.int64)
        found = np.add.reduceat(self.value[data] * self.up[: len(data)], start) * self.down[start]
        return mix(found + size.astype(np.uint64) * STEP), start, size, ends[start], int(ends[-1])

    def blocks(self, data: np.ndarray, ends: np.ndarray, langs: list[str]) -> Iterator[Block]:
        """The words of texts that lie one after the other in ``data``."""
        salt = np.array([xxhash.xxh64_intdigest(x) for x in langs], np.uint64)
        held: list[tuple[np.ndarray, ...]] = []
        at, passed, count = 0, 0, 0
        while at < len(data):
            stop = segment_end(data, at)
            low, high = np.searchsorted(ends, (at, stop))
            found, start, size, before, more = self.segment(data[at:stop], ends[low:high] - at)
            start = start + at
            text = np.searchsorted(ends, start, side="right") - 1
            held.append((mix(found + salt[text]), before + passed + text, start, size, text))
            at, passed, count = stop, passed + more, count + len(start)
            last = at >= len(data)
            if count >= self.chunk or last:
                columns = [np.concatenate(c) for c in zip(*held)]
                starts = len(columns[0]) if last else max(0, len(columns[0]) - LONGEST + 1)
                yield Block(*columns, starts)
                held, count = [tuple(c[starts:] for c in columns)], 0

    def read(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, np.ndarray, list[str]]]:
        """(block, bytes of its texts, their languages)"""
        for part, texts in text_chunks(batches, limit=CHUNK_BYTES):
            data, ends = text_bytes(texts)
            langs = part.column("lang").to_pylist()
            for block in self.blocks(data, ends, langs):
                yield block, data, langs


def partition_of(hashes: np.ndarray, partitions: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(partitions)) >> np.uint64(32)


def measured_mass(docs: DataFrame, partitions: int) -> DataFrame:
    """(lang, part, c): words of each language, where part is null, and occurrences of phrases per hash partition; partial sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, mass, words = Scanner(), np.zeros(partitions, np.int64), Counter()
        for block, _, langs in scanner.read(batches):
            for width in range(1, LONGEST + 1):
                at = block.phrases(width)
                part = partition_of(block.phrase_hashes(width, at), partitions)
                mass += np.bincount(part.astype(np.int64), minlength=partitions)
            for lang, n in zip(langs, np.bincount(block.text[: block.starts], minlength=len(langs)).tolist()):
                words[lang] += n
        at = np.flatnonzero(mass)
        yield rows(lang=pa.nulls(len(at), pa.string()), part=pa.array(at, pa.int32()), c=mass[at])
        if words:
            yield rows(lang=pa.array(list(words), pa.string()), part=pa.nulls(len(words), pa.int32()), c=pa.array(list(words.values()), pa.int64()))

    return docs.mapInArrow(run, "lang string, part int, c long")


def fold(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, sorted, and their summed counts."""
    if not len(hashes):
        return hashes, counts
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
    return hashes[first], np.add.reduceat(counts, first)


def merge(hashes: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """A summary of at most ``capacity`` counters of distinct hashes, and what was taken off each of them."""
    if len(hashes) <= capacity:
        return hashes, counts, 0
    off = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
    keep = counts > off
    return hashes[keep], counts[keep] - off, off


def task_summaries(docs: DataFrame, partitions: int) -> DataFrame:
    """(part, hashes, counts): what each chunk of a task holds of each hash partition, as arrays of 64 and 32 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for block, _, _ in scanner.read(batches):
            found = [block.phrase_hashes(width, block.phrases(width)) for width in range(1, LONGEST + 1)]
            value, times = np.unique(np.concatenate(found), return_counts=True)
            part = partition_of(value, partitions).astype(np.int64)  # sorted, as the hashes are
            here, first = np.unique(part, return_index=True)
            ends = [*first[1:], len(value)]
            times = times.astype(np.uint32)
            yield rows(
                part=pa.array(here, pa.int32()),
                hashes=pa.array([value[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()),
                counts=pa.array([times[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()),
            )

    return docs.mapInArrow(run, "part int, hashes binary, counts binary")


def merged_summaries(summaries: DataFrame, partitions: int, masses: dict[int, int], least: int) -> DataFrame:
    """(h): hashes of phrases whose occurrences may reach ``least``. A task holds twice the capacity of a partition, or one summary more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}  # part -> [arrays of hashes, arrays of counts, counters, taken off]

        def settle(part: int) -> None:
            state = held[part]
            value, times, off = merge(*fold(np.concatenate(state[0]), np.concatenate(state[1])), masses[part] // least + 1)
            held[part] = [[value], [times], len(value), state[3] + off]

        for batch in batches:
            values, counts = batch.column("hashes"), batch.column("counts")
            for i, part in enumerate(batch.column("part").to_pylist()):
                state = held.setdefault(part, [[], [], 0, 0])
                state[0].append(np.frombuffer(values[i].as_buffer(), np.uint64).copy())  # a copy, so that the batch can go
                state[1].append(np.frombuffer(counts[i].as_buffer(), np.uint32).astype(np.int64))
                state[2] += len(state[0][-1])
                if state[2] > 2 * (masses[part] // least + 1):
                    settle(part)
        for part in list(held):
            settle(part)
            (value,), (times,), _, off = held.pop(part)
            yield rows(h=value[times + off >= least])  # no phrase occurred oftener than its counter and what was taken off it

    columns = summaries.repartition(partitions, "part")
    return columns.mapInArrow(run, "h long")


def bit_map(hashes: DataFrame, count: int) -> np.ndarray:
    """A bit for each hash, BITS_EACH of them per hash and MOST_BITS at most, which bounds what reaches the driver."""
    size = min(MOST_BITS, max(1 << 16, 1 << (BITS_EACH * count).bit_length()))
    bit = F.col("h").bitwiseAND(F.lit(size - 1))
    word = F.shiftrightunsigned(bit, 6).cast("int").alias("word")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int"))
    found = hashes.select(word, one.alias("one")).groupBy("word").agg(F.bit_or("one").alias("bits")).toArrow()
    made = np.zeros(size // 64, np.int64)
    made[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return made.view(np.uint64)


def counted_phrases(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """(lang, phrase, width, c): occurrences of the phrases that ``bits`` lets through; partial sums."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, bits, seen, lower = Scanner(), shared.value, None, b""
        mask = np.uint64(len(bits) * 64 - 1)
        for block, data, langs in scanner.read(batches):
            if data is not seen:  # small letters, and one kind of space
                seen, lower = data, data.tobytes().lower().translate(TAB_TO_SPACE)
            for width in range(1, LONGEST + 1):
                at = block.phrases(width)
                value = block.phrase_hashes(width, at)
                spot = value & mask
                may = (bits[(spot >> np.uint64(6)).astype(np.intp)] >> (spot & np.uint64(63))) & np.uint64(1) == 1
                _, first, times = np.unique(value[may], return_index=True, return_counts=True)
                at = at[may][first]
                start, end = block.start[at], block.start[at + width - 1] + block.size[at + width - 1]
                apart = end - start > sum(block.size[at + j] for j in range(width)) + width - 1
                phrase = [lower[a:b] for a, b in zip(start.tolist(), end.tolist())]
                for i in np.flatnonzero(apart).tolist():
                    phrase[i] = b" ".join(w for w in phrase[i].split(b" ") if w)
                yield rows(
                    lang=pa.array([langs[i] for i in block.text[at].tolist()], pa.string()),
                    phrase=pa.array(phrase, pa.binary()).cast(pa.string()),
                    width=pa.array(np.full(len(at), width), pa.int32()),
                    c=times.astype(np.int64),
                )

    return docs.mapInArrow(run, "lang string, phrase string, width int, c long")


def frequent_phrases(docs: DataFrame, least: int = LEAST, capacity: int = CAPACITY) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, width, f) of phrases of one to LONGEST words that occur ``least`` times or more, and (lang, n) of all words.

    ``capacity`` sizes the hash partitions, of which there are as many as the bytes of text ask for; the counters
    of a partition follow from its own mass.
    """
    with arrow_bytes(docs.sparkSession, BATCH_BYTES):
        return found_phrases(docs, least, capacity)


def found_phrases(docs: DataFrame, least: int, capacity: int) -> tuple[DataFrame, DataFrame]:
    """``frequent_phrases``, in Arrow batches of the session's size; every pass of Python ends here, in a stored table."""
    plain = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    plain = plain.where("text != ''")
    size = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = int(max(1, min(MOST_PARTITIONS, size // 2 // (least * capacity) + 1)))
    measured = measured_mass(plain, partitions).groupBy("lang", "part").agg(F.sum("c").alias("n"))
    measured = stored(measured, "mass")
    masses = {r.part: r.n for r in measured.where("part is not null").collect()}
    totals = measured.where("part is null").select("lang", "n")
    kept = stored(merged_summaries(task_summaries(plain, partitions), partitions, masses, least), "summaries")
    counted = counted_phrases(plain, bit_map(kept, kept.count())).groupBy("lang", "phrase", "width").agg(F.sum("c").alias("f"))
    return stored(counted.where(F.col("f") >= least), "phrases"), totals


def wide(x: Column | str) -> Column:
    return F.col(x).cast("decimal(20,0)") if isinstance(x, str) else x.cast("decimal(20,0)")


def first_of(found: DataFrame, most: int, count: int) -> DataFrame:
    """The first ``most`` phrases of each language with their rank. Of a large language many tasks rank a share each, and only their
    first phrases meet."""
    order = F.desc("score"), F.desc("a"), "phrase"
    shares = max(1, min(MOST_RANKS, count // RANKED_AT_ONCE))
    if shares > 1:
        dealt = found.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(shares)))
        among = F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))
        found = dealt.withColumn("rank", among).where(F.col("rank") <= most).drop("share", "rank")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return found.withColumn("rank", rank).where(F.col("rank") <= most)


def collocations(docs: DataFrame, least: int = LEAST, most: int = MOST_RANKED, capacity: int = CAPACITY) -> DataFrame:
    """Per language its first ``most`` phrases: lang, rank, phrase, a, l, r, n, score.

    a: occurrences of the phrase, l and r: those of the two parts of its lowest-scoring cut, n: of all words of the
    language, score: floor(SCALE * a / (l + r)). A phrase of which CONTAINED percent or more lie in one longer phrase of
    ``least`` occurrences goes. A null text has no words, a null language counts as ``und``; rows that are
    repeated count each time, ids and other columns play no part. An empty table gives an empty result.
    """
    phrases, totals = frequent_phrases(docs, least, capacity)
    candidates = phrases.where("width > 1")
    words = F.split("phrase", " ")
    cut = F.explode(F.sequence(F.lit(1), F.col("width") - 1)).alias("k")
    cuts = candidates.select("lang", "phrase", "width", F.col("f").alias("a"), cut)
    part = lambda start, length: F.array_join(F.slice(words, start, length), " ")
    cuts = cuts.select("*", part(1, F.col("k")).alias("left"), part(F.col("k") + 1, F.col("width") - F.col("k")).alias("right"))
    of = phrases.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    cuts = cuts.join(of, ["lang", "left"]).join(of.withColumnsRenamed({"left": "right", "l": "r"}), ["lang", "right"])
    score = F.call_function("div", F.lit(SCALE).cast("decimal(7,0)") * wide("a"), wide("l") + wide("r"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.cast("long").alias("score"), "k", "l", "r")).alias("best"))

    width = F.col("width")
    inner = F.explode(F.sequence(F.lit(2), width - 1)).alias("inner")
    within = candidates.where("width > 2").select("lang", "phrase", "width", "f", inner)
    start = F.explode(F.sequence(F.lit(1), width - F.col("inner") + 1)).alias("start")
    within = within.select("lang", "phrase", "f", "inner", start).select("lang", part(F.col("start"), F.col("inner")).alias("phrase"), "f")
    longer = within.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    left = scored.join(longer, ["lang", "phrase"], "left")
    held = wide(F.coalesce("longer", F.lit(0))) * 100 < wide("a") * CONTAINED
    found = left.where(held).select("lang", "phrase", "a", "best.*")
    ranked = first_of(found, most, candidates.count())
    ranked = ranked.join(F.broadcast(totals) if totals.count() <= 10_000 else totals, "lang")
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
