"""Language-model scores by prediction by partial matching over bytes.

Counts of ORDER + 1 neighbouring bytes in the training texts are summed by Spark; they make a trie of
byte contexts. A byte that follows its longest known context has the share of its count, with the
number of different successors as the weight of an escape (method C). After an escape the next
shorter context is asked, without the symbols already ruled out (symbol exclusion); below the
empty context the remaining byte values are alike. The code length of a text is pretrained: the sum over its bytes and its end.

Every context of the training texts counts. Each task holds the trie's head: the contexts up to SHORT bytes and the most
frequent of each greater length. A byte after a context outside the head is looked up in the table of all counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import chunks, id_remainder, rows, small_batches, stored

ORDER = 5
HEAD_CONTEXTS = 200_000  # most frequent contexts of a length that every task holds
SHORT = 2  # contexts up to this length are held whatever their number: at most 65,793
TAIL_ROWS = 1_000_000  # counts that a worker makes a part of the trie of at once, if one ending's are not more
HEAD_WORDS = 500_000  # most frequent words, whose counts every task holds
CACHED_WORDS = 200_000
COUNT_BYTES = 8_000_000  # of text that a worker counts at once
BEFORE, END = 0xFE, 0xFF  # bytes that no text has: what stands before it, and its end
WORD_END = 0  # the hash under which the end of a text counts as a token


@dataclass
class Words:
    """64-bit hashes of words."""

    seen: dict = field(default_factory=dict)

    def __call__(self, words: list[bytes]) -> np.ndarray:
        seen = self.seen
        try:
            return np.array([seen[w] for w in words], np.uint64)
        except KeyError:
            if len(seen) > CACHED_WORDS:
                seen.clear()
            for w in set(words):
                seen[w] = xxhash.xxh64_intdigest(w) or 1
            return np.array([seen[w] for w in words], np.uint64)


def coded(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's bytes and end with the ``order`` bytes before, as integers; and how many each text has."""
    pad = bytes([BEFORE]) * order
    flat = np.frombuffer(b"".join(pad + t + bytes([END]) for t in texts), np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    ends = np.cumsum(sizes + order)
    code = np.zeros(max(0, len(flat) - order), np.uint64)
    for j in range(order + 1):
        code = (code << np.uint64(8)) | flat[j : len(flat) - order + j].astype(np.uint64)
    keep = np.ones(len(code), bool)
    for end in ends[:-1].tolist():
        keep[end - order : end] = False  # would look across a text's end
    return code[keep], sizes


@dataclass
class Level:
    """Contexts of one length, sorted, with what the scores need."""

    contexts: np.ndarray
    kinds: np.ndarray  # different successors
    total: np.ndarray
    left_kinds: np.ndarray  # of the next shorter context, without this one's successors
    left_total: np.ndarray
    entries: np.ndarray  # context and successor, sorted
    counts: np.ndarray


@dataclass
class Trie:
    order: int
    levels: list  # by length, from 0

    def log10(self, codes: np.ndarray) -> np.ndarray:
        """log10 of the probability of each code's last byte after the others."""
        made = np.zeros(len(codes))
        symbol = codes & np.uint64(255)
        open_ = np.arange(len(codes))  # not yet predicted
        child = np.full(len(codes), -1)  # place of the longer context that was escaped from
        for length in range(self.order, -1, -1):
            level = self.levels[length]
            mask = np.uint64((1 << 8 * length) - 1)
            context = (codes[open_] >> np.uint64(8)) & mask
            at = find(level.contexts, context)
            has, before = at >= 0, child[open_]
            above = self.levels[length + 1] if length < self.order else None
            kinds = np.where(has, level.kinds[at], 0.0)
            total = np.where(has, level.total[at], 0.0)
            if above is not None and len(above.contexts):
                excluded = has & (before >= 0)
                kinds = np.where(excluded, above.left_kinds[before], kinds)
                total = np.where(excluded, above.left_total[before], total)
            entry = find(level.entries, (context << np.uint64(8)) | symbol[open_])
            hit = has & (entry >= 0)
            weight = np.log10(np.maximum(total + kinds, 1))
            made[open_[hit]] += np.log10(level.counts[entry[hit]]) - weight[hit]
            escape = has & ~hit & (kinds > 0)
            made[open_[escape]] += np.log10(kinds[escape]) - weight[escape]
            child[open_[has & ~hit]] = at[has & ~hit]
            child[open_[~has]] = -1
            open_ = open_[~hit]
            if not len(open_):
                return made
        root = self.levels[0]
        rest = 256 - (root.kinds[0] if len(root.kinds) else 0)
        made[open_] -= np.log10(rest)
        return made

    def score(self, texts: list[bytes], whole: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """log10 probability of each text with its end; equal codes of the batch are looked up once.

        Unless the trie is ``whole``, codes after contexts that it lacks are left out and returned: where each text's
        end, the codes, and how often the text has each.
        """
        codes, sizes = coded(texts, self.order)
        each, place = np.unique(codes, return_inverse=True)
        held = np.full(len(each), whole)
        if not whole:
            held = find(self.levels[self.order].contexts, each >> np.uint64(8)) >= 0
        made = np.zeros(len(each))
        made[held] = self.log10(each[held])
        at = np.flatnonzero(~held[place])
        text = np.searchsorted(np.cumsum(sizes), at, side="right")
        pair, times = np.unique(text * len(each) + place[at], return_counts=True)
        ends = np.searchsorted(pair, np.arange(len(texts) + 1) * len(each))
        return np.add.reduceat(made[place], np.cumsum(sizes) - sizes), ends, each[pair % len(each)], times


def find(sorted_: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of values in a sorted array; -1 where there is none."""
    if not len(sorted_):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(sorted_, wanted), len(sorted_) - 1)
    return np.where(sorted_[at] == wanted, at, -1)


def build_trie(order: int, entries: list[tuple[np.ndarray, np.ndarray]], shorter: tuple = ()) -> Trie:
    """From (context and successor, count) of each length, from 0 or after the levels ``shorter``; a context comes with all
    its successors."""
    levels = list(shorter)
    for length, (entry, count) in enumerate(entries, len(levels)):
        by = np.argsort(entry)
        entry, count = entry[by], count[by].astype(np.float64)
        contexts, first = np.unique(entry >> np.uint64(8), return_index=True)
        kinds = np.diff(np.append(first, len(entry))).astype(np.float64)
        total = np.add.reduceat(count, first) if len(first) else np.zeros(0)
        left_kinds, left_total = np.zeros(len(contexts)), np.zeros(len(contexts))
        if length and len(contexts):
            below = levels[-1]
            mask = np.uint64((1 << 8 * (length - 1)) - 1)
            parent = find(below.contexts, contexts & mask)
            shared = find(below.entries, (((entry >> np.uint64(8)) & mask) << np.uint64(8)) | (entry & np.uint64(255)))
            ruled_out = np.add.reduceat(np.where(shared >= 0, below.counts[shared], 0.0), first)
            left_kinds = np.where(parent >= 0, below.kinds[parent] - kinds, 0.0)
            left_total = np.where(parent >= 0, below.total[parent] - ruled_out, 0.0)
        levels.append(Level(contexts, kinds, total, left_kinds, left_total, entry, count))
    return Trie(order, levels)


def gram_counts(docs: DataFrame, order: int) -> DataFrame:
    """(code, n): every run of order + 1 bytes of the texts and how often it stands; folded per worker first."""

    def fold(parts: list[np.ndarray]) -> pa.RecordBatch:
        code, n = np.unique(np.concatenate(parts), return_counts=True)
        return rows(code=code, n=n.astype(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for _, texts in chunks(batches, limit=2_000_000):
            codes, _ = coded([lowered(t) for t in texts], order)
            parts.append(codes)
            size += len(codes)
            if size >= COUNT_BYTES:
                yield fold(parts)
                parts, size = [], 0
        if parts:
            yield fold(parts)

    found = docs.select("text").mapInArrow(run, "code long, n long")
    return found.groupBy("code").agg(F.sum("n").alias("n"))


def lowered(text: str) -> bytes:
    """UTF-8 with A-Z in lower case."""
    return text.encode().lower()


def learn(docs: DataFrame, order: int = ORDER, share: float = 0.0) -> tuple[Trie, DataFrame, bool]:
    """The head of the trie of the byte contexts of rows (text); (code, n) of all; and whether the head has every context.

    The head's contexts make up ``share`` of the bytes at least. One least count holds for all lengths, so that a
    context comes with its endings. What reaches the driver is bounded by HEAD_CONTEXTS and SHORT.
    """
    small_batches(docs.sparkSession)
    deepest = stored(gram_counts(docs, order), "grams")
    bytes_ = deepest.agg(F.sum("n")).first()[0] or 0
    context = lambda length: F.shiftright("code", 8).bitwiseAND(F.lit((1 << 8 * length) - 1)).alias("context")
    step = F.floor(F.log("of") / np.log(1.02)).cast("int")  # ends in a few thousand classes of counts
    large, low, whole = {}, -1, True
    for length in range(SHORT + 1, order + 1):
        large[length] = deepest.groupBy(context(length)).agg(F.sum("n").alias("of"))
        enough = F.col("of") >= share * bytes_
        sizes = large[length].groupBy(step.alias("step"), enough.alias("enough")).agg(F.count("*").alias("contexts")).collect()
        whole = whole and all(r["enough"] for r in sizes)
        total = 0
        for row in sorted(sizes, key=lambda r: -r["step"]):
            total += row["contexts"]
            if total > HEAD_CONTEXTS:
                low, whole = max(low, row["step"] + 1), False
                break
    entries = []
    for length in range(order + 1):
        entry = F.col("code").bitwiseAND(F.lit((1 << 8 * (length + 1)) - 1))
        counts = deepest.groupBy(entry.alias("entry")).agg(F.sum("n").alias("n"))
        if length > SHORT and not whole:
            held = large[length].where((step >= low) & (F.col("of") >= share * bytes_)).select("context")
            counts = counts.withColumn("context", F.shiftright("entry", 8)).join(F.broadcast(held), "context", "left_semi")
        found = counts.select("entry", "n").toArrow()
        entry = found.column("entry").to_numpy().astype(np.int64).view(np.uint64)
        entries.append((entry, found.column("n").to_numpy().astype(np.int64)))
    return build_trie(order, entries), deepest, whole


def tail_scores(grams: DataFrame, wanted: DataFrame, trie: Broadcast, order: int) -> DataFrame:
    """(code, score): log10 of the probability of each of the ``wanted`` codes, by all counts of ``grams``.

    Contexts with the same last SHORT + 1 bytes meet in a task, with all the counts that any of them needs; of equal codes
    there is one row, so their number is bounded whatever the corpus.
    """

    def scores(code: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        asked, entries = code[n == 0], []
        code, n = code[n > 0], n[n > 0]
        for length in range(SHORT + 1, order + 1):
            entry, place = np.unique(code & np.uint64((1 << 8 * (length + 1)) - 1), return_inverse=True)
            count = np.zeros(len(entry), np.int64)
            np.add.at(count, place, n)
            entries.append((entry, count))
        shorter = [Level(*parts) for parts in trie.value[: SHORT + 1]]
        return rows(code=asked, score=build_trie(order, entries, shorter).log10(asked))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            parts.append([batch.column(c).to_numpy() for c in ("ending", "code", "n")])
            size += batch.num_rows
            if size >= TAIL_ROWS:
                ending, code, n = map(np.concatenate, zip(*parts))
                cut = np.searchsorted(ending, ending[-1])  # the last ending may go on
                if cut:
                    yield scores(code[:cut].view(np.uint64), n[:cut])
                parts = [[ending[cut:], code[cut:], n[cut:]]]
                size = 0 if not cut else len(ending) - cut
        if parts:
            _, code, n = map(np.concatenate, zip(*parts))
            yield scores(code.view(np.uint64), n)

    ending = F.shiftright("code", 8).bitwiseAND(F.lit((1 << 8 * (SHORT + 1)) - 1))
    both = grams.select("code", "n").unionAll(wanted.select("code", F.lit(0).cast("long").alias("n")))
    both = both.select(ending.alias("ending"), "code", "n").repartition("ending").sortWithinPartitions("ending")
    return both.mapInArrow(run, "code long, score double")


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): hashed words of the texts, with the end of each text, and how often they stand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, parts, size, ends = Words(), [], 0, 0

        def fold() -> pa.RecordBatch:
            word, n = np.unique(np.concatenate(parts), return_counts=True)
            return rows(word=word, n=n.astype(np.int64))

        for _, texts in chunks(batches):
            for t in texts:
                found = words(lowered(t).split())
                parts.append(found)
                size += len(found)
            ends += len(texts)
            if size >= 2_000_000:
                yield fold()
                parts, size = [], 0
        if size:
            yield fold()
        if ends:
            yield rows(word=np.array([WORD_END], np.int64), n=np.array([ends], np.int64))

    found = docs.select("text").mapInArrow(run, "word long, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The words of at least some count, as low as ``most`` of them allow; no task gathers more than its share."""
    step = F.floor(F.log("n") / np.log(1.02)).cast("int")  # ends in a few thousand classes of counts
    sizes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect()
    low, total = None, 0
    for row in sorted(sizes, key=lambda r: -r["step"]):
        total += row["words"]
        if total > most:
            break
        low = row["step"]
    return counts.where(step >= low if low is not None else F.lit(False))


def score_texts(docs: DataFrame, training: Column | None = None, order: int = ORDER, share: float = 0.0) -> DataFrame:
    """Score every row of ``docs`` (doc_id, text), learning from those where ``training`` holds.

    doc_id, held_out (not ``training``), n_tokens, n_known, train_tokens, base_score (unigrams of words and the text's
    end, add one half) and score (the byte model's log10 probability of the text). A null text counts as empty:
    its end alone. Repeated rows get equal rows and count as often as they stand; a row with a null id is
    training; other columns play no part. With no training rows the model is uniform. Words are told apart by 64-bit hashes.
    Contexts below ``share`` of the training bytes are looked up by a join, as are those beyond HEAD_CONTEXTS; the scores are the same.
    """
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    used = F.coalesce(trained() if training is None else training, F.lit(True))
    plain = docs.select("doc_id", "text", used.alias("used"))
    learned = plain.where("used")
    model, grams, entire = learn(learned, order, share)
    trie = spark.sparkContext.broadcast([tuple(vars(level).values()) for level in model.levels])  # plain arrays need no class there
    del model
    counts = stored(word_counts(learned), "words")
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    known = most_frequent(counts, HEAD_WORDS).toArrow()
    by = np.argsort(known.column("word").to_numpy().view(np.uint64))
    head = spark.sparkContext.broadcast(
        (known.column("word").to_numpy().view(np.uint64)[by], known.column("n").to_numpy().astype(np.float64)[by])
    )
    whole = max(n, 0) + 0.5 * (v + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (words, count), hashed = head.value, Words()
        rates = np.log10((count + 0.5) / whole)
        model = Trie(order, [Level(*parts) for parts in trie.value])
        row = TaskContext.get().partitionId() << 33
        end = np.array([WORD_END], np.uint64)
        for part, texts in chunks(batches, limit=1_000_000):
            data = [lowered(t) for t in texts]
            found = [x for t in data for x in (hashed(t.split()), end)]
            sizes = np.array([len(x) for x in found], np.int64).reshape(-1, 2).sum(1)
            each, place = np.unique(np.concatenate(found), return_inverse=True)
            at = find(words, each)
            hit = (at >= 0)[place]
            first = np.cumsum(sizes) - sizes
            ends = np.cumsum(np.add.reduceat(~hit, first, dtype=np.int64))
            score, code_ends, codes, times = model.score(data, entire)
            yield rows(
                row=np.arange(row, row + len(texts), dtype=np.int64),
                doc_id=part.column("doc_id"),
                used=part.column("used"),
                n_tokens=sizes,
                known=np.add.reduceat(hit, first, dtype=np.int64),
                base=np.add.reduceat(np.where(at >= 0, rates[at] if len(rates) else 0.0, 0.0)[place], first),
                score=score,
                codes=pa.ListArray.from_arrays(pa.array(code_ends, pa.int32()), pa.array(codes.view(np.int64))),
                times=pa.ListArray.from_arrays(pa.array(code_ends, pa.int32()), pa.array(times, pa.int64())),
                tail=pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(each[place[~hit]].view(np.int64))),
            )
            row += len(texts)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"row long, doc_id {kind}, used boolean, n_tokens long, known long, base double, score double, codes array<long>, times array<long>, tail array<long>"
    scored = stored(plain.mapInArrow(run, schema), "scored")
    rate = lambda c: F.log10((F.coalesce(c, F.lit(0)) + 0.5) / F.lit(float(whole)))
    tail = scored.select("row", F.explode("tail").alias("word")).join(counts, "word", "left")
    tail = tail.groupBy("row").agg(F.count("n").alias("tail_known"), F.sum(rate(F.col("n"))).alias("tail_base"))
    both = scored.drop("tail", "codes", "times").join(tail, "row", "left")
    if not entire:
        pairs = scored.select("row", F.inline(F.arrays_zip("codes", "times")))
        rare = stored(tail_scores(grams, pairs.select("codes").distinct().withColumnRenamed("codes", "code"), trie, order), "rare")
        rare = pairs.join(rare, F.col("codes") == F.col("code")).groupBy("row").agg(F.sum(F.col("times") * F.col("score")).alias("tail_score"))
        both = both.join(rare, "row", "left")
    tail_score = F.lit(0.0) if entire else F.coalesce("tail_score", F.lit(0.0))
    return both.select(
        "doc_id",
        (~F.col("used")).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("tail_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("tail_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + tail_score).alias("score"),
    )


def trained(doc_id: str = "doc_id") -> Column:
    """Rows to learn from: remainder other than 1 of 5, or no id."""
    return F.coalesce(id_remainder(F.col(doc_id), 5) != 1, F.lit(True))
