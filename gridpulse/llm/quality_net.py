"""Quality classifier: random-indexing word vectors, pooled per document, in a two-layer network.

Each word has a sparse ternary index vector that follows from its hash; a word's vector is the
normalised sum of the index vectors around it in the sample. A document is the mean of its words'
vectors and the mean of the bound (elementwise) products of neighbours. The network's
probabilities are calibrated by a temperature on rows that it did not learn from.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import added_arrays, chunks, id_remainder, rows, small_batches, stored
from gridpulse.llm.sampling import bounded_sample

DIMENSION = 48
NONZERO = 6  # of an index vector
HASHED = 2_048  # vectors that words outside the sample's vocabulary share
VOCABULARY = 20_000
REACH = 2  # neighbours to each side
HIDDEN = 24
FEATURES = 2 * DIMENSION + 2
SAMPLE_PER_LABEL = 2_000
LEAST_TIMES = 3  # in the sample, of a word of the vocabulary
SLICE = 2_000  # word vectors that one task adds up
TOKENS_AT_ONCE = 65_536
CACHED_WORDS = 200_000
WORD = re.compile(r"\w+|[^\w\s]+")


@dataclass
class WordVectors:
    """Rows: the hashed vectors, then one per word of the vocabulary."""

    table: np.ndarray
    vocabulary: dict
    seen: dict = field(default_factory=dict)

    def ids(self, words: list[str]) -> np.ndarray:
        seen = self.seen
        try:
            return np.array([seen[w] for w in words], np.int64)
        except KeyError:
            if len(seen) > CACHED_WORDS:
                seen.clear()
            for w in set(words):
                if w not in seen:
                    seen[w] = self.vocabulary[w] if w in self.vocabulary else xxhash.xxh64_intdigest(w) % HASHED
            return np.array([seen[w] for w in words], np.int64)

    def pooled(self, words: list[str]) -> np.ndarray:
        """Mean vector, mean bound product of neighbours, its sum, and the log of the length; zeros for no words."""
        made = np.zeros(FEATURES, np.float64)
        ids = self.ids(words)
        if len(ids):
            bound = slice(DIMENSION, 2 * DIMENSION)
            for start in range(0, len(ids), TOKENS_AT_ONCE):
                v = self.table[ids[start : start + TOKENS_AT_ONCE + 1]]  # one more, for the product across the cut
                made[:DIMENSION] += v[:TOKENS_AT_ONCE].sum(0)
                made[bound] += np.einsum("ij,ij->j", v[:-1], v[1:])
            made[:DIMENSION] /= len(ids)
            made[bound] *= DIMENSION / max(1, len(ids) - 1)
            made[-2] = made[bound].mean()
            made[-1] = np.log1p(len(ids)) / 10
        return made


def index_vectors(keys: list[str]) -> np.ndarray:
    """Sparse ternary vectors that depend on nothing but the key."""
    made = np.zeros((len(keys), DIMENSION), np.float32)
    for row, key in zip(made, keys):
        rng = np.random.default_rng(xxhash.xxh64_intdigest(key))
        row[rng.permutation(DIMENSION)[:NONZERO]] = rng.choice((-1.0, 1.0), NONZERO)
    return made


def word_counts(sample: DataFrame) -> DataFrame:
    """(word, n) over whole texts; partial sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in chunks(batches):
            count = Counter(w for text in texts for w in WORD.findall(text))
            yield rows(word=pa.array(list(count), pa.string()), n=pa.array(list(count.values()), pa.int64()))

    return sample.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def contexts(vectors: WordVectors, sample: DataFrame) -> DataFrame:
    """(i, products): of each slice of words, the summed index vectors of what stands around them in whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, total = vectors.table, np.zeros(vectors.table.shape, np.int64)
        for _, texts in chunks(batches):
            for text in texts:
                ids = vectors.ids(WORD.findall(text))
                for start in range(0, len(ids), TOKENS_AT_ONCE):
                    first, end = max(0, start - REACH), start + TOKENS_AT_ONCE
                    near = ids[first : end + REACH]
                    around = np.zeros((len(near), DIMENSION), np.float32)
                    for step in range(1, REACH + 1):
                        around[step:] += index[near[:-step]]
                        around[:-step] += index[near[step:]]
                    own = slice(start - first, start - first + len(ids[start:end]))
                    np.add.at(total, near[own], around[own].astype(np.int64))
        at = range(0, len(total), SLICE)
        yield rows(i=pa.array(list(at), pa.int64()), products=pa.array([total[i : i + SLICE].tobytes() for i in at], pa.binary()))

    return added_arrays(sample.select("text").mapInArrow(run, "i long, products binary"), np.int64)


def learn_vectors(sample: DataFrame) -> WordVectors:
    """Random indexing over a sample: each word sums what stands around it, and its own index vector.

    Counts and sums are made in the tasks, from whole texts; the driver gets the VOCABULARY most frequent words and a vector of each.
    """
    frequent = word_counts(sample).where(F.col("n") >= LEAST_TIMES).orderBy(F.desc("n"), "word").limit(VOCABULARY)
    known = [r["word"] for r in frequent.collect()]
    index = index_vectors([f"hashed {i}" for i in range(HASHED)] + [f"word {w}" for w in known])
    vectors = WordVectors(index, {w: HASHED + i for i, w in enumerate(known)})
    total = index.astype(np.float64)
    for r in contexts(vectors, sample).collect():
        sums = np.frombuffer(r["products"], np.int64).reshape(-1, DIMENSION)
        total[r["i"] : r["i"] + len(sums)] += sums
    unit = total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-9)
    unit -= unit[HASHED:].mean(axis=0) if known else 0  # what all words share tells none apart
    return WordVectors((unit / (np.linalg.norm(unit, axis=1, keepdims=True) + 1e-9)).astype(np.float32), vectors.vocabulary)


def features(vectors: WordVectors, sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Of each row of the sample its label, and what the network sees of its whole text and of a short run of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches):
            made = []
            for text in texts:
                words, rng = WORD.findall(text), np.random.default_rng(xxhash.xxh64_intdigest(text))
                start = int(rng.integers(0, max(1, len(words) - 20)))
                short = words[start : start + int(rng.integers(5, 60))]
                made.append(np.concatenate((vectors.pooled(words), vectors.pooled(short))).tobytes())
            yield rows(doc_id=part.column("doc_id"), quality=part.column("quality"), seen=pa.array(made, pa.binary()))

    kind = sample.schema["doc_id"].dataType.simpleString()
    found = sample.select("doc_id", "text", "quality").mapInArrow(run, f"doc_id {kind}, quality int, seen binary").toArrow()
    ordered = sorted(zip(*(found.column(c).to_pylist() for c in ("doc_id", "quality", "seen"))))
    y = np.array([q for _, q, _ in ordered], np.float64)
    return y, np.array([np.frombuffer(b, np.float64) for _, _, b in ordered]).reshape(-1, 2 * FEATURES)


@dataclass
class QualityNet:
    vectors: WordVectors
    mean: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum((x - self.mean) / self.scale @ self.first + self.first_bias, 0)
        return hidden @ self.second + self.second_bias

    def scores(self, texts: list[str]) -> np.ndarray:
        """Probability of label 1."""
        x = np.stack([self.vectors.pooled(WORD.findall(t)) for t in texts]) if texts else np.zeros((0, FEATURES))
        return sigmoid(self.logits(x) / self.temperature)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def log_loss(logits: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    p = np.clip(sigmoid(logits), 1e-9, 1 - 1e-9)
    return float(-(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / weight.sum())


def train(vectors: WordVectors, y: np.ndarray, seen: np.ndarray, share: float, seed: int = 11, epochs: int = 30) -> QualityNet:
    """Fit on four fifths of the sample and set the temperature on the rest.

    ``share`` is the part of label 1 among all labelled rows; weights undo the sample's balance.
    The short run of words of each document, under its label, joins those that are learned from.
    """
    rng, n = np.random.default_rng(seed), len(y)
    x, y = np.concatenate((seen[:, :FEATURES], seen[:, FEATURES:])), np.concatenate((y, y))
    part = float(np.clip(y.mean(), 1e-6, 1 - 1e-6))
    weight = np.where(y == 1, share / part, (1 - share) / (1 - part)) + 1e-3
    order = rng.permutation(n)
    held, used = order[: n // 5], order[n // 5 :]
    used = np.concatenate((used, used + n))
    mean, scale = x[used].mean(0), x[used].std(0) + 1e-6
    net = QualityNet(
        vectors, mean, scale, rng.normal(0, 0.15, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.2, HIDDEN), 0.0
    )
    names = ("first", "first_bias", "second", "second_bias")
    m, v = {k: 0.0 for k in names}, {k: 0.0 for k in names}
    step = 0
    for _ in range(epochs):
        mixed = rng.permutation(used)
        for i in range(0, len(mixed), 64):
            b = mixed[i : i + 64]
            z = (x[b] - mean) / scale
            before = z @ net.first + net.first_bias
            hidden = np.maximum(before, 0)
            error = (sigmoid(hidden @ net.second + net.second_bias) - y[b]) * weight[b] / weight[b].sum()
            back = np.outer(error, net.second) * (before > 0)
            gradient = {
                "first": z.T @ back + 1e-3 * net.first,
                "first_bias": back.sum(0),
                "second": hidden.T @ error + 1e-3 * net.second,
                "second_bias": error.sum(),
            }
            step += 1
            for k in names:
                m[k] = 0.9 * m[k] + 0.1 * gradient[k]
                v[k] = 0.999 * v[k] + 0.001 * gradient[k] ** 2
                change = m[k] / (1 - 0.9**step) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
                setattr(net, k, getattr(net, k) - 0.004 * change)
    if len(held):
        logits = net.logits(x[held])
        net.temperature = min(np.geomspace(0.5, 8, 61), key=lambda t: log_loss(logits / t, y[held], weight[held]))
    return net


def fit(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> QualityNet | None:
    """Learn ``quality`` from a bounded sample of the rows outside the held-out fold.

    Uses doc_id to join, and text: whole texts of at most ``per_label`` documents of each label are read by the tasks, and
    what the driver gets is bounded by their number. None where there is no labelled text.
    """
    marked = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where("quality in (0, 1)")
    marked = marked.groupBy("doc_id").agg(F.min("quality").alias("quality"))  # a document's worst mark
    usable = docs.select("doc_id", "text").where("text is not null").where(~held_out())
    chosen = bounded_sample(usable.select("doc_id").join(marked, "doc_id"), "quality", per_label, 2 * per_label)
    sample = stored(usable.join(F.broadcast(chosen), "doc_id"), "sample")  # read three times
    if sample.isEmpty():
        return None
    vectors = learn_vectors(sample)
    share = marked.where(~held_out()).agg(F.avg("quality")).first()[0]
    return train(vectors, *features(vectors, sample), share)


def score_quality(docs: DataFrame, net: QualityNet | None) -> DataFrame:
    """Per row of docs: its doc_id, score and predicted (1 from a score of 0.5).

    A null text counts as empty; with no model every score is 0.5. Repeated rows give equal rows; other columns
    and null ids play no part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches):
            scores = net.scores(texts) if net else np.full(len(texts), 0.5)
            yield rows(doc_id=part.column("doc_id"), score=scores, predicted=(scores >= 0.5).astype(np.int32))

    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def keep_good(docs: DataFrame, net: QualityNet | None, least_score: float = 0.5) -> DataFrame:
    """The rows whose text scores ``least_score`` at least; columns as they came."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches):
            scores = net.scores(texts) if net else np.full(len(texts), 0.5)
            yield part.filter(pa.array(scores >= least_score))

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept from training: remainder 1 of 3. False for a null id."""
    return F.coalesce(id_remainder(F.col(doc_id), 3) == 1, F.lit(False))
