"""Language identification by a byte convolutional network.

Bytes are embedded, filters of several widths slide over windows of fixed length, each filter
keeps its maximum, and a softmax names the language. Training and use are numpy; every window of
a text counts, by its number of bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import chunks, id_remainder, rows, small_batches, stored
from gridpulse.llm.sampling import bounded_sample

WINDOW = 256  # bytes
WIDTHS = (2, 3, 4)
FILTERS = 16  # of each width
EMBEDDING = 6
SAMPLE_PER_LANGUAGE = 800  # documents to learn from
SAMPLE_ROWS = 20_000  # in all
SAMPLE_WINDOWS = 4  # of a document
WINDOWS_AT_ONCE = 256
LEAST_QUANTILE = 0.02  # of the learned languages' own scores: texts of their length that score less are in none of them
LEAST_TEXTS = 50  # of a length that have a quantile of their own
LENGTHS = 16  # classes of texts: of 1, 2 to 3, 4 to 7 windows and so on
ALL_LENGTHS = -1  # the class of all texts together
DIGIT_BITS = 12  # of a score that one pass over the scores finds
UNDECIDED = "und"
LETTER = regex.compile(r"\p{L}")


@dataclass
class ByteCnn:
    """Weights; byte 0 pads and embeds as zero. ``conv`` holds all widths, shorter filters ending in zeros."""

    languages: list
    embedding: np.ndarray  # 256 x EMBEDDING
    conv: np.ndarray  # (max width * EMBEDDING) x filters
    bias: np.ndarray
    out: np.ndarray  # filters x languages
    out_bias: np.ndarray

    def unfolded(self, windows: np.ndarray) -> np.ndarray:
        """(windows, positions, max width * EMBEDDING)"""
        padded = np.pad(windows, ((0, 0), (0, max(WIDTHS) - 1)))
        x = self.embedding[padded]
        n, length = windows.shape
        return np.concatenate([x[:, j : j + length] for j in range(max(WIDTHS))], axis=2)

    def logits(self, windows: np.ndarray) -> np.ndarray:
        n, length = windows.shape
        u = self.unfolded(windows).reshape(n * length, -1)
        top = (u @ self.conv).reshape(n, length, -1).max(axis=1) + self.bias
        return np.maximum(top, 0) @ self.out + self.out_bias

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        made = [softmax(self.logits(windows[i : i + WINDOWS_AT_ONCE])) for i in range(0, len(windows), WINDOWS_AT_ONCE)]
        return np.concatenate(made) if made else np.empty((0, len(self.languages)), np.float32)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the texts; of each its text's position and its number of bytes."""
    lengths = np.array([len(t) for t in texts], np.int64)
    counts = -(-lengths // WINDOW)
    flat = np.zeros(int(counts.sum()) * WINDOW, np.uint8)
    start = 0
    for text, count in zip(texts, counts.tolist()):
        flat[start : start + len(text)] = np.frombuffer(text, np.uint8)
        start += count * WINDOW
    owner = np.repeat(np.arange(len(texts)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return flat.reshape(-1, WINDOW), owner, np.minimum(WINDOW, lengths[owner] - nth * WINDOW)


def train(windows: np.ndarray, labels: np.ndarray, languages: list, epochs: int = 5, seed: int = 7) -> ByteCnn:
    """Fit by Adam on cross-entropy; the gradient flows through the winning position of each filter."""
    rng = np.random.default_rng(seed)
    depth, n_filters = max(WIDTHS) * EMBEDDING, FILTERS * len(WIDTHS)
    mask = np.zeros((depth, n_filters), np.float32)
    for i, width in enumerate(WIDTHS):
        mask[: width * EMBEDDING, i * FILTERS : (i + 1) * FILTERS] = 1
    embedding = rng.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32)
    embedding[0] = 0
    conv = rng.normal(0, 0.4, (depth, n_filters)).astype(np.float32) * mask
    out = rng.normal(0, 0.2, (n_filters, len(languages))).astype(np.float32)
    net = ByteCnn(languages, embedding, conv, np.zeros(n_filters, np.float32), out, np.zeros(len(languages), np.float32))
    names = ("embedding", "conv", "bias", "out", "out_bias")
    first = {k: np.zeros_like(getattr(net, k)) for k in names}
    second = {k: np.zeros_like(getattr(net, k)) for k in names}
    step, size = 0, 64
    steps = epochs * -(-len(windows) // size)
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for i in range(0, len(order), size):
            x, y = windows[order[i : i + size]], labels[order[i : i + size]]
            n = len(x)
            u = net.unfolded(x)
            z = (u.reshape(-1, depth) @ net.conv).reshape(n, WINDOW, n_filters)
            at = z.argmax(axis=1)
            top = np.take_along_axis(z, at[:, None], 1)[:, 0] + net.bias
            hidden = np.maximum(top, 0)
            error = softmax(hidden @ net.out + net.out_bias)
            error[np.arange(n), y] -= 1
            error /= n
            back = (error @ net.out.T) * (top > 0)
            won = u[np.arange(n)[:, None], at]  # windows x filters x depth
            slot = np.einsum("nf,df->nfd", back, net.conv).reshape(-1, EMBEDDING)
            padded = np.pad(x, ((0, 0), (0, max(WIDTHS) - 1)))
            touched = padded[np.arange(n)[:, None, None], at[:, :, None] + np.arange(max(WIDTHS))].reshape(-1)
            at_byte = np.stack([np.bincount(touched, slot[:, e], 256) for e in range(EMBEDDING)], 1)
            at_byte[0] = 0
            gradient = {
                "embedding": at_byte,
                "conv": np.einsum("nf,nfd->df", back, won) * mask,
                "bias": back.sum(0),
                "out": hidden.T @ error,
                "out_bias": error.sum(0),
            }
            step += 1
            rate = np.float32(0.01 * (1 - step / (steps + 1)))
            for k in names:
                g = gradient[k].astype(np.float32)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                change = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                setattr(net, k, getattr(net, k) - rate * change)
    return net


def fit(labelled: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, sample_rows: int = SAMPLE_ROWS) -> ByteCnn | None:
    """Learn from a bounded sample of rows (doc_id, text, lang); a few windows of each reach the driver.

    None where no row has both a text and a language.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches):
            found, langs = [], []
            for text, lang in zip(texts, part.column("lang").to_pylist()):
                data = text.encode()
                last = max(0, len(data) - WINDOW)
                for start in sorted({last * i // max(1, SAMPLE_WINDOWS - 1) for i in range(SAMPLE_WINDOWS)}):
                    found.append(data[start : start + WINDOW])
                    langs.append(lang)
            yield rows(piece=pa.array(found, pa.binary()), lang=pa.array(langs, pa.string()))

    small_batches(labelled.sparkSession)
    usable = labelled.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).where("text != ''")
    chosen = bounded_sample(usable.select("doc_id", "lang"), "lang", per_language, sample_rows)
    sample = usable.join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi")
    pieces = sample.select("text", "lang").mapInArrow(cut, "piece binary, lang string").toArrow()
    pairs = sorted(zip(pieces.column("lang").to_pylist(), pieces.column("piece").to_pylist()))
    if not pairs:
        return None
    languages = sorted({lang for lang, _ in pairs})
    windows, _, _ = windows_of([piece for _, piece in pairs])
    number = {lang: i for i, lang in enumerate(languages)}
    return train(windows, np.array([number[lang] for lang, _ in pairs]), languages)


def predict(texts: list[str], net: ByteCnn | None) -> tuple[list[str], list[float]]:
    """Language and probability of each text; ``und`` and 0 without a letter or a model."""
    spoken = [net is not None and LETTER.search(t) is not None for t in texts]
    langs, scores = [UNDECIDED] * len(texts), [0.0] * len(texts)
    places = [i for i, ok in enumerate(spoken) if ok]
    if places:
        windows, owner, weight = windows_of([texts[i].encode() for i in places])
        chance = net.probabilities(windows) * weight[:, None]
        total = np.stack([np.bincount(owner, chance[:, c], len(places)) for c in range(len(net.languages))], 1)
        total /= total.sum(axis=1, keepdims=True)
        for i, best, row in zip(places, total.argmax(axis=1), total):
            langs[i], scores[i] = net.languages[best], float(min(1.0, row[best]))
    return langs, scores


def identify(docs: DataFrame, net: ByteCnn | None) -> DataFrame:
    """Per row of docs: its doc_id, lang_pred and score, from every window of its text.

    A null text, or one without a letter, is ``und`` with score 0. Repeated rows give equal rows;
    other columns, and null ids, play no part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, limit=1_000_000):
            langs, scores = predict(texts, net)
            ids = part.column("doc_id")
            yield rows(doc_id=ids, lang_pred=pa.array(langs, pa.string()), score=pa.array(scores, pa.float64()))

    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def length_class(text: str) -> int:
    return min(max(1, -(-len(text.encode()) // WINDOW)).bit_length(), LENGTHS) - 1


def values_at(table: DataFrame, ranks: dict[int, set[int]]) -> dict[tuple[int, int], float]:
    """By (length, rank): the score of that rank, from 0, among the table's rows (length, bits) of that length.

    Bits are those of a double of 0 or more, which order like the doubles. Each pass counts rows by DIGIT_BITS more of them, of those
    that begin like a wanted score, so counts alone reach the driver, and no task sorts or holds the scores of a length.
    """
    found = {(length, rank): (0, rank) for length, some in ranks.items() for rank in some}
    shift = 63  # no bit is known yet
    while shift and found:
        known, shift = shift, max(0, shift - DIGIT_BITS)
        begun = sorted({(length, prefix) for (length, _), (prefix, _) in found.items()})
        begun = F.broadcast(table.sparkSession.createDataFrame(begun, "length long, prefix long"))
        rows_of = table.withColumn("prefix", F.shiftright("bits", known)).join(begun, ["length", "prefix"])
        counts = rows_of.groupBy("length", "prefix", F.shiftright("bits", shift).alias("next")).agg(F.count("*").alias("n")).toArrow().to_pylist()
        steps: dict[tuple[int, int], list] = {}
        for c in sorted(counts, key=lambda c: c["next"]):
            steps.setdefault((c["length"], c["prefix"]), []).append((c["next"], c["n"]))
        for (length, rank), (prefix, left) in found.items():
            for following, n in steps[length, prefix]:
                if left < n:
                    break
                left -= n
            found[length, rank] = following, left
    return {at: float(np.array([bits], np.int64).view(np.float64)[0]) for at, (bits, _) in found.items()}


def least_scores(labelled: DataFrame, net: ByteCnn | None) -> list[float]:
    """Of each class of lengths, the score that LEAST_QUANTILE of the texts do not reach whose language ``net`` names rightly.

    Every whole text of the rows (doc_id, text, lang) that have an id, a text and a language counts; the scores, stored, stay with
    the tasks. A class with few texts has the quantile of the next shorter one, or of all where there is none. No text at all: 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, limit=1_000_000):
            langs, scores = predict(texts, net)
            own = pa.array([a == b for a, b in zip(langs, part.column("lang").to_pylist())], pa.bool_())
            bits = np.array(scores, np.float64).view(np.int64)
            yield rows(length=pa.array([length_class(t) for t in texts], pa.int64()), bits=bits).filter(own)

    small_batches(labelled.sparkSession)
    usable = labelled.where("doc_id is not null and lang is not null and text != ''").select("text", F.col("lang").cast("string").alias("lang"))
    scored = stored(usable.mapInArrow(run, "length long, bits long"), "language-scores")
    sizes = {r["length"]: r["n"] for r in scored.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return [0.0] * LENGTHS
    sizes[ALL_LENGTHS] = sum(sizes.values())
    places = {k: LEAST_QUANTILE * (n - 1) for k, n in sizes.items() if n >= LEAST_TEXTS or k == ALL_LENGTHS}
    ranks = {k: {int(at), min(int(at) + 1, sizes[k] - 1)} for k, at in places.items()}
    found = values_at(scored.unionAll(scored.withColumn("length", F.lit(ALL_LENGTHS).cast("long"))), ranks)
    quantile = {k: float(np.quantile([found[k, r] for r in sorted(ranks[k])], at - int(at))) for k, at in places.items()}
    least = [quantile[ALL_LENGTHS]]
    for k in range(LENGTHS):
        least.append(quantile.get(k, least[-1]))
    return least[1:]


def keep_spoken(docs: DataFrame, net: ByteCnn | None, least: list[float]) -> DataFrame:
    """The rows whose language the network names with the ``least`` score of their length at least; columns as they came."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, limit=1_000_000):
            langs, scores = predict(texts, net)
            yield part.filter(pa.array([x != UNDECIDED and s >= least[length_class(t)] for t, x, s in zip(texts, langs, scores)], pa.bool_()))

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept from training: remainder 2 of 4. False for a null id."""
    return F.coalesce(id_remainder(F.col(doc_id), 4) == 2, F.lit(False))
