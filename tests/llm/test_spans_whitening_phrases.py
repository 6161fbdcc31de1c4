"""Personal data, whitening and collocations on small fixtures: odd rows, brute force, and texts made to be slow."""

import collections
import hashlib
import math
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from gridpulse.llm import collocations, common, feast, jaccard_tiles, pii
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, spans int, score double, f int"

# --- personal data -------------------------------------------------------------------

PLAIN = {"email": pii.EMAIL.plain, "ip": pii.IP.plain, "card": pii.CARD.plain, "phone": pii.PHONE.plain}


def luhn(digits):
    double = [int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))]
    return sum(double) % 10 == 0


def fits(kind, m):
    digits = re.sub("[^0-9]", "", m)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in m.split(".")),
        "card": lambda: 12 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 9 <= len(digits) <= 15,
    }[kind]()


def base_spans(text):
    found = [
        (m.start(), i, kind, m.end())
        for i, (kind, pattern) in enumerate(PLAIN.items())
        if {"email": "@", "ip": "."}.get(kind, "") in (text or "")  # the plain patterns take long on long runs
        for m in re.finditer(pattern, text or "")
        if fits(kind, m.group())
    ]
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found)]


def personal_texts():
    rng = random.Random(5)
    letters = "ab.@-+ 0123456789()4é\U0001f389\n%_" + "0123456789 .-" * 2
    made = ["".join(rng.choices(letters, k=rng.randrange(200))) for _ in range(300)]
    bits = ["a.b@c.de", "x@y", "a@b.c_d@e.f", "1.2.3.4", "1.2.3.4.5.6.7.8.9", "256.1.1.1", "001.2.3.0255", "4111 1111 1111 1111",
            "4111-1111-1111-1112", "+49 (30) 123-45.67", "+1 2", "+1 (523) 555-1055", "é", "\U0001f389", " ", ", ", "\n"]
    made += ["".join(rng.choices(bits, k=rng.randrange(1, 12))) for _ in range(300)]
    return [None, "", " \n", *made]


def test_base_spans_equal_the_plain_patterns(spark):
    texts = personal_texts()
    rows = [(i, t, None, 1, 0.5, 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame([*rows, rows[-1], (None, "a@b.cd", None, 1, 0.5, 1)], SCHEMA).repartition(3)
    got = [r for r in pii.report(df).collect()]
    assert len(got) == len(texts) + 2
    for r in got:
        text = "a@b.cd" if r.doc_id is None else texts[r.doc_id]
        expected = base_spans(text)
        count = collections.Counter(s.split(":")[0] for s in expected)
        assert r.base_sha256 == hashlib.sha256(",".join(expected).encode()).hexdigest(), text
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [count[k] for k in PLAIN]
        assert set(expected) <= set(r.spans.split(","))
        assert [int(s.split(":")[1]) for s in r.spans.split(",") if s] == sorted(int(s.split(":")[1]) for s in r.spans.split(",") if s)


FURTHER = [
    ("Pay to DE89 3704 0044 0532 0130 00 AND wait", ["iban:7:34"]),
    ("GB82WEST12345698765432.", ["iban:0:22"]),
    ("DE89 3704 0044 0532 0130 01", []),  # wrong remainder
    ("DE89370400440532013000X", []),  # longer than an account number
    ("ssn 123-45-6789", ["ssn:4:15"]),
    ("part 123-45-6789", []),
    ("ssn 000-45-6789, 666-45-6789, 923-45-6789", []),
    ("call (523) 555-1055 now", ["phone:5:19"]),
    ("code (523) 555-1055 now", []),
    ("call +1 (523) 555-1055", ["phone:5:22"]),
    ("two 7536784127813050 4111111111111111 here", ["card:21:37"]),  # together too long for one card
    ("two 7536784127813050 9536784127813059 here", []),
    ("1.2.3.4 is a server", ["ip:0:7"]),
]


@pytest.mark.parametrize("text, expected", FURTHER)
def test_further_spans(spark, text, expected):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert pii.report(df).first().spans == ",".join(expected)


def test_words_nearby_change_the_score_and_base_spans_stay(spark):
    texts = ["version 1.2.3.4", "a 1.2.3.4", "server 1.2.3.4", "1234567890123 4111111111111111", "visa 2111111111111117 x"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.find_spans(df).collect()}
    assert [got[i][0].score for i in range(3)] == [20, 50, 80] and all(got[i][0].base for i in range(3))
    assert [(s.kind, s.start, s.base) for s in got[3]] == [("card", 14, False)]


@pytest.mark.parametrize(
    "bit", ["a", "1", "a@", "a@b", "1.", "1 ", "+", "+1", "+1 ", "(", "(1", "1-", "AB12 ", "A", ".", "a@b.", "123-45-6789 ", "4111 1111 1111 1111 ", "\U0001f389"]
)
def test_long_texts_take_linear_time(spark, bit):
    text = (bit * 300_000)[:300_000]
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    start = time.perf_counter()
    r = pii.report(df).first()
    assert time.perf_counter() - start < 30
    assert r.base_sha256 == hashlib.sha256(",".join(base_spans(text)).encode()).hexdigest()


def test_personal_data_of_an_empty_table(spark):
    assert pii.report(spark.createDataFrame([], SCHEMA)).collect() == []


# --- whitening -----------------------------------------------------------------------


def vectors_table(spark, vectors, ids=None):
    rows = [(i if ids is None else ids[i], v, 3, 0.5) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, component int, whitened double").repartition(3)


def test_whitening_equals_a_full_decomposition(spark):
    rng = np.random.default_rng(3)
    good = (rng.normal(size=(400, 20)) @ rng.normal(size=(20, 20))).astype(np.float32)
    odd = [None, [], [1.0] * 3, [math.nan] + [0.0] * 19, [math.inf] + [0.0] * 19, [None] + [0.0] * 19]
    table = vectors_table(spark, [*good.tolist(), *odd])
    got = feast.whiten(table).toPandas()
    assert len(got) == 400 * 8 and set(got.component) == set(range(1, 9)) and set(got.n) == {400}
    x = np.floor(1024 * good.astype(float)).astype(np.int64) + 100_000
    s = x.sum(0)
    exact = {i: sum((400 * int(a) - int(b)) ** 2 for a, b in zip(v, s)) for i, v in enumerate(x)}
    assert all(exact[r.vec_id] == r.deviation for r in got.itertuples())
    centred = x - s / 400
    values, vectors = np.linalg.eigh(centred.T @ centred / 400)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    explained = got.groupby("component").explained.first().to_numpy()
    assert np.allclose(explained, values / np.trace(centred.T @ centred / 400), rtol=1e-12)
    made = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    for c in range(8):
        expected = centred @ vectors[:, c] / np.sqrt(values[c])
        sign = np.sign(expected @ made[:, c])
        assert np.allclose(made[:, c], sign * expected, rtol=0, atol=1e-9)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9


def test_eigenpairs_with_ties_gaps_and_more_than_one_interval():
    rng = np.random.default_rng(8)
    turn, _ = np.linalg.qr(rng.normal(size=(40, 40)))
    for spectrum in (np.r_[np.full(12, 2.0), np.full(28, 1.0)], np.logspace(0, -12, 40), np.linspace(3, 1, 40), np.r_[5.0, np.zeros(39)]):
        matrix = (turn * spectrum) @ turn.T
        matrix = (matrix + matrix.T) / 2
        for k in (1, 8, 20):
            values, vectors = feast.leading_pairs(matrix, k)
            real = spectrum[:k][spectrum[:k] > 40 * np.finfo(float).eps * spectrum.sum()]
            assert np.allclose(values, real, rtol=1e-9, atol=1e-13) and np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-9)
            assert np.abs(matrix @ vectors - vectors * values).max(initial=0) < 1e-11
    for shift in (-3.0, 0.0, 2.5):
        matrix = rng.normal(size=(30, 30))
        matrix = matrix + matrix.T
        assert feast.count_above(matrix, shift) == (np.linalg.eigvalsh(matrix) > shift).sum()
    assert feast.count_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


def test_whitening_of_odd_tables(spark):
    assert feast.whiten(vectors_table(spark, [])).collect() == []
    assert feast.whiten(vectors_table(spark, [None, []])).collect() == []
    assert feast.whiten(vectors_table(spark, [[1.0, 2.0]] * 5)).collect() == []  # no variance
    two = feast.whiten(vectors_table(spark, [[1.0, 2.0], [1.0, 4.0], [1.0, 4.0], [3.0, 4.0]], [7, None, None, 9])).collect()
    assert len(two) == 8 and sum(r.vec_id is None for r in two) == 4 and {r.n for r in two} == {4}
    large = feast.whiten(vectors_table(spark, [[1e15, 0.0], [-1e15, 1.0], [2e14, 2.0]])).collect()
    assert large and all(r.deviation is None for r in large if r.vec_id < 2) and {r.identity_error < 1e-4 for r in large} == {True}
    assert feast.whiten(vectors_table(spark, [[1e30, 0.0], [1.0, 1.0], [2.0, 3.0]])).select("n").first().n == 2


# --- collocations --------------------------------------------------------------------


def brute_collocations(docs, least, most):
    f, n = collections.Counter(), collections.Counter()
    for text, lang in docs:
        lang, text = lang or "und", "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i : i + k])) for k in range(1, 5) for i in range(len(words) - k + 1))
    candidates = {(lang, w): a for (lang, w), a in f.items() if len(w) > 1 and a >= least}
    inside = collections.Counter()
    for (lang, w), a in candidates.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                inside[lang, w[i : i + k]] = max(inside[lang, w[i : i + k]], a)
    found = collections.defaultdict(list)
    for (lang, w), a in candidates.items():
        if 100 * inside[lang, w] >= 80 * a:
            continue
        cuts = [(2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w))]
        score, _, left, right = min(cuts)
        found[lang].append((-score, -a, " ".join(w).encode(), left, right))
    return {
        (lang, rank, p.decode(), -a, left, right, n[lang], -score)
        for lang, rows in found.items()
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:most], 1)
    }


def phrase_docs():
    rng = random.Random(11)
    words = [rng.choice("abcdefgh") + str(rng.randrange(4)) for _ in range(60)] + ["é", "ÀB", "x\x1cy", "x y", "The", "the"]
    weights = [1 / (i + 1) for i in range(len(words))]
    ends = [" "] * 8 + ["\t", ". ", ", ", "\n", "\r", "!", "  "]
    made = [("".join(w + rng.choice(ends) for w in rng.choices(words, weights, k=rng.randrange(300))), rng.choice(["en", "de", None, "und"])) for _ in range(200)]
    made += [(None, "en"), ("", None), (" \n\t.", "de"), ("one", "en")]
    return made + made[:20]


@pytest.mark.parametrize("capacity, chunk, segment", [(200_000, 10**6, 10**6), (30, 50, 64), (60, 200, 1)])
def test_collocations_equal_brute_force(spark, monkeypatch, capacity, chunk, segment):
    docs = phrase_docs()
    monkeypatch.setattr(collocations.Scanner, "__init__", lambda self, c=chunk, old=collocations.Scanner.__init__: old(self, c))
    monkeypatch.setattr(jaccard_tiles, "SEGMENT", segment)
    rows = [(i, t, lang, 1, 0.5, 1) for i, (t, lang) in enumerate(docs)]
    df = spark.createDataFrame([*rows, rows[3], (None, "the the the", "en", 1, 0.5, 1)], SCHEMA).repartition(4)
    docs = [*docs, docs[3], ("the the the", "en")]
    for least, most in ((30, 2000), (6, 25)):
        got = {tuple(r) for r in collocations.collocations(df, least, most, capacity).collect()}
        assert got == brute_collocations(docs, least, most) and got


def test_summaries_keep_every_frequent_phrase():
    rng = np.random.default_rng(4)
    for least in (3, 10, 50):
        stream = np.concatenate([rng.zipf(1.3, 20_000) % 5_000, rng.integers(0, 10**6, 20_000)]).astype(np.uint64)
        rng.shuffle(stream)
        capacity, held, times, off = len(stream) // least + 1, np.empty(0, np.uint64), np.empty(0, np.int64), 0
        for part in np.array_split(stream, 37):
            value, n = np.unique(part, return_counts=True)
            held, times, more = collocations.merge(*collocations.fold(np.concatenate((held, value)), np.concatenate((times, n))), capacity)
            off += more
            assert len(held) <= capacity
        value, n = np.unique(stream, return_counts=True)
        assert off < least and set(value[n >= least]) <= set(held[times + off >= least])


def test_the_map_of_phrases_lets_none_be_missed(spark):
    value = np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 3_000)
    bits = collocations.bit_map(spark.createDataFrame([(int(v),) for v in value], "h long"), len(value))
    spot = value.view(np.uint64) & np.uint64(len(bits) * 64 - 1)
    assert all(int(bits[int(s) >> 6]) >> (int(s) & 63) & 1 for s in spot)
    assert sum(int(b).bit_count() for b in bits) == len(set(spot.tolist()))


def test_collocations_of_long_texts_and_an_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    long = [(1, "a" * 5_000_000, "en"), (2, "a b " * 1_000_000, "en"), (3, " " * 3_000_000, "en"), (4, "." * 3_000_000, "en")]
    got = collocations.collocations(spark.createDataFrame(long, "doc_id long, text string, lang string")).collect()
    n = 2_000_001
    assert {(r.phrase, r.a, r.n) for r in got} == {("a b a b", 999_999, n), ("b a b a", 999_998, n)}


def test_batches_of_large_rows_are_bounded_in_bytes(spark, monkeypatch):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    name, limits, stored = "spark.sql.execution.arrow.maxBytesPerBatch", [], collocations.stored
    before = spark.conf.get(name)
    monkeypatch.setattr(collocations, "stored", lambda df, label: limits.append(int(spark.conf.get(name))) or stored(df, label))
    df = spark.createDataFrame([(1, "a b c. " * 40, "en"), (2, None, None)], "doc_id long, text string, lang string")
    assert [r.phrase for r in collocations.collocations(df).collect()] == ["a b c"]
    assert len(limits) == 3 and set(limits) == {collocations.BATCH_BYTES} and spark.conf.get(name) == before
    large = spark.range(0, 60, 1, 1).select(F.repeat(F.lit("x"), 1_000_000).cast("binary").alias("b"))
    with common.arrow_bytes(spark, collocations.BATCH_BYTES):
        got = [r.n for r in large.mapInArrow(sizes, "n long").collect()]
    assert max(got) <= collocations.BATCH_BYTES + 1_100_000 and sum(got) >= 60_000_000
