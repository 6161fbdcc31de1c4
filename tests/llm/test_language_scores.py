"""The least scores of a language's own texts, of every learned text."""

import random

import numpy as np
from gridpulse.llm import byte_cnn


def test_least_scores_are_those_of_every_learned_text(spark):
    rng = random.Random(5)
    words = {"en": ["the", "of", "and", "house", "with", "la"], "fr": ["le", "et", "maison", "avec", "dans", "the"]}

    def text(lang):
        other = words["fr" if lang == "en" else "en"]
        return " ".join(rng.choice(words[lang] if rng.random() < 0.75 else other) for _ in range(rng.choice((3, 8, 90))))

    langs = ["en"] * 1500 + ["fr"] * 200 + [None] * 5
    rows = [(i, text(lang or "en"), lang) for i, lang in enumerate(langs)]
    rows += [(9_000, None, "en"), (9_001, "", "en"), (None, "the house", "en"), (7, rows[7][1], "en")]  # a row comes twice
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    net = byte_cnn.fit(docs.where("doc_id < 40 or doc_id between 1500 and 1540"))
    used = [(t, lang) for i, t, lang in rows if i is not None and lang and t]
    named, scores = byte_cnn.predict([t for t, _ in used], net)
    own = [(byte_cnn.length_class(t), s) for (t, lang), name, s in zip(used, named, scores) if name == lang]
    assert len(own) > 2 * byte_cnn.SAMPLE_PER_LANGUAGE * 0.6
    want = [np.quantile([s for _, s in own], byte_cnn.LEAST_QUANTILE)]
    for k in range(byte_cnn.LENGTHS):
        of = [s for length, s in own if length == k]
        want.append(np.quantile(of, byte_cnn.LEAST_QUANTILE) if len(of) >= byte_cnn.LEAST_TEXTS else want[-1])
    assert np.allclose(byte_cnn.least_scores(docs, net), want[1:], rtol=0, atol=1e-6)
    assert byte_cnn.least_scores(docs.where("text is null"), net) == [0.0] * byte_cnn.LENGTHS


def test_scores_of_a_rank_are_exact(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.random(3000), np.ones(500), [0.0, 1e-300, np.nextafter(0.5, 1), 0.5]])
    pairs = [(0, int(b)) for b in values.view(np.int64)] + [(1, int(b)) for b in values[:7].view(np.int64)]
    table = spark.createDataFrame(pairs, "length long, bits long").repartition(7)
    found = byte_cnn.values_at(table, {0: {0, 1, 60, 61, 2999, 3503}, 1: {0, 6}})
    in_order = {0: np.sort(values), 1: np.sort(values[:7])}
    assert found == {(k, r): in_order[k][r] for k, r in found} and len(found) == 8
