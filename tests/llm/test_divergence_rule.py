"""The word rule of the distribution divergence: it leaves texts of their own language and rejects others."""

import random

from gridpulse.llm import divergence
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def judged(spark, rows):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    more = spark.createDataFrame(rows, docs.schema)
    ids = [r[0] for r in rows]
    return {r.doc_id: r for r in divergence.judge(docs.unionAll(more)).collect()}, ids


def good_texts(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").select("doc_id")
    docs = spark.read.parquet(f"{SF}/documents.parquet").join(labels, "doc_id").where("length(text) > 800").select("doc_id", "text", "lang")
    return docs.orderBy("doc_id").collect()


def test_foreign_texts_and_texts_without_common_words_go_and_own_ones_stay(spark):
    rng, good = random.Random(4), good_texts(spark)
    langs = sorted({r.lang for r in good})
    foreign = [(10**9 + r.doc_id, r.text, rng.choice([x for x in langs if x != r.lang])) for r in good[::3]]
    common = {w for r in good for w in r.text.lower().split() if len(w) <= 5}
    bare = []
    for r in good[1::3]:
        words = ["".join(rng.choices("bcdfglmnprstv", k=7)) if w.lower() in common else w for w in r.text.split()]
        bare.append((2 * 10**9 + r.doc_id, " ".join(words), r.lang))
    found, _ = judged(spark, foreign + bare)
    clean = [found[r.doc_id] for r in good]
    assert sum(r.kept for r in clean) >= 0.99 * len(clean)
    assert sum(found[i].kept for i, *_ in foreign) <= 0.15 * len(foreign)  # French and Spanish share some common words
    assert sum(found[i].kept for i, *_ in bare) <= 0.05 * len(bare)
    assert 0.1 < min(r.word_limit for r in clean) and max(r.word_limit for r in clean) < 0.3


def test_short_words_of_any_script_are_common_and_rare_languages_meet_the_pool(spark):
    rng = random.Random(9)
    words = ["он", "на", "и", "в", "не", "но", "да", "ты"]
    text = lambda n: " ".join(rng.choices(words, k=n)) + " " + " ".join(str(rng.randrange(10**6)) for _ in range(n))
    rows = [(i, text(100), "ru") for i in range(60)] + [(100, text(100), "xx"), (101, None, "ru"), (102, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = divergence.references(divergence.counted(docs)).collect()
    own = next(r for r in found if r.lang == "ru")
    assert set(words) <= set(own.words) and own.bare > 0.3 and "xx" not in {r.lang for r in found}
    kept = {r.doc_id: r for r in divergence.judge(docs).collect()}
    assert all(kept[i].kept for i in range(60)) and not kept[101].kept and not kept[102].kept and kept[100].word_limit is not None


def test_the_median_is_that_of_the_steps(spark):
    rows = [("a", 100, d / 100, 0.9) for d in (20, 30, 30, 40, 90)] + [("b", 100, 0.5, 0.2), (None, 100, 0.3, 0.9), ("c", 5, 0.3, 0.9), ("d", 100, None, 0.9)]
    table = spark.createDataFrame(rows, "key string, n_words int, word_distance double, bare double")
    limits = {r.of: r.limit for r in divergence.word_limits(table).collect()}
    noise = divergence.NOISE * (25 / 800) ** 0.5
    at = lambda d: -(-(d - noise) * 1000 // 1) / 1000 * divergence.WORD_SPREAD
    assert limits.keys() == {"a", "b", None}
    assert abs(limits["a"] - at(0.3)) < 1e-9 and limits["b"] == 0.2 * divergence.WORD_SHARE and limits[None] == limits["a"]
    assert divergence.judge(table.select(F.lit(1).alias("doc_id"), F.col("key").alias("text"), F.col("key").alias("lang"))).count() == 9


def test_words_of_any_length_are_common(spark):
    rng = random.Random(9)
    words = ["что", "это", "как", "здравствуйте", "on"]
    text = lambda n: " ".join(rng.choices(words, k=n)) + " " + " ".join(str(rng.randrange(10**6)) for _ in range(n))
    rows = [(i, text(100), "ru") for i in range(60)] + [(100, None, "ru"), (101, "Ⱥ" * 9 + " on", None), (101, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    own = next(r for r in divergence.references(divergence.counted(docs)).collect() if r.lang == "ru")
    assert set(words) <= set(own.words) and own.longest == 24 and own.bare > 0.3
    common = divergence.common_words(divergence.word_counts(divergence.spoken(docs)))
    found = divergence.histograms(divergence.counted(docs), common).collect()
    at = sorted(own.words, key=own.words.get)
    texts = {i: (t or "").split() for i, t, lang in rows if lang == "ru"}
    for r in found:
        if r.lang == "ru":
            named = [texts[r.doc_id].count(w) for w in at]
            assert r.bins == [*named, len(texts[r.doc_id]) - sum(named)]
    kept = {r.doc_id: r.kept for r in divergence.judge(docs).collect()}
    assert all(kept[i] for i in range(60)) and not kept[100]


def test_common_words_are_looked_up_in_one_text(spark):
    rng = random.Random(4)
    words = ["so,", "a,b", ",", "so", "b", "a"]
    text = lambda n: " ".join(rng.choices(words, k=n)) + " \t\n" + " ".join(str(rng.randrange(10**6)) for _ in range(n))
    texts = [text(100) for _ in range(60)] + ["\x0b \nso,\nso,\n \x0b\n \x0b\n", "", None]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    counted = divergence.counted(docs)
    common = divergence.common_words(divergence.word_counts(divergence.spoken(docs)))
    own = next(r for r in common.collect() if r.lang == "en")
    at = sorted(own.words, key=own.words.get)
    assert set(words) <= set(at)
    histograms = divergence.histograms(counted, common)
    for r in histograms.collect():
        found = (texts[r.doc_id] or "").split()
        named = [found.count(w) for w in at]
        assert r.bins == [*named, len(found) - sum(named)] and r.word_chars == sum(map(len, found))
        assert r.n_dup_lines == (1 if r.doc_id == 60 else 0)
    plan = histograms._jdf.queryExecution().optimizedPlan().toString()
    assert "find_in_set" in plan and "ref_words" not in plan  # no map of words is searched key by key
    assert "translate" not in plan  # a line is not read beyond its first word
