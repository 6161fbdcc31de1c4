"""The registered queries at sf0.001: against SQL where there is some, else their shape and coverage."""

import random
from pathlib import Path

import corpus_pipeline
import duckdb
import pytest
from gridpulse.llm import queries as registered

KEYS = {"op1_site_tree": ("pages", "page_id"), "op9_zip_warc": ("pages", "page_id"), "op12_feast": ("embeddings", "vec_id")}


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_query_equals_sql(spark, database, sf_dir, name):
    df = registered.queries()[name](spark, sf_dir)
    expected = database.sql(registered.oracle_sql()[name])
    assert sorted(df.columns) == sorted(expected.columns)
    got = sorted(map(tuple, df.select(*expected.columns).collect()), key=repr)
    assert got == sorted(expected.fetchall(), key=repr) and got


@pytest.mark.parametrize("name", sorted(set(registered.queries()) - set(registered.oracle_sql())))
def test_query_covers_its_table(spark, sf_dir, name):
    table, key = KEYS.get(name, ("documents", "doc_id"))
    ids = {r[0] for r in registered.queries()[name](spark, sf_dir).select(key).collect()}
    assert ids == {r[0] for r in spark.read.parquet(f"{sf_dir}/{table}.parquet").select(key).collect()}


def test_pipeline_keeps_one_of_each_group_and_packs_it(spark, sf_dir):
    docs, seen = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), "test-stage")
        seen.append({r[0] for r in docs.select("doc_id").distinct().collect()})
        if name != "packing":
            assert docs.columns == before.columns
    spoken, good, single, packed = seen
    assert single == packed and packed < good < spoken
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    clean = {i for i in spoken if labels.get(i) == 1}
    assert len(clean - good) <= 0.02 * len(clean)
    assert sum(labels.get(i) == 0 for i in good) <= 0.2 * sum(labels.get(i) == 0 for i in spoken)
    whole = docs.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert all(r["sum(length)"] == r["max(doc_tokens)"] for r in whole)


def test_language_stage_rejects_what_is_in_no_learned_language(spark):
    sf = "/root/testdata/sf0.01"
    docs, rng = spark.read.parquet(f"{sf}/documents.parquet"), random.Random(3)
    unlearned = [
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan ja heille on annettu järki ja omatunto. ",
        "Все люди рождаются свободными и равными в своем достоинстве и правах, они наделены разумом и совестью. ",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw, są obdarzeni rozumem i sumieniem. ",
        "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar, akıl ve vicdana sahiptirler. ",
    ]
    texts = [t * 40 for t in unlearned]
    texts += [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 10))) for _ in range(1500)) for _ in range(20)]
    ids = range(10**9, 10**9 + len(texts))
    more = spark.createDataFrame([(i, t, None, "test", len(t)) for i, t in zip(ids, texts)], docs.select(*corpus_pipeline.COLUMNS).schema)
    kept = corpus_pipeline.language(spark, docs.select(*corpus_pipeline.COLUMNS).unionAll(more), sf)
    kept = {r[0] for r in kept.select("doc_id").collect()}
    clean = {r[0] for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").join(docs, "doc_id").select("doc_id").collect()}
    assert not kept & set(ids)
    assert len(clean - kept) <= 0.02 * len(clean)
