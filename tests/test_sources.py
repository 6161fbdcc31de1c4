import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from gridpulse import schemas
from gridpulse.config import GRANULARITIES, ONE_MINUTE, Pipeline
from gridpulse.plans import common
from gridpulse.session import job_session, shared_folder
from gridpulse.sources.jdbc import Database, serving_ddl, slice_predicates
from gridpulse.sources.kafka import topic_options
from gridpulse.sources.objectstore import s3a_settings


def test_topic_options():
    assert topic_options("broker:9092", "readings") == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "readings",
        "startingOffsets": "latest",
    }
    more = topic_options("b:1", "t", starting_offsets="earliest", max_offsets_per_trigger=10, min_partitions=64)
    assert (more["startingOffsets"], more["maxOffsetsPerTrigger"], more["minPartitions"]) == ("earliest", "10", "64")


def test_object_store_settings_come_from_the_environment():
    given = {"ENDPOINT": "http://store:9000", "ACCESS_KEY": "a", "SECRET_KEY": "b"}
    settings = s3a_settings({f"GRIDPULSE_S3_{key}": value for key, value in given.items()})
    assert settings["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert settings["spark.hadoop.fs.s3a.access.key"] == "a" and settings["spark.hadoop.fs.s3a.secret.key"] == "b"
    assert settings["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert len(settings) == 5
    assert not any("key" in k for k in s3a_settings({}))


def test_database_options_and_secret():
    given = {"URL": "jdbc:postgresql://db/sensors", "USER": "u", "PASSWORD": "s3cret"}
    database = Database.from_env({f"GRIDPULSE_JDBC_{key}": value for key, value in given.items()})
    options = database.write_options("agg")
    assert options["dbtable"] == "agg" and options["driver"] == "org.postgresql.Driver"
    assert (options["user"], options["password"]) == ("u", "s3cret")
    assert options["numPartitions"] == "8"
    assert "s3cret" not in repr(database)
    assert "user" not in Database("jdbc:x").options("t")


def test_slices_name_their_offset_and_leave_no_gap():
    first, last = 1761438600000000, 1761442200000001
    one = slice_predicates(first, last, 1)
    assert one == [
        "window_start >= TIMESTAMP WITH TIME ZONE '2025-10-26 00:30:00+00:00' "
        "AND window_start < TIMESTAMP WITH TIME ZONE '2025-10-26 01:30:00.000002+00:00'"
    ]
    several = [re.findall("'(.*?)'", p) for p in slice_predicates(first, last, 5)]
    assert len(several) == 5 and all(a[1] == b[0] for a, b in zip(several, several[1:]))
    assert [several[0][0], several[-1][1]] == re.findall("'(.*?)'", one[0])
    assert len(slice_predicates(first, first, 8)) == 1


def test_serving_ddl():
    ddl = serving_ddl("agg_1min")
    assert "house_id TEXT NOT NULL" in ddl and "window_start TIMESTAMPTZ NOT NULL" in ddl
    assert ddl.count("DOUBLE PRECISION") == 4 and "PRIMARY KEY (house_id, window_start)" in ddl


def test_pipeline_from_env():
    given = {"ROOT": "s3a://lake/", "STATE_PARTITIONS": "64", "GOLD_TRIGGER": "30 seconds"}
    pipeline = Pipeline.from_env({f"GRIDPULSE_{key}": value for key, value in given.items()})
    assert pipeline.silver == "s3a://lake/silver/readings" and pipeline.state_partitions == 64
    assert pipeline.trigger(pipeline.gold_trigger) == {"processingTime": "30 seconds"}
    assert pipeline.trigger(pipeline.ingest_trigger) == {}
    assert pipeline.backfill().trigger("1 minute") == {"availableNow": True}
    queries = ("silver", "gold_1min", "gold_15min", "serving_1min", "serving_15min")
    assert len({pipeline.checkpoint(q) for q in queries}) == 5
    moved = Pipeline.from_env({"GRIDPULSE_ROOT": "r", "GRIDPULSE_GOLD_1MIN_PATH": "s3a://old/gold"})
    assert (moved.gold(ONE_MINUTE), moved.silver) == ("s3a://old/gold", "r/silver/readings")
    with pytest.raises(ValueError):
        Pipeline.from_env({})


def test_defaults_match_the_contract():
    pipeline = Pipeline(root="r")
    assert (pipeline.zone, pipeline.lateness, pipeline.gold_trigger, pipeline.write_width) == (
        "Europe/Berlin", "2 minutes", "1 minute", 4,
    )
    assert [(g.width, g.keep, g.dashboard_range) for g in GRANULARITIES] == [
        ("1 minute", "7 days", "1 hour"),
        ("15 minutes", "1 year", "6 hours"),
    ]
    assert pipeline.gold(ONE_MINUTE) == "r/gold/readings_1min"


def test_job_session_leaves_the_caller_alone(spark):
    before = spark.conf.get("spark.sql.session.timeZone"), spark.conf.get("spark.sql.shuffle.partitions")
    session = job_session(spark, Pipeline(root="r", state_partitions=7))
    assert session.conf.get("spark.sql.session.timeZone") == "Europe/Berlin"
    assert session.conf.get("spark.sql.shuffle.partitions") == "7"
    assert session.conf.get("spark.sql.ansi.enabled") == "true"
    assert (spark.conf.get("spark.sql.session.timeZone"), spark.conf.get("spark.sql.shuffle.partitions")) == before


def test_shared_folder_follows_the_session():
    def fake(master, **conf):
        return SimpleNamespace(conf=SimpleNamespace(get=conf.get), sparkContext=SimpleNamespace(master=master))

    on_cluster = fake("spark://m:7077", **{"spark.checkpoint.dir": "s3a://lake/tmp/"})
    assert shared_folder(on_cluster, "x").startswith("s3a://lake/tmp/gridpulse/x-")
    assert shared_folder(on_cluster, "x") != shared_folder(on_cluster, "x")
    with pytest.raises(ValueError):
        shared_folder(fake("spark://m:7077"), "x")
    assert shared_folder(fake("local[2]"), "x").startswith("/tmp/run-")


def test_schemas_parse(spark):
    for ddl in (schemas.RAW, schemas.SILVER, schemas.GOLD, schemas.SERVING, schemas.ENVELOPE):
        spark.createDataFrame([], ddl)
    serving = spark.createDataFrame([], schemas.SERVING).schema
    assert tuple(serving.fieldNames()) == schemas.SERVING_COLUMNS
    assert [f.name for f in serving if not f.nullable] == ["window_start", "window_end"]


def test_envelopes_of_a_table_in_one_row_group_are_made_by_many_tasks(spark, tmp_path):
    path = str(tmp_path)
    times = "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id) as ts"
    events = spark.range(0, 300, 1, 1).selectExpr("id as event_id", times, "id as user_id", "'view' as event_type", "1.5 as value", "'{\"k\": 1}' as props")
    documents = spark.range(0, 1, 1, 1).selectExpr("id as doc_id", "'a' as text", "1L as n_chars", "'en' as lang")
    conversations = spark.range(0, 1, 1, 1).selectExpr("id as conv_id", "1 as turn", "'user' as role", "'a' as text")
    for name, rows in (("events", events.withColumn("value", F.col("value").cast("double"))), ("documents", documents), ("conversations", conversations)):
        rows.write.parquet(f"{path}/{name}.parquet")
    for made, rows in ((common.mixed_envelopes, 303), (common.null_key_envelopes, 900)):
        tasks = made(spark, path).groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()
        assert sum(r.n for r in tasks) == rows and len(tasks) > 1 and max(r.n for r in tasks if r.n > 2) < rows / 2
