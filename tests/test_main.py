from unittest.mock import MagicMock

import pytest

from gridpulse.__main__ import main
from gridpulse.config import GRANULARITIES, ONE_MINUTE, Pipeline
from gridpulse.operators.retention import ExpiringTable
from gridpulse.session import shared_folder
from gridpulse.sources.files import gold_table, house_table
from gridpulse.sources.jdbc import Database, serving_table, slice_predicates
from gridpulse.sources.kafka import topic_options, topic_stream
from gridpulse.streaming.progress import metrics_table
from gridpulse.streaming.serving import JdbcServing
from helpers import land, reading, rolled


@pytest.fixture
def root(spark, monkeypatch):
    path = shared_folder(spark, "main")
    monkeypatch.setenv("GRIDPULSE_ROOT", path)
    monkeypatch.delenv("GRIDPULSE_JDBC_URL", raising=False)
    return path


def test_all_jobs_once(spark, root, capsys):
    pipeline = Pipeline(root=root)
    sent = [reading(h, f"2025-12-06T10:{m:02d}:00+00:00", 1.0) for h in (1, 2) for m in range(40)]
    landing = land(spark, pipeline, sent)
    main(["all", "--once", "--landing", landing])
    lines = capsys.readouterr().out.splitlines()
    reported = {line.split(" ")[0] for line in lines if "rows/s" in line}
    assert reported == {"[silver", "[gold_1min", "[gold_15min", "[serving_1min", "[serving_15min", "[houses"}
    assert [r.house_id for r in house_table(spark, pipeline.houses).orderBy("house_id").collect()] == ["1", "2"]
    silver = metrics_table(spark, pipeline.metrics).where("query = 'silver'").collect()
    assert sum(r.input_rows for r in silver) == sum(r.written for r in silver) == 80
    for grain in GRANULARITIES:
        gold = rolled(gold_table(spark, pipeline.gold(grain)))
        assert gold and rolled(gold_table(spark, pipeline.serving(grain))) == gold
    # Each job on its own goes on from the checkpoints.
    land(spark, pipeline, [reading(1, "2025-12-06T12:00:00+00:00", 1.0)])
    for job in ("ingest", "gold", "serve"):
        main([job, "--once", "--landing", landing])
    assert len(rolled(gold_table(spark, pipeline.serving(ONE_MINUTE)))) == 80


def test_expiry_and_catalog_jobs(spark, root, capsys):
    pipeline = Pipeline(root=root)
    rows = [reading(1, f"2025-12-{day:02d}T10:{m:02d}:00+00:00", 1.0) for day in (1, 2, 9, 10) for m in (0, 20)]
    main(["ingest", "--once", "--landing", land(spark, pipeline, rows)])
    main(["gold", "--once"])
    main(["expire"])
    main(["expire"])  # nothing more to do
    lines = [line for line in capsys.readouterr().out.splitlines() if "no longer read" in line]
    assert [line.split(": ")[1] for line in lines] == ["2025-12-01, 2025-12-02", "none"] * 2
    kept = ExpiringTable(pipeline.gold(ONE_MINUTE), pipeline.zone).read(spark)
    assert {str(r.event_date) for r in kept.select("event_date").collect()} == {"2025-12-09", "2025-12-10"}
    main(["tables"])
    assert "gold_readings_1min" in capsys.readouterr().out


def test_topic_needs_its_address(spark, root, monkeypatch):
    monkeypatch.delenv("GRIDPULSE_KAFKA_SERVERS", raising=False)
    with pytest.raises(KeyError, match="GRIDPULSE_KAFKA_SERVERS"):
        main(["ingest", "--once"])


def test_topic_stream_asks_for_the_envelope_only():
    spark = MagicMock()
    options = topic_options("b:1", "readings")
    topic_stream(spark, options)
    reader = spark.readStream.format
    reader.assert_called_once_with("kafka")
    reader.return_value.options.assert_called_once_with(**options)
    reader.return_value.options.return_value.load.return_value.select.assert_called_once_with("value")


def test_database_calls():
    """The calls only: no database may run here."""
    rows, spark, database = MagicMock(), MagicMock(), Database("jdbc:x", "u", "p")
    JdbcServing(database, "agg").append(rows)
    rows.write.format.assert_called_once_with("jdbc")
    rows.write.format.return_value.options.assert_called_once_with(**database.write_options("agg"))
    rows.write.format.return_value.options.return_value.mode.assert_called_once_with("append")
    serving_table(spark, database, "agg")
    spark.read.format.assert_called_once_with("jdbc")
    spark.read.format.return_value.options.assert_called_once_with(**database.options("agg"))
    JdbcServing(database, "agg").slice(spark, 0, 1)
    spark.read.jdbc.assert_called_once_with(
        "jdbc:x",
        "agg",
        predicates=slice_predicates(0, 1, database.connections),
        properties={"driver": database.driver, "fetchsize": "10000", "user": "u", "password": "p"},
    )
