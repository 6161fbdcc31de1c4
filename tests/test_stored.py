"""Stored Gold asked by house and range, expiry by folder, the table of houses, metrics, and live runs."""

import os
import time
from dataclasses import replace
from datetime import date, datetime, timezone

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from gridpulse import schemas
from gridpulse.config import BUSINESS_ZONE, ONE_MINUTE, Pipeline
from gridpulse.functions.clock import instant
from gridpulse.operators import serve
from gridpulse.operators.retention import ExpiringTable, retain
from gridpulse.operators.gold import roll_up, with_partition_keys
from gridpulse.session import job_session, shared_folder
from gridpulse.sources.catalog import register, store_gold
from gridpulse.sources.events import events, readings
from gridpulse.sources.files import envelope_stream, gold_table, house_table
from gridpulse.operators.layout import cluster_for_write, tasks_for
from gridpulse.streaming.jobs import drain, measured, start_gold, start_houses, start_ingest, wait_any
from gridpulse.streaming.progress import METRICS, MetricsTable, metrics_table
from gridpulse.streaming.sinks import each_batch
from helpers import envelopes, land, plan, reading, rolled

DAY = 86_400_000_000


@pytest.fixture
def month(session, sf_dir):
    """Gold of the test events in real time, not yet stored."""
    return with_partition_keys(roll_up(readings(events(session, sf_dir), clock="real"), "15 minutes"), BUSINESS_ZONE)


def scanned(df):
    """Rows that the scans of a query without a shuffle handed on, after row groups were left out; and files."""
    physical = df._jdf.queryExecution().executedPlan()
    df.sparkSession._jvm.org.apache.spark.sql.execution.SparkPlan  # noqa: B018
    df._jdf.queryExecution().toRdd().count()
    leaves = physical.collectLeaves()
    metric = lambda name: sum(leaves.apply(i).metrics().apply(name).value() for i in range(leaves.size()))
    return metric("numOutputRows"), metric("numFiles")


def houses_gold(session, n_houses=4_000, windows=4):
    """Windows of one hour for many houses whose ids are text of equal length."""
    start = F.timestamp_seconds(F.lit(1_765_000_800) + F.pmod("id", F.lit(windows)) * 900)
    rows = session.range(n_houses * windows).select(
        F.lpad(F.floor(F.col("id") / windows).cast("string"), 6, "0").alias("house_id"),
        start.alias("window_start"),
        (start + F.expr("INTERVAL 15 MINUTES")).alias("window_end"),
        *(F.rand(i).alias(c) for i, c in enumerate(schemas.SERVING_COLUMNS[3:])),
    )
    return with_partition_keys(rows, BUSINESS_ZONE)


def test_a_house_is_found_in_its_row_groups(session):
    path = shared_folder(session, "by-house")
    store_gold(houses_gold(session).coalesce(1), path, row_group_bytes=64 * 1024, houses=500)
    table = gold_table(session, path)
    one = serve.to_serving(table).where(F.col("house_id") == "001234")
    rows, _ = scanned(one)
    assert one.count() == 4 and 4 <= rows < 16_000 / 3
    assert "PushedFilters: [IsNotNull(house_id), EqualTo(house_id,001234)]" in plan(one)


def test_bloom_filters_leave_out_row_groups_that_ranges_would_keep(session):
    path = shared_folder(session, "bloom")
    dealt = houses_gold(session).orderBy(F.xxhash64("house_id"))  # every row group spans nearly all ids
    options = {"parquet.bloom.filter.enabled#house_id": "true", "parquet.bloom.filter.expected.ndv#house_id": "2000"}
    for name, chosen in (("with", options), ("without", {})):
        plain = {"parquet.block.size": "65536", "parquet.enable.dictionary": "false"}  # as where a dictionary grows too large
        dealt.coalesce(1).write.options(**plain, **chosen).parquet(f"{path}/{name}")
    found = {}
    for name in ("with", "without"):
        one = session.read.parquet(f"{path}/{name}").where(F.col("house_id") == "001234").select("house_id", "avg_power_kw")
        found[name] = scanned(one)[0]
        assert one.count() == 4
    assert found["with"] < found["without"] / 2


def test_range_reads_its_folders_and_columns(session, month):
    path = shared_folder(session, "range")
    store_gold(month, path)
    table = gold_table(session, path)
    last = serve.latest(table)
    series = serve.panel(table, "click", "ev", since=last - DAY, until=last)
    scan = plan(series)
    filters = scan.split("PartitionFilters: ")[1].splitlines()[0]
    assert "event_date" in filters and ">=" in filters
    pushed = scan.split("PushedFilters: ")[1].splitlines()[0]
    assert "EqualTo(house_id,click)" in pushed and "GreaterThanOrEqual(window_start" in pushed
    assert "ReadSchema: struct<house_id:string,window_start:timestamp,avg_ev_charging_kw:double>" in scan
    few = table.where(F.col("event_date") >= F.to_date(F.timestamp_micros(F.lit(last - DAY)))).select("house_id")
    assert scanned(few)[1] < scanned(table.select("house_id"))[1] / 5
    top = plan(serve.to_serving(serve.peek(table, 10)))
    assert "TakeOrderedAndProject" in top


def test_a_stored_table_has_a_name_in_the_catalog(session, month):
    path = shared_folder(session, "named")
    store_gold(month, path)
    name = f"gold_{path.rsplit('-', 1)[1]}"
    assert register(session, name, path).columns == [*schemas.SERVING_COLUMNS, *schemas.GOLD_PARTITIONS]
    statement = f"SELECT window_start AS time, avg_power_kw AS value FROM {name} WHERE house_id = '$house_id' ORDER BY window_start"
    named = serve.panel_sql(session, statement, "click")
    assert named.collect() == serve.panel(month, "click").collect() and named.count() > 10
    register(session, name, path)  # again
    assert register(session, name, path).count() == month.count()


# --- expiry ----------------------------------------------------------------------------


def files(path):
    found = {}
    for folder, _, names in os.walk(path):
        found |= {os.path.join(folder, n): os.stat(os.path.join(folder, n)).st_mtime_ns for n in names if n.endswith(".parquet")}
    return found


def test_expiry_leaves_whole_days_and_rewrites_one(session, month):
    path = shared_folder(session, "expiry")
    store_gold(month, path)
    before, anchor = files(path), serve.latest(gold_table(session, path))
    table = ExpiringTable(path, BUSINESS_ZONE).create(session)
    assert table.read(session).count() == month.count() and table.expired(session) == []
    for back, version in ((10, 0), (4, 1), (4, 1), (12, 1)):  # again, and an older one: nothing changes
        assert table.expire(session, anchor - back * DAY, "7 days") == version
    kept = table.read(session)
    want = retain(gold_table(session, path), anchor - 4 * DAY, "7 days")
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, want.collect())) and 0 < kept.count() < month.count()
    assert {f: t for f, t in files(path).items() if f in before} == before  # no file was touched
    kept_days = {f.split("event_date=")[1][:10] for f in files(f"{path}/_kept/1")}
    boundary = str(table.last(session).boundary)
    assert kept_days == {boundary} and table.expired(session)[-1] == boundary
    assert len(table.expired(session)) == len({f.split("event_date=")[1][:10] for f in before if f.split("event_date=")[1][:10] <= boundary})
    one, *_ = (part.splitlines()[0] for part in plan(kept).split("PartitionFilters: ")[1:])
    assert "event_date" in one and boundary in one


def test_expiry_reads_the_boundary_day_alone_and_sees_later_appends(session, month):
    path = shared_folder(session, "expiry")
    store_gold(month, path)
    table, anchor = ExpiringTable(path, BUSINESS_ZONE).create(session), serve.latest(gold_table(session, path))
    cutoff = instant(anchor - 7 * DAY)
    table.expire(session, anchor, "7 days")
    n = table.read(session).count()
    later = month.where(F.col("window_start") >= instant(anchor - DAY)).withColumn("house_id", F.concat("house_id", F.lit("-new")))
    store_gold(later, path, mode="append")
    assert table.read(session).count() == n + later.count()
    assert table.read(session).where(F.col("window_start") < cutoff).count() == 0


def test_an_expiry_that_was_cut_off_is_done_again(session, month, monkeypatch):
    from gridpulse.operators import retention

    path = shared_folder(session, "expiry")
    store_gold(month, path)
    table, anchor = ExpiringTable(path, BUSINESS_ZONE).create(session), serve.latest(gold_table(session, path))
    write = store_gold

    def failing(*args, **kwargs):
        write(*args, **kwargs)
        raise RuntimeError("lost")

    monkeypatch.setattr(retention, "store_gold", failing)
    with pytest.raises(RuntimeError):
        table.expire(session, anchor, "7 days")
    assert table.read(session).count() == month.count()
    monkeypatch.setattr(retention, "store_gold", write)
    assert table.expire(session, anchor, "7 days") == 0
    assert sorted(map(tuple, table.read(session).collect())) == sorted(map(tuple, retain(gold_table(session, path), anchor, "7 days").collect()))


def test_expiry_of_an_empty_table(session):
    path = shared_folder(session, "expiry")
    session.createDataFrame([], schemas.GOLD).write.partitionBy(*schemas.GOLD_PARTITIONS).parquet(path)
    table = ExpiringTable(path, BUSINESS_ZONE).create(session)
    assert serve.latest(table.read(session)) is None
    assert table.expire(session, 1_765_000_800_000_000, "7 days") == 0 and table.read(session).count() == 0


# --- houses, metrics, live runs -----------------------------------------------------------


def send(session, pipeline, houses, hour):
    rows = [reading(h, f"2025-12-06T{hour:02d}:{m:02d}:00+00:00", 1.0) for h in houses for m in (0, 10, 20)]
    landing = land(session, pipeline, rows)
    query = start_ingest(envelope_stream(session, landing), pipeline)
    drain(query)
    return query


def test_houses_are_listed_once_across_restarts(session, pipeline):
    for hour, houses in ((8, (1, 2)), (9, (2, 10)), (10, (1, 3))):
        send(session, pipeline, houses, hour)
        drain(start_gold(session, ONE_MINUTE, pipeline))
        query = start_houses(session, ONE_MINUTE, pipeline)
        drain(query)
    table = house_table(session, pipeline.houses)
    assert [r.house_id for r in serve.house_list(table).collect()] == ["1", "10", "2", "3"] and table.count() == 4
    assert max(s.numRowsTotal for p in query.recentProgress for s in p.stateOperators) == 4


def test_metrics_tell_what_each_batch_dropped(session, pipeline):
    metrics = MetricsTable(session, pipeline.metrics)
    session.streams.addListener(metrics)
    try:
        no_house = reading(None, "2025-12-06T08:00:00+00:00", 1.0)
        no_time = reading(7, "soon", 1.0)
        rows = [reading(1, "2025-12-06T08:00:00+00:00", 1.0), reading(1, "2025-12-06T08:09:00+00:00", 1.0), no_house, no_time, "no json", None]
        first = start_ingest(envelope_stream(session, land(session, pipeline, rows)), pipeline)
        drain(first)
        rolling = start_gold(session, ONE_MINUTE, pipeline)
        drain(rolling)
        second = send(session, pipeline, (2,), 7)  # an hour late
        late = start_gold(session, ONE_MINUTE, pipeline)
        drain(late)
        metrics.wait_for(first, rolling, second, late)
    finally:
        session.streams.removeListener(metrics)
    rows = metrics_table(session, pipeline.metrics).orderBy("at").collect()
    silver = [(r.input_rows, r.no_house, r.no_time, r.written) for r in rows if r.query == "silver" and r.input_rows]
    assert silver == [(6, 1, 3, 2), (3, 0, 0, 3)]
    gold = [r for r in rows if r.query == "gold_1min"]
    assert sum(r.written for r in gold) == 1 and sum(r.late_rows for r in gold) == 3 and {r.no_house for r in gold} == {None}
    assert len({r.run for r in rows}) == 4 and {str(r.day) for r in rows} == {str(r.at.date()) for r in rows}


def test_a_row_that_cannot_be_stored_is_reported_and_queries_go_on(session, pipeline):
    path = f"{pipeline.root}/taken"
    envelopes(session, ["x"]).write.parquet(f"{path}/day=not-a-day")
    with open(path + "-file", "w") as file:
        file.write("a file, where the table should be")
    metrics = MetricsTable(session, path + "-file")
    session.streams.addListener(metrics)
    try:
        query = send(session, pipeline, (1,), 8)
        with pytest.raises(Exception, match="file"):
            metrics.wait_for(query)
    finally:
        session.streams.removeListener(metrics)
    assert rolled(roll_up(session.read.schema(schemas.SILVER).parquet(pipeline.silver), "1 minute"))


def test_a_trigger_takes_files_as_they_come_and_a_failure_surfaces(spark):
    pipeline = Pipeline(root=shared_folder(spark, "live"), gold_trigger="1 second")
    session, once = job_session(spark, pipeline), pipeline.backfill()
    send(session, once, (1, 2), 8)
    live = start_gold(session, ONE_MINUTE, pipeline)
    live.processAllAvailable()
    batches = live.lastProgress.batchId
    for hour in (9, 10):
        send(session, once, (1, 2), hour)
        live.processAllAvailable()
    assert live.lastProgress.batchId > batches and live.isActive
    drained = replace(once, root=f"{pipeline.root}/drained", names={"silver": pipeline.silver})
    drain(start_gold(job_session(spark, drained), ONE_MINUTE, drained))  # names are taken per session
    assert rolled(gold_table(session, pipeline.gold(ONE_MINUTE))) == rolled(gold_table(session, drained.gold(ONE_MINUTE)))

    def lose(batch, batch_id):
        raise RuntimeError("lost the store")

    session.streams.resetTerminated()  # the drained queries ended before
    source = envelope_stream(session, f"{pipeline.root}/landing")
    each_batch(source, "failing", lose, pipeline.checkpoint("failing"), pipeline.trigger("1 second"))
    start = time.monotonic()
    with pytest.raises(StreamingQueryException, match="lost the store"):
        wait_any(session)
    assert time.monotonic() - start < 60 and live.isActive
    live.stop()


def test_jobs_start_before_their_folders_exist(spark):
    pipeline = Pipeline(root=shared_folder(spark, "early"), gold_trigger="1 second")
    session, once = job_session(spark, pipeline), pipeline.backfill()
    live = [start_gold(session, ONE_MINUTE, pipeline), start_houses(session, ONE_MINUTE, pipeline)]
    try:
        send(session, once, (1, 2), 8)
        send(session, once, (1, 2), 9)
        for query in live:
            query.processAllAvailable()
        assert len(rolled(gold_table(session, pipeline.gold(ONE_MINUTE)))) == 10
        assert house_table(session, pipeline.houses).count() == 2
    finally:
        for query in live:
            query.stop()


def test_writers_follow_from_the_rows_of_the_last_batches(session, spark):
    assert [tasks_for(n, 100, 8) for n in (0, 1, 100, 101, 750, 10_000)] == [1, 1, 1, 2, 8, 8]
    pipeline = Pipeline(root=shared_folder(spark, "measured"), rows_per_file=100)
    assert measured(session, ONE_MINUTE, pipeline) == pipeline  # nothing is measured yet
    row = ("gold_1min", "r", 0, datetime(2025, 12, 6, 8, tzinfo=timezone.utc), 1, None, None, 0, 730, 1, 1.0, date(2025, 12, 6))
    rows = [row, (*row[:8], 90, *row[9:]), ("gold_15min", *row[1:8], 9_000, *row[9:])]
    session.createDataFrame(rows, METRICS).write.partitionBy("day").parquet(pipeline.metrics)
    hot = measured(session, ONE_MINUTE, pipeline)
    assert (hot.write_salt, hot.write_width) == (8, 16)
    assert measured(session, ONE_MINUTE, pipeline.backfill()).write_width is None
    for name, n in (("hot", 730), ("thin", 90)):
        chosen = replace(pipeline, root=f"{pipeline.root}/{name}")
        session.createDataFrame([(*row[:8], n, *row[9:])], METRICS).write.partitionBy("day").parquet(chosen.metrics)
        chosen = measured(session, ONE_MINUTE, chosen)
        hour = houses_gold(session, n, 1)
        dealt = cluster_for_write(hour, schemas.GOLD_PARTITIONS, chosen.write_width, salt=chosen.write_salt, spread_by=schemas.SERVING_KEY)
        dealt.write.partitionBy(*schemas.GOLD_PARTITIONS).parquet(f"{chosen.root}/gold")
        sizes = gold_table(session, f"{chosen.root}/gold").groupBy("_metadata.file_path").count().collect()
        assert sum(r["count"] for r in sizes) == n and max(r["count"] for r in sizes) <= 3 * pipeline.rows_per_file
        assert n / len(sizes) >= pipeline.rows_per_file / 2
