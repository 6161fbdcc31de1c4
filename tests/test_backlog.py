"""Backlogs in the order of event time, and the serving table with a ledger."""

import os
import time
from dataclasses import replace

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from gridpulse import schemas
from gridpulse.config import ONE_MINUTE, QUARTER_HOUR
from gridpulse.operators.gold import roll_up
from gridpulse.sources.files import envelope_stream, gold_table, silver_table
from gridpulse.streaming.backlog import LateReadings, folders, run_backlog, step_stream, steps
from gridpulse.streaming.jobs import drain, start_gold, start_ingest, start_serving
from gridpulse.streaming.progress import throughput
from gridpulse.streaming.serving import LedgerServing, ledgered
from helpers import land, plan, reading, rolled


def day(session, pipeline, hours, houses=3, minutes=(0, 7, 31, 58)):
    """Readings of some hours of a day, ingested as one batch."""
    rows = [reading(h, f"2025-12-06T{t:02d}:{m:02d}:10+00:00", float(h + m)) for t in hours for m in minutes for h in range(houses)]
    drain(start_ingest(envelope_stream(session, land(session, pipeline, rows)), pipeline))


def expected(session, pipeline, grain, last_us):
    """All windows of Silver that a watermark two minutes before the last reading has passed."""
    batch = rolled(roll_up(silver_table(session, pipeline.silver), grain.width))
    width = {"1min": 60, "15min": 900}[grain.name] * 1_000_000
    return {k: v for k, v in batch.items() if k[1] + width <= last_us - 120_000_000}


def last_reading(session, pipeline):
    return silver_table(session, pipeline.silver).agg(F.unix_micros(F.max("event_time"))).first()[0]


@pytest.mark.parametrize("grain", [ONE_MINUTE, QUARTER_HOUR], ids=lambda g: g.name)
def test_a_backlog_written_backwards_is_read_forwards_with_little_state(session, pipeline, grain):
    for hours in ([20, 21], [3, 15], [9], [2, 4, 16]):
        day(session, pipeline, hours)
    report = run_backlog(session, grain, pipeline, hours=2)
    written = rolled(gold_table(session, pipeline.gold(grain)))
    assert written == expected(session, pipeline, grain, last_reading(session, pipeline))
    a_step = 2 * 3 * 4  # hours, houses and windows of an hour that hold readings
    assert max(batch[6] for batch in report) <= a_step + 3 and len(written) > 2 * a_step
    assert sum(batch[2] for batch in report) == 8 * 3 * 4  # each reading once
    assert sum(batch[2] for batch in run_backlog(session, grain, pipeline, hours=3)) == 0  # steps may change, nothing is read again
    assert rolled(gold_table(session, pipeline.gold(grain))) == written


def test_a_live_run_goes_on_after_a_backlog(session, pipeline):
    day(session, pipeline, [10, 8])
    run_backlog(session, ONE_MINUTE, pipeline, hours=1)
    day(session, pipeline, [11])
    query = start_gold(session, ONE_MINUTE, pipeline)
    drain(query)
    assert sum(batch[2] for batch in throughput(query)) == 12
    assert rolled(gold_table(session, pipeline.gold(ONE_MINUTE))) == expected(session, pipeline, ONE_MINUTE, last_reading(session, pipeline))


def test_a_backlog_stops_at_late_readings(session, pipeline):
    day(session, pipeline, [8, 12])
    run_backlog(session, ONE_MINUTE, pipeline, hours=1)
    before = rolled(gold_table(session, pipeline.gold(ONE_MINUTE)))
    day(session, pipeline, [9, 13])
    with pytest.raises(LateReadings, match="recompute"):
        run_backlog(session, ONE_MINUTE, pipeline, hours=1)
    assert rolled(gold_table(session, pipeline.gold(ONE_MINUTE))) == before


def test_old_files_are_read_and_uncommitted_ones_are_not(session, pipeline):
    day(session, pipeline, [8])
    day(session, pipeline, [9])
    whole = rolled(roll_up(silver_table(session, pipeline.silver), "1 minute"))
    stored = folders(silver_table(session, pipeline.silver))
    assert [k[1] for k in stored] == [9, 10]  # local hours
    (name,) = stored["2025-12-06", 10]
    old = f"{pipeline.silver}/dt=2025-12-06/hour=10/{name}"
    with open(old, "rb") as file, open(old.replace(name, "part-left-behind.parquet"), "wb") as copy:
        copy.write(file.read())
    os.utime(old, (time.time() - 40 * 86_400,) * 2)
    report = run_backlog(session, ONE_MINUTE, pipeline, hours=1)
    assert sum(batch[2] for batch in report) >= 24
    written = rolled(gold_table(session, pipeline.gold(ONE_MINUTE)))
    assert written == expected(session, pipeline, ONE_MINUTE, last_reading(session, pipeline)) and written.items() <= whole.items()


def test_steps_are_pruned_to_their_folders(session, pipeline):
    day(session, pipeline, [8, 9, 10])
    chosen = steps(folders(silver_table(session, pipeline.silver)), 2)
    assert [len(s) for s in chosen] == [2, 1]
    stream = step_stream(session, pipeline.silver, chosen[1])
    assert stream.isStreaming and stream.columns == silver_table(session, pipeline.silver).columns


# --- the ledger ----------------------------------------------------------------------


def served(session, pipeline, table, grain=ONE_MINUTE):
    drain(start_serving(session, grain, pipeline, table))
    return rolled(table.read(session))


def gold_of_hours(session, pipeline, *hours):
    for hour in hours:
        day(session, pipeline, [hour])
        drain(start_gold(session, ONE_MINUTE, pipeline))
    return rolled(gold_table(session, pipeline.gold(ONE_MINUTE)))


def test_batches_read_nothing_back(session, pipeline, monkeypatch):
    gold = gold_of_hours(session, pipeline, 8, 9)
    monkeypatch.setattr(LedgerServing, "held", lambda *_: pytest.fail("read back"))
    table = LedgerServing(pipeline.serving(ONE_MINUTE), pipeline.zone).create(session)
    assert served(session, pipeline, table) == gold
    gold = gold_of_hours(session, pipeline, 10)
    assert served(session, pipeline, table) == gold and len(gold) > 20


@pytest.mark.parametrize("share", [0.0, 0.4, 1.0])
def test_a_batch_that_failed_is_written_again_in_place(session, pipeline, monkeypatch, share):
    gold = gold_of_hours(session, pipeline, 8, 9)
    table = LedgerServing(pipeline.serving(ONE_MINUTE), pipeline.zone).create(session)
    store = LedgerServing.store

    def failing(self, batch, batch_id, writer):
        part = batch.orderBy(*schemas.SERVING_KEY).limit(int(batch.count() * share))
        store(self, part, batch_id, writer)
        raise RuntimeError("lost")

    monkeypatch.setattr(LedgerServing, "store", failing)
    with pytest.raises(StreamingQueryException):
        served(session, pipeline, table)
    monkeypatch.setattr(LedgerServing, "store", store)
    assert table.read(session).count() == int(len(gold) * share)
    assert served(session, pipeline, table) == gold


def test_a_lost_checkpoint_compares_keys_in_shared_folders_alone(session, pipeline):
    gold = gold_of_hours(session, pipeline, 8, 9)
    table = LedgerServing(pipeline.serving(ONE_MINUTE), pipeline.zone).create(session)
    assert served(session, pipeline, table) == gold
    again = replace(pipeline, root=f"{pipeline.root}/again", names={"gold_1min": pipeline.gold(ONE_MINUTE)})
    fresh = LedgerServing(table.path, table.zone)
    gold = gold_of_hours(session, pipeline, 15)
    assert served(session, again, fresh) == gold
    assert fresh.ledger(session).select("writer").distinct().count() == 2
    # A later batch of the new query with one old window reads that window's folder, not all between.
    spanning = gold_table(session, pipeline.gold(ONE_MINUTE)).limit(0)
    assert spanning.columns == list(schemas.SERVING_COLUMNS) + list(schemas.GOLD_PARTITIONS)
    writer = fresh.ledger(session).first()["writer"]
    dates = {(r.event_date, r.hour) for r in fresh.ledger(session).collect()}
    oldest = {min(dates)}
    held = fresh.held(session, "another", oldest)
    scan = plan(held)
    filters = scan.split("PartitionFilters: ")[1].splitlines()[0]
    assert "event_date" in filters and "hour" in filters and "writer" in filters and "ReadSchema: struct<house_id:string,window_start:timestamp>" in scan
    files = held.select(F.col("house_id"), "window_start").count(), fresh._stored(session).count()
    assert 0 < files[0] < files[1] and fresh.others(session, writer)


def test_empty_batches_leave_no_trace(session, pipeline):
    table = LedgerServing(pipeline.serving(ONE_MINUTE), pipeline.zone).create(session)
    table.store(session.createDataFrame([], schemas.GOLD), 0, "w")
    assert table.ledger(session).count() == 0
    row = ("1", None, None, 1.0, 1.0, 1.0, 1.0, None, None)
    with pytest.raises(Exception, match="window_start must not be null"):
        table.store(session.createDataFrame([row], schemas.GOLD), 1, "w")
    assert callable(ledgered(table, "nowhere"))
