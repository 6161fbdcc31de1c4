import os
import random
import re
import time
from dataclasses import replace

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from gridpulse import schemas
from gridpulse.config import BUSINESS_ZONE, ONE_MINUTE, QUARTER_HOUR
from gridpulse.operators.gold import roll_up
from gridpulse.operators.silver import silver
from gridpulse.session import job_session
from gridpulse.sources.files import envelope_stream, gold_table, silver_table
from gridpulse.streaming.jobs import drain, gold_rows, start_gold, start_ingest, wait_any
from gridpulse.streaming.progress import ThroughputReport, line, throughput, throughput_table
from gridpulse.streaming.sinks import append_parquet, each_batch
from gridpulse.streaming.state import open_windows, state_layout
from helpers import at, land, plan, reading, rolled


def send(session, pipeline, *triples):
    """Land readings (house, UTC time, kW) and ingest them into Silver."""
    landing = land(session, pipeline, [reading(h, f"2025-12-06T{t}+00:00", p) for h, t, p in triples])
    drain(start_ingest(envelope_stream(session, landing), pipeline))


def run_gold(session, pipeline, grain=ONE_MINUTE):
    """Run the Gold query once; return what it has written so far, and the query."""
    query = start_gold(session, grain, pipeline)
    drain(query)
    if not os.path.exists(pipeline.gold(grain)):
        return {}, query
    return rolled(gold_table(session, pipeline.gold(grain))), query


def parquet_files(path):
    return [os.path.join(folder, f) for folder, _, files in os.walk(path) for f in files if f.endswith(".parquet")]


def dropped(query):
    return sum(row[5] for row in throughput(query))


def test_late_rows_and_open_windows(session, pipeline):
    send(session, pipeline, (1, "10:00:10", 1.0), (1, "10:00:50", 3.0), (1, "10:01:10", 5.0))
    written, query = run_gold(session, pipeline)
    assert written == {} and dropped(query) == 0

    send(session, pipeline, (1, "10:05:00", 7.0))
    closed = {("1", at("10:00")): (2.0, 3.0), ("1", at("10:01")): (5.0, 5.0)}
    written, query = run_gold(session, pipeline)
    assert written == closed and dropped(query) == 0

    # 10:00 has been written and is closed; 10:03 is still open.
    send(session, pipeline, (1, "10:00:30", 99.0), (1, "10:03:30", 11.0))
    written, query = run_gold(session, pipeline)
    assert written == closed and dropped(query) == 1

    # A late row for an open window is merged into it.
    send(session, pipeline, (1, "10:03:40", 13.0))
    send(session, pipeline, (1, "10:30:00", 0.0))
    written, _ = run_gold(session, pipeline)
    assert written == closed | {("1", at("10:03")): (12.0, 13.0), ("1", at("10:05")): (7.0, 7.0)}


def test_a_row_late_for_its_minute_may_be_in_time_for_its_quarter(session, pipeline):
    send(session, pipeline, (1, "10:10:00", 1.0))
    run_gold(session, pipeline, ONE_MINUTE)
    run_gold(session, pipeline, QUARTER_HOUR)
    send(session, pipeline, (1, "10:05:00", 3.0))
    assert dropped(run_gold(session, pipeline, ONE_MINUTE)[1]) == 1
    assert dropped(run_gold(session, pipeline, QUARTER_HOUR)[1]) == 0
    send(session, pipeline, (1, "11:00:00", 0.0))
    assert run_gold(session, pipeline, QUARTER_HOUR)[0]["1", at("10:00")] == (2.0, 3.0)


def test_restart_goes_on_without_doubling(session, pipeline):
    for minute in range(4):
        send(session, pipeline, *((h, f"10:{minute:02d}:{s:02d}", float(s)) for h in (1, 2) for s in (5, 25)))
        run_gold(session, pipeline)
        run_gold(session, pipeline)  # nothing new
    assert silver_table(session, pipeline.silver).count() == 16
    send(session, pipeline, (3, "12:00:00", 1.0))
    written, _ = run_gold(session, pipeline)
    assert written == {(h, at(f"10:0{m}")): (15.0, 25.0) for h in "12" for m in range(4)}


def test_stream_equals_batch_but_for_open_windows(session, pipeline):
    triples = [(h, f"10:{m:02d}:{s:02d}", float(m * s + h)) for h in range(3) for m in range(0, 60, 7) for s in (1, 31)]
    send(session, pipeline, *triples)
    for grain in (ONE_MINUTE, QUARTER_HOUR):
        batch = rolled(roll_up(silver_table(session, pipeline.silver), grain.width))
        written, _ = run_gold(session, pipeline, grain)
        width = {"1min": 60, "15min": 900}[grain.name] * 1_000_000
        watermark = at("10:56") + 31_000_000 - 120_000_000
        assert written == {k: v for k, v in batch.items() if k[1] + width <= watermark}
        assert 0 < len(written) < len(batch)


@pytest.mark.parametrize("grain", [ONE_MINUTE, QUARTER_HOUR], ids=lambda g: g.name)
def test_random_arrivals_against_brute_force(session, pipeline, grain):
    """Five runs of shuffled, partly late readings, replayed by hand."""
    rng = random.Random(20251206)
    width, lateness = {"1min": 60, "15min": 900}[grain.name], 120
    watermark, windows, emitted = 0, {}, {}
    for run in range(5):
        arrivals = []
        for _ in range(60):
            second = max(0, rng.gauss(run * 900, 700)) // 1
            arrivals.append((rng.choice((1, 1, 1, 2, 3)), int(second), round(rng.uniform(-5, 9), 3)))
        rows = [(h, f"{10 + s // 3600:02d}:{s // 60 % 60:02d}:{s % 60:02d}", kw) for h, s, kw in arrivals]
        send(session, pipeline, *rows)
        for house, second, kw in arrivals:
            start = second // width * width
            if start + width > watermark:
                windows.setdefault((str(house), start), []).append(kw)
        watermark = max(watermark, max(s for _, s, _ in arrivals) - lateness)
        for key in [k for k in windows if k[1] + width <= watermark]:
            kws = windows.pop(key)
            mean = sum(round(k * 1000) for k in kws) / 1000 / len(kws)
            emitted[key[0], at("10:00") + key[1] * 1_000_000] = (mean, max(kws))
        written, _ = run_gold(session, replace(pipeline, decimals=3), grain)
        assert written == emitted
    assert len(emitted) > 5 and windows


def test_backlog_out_of_order_loses_nothing(session, pipeline):
    """Silver written in reverse order closes the same windows, also where other streams read file by file."""
    for quarter in (2, 1, 0, 3):
        send(session, pipeline, *((h, f"1{quarter}:{m:02d}:05", float(m + h)) for h in (1, 2) for m in range(0, 60, 5)))
    stepped = replace(pipeline, root=f"{pipeline.root}/steps", names={"silver": pipeline.silver}, max_files_per_trigger=1)
    written, query = run_gold(session, stepped)
    assert len([1 for row in throughput(query) if row[2]]) == 1 and dropped(query) == 0
    assert written == run_gold(session, pipeline)[0] and len(written) == 94


def test_layers_on_disk(session, pipeline):
    send(session, pipeline, *((h, f"{t}:00:01", 1.0) for h in range(20) for t in ("08", "09", "23")))
    assert sorted(os.listdir(f"{pipeline.silver}/dt=2025-12-06")) == ["hour=10", "hour=9"]
    assert os.listdir(f"{pipeline.silver}/dt=2025-12-07") == ["hour=0"]
    declared = session.createDataFrame([], schemas.SILVER).schema
    assert silver_table(session, pipeline.silver).schema.simpleString() == declared.simpleString()
    run_gold(session, pipeline)
    hours = parquet_files(pipeline.gold(ONE_MINUTE))
    assert len({os.path.dirname(f) for f in hours}) == 2 and all(re.search(r"event_date=2025-12-06/hour=(9|10)/", f) for f in hours)


def test_salt_splits_an_hour_over_tasks(session, pipeline):
    salted = replace(pipeline, write_width=4)
    send(session, pipeline, *((h, "08:00:01", 1.0) for h in range(50)), (1, "10:00:00", 1.0))
    written, _ = run_gold(session, salted)
    files = parquet_files(salted.gold(ONE_MINUTE))
    assert len(written) == 50 and 1 < len(files) <= 4


def test_clustered_ingest_writes_one_file_per_hour(session, pipeline):
    payloads = [reading(h, f"2025-12-06T08:{h % 60:02d}:00+00:00", 1.0) for h in range(80)]
    for part in range(4):
        landing = land(session, pipeline, payloads[part * 20 : part * 20 + 20])
    drain(start_ingest(envelope_stream(session, landing), pipeline, cluster=True))
    files = parquet_files(pipeline.silver)
    assert len(files) == 1 and silver_table(session, pipeline.silver).count() == 80


def test_clustered_ingest_splits_a_hot_hour(session, pipeline):
    """Nearly all readings, of one house, in one hour: several tasks share them."""
    times = [f"2025-12-06T08:{i % 60:02d}:{i // 60 % 60:02d}.{i:06d}+00:00" for i in range(4000)]
    for part in range(8):
        rows = [reading(1, t, float(i)) for i, t in enumerate(times[part * 500 : part * 500 + 500])]
        landing = land(session, pipeline, rows)
    land(session, pipeline, [reading(2, "2025-12-06T09:00:00+00:00", 1.0)])
    session.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    drain(start_ingest(envelope_stream(session, landing), pipeline, cluster=True))
    hot = [f for f in parquet_files(pipeline.silver) if "/hour=9/" in f]
    assert len(hot) > 1 and silver_table(session, pipeline.silver).count() == 4001


def test_state_width_is_fixed_by_the_checkpoint(session, spark, pipeline):
    send(session, pipeline, (1, "10:00:00", 1.0))
    run_gold(session, pipeline)
    wider = job_session(spark, pipeline)
    wider.conf.set("spark.sql.shuffle.partitions", "7")
    send(wider, pipeline, (1, "10:05:00", 1.0))
    _, query = run_gold(wider, pipeline)
    assert {s.numShufflePartitions for p in query.recentProgress for s in p.stateOperators} == {4}


def test_state_layout_after_a_restart_with_another_width(session, spark, pipeline):
    send(session, pipeline, (1, "10:00:00", 1.0))
    run_gold(session, pipeline)
    wider = job_session(spark, pipeline)
    wider.conf.set("spark.sql.shuffle.partitions", "7")
    send(wider, pipeline, (1, "10:05:00", 1.0))
    run_gold(wider, pipeline)
    (row,) = state_layout(spark, ONE_MINUTE, pipeline).collect()
    assert (row.operator, row.partitions, row.first_batch) == ("stateStoreSave", 4, 0) and row.last_batch >= 2


@pytest.mark.parametrize("decimals", [None, 3])
def test_open_windows_hold_what_gold_has_not_written(session, pipeline, decimals):
    pipeline = replace(pipeline, decimals=decimals)
    send(session, pipeline, (1, "10:00:00", 1.0), (1, "10:00:30", 2.0), (2, "10:04:00", None), (1, "10:05:30", 5.0))
    written, _ = run_gold(session, pipeline)
    held = rolled(open_windows(session, ONE_MINUTE, pipeline))
    assert written == {("1", at("10:00")): (1.5, 2.0)}  # the watermark stands at 10:03:30
    assert held == {("2", at("10:04")): (None, None), ("1", at("10:05")): (5.0, 5.0)}
    send(session, pipeline, (2, "10:04:59", 3.0), (1, "10:05:40", 6.0), (3, "10:20:00", 1.0))
    before = rolled(open_windows(session, ONE_MINUTE, pipeline))
    assert before == held  # Silver has more, the query has not run
    written, _ = run_gold(session, pipeline)
    assert written[("2", at("10:04"))] == (3.0, 3.0) and written[("1", at("10:05"))] == (5.5, 6.0)
    assert rolled(open_windows(session, ONE_MINUTE, pipeline)) == {("3", at("10:20")): (1.0, 1.0)}
    assert rolled(open_windows(session, ONE_MINUTE, pipeline, batch_id=0)).keys() >= held.keys()


def test_gold_stream_reads_only_what_it_needs(session, pipeline):
    send(session, pipeline, (1, "10:00:00", 1.0))
    _, query = run_gold(session, pipeline)
    rows = gold_rows(silver_table(session, pipeline.silver), ONE_MINUTE, pipeline)
    scan = plan(rows).split("ReadSchema: ")[1].splitlines()[0]
    assert "voltage" not in scan and "timestamp:string" not in scan


def test_throughput(session, pipeline):
    landing = land(session, pipeline, [reading(h, "2025-12-06T08:00:00+00:00", 1.0) for h in range(30)])
    query = start_ingest(envelope_stream(session, landing), pipeline)
    drain(query)
    rows = throughput_table(session, query).collect()
    assert sum(r.input_rows for r in rows) == 30
    assert all(r.query == "silver" and r.seconds > 0 for r in rows)
    assert rows[0].rows_per_second == pytest.approx(rows[0].input_rows / rows[0].seconds)
    assert "rows/s" in line(throughput(query)[0])


def test_report_writes_a_line_per_batch(session, pipeline):
    lines = []
    listener = ThroughputReport(lines.append)
    session.streams.addListener(listener)
    try:
        send(session, pipeline, (1, "08:00:00", 1.0), (2, "08:00:00", 1.0))
        deadline = time.monotonic() + 20
        while len(lines) < 2 and time.monotonic() < deadline:  # listeners run behind the query
            time.sleep(0.1)
    finally:
        session.streams.removeListener(listener)
    assert lines[0] == "[silver] started"
    assert lines[1].startswith("[silver batch 0] 2 rows in ")


def test_several_queries_and_the_first_failure_surfaces(session, pipeline):
    landing = land(session, pipeline, [reading(1, "2025-12-06T08:00:00+00:00", 1.0)])
    source = envelope_stream(session, landing)

    def fail(batch, batch_id):
        raise RuntimeError("sink is down")

    healthy = append_parquet(
        silver(source, BUSINESS_ZONE), "healthy", pipeline.silver, schemas.SILVER_PARTITIONS,
        pipeline.checkpoint("healthy"), {"processingTime": "1 second"},
    )
    broken = each_batch(source, "broken", fail, pipeline.checkpoint("broken"), {})
    try:
        assert len(session.streams.active) >= 1
        with pytest.raises(StreamingQueryException, match="sink is down"):
            wait_any(session)
    finally:
        healthy.stop()
        broken.stop()
        session.streams.resetTerminated()


def test_trigger_settings(session, pipeline):
    landing = land(session, pipeline, [reading(1, "2025-12-06T08:00:00+00:00", 1.0)])
    live = replace(pipeline, available_now=False, ingest_trigger="1 second")
    query = start_ingest(envelope_stream(session, landing), live)
    try:
        query.processAllAvailable()
        land(session, pipeline, [reading(2, "2025-12-06T08:00:30+00:00", 1.0)])
        query.processAllAvailable()
        assert silver_table(session, pipeline.silver).count() == 2
        assert query.isActive
    finally:
        query.stop()


def test_rows_are_never_nulled_by_the_pipeline(session, pipeline):
    send(session, pipeline, (1, "08:00:00", None), (1, "08:00:10", 2.0))
    assert silver_table(session, pipeline.silver).filter(F.col("power_kw").isNull()).count() == 1
