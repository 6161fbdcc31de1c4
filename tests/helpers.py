"""Small fixtures for the tests."""

import json

from pyspark.sql import functions as F

from gridpulse import schemas


def envelopes(spark, payloads):
    """Payload texts (or None, or dicts) as envelopes."""
    rows = [
        (None if p is None else bytearray((p if isinstance(p, str) else json.dumps(p)).encode()),) for p in payloads
    ]
    return spark.createDataFrame(rows, schemas.ENVELOPE)


def reading(house, time, power, pv=0.0, ev=0.0):
    return {
        "house_id": house,
        "timestamp": time,
        "pv_panel_kw": pv,
        "ev_charging_kw": ev,
        "power_kw": power,
        "voltage": 230.0,
    }


def land(spark, pipeline, payloads):
    """Append envelopes to the landing folder of a pipeline, as one file."""
    path = f"{pipeline.root}/landing"
    envelopes(spark, payloads).coalesce(1).write.mode("append").parquet(path)
    return path


def at(text):
    """A UTC wall clock of 2025-12-06 as epoch microseconds."""
    from datetime import datetime, timezone

    h, m = text.split(":")[:2]
    return int(datetime(2025, 12, 6, int(h), int(m), tzinfo=timezone.utc).timestamp()) * 1_000_000


def rolled(df):
    """{(house, start in us): (mean power, peak power)}"""
    rows = df.select("house_id", F.unix_micros("window_start"), "avg_power_kw", "max_power_kw").collect()
    found = {(r[0], r[1]): (r[2], r[3]) for r in rows}
    assert len(found) == len(rows)
    return found


def plan(df):
    """The formatted physical plan, with whole filter lists."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
