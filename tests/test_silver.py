import datetime

import pytest
from pyspark.sql import functions as F

from gridpulse import schemas
from gridpulse.config import BUSINESS_ZONE
from gridpulse.functions import wire
from gridpulse.functions.clock import instant, iso_utc, local_date, local_hour, minus
from gridpulse.operators.silver import clean, parse, silver
from helpers import envelopes, plan, reading

SAMPLE = {
    "house_id": "417",
    "timestamp": "2025-12-06T08:41:07.500000+00:00",
    "pv_panel_kw": 1.25,
    "ev_charging_kw": 3.5,
    "power_kw": 2.75,
    "voltage": 231.5,
}


def test_sample_reading_is_stored_under_local_hour(session):
    row = silver(envelopes(session, [SAMPLE]), BUSINESS_ZONE).first()
    assert (row.house_id, row.pv_panel_kw, row.ev_charging_kw, row.power_kw, row.voltage) == (
        "417", 1.25, 3.5, 2.75, 231.5,
    )
    assert (row.dt, row.hour) == (datetime.date(2025, 12, 6), 9)


@pytest.mark.parametrize(
    "payload",
    [
        "not json",
        "",
        None,
        '["a"]',
        "17",
        {"house_id": None, "timestamp": "2025-12-06T23:30:00Z"},
        {"timestamp": "2025-12-06T23:30:00Z"},
        {"house_id": 1, "timestamp": "garbage"},
        {"house_id": 1},
    ],
)
def test_unusable_payload_is_parsed_to_nulls_and_dropped(session, payload):
    rows = envelopes(session, [payload])
    assert parse(rows).count() == 1
    assert silver(rows, BUSINESS_ZONE).count() == 0


def test_whole_number_house_and_extra_key(session):
    row = silver(envelopes(session, [SAMPLE | {"house_id": 2113, "extra": 1}]), BUSINESS_ZONE).first()
    assert row.house_id == "2113"
    assert set(row.asDict()) == set(SAMPLE) | {"event_time", "dt", "hour"}


def test_unreadable_field_is_null_and_the_row_stays(session):
    payload = {"house_id": "7", "timestamp": "2025-12-06T23:30:00+00:00", "power_kw": "abc", "voltage": 229.5}
    row = silver(envelopes(session, [payload]), BUSINESS_ZONE).first()
    assert row.power_kw is None and row.voltage == 229.5
    assert (row.dt, row.hour) == (datetime.date(2025, 12, 7), 0)


def test_time_without_offset_is_local_and_nan_is_kept(session):
    rows = silver(
        envelopes(
            session,
            [
                '{"house_id":1,"timestamp":"2025-12-06 10:00:00"}',
                '{"house_id":1.5,"timestamp":"2025-12-06","power_kw":NaN}',
            ],
        ),
        BUSINESS_ZONE,
    ).orderBy("house_id").collect()
    assert [(r.house_id, r.hour) for r in rows] == [("1", 10), ("1.5", 0)]
    assert rows[1].power_kw != rows[1].power_kw


def test_autumn_hour_happens_twice_under_one_key(session):
    rows = silver(
        envelopes(session, [reading(1, f"2025-10-26T0{h}:30:00+00:00", 1.0) for h in (0, 1)]), BUSINESS_ZONE
    )
    assert {(str(r.dt), r.hour) for r in rows.collect()} == {("2025-10-26", 2)}
    assert rows.select("event_time").distinct().count() == 2


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "America/New_York", "Asia/Kolkata"])
def test_clock_does_not_depend_on_the_session_zone(spark, zone):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", zone)
    # 01:30Z lies in New York's spring gap as a wall clock on 2025-03-09T02:30, and in Berlin's autumn overlap.
    for us, iso, day, hour, week in [
        (1741487400000000, "2025-03-09T02:30:00+00:00", "2025-03-09", 3, 1740882600000000),
        (1761442200123456, "2025-10-26T01:30:00.123456+00:00", "2025-10-26", 2, 1760837400123456),
    ]:
        ts = instant(us)
        row = other.range(1).select(
            iso_utc(ts), local_date(ts, "Europe/Berlin").cast("string"), local_hour(ts, "Europe/Berlin"),
            F.unix_micros(minus(ts, "7 days")),
        ).first()
        assert tuple(row) == (iso, day, hour, week)


def test_encode_and_decode_are_inverse(session):
    sent = session.createDataFrame([("7", "2025-12-06T08:00:00+00:00", 1.25, 0.0, -3.5, 229.9)], schemas.RAW)
    envelope = sent.select(wire.encode(*sent.columns).alias("value"))
    assert envelope.schema["value"].dataType.simpleString() == "binary"
    assert parse(envelope).collect() == sent.collect()


def test_json_is_parsed_once_per_row(session, tmp_path):
    """A filter on parsed fields must not bring its own copies of the parser."""
    path = str(tmp_path / "landing")
    envelopes(session, [SAMPLE]).write.parquet(path)
    physical = plan(clean(parse(session.read.parquet(path))))
    assert physical.count("from_json") == 1
    assert "Exchange" not in physical


@pytest.mark.parametrize("zone", ["Europe/Berlin", "Asia/Kathmandu", "Pacific/Pago_Pago", "America/St_Johns"])
def test_local_keys_equal_the_calendar_of_the_zone(spark, zone):
    """Every quarter-hour of two years with four clock changes, and before 1970."""
    local = spark.newSession()
    local.conf.set("spark.sql.session.timeZone", zone)

    def quarters(first, n):
        return local.range(n).select(F.timestamp_micros(F.lit(first) + F.col("id") * 900_000_000).alias("t"))

    rows = quarters(1704067200000000 - 1, 70_000).unionAll(quarters(-900000000000, 2_000))
    wrong = rows.filter((local_date("t", zone) != F.to_date("t")) | (local_hour("t", zone) != F.hour("t")))
    assert wrong.count() == 0 and rows.filter(local_date("t", zone).isNull()).count() == 0


def test_parse_equals_a_plain_projection_of_the_fields(session):
    good = '{"house_id":1,"timestamp":"2025-12-06T10:00:00Z","power_kw":1.5}'
    payloads = [
        good, f"[{good}]", f"[{good},{good}]", f"{good}{good}", f"{good} trailing", good[:-1], "[]", "{}", "null", "true",
        '"text"', "1e5", " ", None, "", '{"house_id":{"a":1}}', '{"house_id":[1]}', '{"house_id":true,"house_id":2}',
        '{"power_kw":"1.5"}', '{"power_kw":Infinity}', '{"power_kw":"NaN"}', '{"power_kw":1e400}', '{"voltage":[230]}',
        "{'house_id':1}", '{"HOUSE_ID":1}', '{"house_id":"\\u0000\\ud83d\\ude00"}', "\ufeff" + good,
    ]
    rows = [(None if p is None else bytearray(p.encode()),) for p in payloads] + [(bytearray(b"\xff\xfe{"),)]
    envelope = session.createDataFrame(rows, schemas.ENVELOPE)
    plain = envelope.select(wire.decode("value").alias("r")).select("r.*")
    assert list(map(repr, parse(envelope).collect())) == list(map(repr, plain.collect()))
    assert parse(envelope).count() == len(rows)
