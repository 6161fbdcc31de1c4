"""Instants, local calendar keys and interval arithmetic, independent of the session zone."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def parse_instant(text: Column | str) -> Column:
    """ISO-8601 text to an instant; null when it is not one (ANSI mode would raise).

    Text without an offset is read in the session zone.
    """
    return F.try_to_timestamp(text)


# An aware datetime, epoch microseconds, or a constant TIMESTAMP column.
Moment = datetime | int | Column


def instant(moment: Moment) -> Column:
    """The moment as a TIMESTAMP that the optimizer folds to a literal."""
    if isinstance(moment, Column):
        return moment
    if isinstance(moment, datetime):
        if moment.tzinfo is None:
            raise ValueError("a datetime bound needs a time zone")
        moment = (moment - _EPOCH) // timedelta(microseconds=1)
    return F.timestamp_micros(F.lit(moment))


def utc_clock(ts: Column | str) -> Column:
    """The UTC wall clock of an instant, as TIMESTAMP_NTZ.

    A cast to TIMESTAMP_NTZ would go through the session zone.
    """
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def _local_seconds(ts: Column | str, zone: str) -> Column:
    """Seconds of the wall clock of ``zone``, counted as if it were UTC.

    ``from_utc_timestamp`` moves an instant by the offset of the zone, whatever the
    session zone, at a fraction of the cost of ``convert_timezone``.
    """
    return F.unix_seconds(F.from_utc_timestamp(ts, zone))


def local_date(ts: Column | str, zone: str) -> Column:
    return F.date_from_unix_date(F.floor(_local_seconds(ts, zone) / 86_400).cast("int"))


def local_hour(ts: Column | str, zone: str) -> Column:
    """0-23. Both passes of the hour repeated in autumn give the same value."""
    return F.floor(F.pmod(_local_seconds(ts, zone), F.lit(86_400)) / 3_600).cast("int")


def iso_utc(ts: Column | str) -> Column:
    """ISO-8601 text with the UTC offset."""
    return F.concat(F.replace(utc_clock(ts).cast("string"), F.lit(" "), F.lit("T")), F.lit("+00:00"))


def minus(ts: Column | str, interval: str) -> Column:
    """An instant moved back by an interval such as ``7 days`` or ``1 year`` on the UTC calendar."""
    moved = utc_clock(ts) - F.expr(f"INTERVAL '{interval}'")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), moved))
