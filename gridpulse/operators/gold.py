"""Roll-ups of readings per house and tumbling window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse import schemas
from gridpulse.functions import means
from gridpulse.functions.clock import Moment, instant, local_date, local_hour


#: Readings that a roll-up averages.
AVERAGED = ("power_kw", "pv_panel_kw", "ev_charging_kw")


def partial_columns(decimals: int | None) -> list[str]:
    """What a window holds until it is finished, in the order in which a stream's state keeps it."""
    return ["max_power_kw", *(f"{name}__{part}" for name in AVERAGED for part in means.parts_of(decimals))]


def partials(decimals: int | None) -> list[Column]:
    made = {"max_power_kw": F.max("power_kw")}
    for name in AVERAGED:
        made |= {f"{name}__{part}": column for part, column in means.sums(F.col(name), decimals).items()}
    return [made[c].alias(c) for c in partial_columns(decimals)]


def finish(rolled: DataFrame, decimals: int | None) -> DataFrame:
    """Means from the partial columns."""
    parts = {name: {part: F.col(f"{name}__{part}") for part in means.parts_of(decimals)} for name in AVERAGED}
    made = {f"avg_{name}": means.mean(parts[name], decimals) for name in AVERAGED}
    return rolled.withColumns(made).select(*schemas.SERVING_COLUMNS)


def roll_up(
    readings: DataFrame,
    width: str,
    *,
    lateness: str | None = None,
    decimals: int | None = None,
    since: Moment | None = None,
    until: Moment | None = None,
) -> DataFrame:
    """Mean power, PV and EV and peak power per house and window of ``width``.

    Rows are combined before the one shuffle, by (house, window), so a house with a
    third of all readings costs each task one row per window. A stream needs
    ``lateness``: a window is emitted once, when the watermark passes its end, and
    later readings for it are dropped.

    ``since`` and ``until`` keep windows that start in [since, until]. The readings
    outside are filtered first, on ``event_time`` itself, which a scan understands;
    it does not see through the window arithmetic.

    Means are summed exactly and do not depend on partitioning. ``decimals`` names the
    resolution of the readings; their decimal values are then summed in fixed point.
    """
    slot = F.window("event_time", width)
    if since is not None:
        readings = readings.filter(F.col("event_time") >= instant(since))
    if until is not None:
        readings = readings.filter(F.col("event_time") < instant(until) + F.expr(f"INTERVAL '{width}'"))

    if readings.isStreaming:
        if lateness:
            readings = readings.withWatermark("event_time", lateness)
        windows, start, end = readings.groupBy("house_id", slot.alias("slot")), "slot.start", F.col("slot.end")
    else:
        # A flat timestamp key fits the hash map of generated code; a struct does not.
        windows = readings.withColumns({"start": slot.start}).groupBy("house_id", "start")
        start, end = "start", F.col("start") + F.expr(f"INTERVAL '{width}'")

    rolled = windows.agg(*partials(decimals)).withColumns({"window_start": F.col(start), "window_end": end})
    return between(finish(rolled, decimals), since, until)


def between(gold: DataFrame, since: Moment | None, until: Moment | None) -> DataFrame:
    """Rows whose window starts in [since, until]."""
    start = F.col("window_start")
    if since is not None:
        gold = gold.filter(start >= instant(since))
    if until is not None:
        gold = gold.filter(start <= instant(until))
    return gold


def with_partition_keys(gold: DataFrame, zone: str) -> DataFrame:
    """The local date and hour in which a window starts."""
    return gold.withColumns(
        {"event_date": local_date("window_start", zone), "hour": local_hour("window_start", zone)}
    )
