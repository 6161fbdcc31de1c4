"""The dashboard questions, over any Gold or serving table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse import schemas
from gridpulse.config import DEFAULT_HOUSE
from gridpulse.functions.clock import Moment, instant, utc_clock
from gridpulse.operators.gold import between

# --- fixed values: the three series of a dashboard ------------------------------
PANELS = {
    "power": "avg_power_kw",
    "pv": "avg_pv_panel_kw",
    "ev": "avg_ev_charging_kw",
}


def to_serving(gold: DataFrame) -> DataFrame:
    """The seven serving columns, without the storage keys."""
    return gold.select(*schemas.SERVING_COLUMNS)


def house_list(table: DataFrame) -> DataFrame:
    """The houses to choose from, in text order ("10" before "2")."""
    return table.select("house_id").distinct().orderBy("house_id")


def in_range(table: DataFrame, since: Moment | None, until: Moment | None) -> DataFrame:
    """Windows that start in [since, until].

    On a stored Gold table the same bounds also prune its date folders. A local date
    is at most a day away from the UTC date, whatever the zone.
    """
    if "event_date" in table.columns:
        date = F.col("event_date")
        if since is not None:
            table = table.filter(date >= F.date_sub(F.to_date(utc_clock(instant(since))), 1))
        if until is not None:
            table = table.filter(date <= F.date_add(F.to_date(utc_clock(instant(until))), 1))
    return between(table, since, until)


def panel(
    table: DataFrame,
    house_id: str = DEFAULT_HOUSE,
    metric: str = "power",
    *,
    since: Moment | None = None,
    until: Moment | None = None,
) -> DataFrame:
    """One series of one house: (time, value) in time order.

    ``metric`` is a panel name (``power``, ``pv``, ``ev``) or a column.
    """
    value = F.col(PANELS.get(metric, metric))
    chosen = in_range(table, since, until).filter(F.col("house_id") == F.lit(house_id))
    return chosen.select(F.col("window_start").alias("time"), value.alias("value")).orderBy("time")


def dashboard(table: DataFrame, house_id: str = DEFAULT_HOUSE, **bounds: Moment | None) -> dict[str, DataFrame]:
    """The three series of one house, by panel name."""
    return {name: panel(table, house_id, name, **bounds) for name in PANELS}


def panel_sql(spark: SparkSession, statement: str, house_id: str, **tables: DataFrame) -> DataFrame:
    """A dashboard's own SQL. ``'$house_id'`` becomes a bound parameter, so that the
    choice is never read as SQL, and each keyword names a table of the statement."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    text = statement.strip().rstrip(";").replace("'$house_id'", ":house_id")
    return spark.sql(text, args={"house_id": house_id}) if ":house_id" in text else spark.sql(text)


def peek(table: DataFrame, n: int = 10, *, ordered: bool = True) -> DataFrame:
    """A few rows: the first by house and time, always the same, or just any.

    The first rows take a pass over the whole table; any rows take a file or two.
    """
    return (table.orderBy(*schemas.SERVING_KEY) if ordered else table).limit(n)


def latest(table: DataFrame) -> int | None:
    """The latest window start of a table, in epoch microseconds.

    One number reaches the driver; as a literal it can then prune scans. On a stored
    Gold table the newest folder is found first, which reads no column, and the rest
    are left out. The folder before it counts too, for zones whose clocks go back at
    midnight.
    """
    if "event_date" in table.columns:
        newest = table.agg(F.max("event_date")).first()[0]
        table = table.filter(F.col("event_date") >= F.date_sub(F.lit(newest).cast("date"), 1))
    return table.agg(F.unix_micros(F.max("window_start"))).first()[0]
