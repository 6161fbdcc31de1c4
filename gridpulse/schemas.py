"""Declared schemas of every layer, as Spark DDL. Nothing is ever inferred.

Column names and types are fixed values: they are the contract between the
layers and with whoever reads them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: the JSON reading as it arrives ------------------------------
RAW = (
    "house_id STRING, timestamp STRING, pv_panel_kw DOUBLE, "
    "ev_charging_kw DOUBLE, power_kw DOUBLE, voltage DOUBLE"
)

# --- fixed values: stored layers -----------------------------------------------
ENVELOPE = "value BINARY"
SILVER_PARTITIONS = ("dt", "hour")
SILVER = f"{RAW}, event_time TIMESTAMP, dt DATE, hour INT"
SERVING = (
    "house_id STRING, window_start TIMESTAMP NOT NULL, window_end TIMESTAMP NOT NULL, "
    "avg_power_kw DOUBLE, max_power_kw DOUBLE, "
    "avg_pv_panel_kw DOUBLE, avg_ev_charging_kw DOUBLE"
)
SERVING_COLUMNS = (
    "house_id",
    "window_start",
    "window_end",
    "avg_power_kw",
    "max_power_kw",
    "avg_pv_panel_kw",
    "avg_ev_charging_kw",
)
SERVING_KEY = ("house_id", "window_start")
GOLD_PARTITIONS = ("event_date", "hour")
GOLD = SERVING.replace(" NOT NULL", "") + ", event_date DATE, hour INT"

HOUSES = "house_id STRING"
GOLD_TYPES = dict(column.split(" ", 1) for column in GOLD.split(", "))


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    """Fail the write, naming the column, if a NOT NULL column holds a null.

    Belongs on the way into a table only: the guard hides the column from
    predicate pushdown.
    """
    return df.withColumns(
        {
            c: F.coalesce(F.col(c), F.raise_error(F.lit(f"{c} must not be null")).cast(df.schema[c].dataType))
            for c in columns
        }
    )
