"""Registered queries that run as one batch plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse import schemas
from gridpulse.config import BUSINESS_ZONE, GRANULARITIES, Granularity, Pipeline
from gridpulse.functions import profile
from gridpulse.functions.clock import instant, minus
from gridpulse.functions.means import exact_mean
from gridpulse.operators import gold, serve
from gridpulse.operators.layout import balance_for_write, cluster_for_write
from gridpulse.operators.retention import retain
from gridpulse.operators.silver import clean, parse, silver, with_partition_keys
from gridpulse.plans.common import (
    DECIMALS,
    HOUSE,
    dense_gold,
    dense_readings,
    encoded,
    mixed_envelopes,
    null_key_envelopes,
    portable,
    real_readings,
)
from gridpulse.session import job_session, shared_folder
from gridpulse.sources.events import events, readings, undense
from gridpulse.sources.files import gold_table, silver_table


def silver_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse(mixed_envelopes(spark, sf_dir))


def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_partition_keys(clean(parse(mixed_envelopes(spark, sf_dir))), BUSINESS_ZONE)
    return portable(rows.drop("timestamp"))


def silver_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_partition_keys(clean(parse(null_key_envelopes(spark, sf_dir))), BUSINESS_ZONE)
    return portable(rows.drop("timestamp"))


def event_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = encoded(real_readings(spark, sf_dir))
    return portable(clean(parse(sent)).drop("timestamp"))


def layer_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write Silver, read it back as a table, and count what each folder holds."""
    path = shared_folder(spark, "silver")
    session = job_session(spark, Pipeline(root=path))
    rows = silver(mixed_envelopes(session, sf_dir), BUSINESS_ZONE)
    written = balance_for_write(rows, schemas.SILVER_PARTITIONS)
    written.write.partitionBy(*schemas.SILVER_PARTITIONS).parquet(path)
    folders = silver_table(spark, path).groupBy("dt", "hour").agg(F.count(F.lit(1)).alias("n_rows"))
    return portable(folders)


def gold_of(grain: Granularity):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(gold.with_partition_keys(dense_gold(spark, sf_dir, grain), BUSINESS_ZONE))

    return query


def gold_avg_of(grain: Granularity):
    """Means as the jobs compute them by default: of the readings' doubles, summed exactly."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        table = gold.roll_up(dense_readings(spark, sf_dir), grain.width)
        return portable(gold.with_partition_keys(table, BUSINESS_ZONE))

    return query


def serving_of(grain: Granularity):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        stored = gold.with_partition_keys(dense_gold(spark, sf_dir, grain), BUSINESS_ZONE)
        return portable(serve.to_serving(stored))

    return query


def house_list_of(grain: Granularity):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return serve.house_list(dense_gold(spark, sf_dir, grain))

    return query


def panel_of(grain: Granularity, metric: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(serve.panel(dense_gold(spark, sf_dir, grain), HOUSE, metric))

    return query


# Fixed value: the shape of the statement a dashboard sends, with its token for the house.
PANEL_STATEMENT = """
SELECT window_start AS time, avg_power_kw AS value
FROM readings_rolled_up
WHERE house_id = '$house_id'
ORDER BY window_start;
"""


def dashboard_sql_of(grain: Granularity):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        table = dense_gold(spark, sf_dir, grain)
        return portable(serve.panel_sql(spark, PANEL_STATEMENT, HOUSE, readings_rolled_up=table))

    return query


def panel_range_of(grain: Granularity):
    """The default dashboard range, counted back from the latest window."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = events(spark, sf_dir)
        since, until = latest_windows(readings(source), grain, grain.dashboard_range)
        width = F.expr(f"INTERVAL '{grain.width}'")
        # The same bounds in the time of the stored column, for the scan.
        ts = F.col("ts")
        source = source.filter((ts >= undense(instant(since))) & (ts < undense(instant(until) + width)))
        table = gold.roll_up(readings(source), grain.width, decimals=DECIMALS, since=since, until=until)
        return portable(serve.panel(table, HOUSE, "power"))

    return query


def gold_files_of(grain: Granularity):
    """Store Gold clustered by hour; count the files and rows of each folder."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = shared_folder(spark, f"gold-files-{grain.name}")
        session = job_session(spark, Pipeline(root=path))
        rows = gold.with_partition_keys(dense_gold(session, sf_dir, grain), BUSINESS_ZONE)
        cluster_for_write(rows, schemas.GOLD_PARTITIONS).write.partitionBy(*schemas.GOLD_PARTITIONS).parquet(path)
        per_file = gold_table(spark, path).groupBy("event_date", "hour", "_metadata.file_path").count()
        folders = per_file.groupBy("event_date", "hour").agg(
            F.count(F.lit(1)).alias("n_files"), F.sum("count").alias("n_rows")
        )
        return portable(folders)

    return query


def gold_salted_of(grain: Granularity):
    """Store Gold as a live query does, each hour dealt to a few tasks; per folder its rows, and whether it has a file per task at most."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = shared_folder(spark, f"gold-salted-{grain.name}")
        pipeline = Pipeline(root=path)
        session = job_session(spark, pipeline)
        rows = gold.with_partition_keys(dense_gold(session, sf_dir, grain), BUSINESS_ZONE)
        dealt = cluster_for_write(
            rows, schemas.GOLD_PARTITIONS, pipeline.write_width, salt=pipeline.write_salt, spread_by=schemas.SERVING_KEY
        )
        dealt.write.partitionBy(*schemas.GOLD_PARTITIONS).parquet(path)
        folders = gold_table(spark, path).groupBy("event_date", "hour").agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.countDistinct("house_id", "window_start").alias("n_windows"),
            F.max("window_start").alias("last_window"),
            (F.countDistinct("_metadata.file_path") <= pipeline.write_salt).alias("files_bounded"),
        )
        return portable(folders)

    return query


def latest_windows(rows: DataFrame, grain: Granularity, back: str) -> tuple[int, int]:
    """Starts of the earliest and latest window of a range that ends with the data, in
    epoch microseconds."""
    newest = rows.agg(F.max("event_time").alias("event_time"))
    start = F.window("event_time", grain.width).start
    return tuple(newest.select(F.unix_micros(minus(start, back)), F.unix_micros(start)).first())


def peek_of(grain: Granularity):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(serve.peek(dense_gold(spark, sf_dir, grain), 10))

    return query


def retention_of(grain: Granularity):
    """Real time: the month of test data outlasts the shorter retention."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = real_readings(spark, sf_dir)
        since, anchor = latest_windows(rows, grain, grain.keep)
        table = gold.roll_up(rows, grain.width, decimals=DECIMALS, since=since)
        return portable(retain(table, anchor, grain.keep))

    return query


def profile_hour_frac(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _at_hours(spark, sf_dir, lambda h: F.round(h, 6).alias("hour_frac"))


def profile_pv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _at_hours(
        spark,
        sf_dir,
        lambda h: F.round(profile.expected_pv(h, 6), 6).alias("expected_pv_6_kw"),
        lambda h: F.round(profile.expected_pv(h, 8), 6).alias("expected_pv_8_kw"),
    )


def profile_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _at_hours(spark, sf_dir, lambda h: profile.ev_session(h, 18, 1.5).alias("expected_ev_kw"))


def profile_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _at_hours(spark, sf_dir, lambda h: F.round(profile.base_load(h), 6).alias("expected_load_kw"))


def profile_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected against measured grid power."""
    return _at_hours(
        spark,
        sf_dir,
        lambda h: F.round(
            profile.net_power(profile.base_load(h), profile.ev_session(h, 18, 1.5), profile.expected_pv(h, 6)), 6
        ).alias("expected_power_kw"),
        lambda h: F.col("power_kw"),
    )


def profile_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per house and hour of the day: what was measured, what the profile expects at the same times, and how far they lie apart.

    The size of a house's panels is taken from its greatest output.
    """
    rows = real_readings(spark, sf_dir)
    sizes = rows.groupBy("house_id").agg(F.when(F.max("pv_panel_kw") > 6, F.lit(8.0)).otherwise(F.lit(6.0)).alias("size_kw"))
    h = profile.hour_fraction("event_time")
    placed = rows.withColumns({"h": h, "hour_of_day": F.floor(h).cast("int"), "load_kw": profile.house_load("power_kw", "ev_charging_kw", "pv_panel_kw")})
    sums = {"load": ("load_kw", profile.base_load("h")), "ev": ("ev_charging_kw", profile.ev_session("h", 18, 1.5))}
    found = placed.groupBy("house_id", "hour_of_day").agg(
        F.count(F.lit(1)).alias("n_readings"),
        exact_mean(F.col("pv_panel_kw")).alias("pv"),
        exact_mean(profile.expected_pv("h", 1.0)).alias("pv_of_one_kw"),
        *(exact_mean(F.col(c)).alias(name) for name, (c, _) in sums.items()),
        *(exact_mean(expected).alias(f"expected_{name}") for name, (_, expected) in sums.items()),
    )
    pv = F.col("pv_of_one_kw") * F.col("size_kw")
    joined = found.join(sizes, "house_id")  # a row per house on one side, 24 on the other
    return joined.select(
        "house_id",
        "hour_of_day",
        "n_readings",
        F.col("pv").alias("pv_kw"),
        F.round(pv, 6).alias("expected_pv_kw"),
        F.round(F.col("pv") - pv, 6).alias("pv_deviation_kw"),
        F.round(F.col("ev") - F.col("expected_ev"), 6).alias("ev_deviation_kw"),
        F.round(F.col("load") - F.col("expected_load"), 6).alias("load_deviation_kw"),
    )


def _at_hours(spark: SparkSession, sf_dir: str, *features) -> DataFrame:
    h = profile.hour_fraction("event_time")
    return real_readings(spark, sf_dir).select("event_id", *(feature(h) for feature in features))


def net_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    load = profile.house_load("power_kw", "ev_charging_kw", "pv_panel_kw")
    return real_readings(spark, sf_dir).select("event_id", F.round(load, 6).alias("house_load_kw"))


def measure_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    return real_readings(spark, sf_dir).select(
        "event_id",
        profile.measured("power_kw", profile.VOLT_DECIMALS).alias("power_1"),
        profile.measured(F.col("power_kw") / 16, profile.KW_DECIMALS).alias("sixteenth_3"),
    )


def queries() -> dict:
    registered = {
        "silver_parse": silver_parse,
        "silver_clean": silver_clean,
        "silver_null_keys": silver_null_keys,
        "event_encode": event_encode,
        "layer_scan": layer_scan,
        "profile_hour_frac": profile_hour_frac,
        "profile_pv": profile_pv,
        "profile_ev": profile_ev,
        "profile_load": profile_load,
        "profile_net": profile_net,
        "profile_deviation": profile_deviation,
        "net_balance": net_balance,
        "measure_round": measure_round,
    }
    for grain in GRANULARITIES:
        registered |= {
            f"gold_{grain.name}": gold_of(grain),
            f"gold_avg_{grain.name}": gold_avg_of(grain),
            f"gold_files_{grain.name}": gold_files_of(grain),
            f"gold_salted_{grain.name}": gold_salted_of(grain),
            f"serving_{grain.name}": serving_of(grain),
            f"house_list_{grain.name}": house_list_of(grain),
            f"dashboard_sql_{grain.name}": dashboard_sql_of(grain),
            f"panel_range_{grain.name}": panel_range_of(grain),
            f"peek_{grain.name}": peek_of(grain),
            f"retention_{grain.name}": retention_of(grain),
        }
        registered |= {f"panel_{m}_{grain.name}": panel_of(grain, m) for m in serve.PANELS}
    return registered
