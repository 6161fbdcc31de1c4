import math
import random

import pytest
from pyspark.sql import functions as F

from gridpulse.config import BUSINESS_ZONE, ONE_MINUTE, QUARTER_HOUR
from gridpulse.functions.means import exact_mean, fixed_point_mean
from gridpulse.operators import gold
from gridpulse.operators.gold import roll_up
from gridpulse.operators.silver import silver
from gridpulse.sources.events import events, readings
from helpers import at, envelopes, plan, reading, rolled


def rows_of(session, *triples):
    return silver(
        envelopes(session, [reading(h, f"2025-12-06T{t}+00:00", p) for h, t, p in triples]), BUSINESS_ZONE
    )


def test_windows_are_half_open_and_start_at_the_epoch(session):
    df = rows_of(
        session, (1, "10:00:00", 1.0), (1, "10:00:59.999999", 3.0), (1, "10:01:00", 10.0), (2, "10:00:30", 7.0)
    )
    assert rolled(roll_up(df, "1 minute")) == {
        ("1", at("10:00")): (2.0, 3.0),
        ("1", at("10:01")): (10.0, 10.0),
        ("2", at("10:00")): (7.0, 7.0),
    }
    assert rolled(roll_up(df, "15 minutes"))["1", at("10:00")] == (14 / 3, 10.0)


def test_window_end_and_local_keys(session):
    row = gold.with_partition_keys(roll_up(rows_of(session, (1, "23:05:00", 1.0)), "15 minutes"), BUSINESS_ZONE)
    start, end = F.unix_micros("window_start"), F.unix_micros("window_end")
    row = row.select(start, end, F.col("event_date").cast("string"), "hour").first()
    assert tuple(row) == (at("23:00"), at("23:15"), "2025-12-07", 0)


@pytest.mark.parametrize("decimals", [None, 3])
def test_nulls_are_skipped_and_nan_poisons(session, decimals):
    nan = float("nan")

    def result(*values):
        df = rows_of(session, *((1, f"10:00:{i:02d}", v) for i, v in enumerate(values)))
        return rolled(roll_up(df, "1 minute", decimals=decimals))["1", at("10:00")]

    assert result(1.0, None, 4.0) == (2.5, 4.0)
    assert result(None, None) == (None, None)
    assert all(math.isnan(x) for x in result(1.0, None, nan))
    assert result(1.0, float("inf")) == (math.inf, math.inf)
    assert all(math.isnan(x) for x in (result(math.inf, -math.inf)[0],))
    assert result(1e300, 1e300, 1.5)[0] == pytest.approx(2e300 / 3)


def test_fixed_point_mean_does_not_depend_on_partitioning(spark):
    rng = random.Random(7)
    values = [round(rng.uniform(-9, 9), 3) for _ in range(20_000)]
    df = spark.createDataFrame([(v,) for v in values], "power_kw DOUBLE").withColumns(
        {
            "house_id": F.lit("1"),
            "event_time": F.lit("2025-12-06T10:00:30Z").cast("timestamp"),
            "pv_panel_kw": F.lit(0.0),
            "ev_charging_kw": F.lit(0.0),
        }
    )
    exact = sum(round(v * 1000) for v in values) / 1000 / len(values)
    for partitions in (1, 3, 16):
        dealt = df.repartition(partitions)
        assert roll_up(dealt, "1 minute", decimals=3).first().avg_power_kw == exact
        assert roll_up(dealt, "1 minute").first().avg_power_kw == math.fsum(values) / len(values)


def test_means_equal_an_exact_sum_rounded_once(spark):
    rng, groups = random.Random(3), []
    for _ in range(200):
        scale = rng.choice([0, 5, -20, 30, 50, 60])
        sizes = (2.0 ** rng.choice([scale, scale - 10, scale + 1]) for _ in range(rng.randrange(1, 40)))
        groups.append([rng.choice([1, -1]) * rng.random() * size for size in sizes])
    groups += [[1.0, -1.0, 2.0**-43], [2.0**53, 1.0, 2.0**-40], [0.1] * 10, [-0.1] * 10, [7.4, -7.4], [2.0**-30, 2.0**-80 - 2.0**-30]]
    groups += [[-(2.0**-50)], [1.0, 2.0**-53, 2.0**-90], [1.0, 2.0**-53], [2.0**61, -(2.0**61), 3.0], [2.0**61] * 40, [0.0], []]
    rows = [(i, v) for i, group in enumerate(groups) for v in [*group, None]]
    rng.shuffle(rows)
    means = spark.createDataFrame(rows, "g INT, x DOUBLE").repartition(7).groupBy("g").agg(exact_mean(F.col("x")).alias("m"))
    assert dict(means.collect()) == {i: math.fsum(g) / len(g) if g else None for i, g in enumerate(groups)}


def test_readings_beyond_the_limbs_act_as_in_avg(spark):
    rows = [(1, 1e300), (1, 1e300), (1, -1e300), (2, math.inf), (2, 1.0), (3, math.nan), (4, 2.0**62), (4, 1.0)]
    df = spark.createDataFrame(rows, "g INT, x DOUBLE")
    both = df.groupBy("g").agg(exact_mean(F.col("x")), fixed_point_mean(F.col("x"), 3), F.avg("x")).collect()
    assert all(str(a) == str(b) == str(c) for _, a, b, c in both) and len(both) == 4


@pytest.mark.parametrize("grain", [ONE_MINUTE, QUARTER_HOUR], ids=lambda g: g.name)
def test_plain_and_fixed_point_means_agree(spark, sf_dir, grain):
    df = readings(events(spark, sf_dir))
    both = roll_up(df, grain.width).alias("a").join(
        roll_up(df, grain.width, decimals=3).alias("b"), ["house_id", "window_start"], "full"
    )
    means = ("avg_power_kw", "avg_pv_panel_kw", "avg_ev_charging_kw")
    gaps = [F.max(F.abs(F.col(f"a.{c}") - F.col(f"b.{c}"))) for c in means]
    missing = F.sum(F.when(F.col("a.avg_power_kw").isNull() | F.col("b.avg_power_kw").isNull(), 1).otherwise(0))
    *gaps, missing = both.agg(*gaps, missing).first()
    assert missing == 0 and max(gaps) < 1e-9


def test_bounds_equal_a_filter_afterwards_and_reach_the_scan(spark, sf_dir):
    df = readings(events(spark, sf_dir), clock="real")
    everything = roll_up(df, "15 minutes")
    starts = sorted(r[0] for r in everything.select(F.unix_micros("window_start")).distinct().collect())
    since, until = starts[len(starts) // 3], starts[len(starts) // 2]
    some = roll_up(df, "15 minutes", since=since, until=until)
    assert rolled(some) == rolled(gold.between(everything, since, until))
    assert {k[1] for k in rolled(some)} >= {since, until}
    scan = plan(some).split("PushedFilters: ")[1]
    assert "GreaterThanOrEqual(ts" in scan and "LessThan(ts" in scan


def test_one_shuffle_after_partial_aggregation(spark, sf_dir):
    physical = plan(roll_up(readings(events(spark, sf_dir)), "1 minute"))
    tree = physical.split("(1) Scan")[0]
    assert tree.count("Exchange") == 1 and tree.count("HashAggregate") == 2
    assert "partial_sum" in physical and "partial_max" in physical
    assert "ReadSchema: struct<ts:timestamp,event_type:string,value:double,props:string>" in physical
