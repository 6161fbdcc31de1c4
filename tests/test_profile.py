import random

import pytest
from pyspark.sql import functions as F

from gridpulse.functions import profile


def column(spark, values, expression):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i INT, x DOUBLE")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_expected_profile_points(spark):
    hours = [6.99, 10, 13, 18, 19.5]
    six = column(spark, hours, profile.expected_pv("x", 6))
    eight = column(spark, hours, profile.expected_pv("x", 8))
    assert six == pytest.approx([0, 3.394113, 4.8, 1.242331, 0], abs=1e-6)
    assert eight == pytest.approx([0, 4.525483, 6.4, 1.656442, 0], abs=1e-6)
    assert column(spark, hours, profile.ev_session("x", 18, 1.5)) == [0, 0, 0, 7.4, 0]
    assert all(v >= 0 for v in column(spark, [7, 19], profile.expected_pv("x", 6)))


def test_parameters_may_be_columns(spark):
    houses = [(18.0, 6.0, 17.5, 1.0, 0.8), (18.0, 8.0, 18.5, 1.0, 1.2)]
    df = spark.createDataFrame(houses, "h DOUBLE, size DOUBLE, s DOUBLE, d DOUBLE, k DOUBLE")
    rows = df.select(
        profile.expected_pv("h", "size"), profile.ev_session("h", "s", "d"), profile.base_load("h", "k")
    ).collect()
    assert rows[1][0] / rows[0][0] == pytest.approx(8 / 6)
    assert [r[1] for r in rows] == [7.4, 0.0]
    assert rows[1][2] / rows[0][2] == pytest.approx(1.5)


def test_base_load_peaks_in_the_evening(spark):
    hours = [h / 4 for h in range(96)]
    load = column(spark, hours, profile.base_load("x"))
    assert hours[load.index(max(load))] == 19.5
    assert load[0] == pytest.approx(0.25, abs=1e-3)


def test_net_power_and_house_load_are_inverse(spark):
    net = profile.net_power(F.col("x"), F.lit(7.4), F.lit(1.3))
    assert column(spark, [0.5, 2.0], profile.house_load(net, F.lit(7.4), F.lit(1.3))) == pytest.approx([0.5, 2.0])


def test_hour_fraction_is_utc_to_the_second(spark):
    got = spark.sql("SELECT TIMESTAMP'2025-12-06T18:30:36.9+00:00' AS t").select(profile.hour_fraction("t")).first()[0]
    assert got == 18.51


@pytest.mark.parametrize("decimals", [1, 3])
def test_measured_rounds_by_the_exact_value(spark, decimals):
    rng = random.Random(11)
    ties = [(k + 0.5) / 10**decimals for k in range(-400, 400)]
    binary_ties = [k / 16 for k in range(-400, 400)]
    noise = [rng.uniform(-20, 20) for _ in range(5000)]
    special = [0.15, 2.675, 1.005, 0.0625, 1e15 + 0.3, 123456789.0005, 5e-324, 0.0, -0.0, 1e300]
    values = ties + binary_ties + noise + special
    assert column(spark, values, profile.measured("x", decimals)) == [round(v, decimals) for v in values]
