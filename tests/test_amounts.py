"""Exact sums against decimal arithmetic."""

import math
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tripflow.functions.amounts import exact_avg, exact_sum, percentage
from pyspark.sql import functions as F


def summed(spark, values):
    frame = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    return frame.agg(exact_sum("x").alias("s"), exact_avg("x").alias("a")).first()


cents = st.integers(-(10**9), 10**9).map(lambda n: n / 100)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(cents, min_size=1, max_size=60))
def test_sum_of_cents_is_exact(spark, values):
    expected = float(sum(Decimal(repr(v)) for v in values))
    got = summed(spark, values)
    assert got.s == expected
    assert got.a == expected / len(values)


def test_noise_is_folded_and_other_values_are_kept(spark):
    assert summed(spark, [0.1 + 0.2, 0.1, 0.1]).s == 0.5
    assert math.isclose(summed(spark, [1 / 3, 1 / 3, 1.0]).s, 5 / 3)
    assert summed(spark, [1e15, 1.5]).s == 1e15 + 1.5
    assert math.isnan(summed(spark, [float("nan"), 1.0]).s)
    assert summed(spark, [float("inf"), 1.0]).s == float("inf")


def test_totals_beyond_a_long_and_small_parts_do_not_depend_on_partitions(spark):
    frame = spark.range(2_000_000).select((F.lit(9e8) + F.col("id") / 1e6).alias("x"))
    expected = float(sum(Decimal(900_000_000) + Decimal(i) / 10**6 for i in range(2_000_000)))
    for n in (1, 3, 7):
        assert frame.repartition(n).agg(exact_sum("x").alias("s")).first().s == expected
    assert summed(spark, [12.340000004] * 3).s == 37.020000012
    assert summed(spark, [2e9, 0.3, 1e12]).s == 1002000000000.3


def test_nulls(spark):
    assert summed(spark, [None, 2.0, 4.0]).a == 3.0
    assert tuple(summed(spark, [None, None])) == (None, None)


def test_percentage_of_nothing(spark):
    assert spark.range(1).select(percentage(F.lit(0), F.lit(0)).alias("p")).first()[0] == 0.0


def test_amounts_that_no_trip_costs_do_not_end_a_run(spark):
    assert summed(spark, [1e30, 1.5]).s == 1e30
    assert summed(spark, [-1e300, 2.0, None]).s == -1e300
    assert math.isnan(summed(spark, [float("nan"), 1e30]).s)
    assert summed(spark, [1e17, 0.25, 1e17]).s == 2e17
