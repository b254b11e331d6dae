"""Sums of doubles: the same digits in any order."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from layerwright.functions.exact import exact_avg, exact_sum
from layerwright.operators.summaries import Measure, Summary, rollup, summarise, summarise_rollup

SUMMARY = Summary(("k",), (Measure("s", "sum", "x"), Measure("a", "avg", "x")))


def frame(spark, numbers):
    return spark.createDataFrame([(i % 3, x) for i, x in enumerate(numbers)], "k int, x double")


@pytest.mark.parametrize("seed", [1, 2])
def test_same_digits_over_any_partitioning(spark, seed):
    rng = random.Random(seed)
    numbers = [rng.choice((rng.uniform(-1e6, 1e6), rng.gauss(0, 1e-3), round(rng.uniform(0, 1e9), 2))) for _ in range(3000)]
    df = frame(spark, numbers)
    found = {
        tuple(sorted(map(tuple, way.collect())))
        for parts in (1, 7, 200)
        for way in (summarise(df.repartition(parts), SUMMARY), summarise_rollup(rollup(df.repartition(parts), [SUMMARY]), SUMMARY))
    }
    assert len(found) == 1
    for k, s, a in found.pop():
        own = [Fraction(x) for i, x in enumerate(numbers) if i % 3 == k]
        assert math.isclose(s, float(sum(own)), rel_tol=4e-16, abs_tol=len(own) * 2**-52)
        assert a == s / len(own)


def test_plain_sums_do_depend_on_the_order(spark):
    """What this is for: the usual sum of the same rows has other last digits when they are dealt otherwise."""
    rng = random.Random(4)
    df = frame(spark, [rng.uniform(-1e9, 1e9) for _ in range(5000)])
    plain = {df.repartition(n).agg(F.sum("x")).first()[0] for n in (1, 7, 200)}
    exact = {df.repartition(n).agg(exact_sum(F.col("x"))).first()[0] for n in (1, 7, 200)}
    assert len(plain) > 1 and len(exact) == 1


@pytest.mark.parametrize(
    ("numbers", "total"),
    [
        ([], None), ([None, None], None), ([None, 1.5], 1.5), ([0.1] * 10, 1.0), ([-0.25, -0.5], -0.75), ([-3.0, 2.5], -0.5),
        ([2.0**53, 1.0], 2.0**53 + 1), ([1e300, 1.0], 1e300), ([float("inf"), 1.0], float("inf")),
        ([float("nan"), 1.0], "nan"), ([float("inf"), float("-inf")], "nan"), ([2.0**52 + 0.5, 0.5], 2.0**52 + 1),
        ([1e-300] * 5, 0.0), ([-1e-300], 0.0),
    ],
)
def test_edges(spark, numbers, total):
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    row = df.agg(exact_sum(F.col("x")).alias("s"), exact_avg(F.col("x")).alias("a")).first()
    if total is None:
        assert tuple(row) == (None, None)
    elif total == "nan":
        assert math.isnan(row.s) and math.isnan(row.a)
    else:
        assert math.isclose(row.s, total, abs_tol=1e-15) and math.isclose(row.a, total / sum(x is not None for x in numbers), abs_tol=1e-15)


def test_whole_numbers_and_decimals_are_summed_as_they_are(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), F.col("id").cast("decimal(18,2)").alias("x"))
    assert dict(summarise(df, Summary(("k",), (Measure("s", "sum", "x"),))).dtypes)["s"] == "decimal(28,2)"
