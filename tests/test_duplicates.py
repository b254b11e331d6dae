"""Duplicate keys by short keys."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from layerwright.operators import checks, multiset, quality
from layerwright.sources.scratch import write_once
from test_plans import shuffled_bytes, shuffled_records

KEYS = ("sender", "receiver", "at")


def wide(spark, rows):
    return spark.createDataFrame(rows, "sender string, receiver string, at long")


def test_equal_to_brute_force_with_null_keys(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", "", None]), rng.choice(["a", "b", "", None]), rng.choice([1, 2, None])) for _ in range(300)]
    assert tuple(quality.duplicate_counts(wide(spark, rows), KEYS).first()) == (300, 300 - len(Counter(rows)))
    assert tuple(quality.duplicate_counts(wide(spark, rows).limit(0), KEYS).first()) == (0, 0)
    # the same values in other places are another key
    assert tuple(quality.duplicate_counts(wide(spark, [("a", None, 1), (None, "a", 1)]), KEYS).first()) == (2, 0)


def test_unique_tests_on_text_and_numbers(spark):
    df = wide(spark, [("a", "x", 1), ("a", "y", 1), (None, "z", 2), (None, "z", 3)])
    found = checks.run_table_tests(df, "t", checks.unique(*KEYS)).collect()
    assert [r.failures for r in found] == [1, 1, 1]
    assert {tuple(r) for r in checks.offending(df, checks.unique("sender")[0]).collect()} == {("a", 2)}


def test_short_keys_stay_as_they_are(spark):
    df = wide(spark, [])
    assert len(multiset.short_keys(df, ["at"])) == 1 and str(multiset.short_keys(df, ["at"])[0]) == "Column<'at'>"
    assert len(multiset.short_keys(df, KEYS)) == 2
    dated = df.withColumn("d", F.current_date())
    assert [str(c) for c in multiset.short_keys(dated, ["at", "d"])] == ["Column<'at'>", "Column<'d'>"]


@pytest.mark.parametrize("hot", [0, 3])
def test_what_is_shuffled_is_a_fraction_of_the_keys(spark, hot):
    """Distinct keys with addresses of 40 characters; with a hot key, a third of all rows share one."""
    text = F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 40)
    key = F.when(F.col("id") % 3 < (1 if hot else 0), F.lit("hot")).otherwise(text)
    rows = write_once(spark.range(0, 60_000, 1, 4).select(key.alias("sender"), F.reverse(F.sha2(key, 256)).alias("receiver"), F.lit(1).cast("long").alias("at")), "wide")
    direct = rows.groupBy(*KEYS).agg(F.count("*").alias("n"))
    short = rows.groupBy(*multiset.short_keys(rows, KEYS)).agg(F.count("*").alias("n"))
    sizes = []
    for df in (direct, short):
        assert df.count() == len(df.collect())
        sizes.append(shuffled_bytes(df))
    assert sizes[1] < 0.4 * sizes[0]
    assert shuffled_records(short) <= 60_000 - (20_000 - 4 if hot else 0)
