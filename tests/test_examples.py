"""Examples of rows that table tests object to."""

import json

from pyspark.sql import functions as F

from layerwright.operators import checks
from test_plans import full_plan

TESTS = [*checks.not_null("a"), *checks.accepted_values("b", ["x"]), *checks.accepted_range(0, 5, "a"), *checks.unique("b")]


def test_examples_are_offending_rows(spark):
    df = spark.createDataFrame([(i if i % 4 else None, "x" if i % 2 else "y") for i in range(40)], "a int, b string")
    found = {(r.column_name, r.test): r for r in checks.run_table_tests(df, "t", TESTS, examples=4).collect()}
    rows = {key: [json.loads(e) for e in r.examples] for key, r in found.items()}
    assert found["a", "not_null"].failures == 10 and all(e["a"] is None for e in rows["a", "not_null"])
    assert all(e["b"] == "y" for e in rows["b", "accepted_values"]) and all(e["a"] > 5 for e in rows["a", "accepted_range"])
    assert all(1 <= len(e) <= 4 for (_, kind), e in rows.items() if kind != "unique") and rows["b", "unique"] == []
    plain = checks.run_table_tests(df, "t", TESTS)
    assert "examples" not in plain.columns
    assert {(r.column_name, r.test, r.failures, r.status) for r in plain.collect()} == {(*k, r.failures, r.status) for k, r in found.items()}


def test_a_single_offending_row_is_shown_and_a_passing_test_has_none(spark):
    df = spark.range(1000).select(F.when(F.col("id") == 777, None).otherwise(F.col("id")).alias("a"), F.lit("x").alias("b"))
    found = {(r.column_name, r.test): r for r in checks.run_table_tests(df, "t", TESTS[:2], examples=3).collect()}
    assert found["a", "not_null"].examples == ['{"a":null,"b":"x"}'] and found["b", "accepted_values"].examples == []


def test_examples_do_not_depend_on_partitions(spark):
    df = spark.range(500).select(F.col("id").alias("a"), F.lit("x").alias("b"))
    found = {str(checks.run_table_tests(df.repartition(n), "t", TESTS[2:3], examples=5).collect()) for n in (1, 7, 50)}
    assert len(found) == 1


def test_examples_cost_no_second_scan(spark, tmp_path):
    spark.range(9).select(F.col("id").alias("a"), F.lit("x").alias("b")).write.parquet(f"{tmp_path}/t")
    plan = full_plan(checks.run_table_tests(spark.read.parquet(f"{tmp_path}/t"), "t", TESTS[:3], examples=3))
    assert plan.count("FileScan") == 1 and "hashpartitioning" not in plan
