"""What the physical plans must look like to hold on large tables."""

import pytest
from pyspark.sql import functions as F

from layerwright.operators import quality, summaries
from layerwright.operators.charts import listing_page
from layerwright.operators.checks import run_table_tests
from layerwright.operators.enrich import enrich
from layerwright.operators.validate import split
from layerwright.plans import transactions as t
from layerwright.plans.refresh import report_document
from layerwright.sources.scratch import write_once
from workload import tx
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bronze(spark):
    return tx.bronze(spark, SF)


@pytest.fixture(scope="module")
def silver(spark):
    return tx.silver(spark, SF)


def pushed(plan):
    return plan.split("PushedFilters:")[1].split("], ReadSchema")[0]


def shuffled_records(df) -> int:
    """Rows that the exchanges of a collected frame wrote."""
    return _shuffled(df, "shuffleRecordsWritten")


def shuffled_bytes(df) -> int:
    return _shuffled(df, "shuffleBytesWritten")


def _shuffled(df, metric: str) -> int:
    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        own = node.metrics().apply(metric).value() if name == "ShuffleExchangeExec" else 0
        children = node.children()
        return own + sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(df._jdf.queryExecution().executedPlan())


def full_plan(df, width=100_000):
    spark = df.sparkSession
    spark.conf.set("spark.sql.maxMetadataStringLength", str(width))
    try:
        return df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_query_uses_python_workers(spark, name):
    plan = full_plan(QUERIES[name](spark, SF))
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_validity_reaches_the_scan(bronze):
    plan = full_plan(split(bronze, t.SPEC).valid)
    assert "Exchange" not in plan
    found = pushed(plan)
    for part in (
        "GreaterThan(amount,0.00)", "In(location_region", "In(anomaly", "IsNotNull(sending_address)",
        "GreaterThanOrEqual(risk_score,0.0)", "LessThanOrEqual(risk_score,100.0)",
    ):
        assert part in found


def test_row_steps_stay_small_enough_for_the_jit(spark, bronze):
    """HotSpot does not compile methods over 8000 bytes; a fused stage beyond that runs ten times slower."""
    debug = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$").__getattr__("MODULE$")
    valid, rejected = split(bronze, t.SPEC)
    for df in (enrich(valid, t.SPEC.derivations), rejected):
        stages = debug.codegenStringSeq(df._jdf.queryExecution().executedPlan())
        assert stages.size() == 1
        assert all(stages.apply(i)._3().maxMethodCodeSize() < 8000 for i in range(stages.size()))


def test_rejects_are_a_narrow_filter(bronze):
    assert "Exchange" not in full_plan(split(bronze, t.SPEC).rejected)


@pytest.mark.parametrize("name", list(t.SUMMARIES))
def test_summaries_aggregate_before_one_shuffle(silver, name):
    summary = t.SUMMARIES[name]
    plan = full_plan(summaries.summarise(silver, summary))
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_count" in plan
    assert "Sort [" not in plan or summary.order_by_desc
    used = {*summary.keys, *(m.column for m in summary.measures if m.column)}
    schema = plan.split("ReadSchema: struct<")[1]
    assert used <= {part.split(":")[0] for part in schema.split(">")[0].split(",")}
    assert "ip_prefix" not in schema and "sending_address" not in schema


def test_extract_pushes_its_condition(silver):
    plan = full_plan(summaries.extract(silver, t.is_high_risk_row(), t.HIGH_RISK_COLUMNS))
    assert "Exchange" not in plan and "Or(EqualTo(anomaly,high_risk),GreaterThanOrEqual(risk_score,75.0))" in plan


def test_latest_rows_are_limited_before_the_shuffle(silver):
    latest = summaries.latest_per_key(silver, "receiving_address", [F.desc("timestamp"), F.desc("amount")])
    plan = full_plan(latest)
    assert plan.count("WindowGroupLimit") == 2 and "WindowGroupLimit" in plan.split("Exchange hashpartitioning")[1]


def test_top_list_merges_before_the_shuffle(silver):
    plan = full_plan(summaries.top_latest(silver, **t.top_receivers_args()))
    assert "TakeOrderedAndProject(limit=3" in plan and plan.count("Exchange hashpartitioning") == 1
    below = plan.split("Exchange hashpartitioning")[1]
    assert "partial_max" in below and "EqualTo(transaction_type,sale)" in below


def test_a_page_is_a_bounded_top_list(silver):
    """The limit is that of one page, however deep the page is."""
    first = listing_page(silver, t.LISTING_COLUMNS, "transaction_datetime")
    last = first.tail(1)[0]
    plan = full_plan(listing_page(silver, t.LISTING_COLUMNS, "transaction_datetime", after=last))
    assert f"TakeOrderedAndProject(limit={25 + last.row_number}" in plan and "transaction_datetime" in pushed(plan)


def test_document_does_not_repeat_the_checks(silver, bronze):
    results = write_once(quality.clean_report(silver, t.clean_checks()), "results")
    plan = full_plan(report_document(silver, split(bronze, t.SPEC).rejected, "now", results=results))
    assert "sending_address, receiving_address, timestamp" not in plan


def test_report_reads_the_table_once_per_kind_of_check(bronze):
    plan = full_plan(quality.raw_report(bronze, t.raw_checks()))
    assert plan.count("FileScan") == 2 and plan.count("Exchange hashpartitioning") == 1
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_distributions_count_before_the_shuffle(bronze):
    plan = full_plan(quality.distributions(bronze, t.raw_dimensions(), t.NULL_LABEL))
    assert "partial_count" in plan.split("Exchange hashpartitioning")[1] and "NestedLoop" not in plan
    assert plan.count("FileScan") == 2  # the second one, for the total, reads no column
    assert "ReadSchema: struct<>" in plan


def test_table_tests_are_one_scan(silver):
    plan = full_plan(run_table_tests(silver, "silver", t.table_tests()["silver"]))
    assert plan.count("FileScan") == 1 and "hashpartitioning" not in plan


def test_skewed_groups_do_not_grow_the_shuffle(spark):
    """One key with most rows: what leaves each task is one row per group, whatever the skew."""
    skewed = spark.range(0, 300_000, 1, 6).select(
        F.when(F.col("id") % 10 < 8, "hot").otherwise((F.col("id") % 7).cast("string")).alias("k"), F.col("id")
    )
    rows = write_once(skewed, "skewed")
    summary = summaries.Summary(("k",), (summaries.Measure("n", "rows"), summaries.Measure("s", "sum", "id")))
    summed = summaries.summarise(rows, summary)
    found = {r["k"]: r["n"] for r in summed.collect()}
    assert sum(found.values()) == 300_000 and found["hot"] == 240_000
    # 8 groups from each of 6 files at most
    assert 0 < shuffled_records(summed) <= 8 * 6


def test_joins_of_the_workload_broadcast_by_size_only(spark):
    """With broadcasting off, the source still joins, with no cross join anywhere."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = full_plan(tx.source_rows(spark, SF))
        assert plan.count("SortMergeJoin") == 6 and "Broadcast" not in plan and "Cartesian" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
