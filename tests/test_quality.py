import json

import pytest
from pyspark.sql import functions as F

from layerwright.operators import checks, quality
from layerwright.operators.enrich import enrich
from layerwright.operators.validate import split
from layerwright.plans import refresh
from layerwright.plans import transactions as t
from layerwright.sources.scratch import new_path
from layerwright.sources.tables import write_json_document

FAULTS = [
    {},
    {},
    {"amount": None},
    {"amount": -1.0, "anomaly": "?"},
    {"location_region": None},
    {"location_region": "0", "risk_score": 150.0},
    {"risk_score": float("nan")},
    {"sending_address": None, "timestamp": None},
    {"sending_address": None, "timestamp": None},
    {"timestamp": 5},
]


@pytest.fixture(scope="module")
def raw(rows):
    return rows(*FAULTS).cache()


@pytest.fixture(scope="module")
def parts(raw):
    valid, rejected = split(raw, t.SPEC)
    return enrich(valid, t.SPEC.derivations), rejected


def by_name(report):
    return {r["check_name"]: r for r in report.collect()}


def test_raw_report(raw):
    report = by_name(quality.raw_report(raw, t.raw_checks()))
    errors = {name: r["error_count"] for name, r in report.items() if r["error_count"]}
    assert errors == {
        "amount": 1, "location_region": 1, "sending_address": 2, "timestamp": 2, "amount_positive": 1,
        "anomaly_valid": 1, "location_region_valid": 1, "risk_score_range": 2,
        # rows 1-7 share one key, the two without sender and time share another
        "no_duplicates": 7,
    }
    assert len(report) == 19 and all(r["total_records"] == 10 for r in report.values())
    row = report["sending_address"]
    assert (row["error_pct"], row["conformance_pct"], row["status"]) == (20.0, 80.0, "FAIL")
    assert report["age_group"]["status"] == "PASS" and report["amount"]["description"] == "amount IS NULL"


def test_raw_report_is_sorted(raw):
    found = [(r["check_type"], r["check_name"]) for r in quality.raw_report(raw, t.raw_checks()).collect()]
    assert found == sorted(found)


def test_clean_report(parts):
    rows = quality.clean_report(parts[0], t.clean_checks(), "2024-05-01T00:00:00+00:00").collect()
    assert [r["check_name"] for r in rows] == [c.name for c in t.clean_checks()] and len(rows) == 14
    assert rows[0]["report_timestamp"] == "2024-05-01T00:00:00+00:00"
    last = rows[-1]  # 3 valid rows, two of them alike
    assert (last["check_name"], last["error_count"], last["total_records"]) == ("duplicate_records", 1, 3)
    assert (last["error_pct"], last["conformance_pct"], last["status"]) == (33.33, 66.67, "FAIL")
    assert all(r["status"] == "PASS" and r["conformance_pct"] == 100.0 for r in rows[:-1])


def test_reports_on_an_empty_table(raw):
    empty = raw.limit(0)
    raw_rows = quality.raw_report(empty, t.raw_checks()).collect()
    assert all(r["error_count"] == 0 and r["error_pct"] is None and r["status"] == "PASS" for r in raw_rows)
    clean_rows = quality.clean_report(empty, t.clean_checks()).collect()
    shares = {(r["check_type"], r["error_pct"], r["conformance_pct"]) for r in clean_rows}
    assert shares == {("completeness", 0.0, 100.0), ("validity", 100.0, 0.0)}


def test_duplicates_with_nulls(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (None, 2), ("a", None), ("a", None), ("a", 1)], "k string, n int")
    assert tuple(quality.duplicate_counts(df, ["k", "n"]).first()) == (6, 2)


def test_distribution_is_ordered_and_complete(raw):
    found = [tuple(r) for r in quality.distribution(raw, F.col("anomaly"), "anomaly").collect()]
    assert found == [("?", 1, 10.0), ("low_risk", 9, 90.0)]


def test_distributions(raw):
    found = quality.distributions(raw, t.raw_dimensions(), t.NULL_LABEL).collect()
    as_dict = {(r["dimension"], r["dim_value"]): (r["record_count"], r["pct"]) for r in found}
    assert as_dict["location_region", "[NULL]"] == (1, 10.0) and as_dict["location_region", "Asia"] == (8, 80.0)
    assert as_dict["risk_score_band", "76-100"] == (2, 20.0) and as_dict["risk_score_band", "26-50"] == (8, 80.0)
    order = [(r["dimension"], -r["record_count"]) for r in found]
    assert order == sorted(order)
    for dimension in t.raw_dimensions():
        assert sum(n for (d, _), (n, _) in as_dict.items() if d == dimension) == 10


def test_summary_can_fall_below_zero(raw, parts):
    row = quality.report_summary(raw.limit(0), parts[1], t.clean_checks()).first()
    assert (row["total_input_records"], row["overall_conformance_pct"], row["quarantine_rate_pct"]) == (7, 0.0, 100.0)
    bad = raw.filter("amount IS NULL OR sending_address IS NULL")
    row = quality.report_summary(bad, parts[1].limit(0), t.clean_checks()).first()
    assert row["total_quality_errors"] == 6 and row["overall_conformance_pct"] == -100.0


def test_document(spark, parts):
    document = refresh.report_document(*parts, "2024-05-01T00:00:00+00:00")
    path = new_path(spark, "document")
    write_json_document(document, path)
    report = json.loads("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))
    assert list(report) == [
        "generated_at", "summary", "completeness", "validity", "distributions", "quarantine_rejection_reasons",
    ]
    assert report["summary"] == {
        "total_input_records": 10, "silver_records": 3, "quarantine_records": 7, "quarantine_rate_pct": 70.0,
        "total_quality_errors": 1, "overall_conformance_pct": 66.67,
    }
    assert [c["column"] for c in report["completeness"]] == list(t.REQUIRED_COLUMNS)
    assert report["validity"][-1]["rule"] == "duplicate_records" and report["validity"][-1]["status"] == "FAIL"
    assert report["distributions"]["risk_score_bands"] == [{"band": "26–50", "count": 3, "pct": 100.0}]
    assert report["distributions"]["anomaly"] == [{"anomaly": "low_risk", "count": 3, "pct": 100.0}]
    reasons = report["quarantine_rejection_reasons"]
    assert [(r["reason"], r["count"]) for r in reasons] == [
        ("other", 3), ("invalid_amount", 2), ("invalid_region", 1), ("invalid_risk_score", 1),
    ]
    assert reasons[0]["pct"] == 30.0


def test_document_of_nothing(parts):
    report = refresh.report_document(parts[0].limit(0), parts[1].limit(0), "now").first()
    assert report["summary"]["total_input_records"] == 0 and report["quarantine_rejection_reasons"] == []
    assert report["distributions"]["anomaly"] == [] and report["summary"]["overall_conformance_pct"] == 0.0


# --- table tests ---
def test_kinds_of_tests(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, None), (9, "z")], "n int, s string")
    tests = [
        *checks.not_null("n"), *checks.accepted_values("s", "ab"), *checks.accepted_range(2, 5, "n"),
        *checks.accepted_range(None, 5, "n"), *checks.unique("n", "s"),
    ]
    found = checks.run_table_tests(df, "tb", tests).collect()
    assert [(r["column_name"], r["test"], r["failures"], r["status"]) for r in found] == [
        ("n", "not_null", 1, "FAIL"), ("s", "accepted_values", 1, "FAIL"), ("n", "accepted_range", 2, "FAIL"),
        ("n", "accepted_range", 1, "FAIL"), ("n", "unique", 1, "FAIL"), ("s", "unique", 1, "FAIL"),
    ]


def test_null_passes_all_but_not_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "n int")
    tests = [*checks.accepted_values("n", [1]), *checks.accepted_range(1, 2, "n"), *checks.unique("n")]
    assert {r["status"] for r in checks.run_table_tests(df, "tb", tests).collect()} == {"PASS"}


def test_offending_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, None)], "n int, `odd name` string")
    (null,), (values,), (between,), (once,) = (
        checks.not_null("odd name"), checks.accepted_values("n", [1]), checks.accepted_range(0, 1, "n"), checks.unique("n"),
    )
    assert [tuple(r) for r in checks.offending(df, null).collect()] == [(None,)]
    assert [tuple(r) for r in checks.offending(df, values).collect()] == [(2, 2)]
    assert [tuple(r) for r in checks.offending(df, between).collect()] == [(2, "b"), (2, "b")]
    assert [tuple(r) for r in checks.offending(df, once).collect()] == [(2, 2)]


def test_declared_plan():
    counts = {table: len(tests) for table, tests in t.table_tests().items()}
    assert counts == {
        "silver": 11, "fraud_by_region": 10, "fraud_by_type": 8, "daily_fraud_metrics": 9,
        "high_risk_transactions": 7, "risk_profile": 8, "region_risk_ranking": 10, "top_sale_receivers": 4,
        "bronze_quality_report": 14, "bronze_quality_distributions": 6,
    }
    kinds = [test.kind for tests in t.table_tests().values() for test in tests]
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "not_null": 52, "accepted_values": 12, "accepted_range": 22, "unique": 1,
    }


def test_invariants(raw, parts):
    found = refresh.invariants(raw, *parts).collect()
    assert {r["status"] for r in found} == {"PASS"} and len(found) == 13


def test_invariants_find_faults(raw, parts):
    clean = parts[0]
    broken = clean.withColumn("amount_tier", F.lit(None).cast("string")).unionByName(clean)
    found = {(r["table_name"], r["invariant"]): r["violations"] for r in refresh.invariants(raw, broken, parts[1]).collect()}
    assert found["all", "whole = silver + quarantine"] == 3 and found["silver", "amount_tier_known"] == 3
    empty = checks.run_invariants(clean.limit(0), "silver", {}).first()
    assert (empty["invariant"], empty["violations"], empty["status"]) == ("not_empty", 1, "FAIL")
