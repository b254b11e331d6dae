"""Row-level operators: column operations, validity, split, reject reasons, derived columns."""

import datetime
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from layerwright.functions.predicates import COMPARISONS, compare, outside
from layerwright.functions.scalars import bands, percent
from layerwright.operators.columns import apply_column_ops, with_audit
from layerwright.operators.enrich import enrich
from layerwright.operators.validate import label_rejects, reject_counts, split, split_counts
from layerwright.plans.transactions import REGIONS, RISK_CLASSES, SPEC, TRANSACTION_TYPES
from layerwright.spec import Bucket, Condition, Derivation, Rejects, RejectRule, TableSpec


def reasons(df, spec=SPEC):
    return [r["_rejection_reason"] for r in label_rejects(df, spec).collect()]


# --- column operations ---
def test_rename_drop_cast_in_that_order(spark):
    spec = TableSpec("k", "t", rename={"a": "b", "b": "c"}, drop=("d", "gone"), cast={"c": "int", "gone": "int"})
    df = apply_column_ops(spark.createDataFrame([("7", 1)], ["a", "d"]), spec)
    assert df.dtypes == [("c", "int")] and df.first()["c"] == 7


def test_casts_yield_null_instead_of_an_error(spark):
    spec = TableSpec("k", "t", cast={"n": "int", "x": "double"})
    df = apply_column_ops(spark.createDataFrame([("3.7", "1.5"), ("x", "y"), (" 4 ", None)], ["n", "x"]), spec)
    assert [tuple(r) for r in df.collect()] == [(3, 1.5), (None, None), (4, None)]


@pytest.mark.parametrize("kind", ["int", "bigint"])
def test_epoch_seconds_become_timestamps(spark, kind):
    df = spark.sql(f"SELECT CAST(1609459200 AS {kind}) AS timestamp")
    assert apply_column_ops(df, SPEC).first()["timestamp"] == datetime.datetime(2021, 1, 1)


def test_missing_columns_are_left_alone(spark):
    df = spark.createDataFrame([(1,)], ["other"])
    assert apply_column_ops(df, SPEC).columns == ["other"]


def test_audit_columns(rows):
    row = with_audit(rows({}), "a.csv", "b7").first()
    assert (row["_source_file"], row["_batch_id"]) == ("a.csv", "b7") and row["_ingestion_time"] is not None


# --- validity ---
@pytest.mark.parametrize(
    "change",
    [
        *({c: None} for c in (
            "timestamp", "sending_address", "receiving_address", "amount", "transaction_type", "location_region",
            "risk_score", "anomaly",
        )),
        {"amount": 0.0}, {"amount": -3.0}, {"transaction_type": "gift"}, {"location_region": "Antarctica"},
        {"anomaly": "unknown"}, {"risk_score": 100.5}, {"risk_score": -0.5}, {"risk_score": math.nan},
    ],
)
def test_invalid_rows(rows, change):
    valid, rejected = split(rows(change), SPEC)
    assert (valid.count(), rejected.count()) == (0, 1)


@pytest.mark.parametrize("change", [{}, {"risk_score": 0.0}, {"risk_score": 100.0}, {"ip_prefix": None}, {"age_group": "?"}])
def test_valid_rows(rows, change):
    valid, rejected = split(rows(change), SPEC)
    assert (valid.count(), rejected.count()) == (1, 0)


def test_split_of_nothing(rows):
    empty = rows({}).limit(0)
    valid, rejected = split(empty, SPEC)
    assert valid.count() == rejected.count() == 0
    assert split_counts(empty, SPEC).first().asDict() == {"input_rows": 0, "valid_rows": 0, "rejected_rows": 0}


@pytest.mark.parametrize(
    ("change", "reason"),
    [
        ({"amount": 0.0}, "invalid_amount"),
        ({"amount": None}, "invalid_amount"),
        ({"amount": -5.0, "location_region": "Atlantis"}, "invalid_amount"),
        ({"location_region": "Atlantis", "anomaly": "?"}, "invalid_region"),
        ({"anomaly": "?"}, "invalid_anomaly"),
        ({"transaction_type": "gift", "risk_score": 150.0}, "invalid_transaction_type"),
        ({"risk_score": 150.0}, "invalid_risk_score"),
        ({"risk_score": None}, "invalid_risk_score"),
        ({"risk_score": math.nan}, "invalid_risk_score"),
        ({"sending_address": None}, "other"),
        ({"location_region": None}, "other"),
        ({"location_region": None, "anomaly": "?"}, "invalid_anomaly"),
    ],
)
def test_reject_reasons(rows, change, reason):
    assert reasons(rows(change)) == [reason]


def test_text_amounts_are_read_as_numbers(spark, rows):
    df = rows({}, {}, {}).withColumn("amount", F.lit("12.5"))
    assert split(df, SPEC).valid.count() == 3
    junk = df.withColumn("amount", F.lit("n/a"))
    assert reasons(junk) == ["invalid_amount"] * 3


def test_rejects_without_rules_are_other_and_have_a_time(rows):
    labelled = label_rejects(rows({}), TableSpec("k", "t")).first()
    assert labelled["_rejection_reason"] == "other" and labelled["_quarantine_time"] is not None


def test_undeclared_list_matches_every_row(rows):
    rule = RejectRule("unlisted", Condition("not_in", "anomaly", values_ref="missing"))
    spec = TableSpec("k", "t", rejects=Rejects(rules=(rule,)))
    assert reasons(rows({}, {"anomaly": None}), spec) == ["unlisted", "unlisted"]


def test_reject_counts_by_frequency(rows):
    df = rows({"amount": 0.0}, {"amount": 0.0}, {"anomaly": "?"}, {})
    counts = reject_counts(split(df, SPEC).rejected, SPEC, F.lit(4)).collect()
    assert [tuple(r) for r in counts] == [("invalid_amount", 2, 50.0), ("invalid_anomaly", 1, 25.0)]


VALUES = {
    "timestamp": st.sampled_from([None, 0, 1_700_000_000]),
    "sending_address": st.sampled_from([None, "s", ""]),
    "receiving_address": st.sampled_from([None, "r"]),
    "amount": st.sampled_from([None, -1.0, 0.0, 0.01, 5000.0, math.nan, math.inf]),
    "transaction_type": st.sampled_from([None, "gift", *TRANSACTION_TYPES]),
    "location_region": st.sampled_from([None, "0", *REGIONS]),
    "risk_score": st.sampled_from([None, -1.0, 0.0, 75.0, 100.0, 100.01, math.nan]),
    "anomaly": st.sampled_from([None, "unknown", *RISK_CLASSES]),
}


def expected_reason(row):
    """Brute force: None for a valid row, else its reason. NaN is larger than any number."""
    amount, risk = row["amount"], row["risk_score"]
    listed = {"location_region": REGIONS, "anomaly": RISK_CLASSES, "transaction_type": TRANSACTION_TYPES}
    amount_ok = amount is not None and (math.isnan(amount) or amount > 0)
    risk_ok = risk is not None and not math.isnan(risk) and 0 <= risk <= 100
    there = all(row[c] is not None for c in ("timestamp", "sending_address", "receiving_address"))
    if there and amount_ok and risk_ok and all(row[c] in values for c, values in listed.items()):
        return None
    if not amount_ok:
        return "invalid_amount"
    for column, reason in (
        ("location_region", "invalid_region"), ("anomaly", "invalid_anomaly"),
        ("transaction_type", "invalid_transaction_type"),
    ):
        if row[column] is not None and row[column] not in listed[column]:
            return reason
    return "other" if risk_ok else "invalid_risk_score"


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.fixed_dictionaries(VALUES), min_size=1, max_size=60))
def test_split_against_brute_force(rows, changes):
    changes = [{**c, "login_frequency": i} for i, c in enumerate(changes)]  # a row number
    valid, rejected = split(rows(*changes), SPEC)
    found = {r["login_frequency"]: None for r in valid.collect()}
    found |= {r["login_frequency"]: r["_rejection_reason"] for r in rejected.collect()}
    assert valid.count() + rejected.count() == len(changes)
    assert found == {i: expected_reason(c) for i, c in enumerate(changes)}


# --- derived columns ---
def test_shipped_derivations(rows):
    row = enrich(rows({"transaction_type": "scam", "risk_score": 75.0}), SPEC.derivations).first()
    assert row["transaction_datetime"] == datetime.datetime(2023, 11, 14, 22, 13, 20)
    assert row["transaction_date"] == datetime.date(2023, 11, 14)
    assert row["is_fraudulent"] is True and row["is_high_risk"] is True
    assert row["amount_tier"] == "micro" and row["_processing_time"] is not None


@pytest.mark.parametrize(
    ("amount", "tier"),
    [(999.99, "micro"), (1000.0, "small"), (9999.0, "small"), (10000.0, "medium"), (50000.0, "large"), (None, "large")],
)
def test_tier_limits(rows, amount, tier):
    assert enrich(rows({"amount": amount}), SPEC.derivations).first()["amount_tier"] == tier


def test_text_is_compared_as_a_number(spark):
    rules = [
        Derivation("big", "threshold", "n", operator=">", value=9.0),
        Derivation("size", "buckets", "n", buckets=(Bucket("s", 10), Bucket("l"))),
    ]
    found = enrich(spark.createDataFrame([("10",), ("9",), ("junk",)], ["n"]), rules).collect()
    assert [(r["big"], r["size"]) for r in found] == [(True, "l"), (False, "s"), (None, "l")]


def test_text_that_is_no_moment_gives_null(spark):
    rules = [
        Derivation("at", "to_timestamp", "text"),
        Derivation("day", "to_date", "text"),
        Derivation("from_seconds", "to_timestamp", "text", source_cast="long"),
    ]
    found = enrich(spark.createDataFrame([("2021-01-02 03:04:05",), ("junk",)], ["text"]), rules).collect()
    assert found[0]["at"] == datetime.datetime(2021, 1, 2, 3, 4, 5) and found[0]["day"] == datetime.date(2021, 1, 2)
    assert found[1]["at"] is None and found[1]["day"] is None and found[1]["from_seconds"] is None
    seconds = enrich(spark.createDataFrame([("86400",)], ["text"]), rules[2:]).first()
    assert seconds["from_seconds"] == datetime.datetime(1970, 1, 2)


@pytest.mark.parametrize("values", [(1, 2), ("1", "2", "x")])
def test_lists_and_columns_of_unlike_types(spark, values):
    rules = [Derivation("a", "isin", "text", values=values), Derivation("b", "isin", "n", values=values)]
    found = enrich(spark.createDataFrame([("1", 2), ("junk", 3), (None, None)], "text string, n int"), rules).collect()
    assert [(r["a"], r["b"]) for r in found] == [(True, True), (False, False), (None, None)]


def test_dates_follow_the_session_time_zone(spark, rows):
    rules = [Derivation("day", "to_date", "timestamp", source_cast="long")]
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert enrich(rows({"timestamp": 1609459200 - 3600}), rules).first()["day"] == datetime.date(2021, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert enrich(rows({"timestamp": 1609459200 - 3600}), rules).first()["day"] == datetime.date(2020, 12, 31)


def test_null_sources_give_null_flags(rows):
    row = enrich(rows({"transaction_type": None, "risk_score": None, "timestamp": None}), SPEC.derivations).first()
    assert row["is_fraudulent"] is None and row["is_high_risk"] is None and row["transaction_date"] is None


def test_later_rules_see_earlier_columns(spark):
    rules = [
        Derivation("n", "cast", "text", type="double"),
        Derivation("n", "cast", "n", type="int"),
        Derivation("size", "buckets", "n", buckets=(Bucket("s", 5), Bucket("l"))),
        Derivation("is_small", "isin", "size", values=("s",)),
    ]
    row = enrich(spark.createDataFrame([("4.9",)], ["text"]), rules).first()
    assert row.asDict() == {"text": "4.9", "n": 4, "size": "s", "is_small": True}


def test_independent_rules_share_a_projection(rows):
    df = enrich(rows({}), SPEC.derivations)
    assert df._jdf.queryExecution().logical().toString().count("Project") <= 3


# --- expressions ---
@pytest.mark.parametrize(("op", "found"), [(">=", 2), (">", 1), ("<=", 2), ("<", 1), ("==", 1), ("!=", 2)])
def test_comparisons(spark, op, found):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "x double")
    assert op in COMPARISONS and df.filter(compare(F.col("x"), op, 2.0)).count() == found


def test_unknown_comparison():
    with pytest.raises(ValueError):
        compare(None, "<>", 1)


def test_outside_is_inclusive_and_null_stays_null(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (2.5,), (None,)], "x double")
    found = [r[0] for r in df.select(outside(F.col("x"), 1, 2)).collect()]
    assert found == [True, False, False, True, None]
    assert [r[0] for r in df.select(outside(F.col("x"))).collect()] == [False] * 5


def test_percent_of_nothing(spark):
    row = spark.range(1).select(
        percent(F.lit(1), F.lit(3)).alias("third"),
        percent(F.lit(0), F.lit(0)).alias("none"),
        percent(F.lit(0), F.lit(0), empty=0.0).alias("zero"),
    )
    assert tuple(row.first()) == (33.33, None, 0.0)


def test_band_limits(spark):
    df = spark.createDataFrame([(25.0,), (25.1,), (75.0,), (75.1,), (None,), (math.nan,)], "x double")
    labels = ("a", "b", "c", "d")
    plain = [r[0] for r in df.select(bands(F.col("x"), (25, 50, 75), labels)).collect()]
    named = [r[0] for r in df.select(bands(F.col("x"), (25, 50, 75), labels, "[NULL]")).collect()]
    assert plain == ["a", "b", "c", "d", "d", "d"] and named == ["a", "b", "c", "d", "[NULL]", "d"]
