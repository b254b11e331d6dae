"""The transaction table: its spec, summaries, quality checks, table tests and charts.

Everything here is data. Names, value lists, limits, labels and texts are fixed values: tables, dashboards and
tests that people already have refer to them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from layerwright.functions.scalars import bands
from layerwright.operators.charts import Chart
from layerwright.operators.checks import TableTest, accepted_range, accepted_values, not_null, unique
from layerwright.operators.quality import (
    Check,
    DuplicateCheck,
    domain_check,
    null_check,
    positive_check,
    range_check,
)
from layerwright.operators.summaries import Measure, Summary
from layerwright.spec import (
    Bucket,
    Condition,
    Derivation,
    Field,
    Rejects,
    RejectRule,
    TableSpec,
)

# --- Fixed values: domains and limits -----------------------------------------------------------------------
REGIONS = ("Africa", "Asia", "Europe", "North America", "South America")
RISK_CLASSES = ("low_risk", "moderate_risk", "high_risk")
TRANSACTION_TYPES = ("purchase", "sale", "transfer", "phishing", "scam")
FRAUD_TYPES = ("phishing", "scam")
TIERS = ("micro", "small", "medium", "large")
HIGH_RISK_SCORE = 75.0
REASONS = (
    "invalid_amount", "invalid_region", "invalid_anomaly", "invalid_transaction_type", "invalid_risk_score", "other",
)
# ------------------------------------------------------------------------------------------------------------

SPEC = TableSpec(
    key="df_fraud_credit.csv",
    table="tb_fraud_credit",
    fields=(
        Field("timestamp", "integer", nullable=False),
        Field("sending_address", "string", nullable=False),
        Field("receiving_address", "string", nullable=False),
        Field("amount", "decimal", nullable=False, precision=18, scale=2),
        Field("transaction_type", "string", nullable=False),
        Field("location_region", "string", nullable=False),
        Field("ip_prefix", "string", nullable=False),
        Field("login_frequency", "integer", nullable=False),
        Field("session_duration", "integer", nullable=False),
        Field("purchase_pattern", "string", nullable=False),
        Field("age_group", "string", nullable=False),
        Field("risk_score", "double", nullable=False),
        Field("anomaly", "string", nullable=False),
    ),
    cast={"timestamp": "timestamp"},
    sort_by=("location_region",),
    domains={
        "valid_regions": REGIONS,
        "valid_anomalies": RISK_CLASSES,
        "valid_transaction_types": TRANSACTION_TYPES,
    },
    derivations=(
        Derivation("transaction_datetime", "to_timestamp", "timestamp", source_cast="long"),
        Derivation("transaction_date", "to_date", "timestamp", source_cast="long"),
        Derivation("amount", "cast", "amount", type="double"),
        Derivation("risk_score", "cast", "risk_score", type="double"),
        Derivation("login_frequency", "cast", "login_frequency", type="int"),
        Derivation("session_duration", "cast", "session_duration", type="int"),
        Derivation("is_fraudulent", "isin", "transaction_type", values=FRAUD_TYPES),
        Derivation("is_high_risk", "threshold", "risk_score", operator=">=", value=HIGH_RISK_SCORE),
        Derivation(
            "amount_tier",
            "buckets",
            "amount",
            buckets=(
                Bucket("micro", 1000),
                Bucket("small", 10000),
                Bucket("medium", 50000),
                Bucket("large", otherwise=True),
            ),
        ),
        Derivation("_processing_time", "current_timestamp"),
    ),
    rejects=Rejects(
        "_rejection_reason",
        "_quarantine_time",
        (
            RejectRule("invalid_amount", Condition("null_or_threshold", "amount", operator="<=", value=0.0)),
            RejectRule("invalid_region", Condition("not_in", "location_region", values_ref="valid_regions")),
            RejectRule("invalid_anomaly", Condition("not_in", "anomaly", values_ref="valid_anomalies")),
            RejectRule(
                "invalid_transaction_type",
                Condition("not_in", "transaction_type", values_ref="valid_transaction_types"),
            ),
            RejectRule("invalid_risk_score", Condition("null_or_range", "risk_score", min=0.0, max=100.0)),
        ),
    ),
)


# --- Summaries ----------------------------------------------------------------------------------------------
def _two_digits(kind: str, column: str, name: str | None = None) -> Measure:
    return Measure(name or f"{kind}_{column}", kind, column, digits=2)


TRANSACTIONS = Measure("transaction_count", "rows")
AVG_RISK = _two_digits("avg", "risk_score")
RISK_RANGE = (AVG_RISK, _two_digits("min", "risk_score"), _two_digits("max", "risk_score"))
AMOUNTS = (_two_digits("sum", "amount", "total_amount"), _two_digits("avg", "amount"))
FRAUD_ROWS = Measure("fraudulent_count", "rows_where", where="is_fraudulent")

SUMMARIES = {
    "region_risk_ranking": Summary(("location_region",), (TRANSACTIONS, *RISK_RANGE), order_by_desc="avg_risk_score"),
    "fraud_by_region": Summary(
        ("location_region", "anomaly"),
        (TRANSACTIONS, *AMOUNTS, AVG_RISK, Measure("max_amount", "max", "amount"), FRAUD_ROWS),
    ),
    "fraud_by_type": Summary(
        ("transaction_type", "anomaly", "purchase_pattern"),
        (TRANSACTIONS, *AMOUNTS, AVG_RISK, Measure("avg_session_duration", "avg", "session_duration", digits=1)),
    ),
    "daily_fraud_metrics": Summary(
        ("transaction_date", "location_region"),
        (
            Measure("total_transactions", "rows"),
            *(Measure(f"{c}_count", "rows_where", where=f"anomaly = '{c}'") for c in reversed(RISK_CLASSES)),
            FRAUD_ROWS,
            AMOUNTS[0],
            AVG_RISK,
        ),
    ),
    "risk_profile": Summary(
        ("age_group", "purchase_pattern", "anomaly"),
        (
            TRANSACTIONS,
            *RISK_RANGE,
            AMOUNTS[1],
            _two_digits("avg", "login_frequency"),
            _two_digits("avg", "session_duration"),
        ),
    ),
}

# Region, class, type, pattern and age group have a few values each, so four summaries share one rollup. The daily
# one stays out: with the date the combinations would run into millions per task.
SHARED_ROLLUP = ("region_risk_ranking", "fraud_by_region", "fraud_by_type", "risk_profile")

HIGH_RISK_COLUMNS = (
    "transaction_datetime", "transaction_date", "sending_address", "receiving_address", "amount", "amount_tier",
    "transaction_type", "location_region", "ip_prefix", "risk_score", "anomaly", "age_group", "purchase_pattern",
    "login_frequency", "session_duration", "is_fraudulent",
)


def is_high_risk_row() -> Column:
    return (F.col("anomaly") == "high_risk") | (F.col("risk_score") >= HIGH_RISK_SCORE)


def top_receivers_args() -> dict:
    return {
        "where": F.col("transaction_type") == "sale",
        "key": "receiving_address",
        "time": "timestamp",
        "measure": "amount",
        "k": 3,
        "digits": 2,
    }


# --- Quality reports ----------------------------------------------------------------------------------------
DUPLICATE_KEYS = ("sending_address", "receiving_address", "timestamp")
REQUIRED_COLUMNS = (
    "timestamp", "sending_address", "receiving_address", "amount", "transaction_type", "location_region", "anomaly",
    "risk_score",
)
OPTIONAL_COLUMNS = ("login_frequency", "session_duration", "purchase_pattern", "age_group", "ip_prefix")

_KEY_TEXT = f"({', '.join(DUPLICATE_KEYS)})"


def _rule_checks(spec: TableSpec) -> list[Check]:
    return [
        domain_check("transaction_type", spec.domain("valid_transaction_types")),
        domain_check("location_region", spec.domain("valid_regions")),
        domain_check("anomaly", spec.domain("valid_anomalies")),
        range_check("risk_score", 0, 100),
    ]


def clean_checks(spec: TableSpec = SPEC) -> list[Check | DuplicateCheck]:
    """Checks on validated rows."""
    return [
        *(null_check(c, "NULL check on {column}") for c in REQUIRED_COLUMNS),
        *_rule_checks(spec),
        positive_check("amount", "{column} must be greater than 0"),
        DuplicateCheck("validity", "duplicate_records", f"No duplicate {_KEY_TEXT} combinations", DUPLICATE_KEYS),
    ]


def raw_checks(spec: TableSpec = SPEC) -> list[Check | DuplicateCheck]:
    """Checks on unvalidated rows."""
    return [
        *(null_check(c, "{column} IS NULL") for c in REQUIRED_COLUMNS + OPTIONAL_COLUMNS),
        positive_check("amount", "{column} must be > 0"),
        *_rule_checks(spec),
        DuplicateCheck("validity", "no_duplicates", f"no duplicate {_KEY_TEXT} rows", DUPLICATE_KEYS),
    ]


BAND_UPPERS = (25, 50, 75)
CLEAN_BAND_LABELS = ("0–25", "26–50", "51–75", "76–100")  # en dash
RAW_BAND_LABELS = ("0-25", "26-50", "51-75", "76-100")  # hyphen
NULL_LABEL = "[NULL]"
CLEAN_DIMENSIONS = ("anomaly", "transaction_type", "location_region")
RAW_DIMENSIONS = ("anomaly", "transaction_type", "location_region", "age_group", "purchase_pattern")


def clean_dimensions() -> dict[str, Column]:
    return {name: F.col(name) for name in CLEAN_DIMENSIONS}


def document_dimensions(spec: TableSpec = SPEC) -> dict[str, Column]:
    """The dimensions of the report document, whose arrays hold one entry per value: each must be a column with
    a value list that valid rows meet."""
    listed = {r.column for r in spec.requirements if r.test == "in" and spec.domain(r.values_ref)}
    if missing := [name for name in CLEAN_DIMENSIONS if name not in listed]:
        raise ValueError(f"no value list bounds the report's dimensions {', '.join(missing)}")
    return clean_dimensions()


def clean_bands() -> Column:
    """Risk bands of validated rows; a NULL score would count in the last band."""
    return bands(F.col("risk_score"), BAND_UPPERS, CLEAN_BAND_LABELS)


def raw_bands() -> Column:
    """Risk bands of unvalidated rows; a NULL score has its own band."""
    return bands(F.col("risk_score"), BAND_UPPERS, RAW_BAND_LABELS, null_label=NULL_LABEL)


def raw_dimensions() -> dict[str, Column]:
    return {name: F.col(name) for name in RAW_DIMENSIONS} | {"risk_score_band": raw_bands()}


# --- Table tests --------------------------------------------------------------------------------------------
def _percentages(*columns: str):
    return [*not_null(*columns), *accepted_range(0, 100, *columns)]


def _at_least(low: int, *columns: str):
    return [*not_null(*columns), *accepted_range(low, None, *columns)]


def _one_of(column: str, values):
    return [*not_null(column), *accepted_values(column, values)]


def table_tests(spec: TableSpec = SPEC) -> dict[str, list[TableTest]]:
    """The declared tests of each table, with the value lists of the spec."""
    region = _one_of("location_region", spec.domain("valid_regions"))
    risk_class = _one_of("anomaly", spec.domain("valid_anomalies"))
    kind = _one_of("transaction_type", spec.domain("valid_transaction_types"))
    return _table_tests(region, risk_class, kind)


def _table_tests(region, risk_class, kind) -> dict[str, list[TableTest]]:
    return {
        "silver": [
            *not_null("timestamp", "sending_address", "receiving_address", "amount"),
            *kind, *region, *risk_class, *not_null("risk_score"),
        ],
        "fraud_by_region": [
            *region, *risk_class, *_at_least(0, "transaction_count", "fraudulent_count"), *_percentages("avg_risk_score"),
        ],
        "fraud_by_type": [*kind, *risk_class, *_at_least(0, "transaction_count"), *_percentages("avg_risk_score")],
        "daily_fraud_metrics": [
            *not_null("transaction_date"), *region, *_at_least(1, "total_transactions"),
            *_at_least(0, "high_risk_count"), *_percentages("avg_risk_score"),
        ],
        "high_risk_transactions": [
            *not_null("transaction_datetime", "sending_address", "amount"), *_percentages("risk_score"),
            # low_risk rows with a high score do occur; the test is meant to show them
            *_one_of("anomaly", ("high_risk", "moderate_risk")),
        ],
        "risk_profile": [
            *not_null("age_group", "purchase_pattern"), *risk_class, *_at_least(0, "transaction_count"),
            *_percentages("avg_risk_score"),
        ],
        "region_risk_ranking": [
            *region, *_at_least(1, "transaction_count"),
            *_percentages("avg_risk_score", "min_risk_score", "max_risk_score"),
        ],
        "top_sale_receivers": [*not_null("receiving_address", "timestamp"), *_at_least(0, "amount")],
        "bronze_quality_report": [
            *not_null("check_type", "check_name", "description"), *unique("check_name"), *_at_least(0, "error_count"),
            *_at_least(1, "total_records"), *_percentages("error_pct", "conformance_pct"),
            *_one_of("status", ("PASS", "FAIL")),
        ],
        "bronze_quality_distributions": [
            *not_null("dimension", "dim_value"), *_at_least(1, "record_count"), *_percentages("pct"),
        ],
    }


def _derived(spec: TableSpec, column: str, default) -> list:
    """The values or labels that the spec gives for a derived column."""
    for rule in spec.derivations:
        if rule.column == column:
            return list(rule.values or (bucket.label for bucket in rule.buckets))
    return list(default)


def clean_invariants(spec: TableSpec = SPEC) -> dict[str, Column]:
    """Violations that a validated table must not show."""
    c, regions = F.col, spec.domain("valid_regions")
    return {
        "amount_not_null": c("amount").isNull(),
        "amount_positive": c("amount") <= 0,
        "risk_score_in_range": (c("risk_score") < 0) | (c("risk_score") > 100),
        "amount_tier_known": ~F.coalesce(c("amount_tier").isin(_derived(spec, "amount_tier", TIERS)), F.lit(False)),
        "fraud_flag_only_for_fraud_types": c("is_fraudulent")
        & ~c("transaction_type").isin(_derived(spec, "is_fraudulent", FRAUD_TYPES)),
        "location_region_known": ~F.coalesce(c("location_region").isin(regions), F.lit(False)),
    }


def reject_invariants(spec: TableSpec = SPEC) -> dict[str, Column]:
    """Violations that a table of rejected rows must not show."""
    reason = F.col(spec.rejects.reason_column)
    reasons = [*(rule.reason for rule in spec.rejects.rules), spec.rejects.malformed or "other", "other"]
    return {
        "reason_not_null": reason.isNull(),
        "reason_known": ~reason.isin(reasons),
        "reject_time_not_null": F.col(spec.rejects.time_column).isNull(),
    }


# --- Charts -------------------------------------------------------------------------------------------------
CHARTS = {
    "transactions_by_region": Chart("fraud_by_region", ("location_region",), "sum", "transaction_count", "Transactions"),
    "anomaly_distribution": Chart("fraud_by_region", ("anomaly",), "sum", "transaction_count", "Count"),
    "avg_risk_by_region": Chart("fraud_by_region", ("location_region",), "avg", "avg_risk_score", "Avg Risk Score"),
    "amount_by_type": Chart("fraud_by_type", ("transaction_type",), "sum", "total_amount", "Total Amount"),
    "count_by_type_and_anomaly": Chart(
        "fraud_by_type", ("transaction_type",), "sum", "transaction_count", "Count", series="anomaly"
    ),
    "daily_volume": Chart(
        "daily_fraud_metrics", ("transaction_date",), "sum", "total_transactions", "Total Transactions",
        series="location_region",
    ),
    "daily_high_risk": Chart("daily_fraud_metrics", ("transaction_date",), "sum", "high_risk_count", "High Risk"),
    "risk_heatmap": Chart(
        "fraud_by_region", ("location_region",), "avg", "avg_risk_score", "Avg Risk Score", series="anomaly"
    ),
    "risk_by_segment": Chart(
        "risk_profile", ("age_group",), "avg", "avg_risk_score", "Avg Risk Score", series="purchase_pattern"
    ),
}
LISTING_COLUMNS = (
    "transaction_datetime", "location_region", "transaction_type", "amount", "risk_score", "anomaly", "age_group",
    "purchase_pattern", "is_fraudulent",
)
