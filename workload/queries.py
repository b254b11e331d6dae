"""The registered queries: each takes (session, data folder) and returns a lazy frame over whole tables.

Columns that hold the time of the run are left out; dates and timestamps are shown as text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import partial, reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from layerwright.functions.predicates import COMPARISONS, compare
from layerwright.functions.scalars import percent, soft_cast
from layerwright.operators import charts, checks, quality, summaries
from layerwright.operators.columns import apply_column_ops, with_audit
from layerwright.operators.enrich import enrich
from layerwright.operators.validate import (
    label_rejects,
    reject_counts,
    split,
    split_counts,
    valid_mask,
)
from layerwright.plans import refresh
from layerwright.plans import transactions as t
from layerwright.sources import tables
from layerwright.sources.scratch import new_path, write_once
from layerwright.spec import TableSpec
from workload import tx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def renamed(df: DataFrame, **names: str) -> DataFrame:
    return df.withColumnsRenamed(names)


# --- Column operations --------------------------------------------------------------------------------------
EVENTS = {
    "table": "tb_events",
    "rename_columns": {"user_id": "account_id", "no_such_column": "x"},
    "drop_columns": ["props", "no_such_column"],
    "cast_columns": {"event_id": "string", "account_id": "int", "value": "decimal(12,1)", "no_such_column": "int"},
    "validation": {
        "known_types": ["view", "click", "purchase"],
        "rules": [
            {"column": "ts", "test": "not_null"},
            {"column": "event_type", "test": "in", "values_ref": "known_types"},
            {"column": "value", "test": "between", "min": 1, "max": 60},
        ],
    },
    "silver": {
        "enrichment": [
            {"column": "event_second", "transform": "cast", "source": "ts", "type": "timestamp"},
            {"column": "event_time", "transform": "to_timestamp", "source": "ts", "source_cast": "long"},
            {"column": "event_date", "transform": "to_date", "source": "ts"},
            {"column": "value", "transform": "cast", "source": "value", "type": "int"},
            {"column": "is_purchase", "transform": "isin", "source": "event_type", "values": ["purchase"]},
            {"column": "is_small", "transform": "threshold", "source": "value", "operator": "<", "value": 5},
            {
                "column": "size",
                "transform": "buckets",
                "source": "value",
                "buckets": [{"label": "s", "max": 10}, {"label": "m", "max": 30}, {"label": "l"}],
            },
        ],
        "quarantine": {
            "rejection_column": "why",
            "timestamp_column": "seen_at",
            "rules": [
                {
                    "reason": "type",
                    "condition": {"type": "not_in", "column": "event_type", "values_ref": "known_types"},
                },
                {
                    "reason": "too_small",
                    "condition": {"type": "null_or_threshold", "column": "value", "operator": "<", "value": 1},
                },
            ],
        },
    },
}


def event_spec() -> TableSpec:
    return TableSpec.from_dict("events.csv", EVENTS)


@query
def ingest_column_ops(spark, sf):
    """Rename, drop, cast on the event table."""
    events = apply_column_ops(tx.read(spark, sf, "events"), event_spec())
    return events.withColumns({"value": F.col("value").cast("double"), "ts": F.col("ts").cast("string")})


@query
def audit_columns(spark, sf):
    rows = with_audit(tx.bronze(spark, sf), t.SPEC.key, "batch_1")
    return rows.groupBy("_source_file", "_batch_id").agg(
        F.count("*").alias("row_count"), F.count("_ingestion_time").alias("stamped_rows")
    )


# --- Validation, enrichment, rejects ------------------------------------------------------------------------
@query
def validate_split_counts(spark, sf):
    return split_counts(tx.bronze(spark, sf), t.SPEC)


@query
def silver_enriched(spark, sf):
    valid = split(tx.bronze(spark, sf), t.SPEC).valid
    rows = enrich(valid, t.SPEC.derivations).drop("_processing_time")
    return tx.as_text(rows, "timestamp", "transaction_datetime", "transaction_date")


@query
def quarantine_reasons(spark, sf):
    rows = split(tx.bronze(spark, sf), t.SPEC).rejected.drop("_quarantine_time")
    rows = rows.withColumn("amount", F.col("amount").cast("double"))
    # NaN has no common text form; the validity checks count it
    return tx.as_text(rows, "timestamp").withColumn("risk_score", F.nanvl("risk_score", F.lit(-1.0)))


@query
def quarantine_reason_counts(spark, sf):
    source = tx.bronze(spark, sf)
    return renamed(reject_counts(tx.rejected(spark, sf), t.SPEC, quality.row_total(source)), count="row_count")


@query
def reject_without_lists(spark, sf):
    """A value list nobody declared is empty: every row misses it, rows without a value too."""
    bare = TableSpec(t.SPEC.key, t.SPEC.table, domains={}, rejects=t.SPEC.rejects)
    rows = label_rejects(tx.bronze(spark, sf), bare)
    return rows.groupBy("_rejection_reason").agg(F.count("*").alias("row_count"))


@query
def comparison_operators(spark, sf):
    rows = tx.bronze(spark, sf)
    names = {">=": "ge", ">": "gt", "<=": "le", "<": "lt", "==": "eq", "!=": "ne"}
    return rows.agg(*(F.count_if(compare(F.col("risk_score"), op, 50.0)).alias(names[op]) for op in COMPARISONS))


@query
def events_enriched(spark, sf):
    """A second spec, over a timestamp without zone and with its own validity rules."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    source = tx.read(spark, sf, "events")
    spec = event_spec()
    rows = enrich(source.filter(valid_mask(spec, source.schema)), spec.derivations).drop("props")
    return tx.as_text(rows, "ts", "event_second", "event_time", "event_date")


@query
def events_reject_counts(spark, sf):
    source = tx.read(spark, sf, "events")
    rejected = split(source, event_spec()).rejected
    return renamed(reject_counts(rejected, event_spec(), quality.row_total(source)), count="row_count")


# --- Summaries ----------------------------------------------------------------------------------------------
def _summary(name: str, spark, sf) -> DataFrame:
    rows = summaries.summarise(tx.silver(spark, sf), t.SUMMARIES[name])
    return tx.as_text(rows, *(c for c in rows.columns if c == "transaction_date"))


def _summary_from_rollup(name: str, spark, sf) -> DataFrame:
    return summaries.summarise_rollup(refresh.shared_rollup(tx.silver(spark, sf)), t.SUMMARIES[name])


@query
def sums_by_partitioning(spark, sf):
    """Sums and averages of doubles, unrounded, over three ways to deal the rows; all digits are compared."""
    rows = tx.silver(spark, sf).select("location_region", "amount", (F.col("amount") / 7 - F.col("risk_score")).alias("odd"))
    measures = [summaries.Measure(f"{kind}_{c}", kind, c) for kind in ("sum", "avg") for c in ("amount", "odd")]
    summary = summaries.Summary(("location_region",), tuple(measures))
    dealt = {"as read": rows, "one": rows.coalesce(1), "many": rows.repartition(50)}
    frames = [summaries.summarise(df, summary).withColumn("dealt", F.lit(name)) for name, df in dealt.items()]
    frames.append(summaries.summarise_rollup(summaries.rollup(rows, [summary]), summary).withColumn("dealt", F.lit("rollup")))
    return reduce(DataFrame.unionByName, frames)


for _name in t.SUMMARIES:
    QUERIES[_name] = partial(_summary, _name)
for _name in t.SHARED_ROLLUP:
    QUERIES[f"{_name}_from_rollup"] = partial(_summary_from_rollup, _name)


@query
def high_risk_transactions(spark, sf):
    rows = summaries.extract(tx.silver(spark, sf), t.is_high_risk_row(), t.HIGH_RISK_COLUMNS)
    return tx.as_text(rows, "transaction_datetime", "transaction_date")


@query
def top_sale_receivers(spark, sf):
    return tx.as_text(summaries.top_latest(tx.silver(spark, sf), **t.top_receivers_args()), "timestamp")


@query
def latest_sale_per_receiver(spark, sf):
    sales = tx.silver(spark, sf).filter("transaction_type = 'sale'").select("receiving_address", "amount", "timestamp")
    latest = summaries.latest_per_key(sales, "receiving_address", [F.desc("timestamp"), F.desc("amount")])
    return tx.as_text(latest, "timestamp")


@query
def distinct_values(spark, sf):
    return tx.silver(spark, sf).select("amount_tier", "location_region").distinct()


# --- Quality ------------------------------------------------------------------------------------------------
@query
def quality_null_counts(spark, sf):
    nulls = [c for c in t.raw_checks() if c.type == "completeness"]
    return quality.error_counts(tx.bronze(spark, sf), nulls)


@query
def quality_violations(spark, sf):
    rules = [c for c in t.raw_checks() if isinstance(c, quality.Check) and c.type == "validity"]
    return quality.error_counts(tx.bronze(spark, sf), rules)


@query
def quality_duplicates(spark, sf):
    return quality.duplicate_counts(tx.bronze(spark, sf), t.DUPLICATE_KEYS)


@query
def bronze_quality_report(spark, sf):
    return quality.raw_report(tx.bronze(spark, sf), t.raw_checks())


def _in_order(df: DataFrame) -> DataFrame:
    """The few rows of a sorted report with their places."""
    return df.coalesce(1).withColumn("place", F.row_number().over(Window.orderBy(F.monotonically_increasing_id())))


@query
def bronze_quality_report_order(spark, sf):
    return _in_order(quality.raw_report(tx.bronze(spark, sf), t.raw_checks())).select("check_type", "check_name", "place")


@query
def region_risk_ranking_order(spark, sf):
    return _in_order(_summary("region_risk_ranking", spark, sf)).select("location_region", "place")


@query
def silver_quality_report(spark, sf):
    return quality.clean_report(tx.silver(spark, sf), t.clean_checks(), "2024-01-01T00:00:00+00:00")


@query
def clean_report_on_raw_rows(spark, sf):
    """The report for validated rows, put over unvalidated ones so that its checks find errors."""
    return quality.clean_report(tx.bronze(spark, sf), t.clean_checks())


@query
def quality_summary(spark, sf):
    return quality.report_summary(tx.silver(spark, sf), tx.rejected(spark, sf), t.clean_checks())


@query
def quality_summary_on_raw_rows(spark, sf):
    """Errors are added over the checks; over unvalidated rows they are many."""
    return quality.report_summary(tx.bronze(spark, sf), tx.rejected(spark, sf), t.clean_checks())


@query
def row_counts(spark, sf):
    counts = tx.silver(spark, sf).agg(F.count("*").alias("silver_rows"))
    return counts.withColumn("bronze_rows", quality.row_total(tx.bronze(spark, sf)))


def _distribution(column, name: str, source: DataFrame) -> DataFrame:
    return renamed(quality.distribution(source, column, name), count="row_count")


for _name in t.CLEAN_DIMENSIONS:
    QUERIES[f"distribution_{_name}"] = (
        lambda spark, sf, name=_name: _distribution(F.col(name), name, tx.silver(spark, sf))
    )


@query
def distribution_risk_bands(spark, sf):
    return _distribution(t.clean_bands(), "band", tx.silver(spark, sf))


@query
def distribution_risk_bands_with_null(spark, sf):
    return _distribution(t.raw_bands(), "band", tx.bronze(spark, sf))


@query
def distributions_all_dimensions(spark, sf):
    return quality.distributions(tx.bronze(spark, sf), t.raw_dimensions(), t.NULL_LABEL)


@query
def report_document(spark, sf):
    """The nested report, written as JSON, read back and flattened to one row per entry."""
    document = refresh.report_document(tx.silver(spark, sf), tx.rejected(spark, sf), "2024-01-01T00:00:00+00:00")
    path = new_path(spark, "report")
    tables.write_json_document(document, path)
    report = spark.read.schema(document.schema).json(path, multiLine=True)

    def entries(section: str, array: str, **columns: str) -> DataFrame:
        return report.select(F.explode(array).alias("e")).select(
            F.lit(section).alias("section"), *(F.expr(e).alias(c) for c, e in columns.items())
        )

    frames = [
        entries("completeness", "completeness", name="e.column", n="e.null_count", pct="e.null_pct", note="e.status"),
        entries("validity", "validity", name="e.rule", n="e.error_count", pct="e.conformance_pct", note="e.status"),
        entries(
            "reasons", "quarantine_rejection_reasons", name="e.reason", n="e.count", pct="e.pct", note="string(null)"
        ),
    ]
    for name in (*t.CLEAN_DIMENSIONS, "risk_score_bands"):
        label = "band" if name == "risk_score_bands" else name
        frames.append(
            entries(
                name, f"distributions.{name}", name=f"e.{label}", n="e.count", pct="e.pct", note="string(null)"
            )
        )
    figures = report.select("summary.*")
    counts = [c for c in figures.columns if not c.endswith("_pct")]
    shares = [c for c in figures.columns if c.endswith("_pct")]
    headline = figures.select(
        F.inline(
            F.array(
                *(F.struct(F.lit(c).alias("name"), F.col(c).alias("n"), F.lit(None).cast("double").alias("pct"))
                  for c in counts),
                *(F.struct(F.lit(c).alias("name"), F.lit(None).cast("long").alias("n"), F.col(c).alias("pct"))
                  for c in shares),
            )
        )
    ).select(F.lit("summary").alias("section"), "name", "n", "pct", F.lit(None).cast("string").alias("note"))
    return reduce(DataFrame.unionByName, [headline, *frames])


# --- Table tests --------------------------------------------------------------------------------------------
RAW_TESTS = {
    "not_null": checks.not_null("timestamp", "sending_address", "amount", "location_region", "ip_prefix"),
    "accepted_values": [
        *checks.accepted_values("location_region", t.REGIONS),
        *checks.accepted_values("anomaly", t.RISK_CLASSES),
        *checks.accepted_values("transaction_type", t.TRANSACTION_TYPES),
    ],
    "accepted_range": [
        *checks.accepted_range(0, 100, "risk_score"),
        *checks.accepted_range(0, None, "amount"),
        *checks.accepted_range(None, 6, "login_frequency"),
    ],
    "unique": checks.unique("sending_address", "timestamp"),
}


def _raw_tests(kind: str, spark, sf) -> DataFrame:
    return checks.run_table_tests(tx.bronze(spark, sf), "bronze", RAW_TESTS[kind])


for _name in RAW_TESTS:
    QUERIES[f"tests_{_name}"] = partial(_raw_tests, _name)


@query
def table_test_examples(spark, sf):
    """Tests of the raw rows with up to five examples each, found in the same scan; every example must be a row that the
    test objects to."""
    kinds = [test for kind in ("not_null", "accepted_values", "accepted_range") for test in RAW_TESTS[kind]]
    found = checks.run_table_tests(tx.bronze(spark, sf), "bronze", kinds, examples=5)
    objects = {
        "not_null": lambda v: v.isNull(),
        "location_region": lambda v: ~v.isin(*t.REGIONS),
        "anomaly": lambda v: ~v.isin(*t.RISK_CLASSES),
        "transaction_type": lambda v: ~v.isin(*t.TRANSACTION_TYPES),
        "risk_score": lambda v: (v == "NaN") | (v.try_cast("double") < 0) | (v.try_cast("double") > 100),
        "amount": lambda v: v.try_cast("double") < 0,
        "login_frequency": lambda v: v.try_cast("int") > 6,
    }

    def all_offend(test):
        rule = objects["not_null" if test.kind == "not_null" else test.column]
        own = (F.col("column_name") == test.column) & (F.col("test") == test.kind)
        return own & F.forall("examples", lambda row: F.coalesce(rule(F.get_json_object(row, f"$.{test.column}")), F.lit(False)))

    sound = reduce(lambda a, b: a | b, map(all_offend, kinds))
    n = F.size("examples")
    return found.select(
        "column_name", "test", "failures", (n > 0).alias("has_examples"), (n <= F.least(F.col("failures"), F.lit(5))).alias("few_enough"),
        sound.alias("all_offend"),
    )


@query
def offending_values(spark, sf):
    (test,) = checks.accepted_values("location_region", t.REGIONS)
    return checks.offending(tx.bronze(spark, sf), test)


@query
def offending_repeats(spark, sf):
    (test,) = checks.unique("timestamp")
    return tx.as_text(checks.offending(tx.bronze(spark, sf), test), "value")


@query
def offending_range_rows(spark, sf):
    (test,) = checks.accepted_range(None, 6, "login_frequency")
    rows = checks.offending(tx.bronze(spark, sf), test)
    return tx.as_text(rows, "timestamp").withColumn("amount", F.col("amount").cast("double"))


@query
def offending_null_rows(spark, sf):
    (test,) = checks.not_null("amount")
    return checks.offending(tx.bronze(spark, sf), test).agg(F.count("*").alias("row_count"))


def _declared_tests(spark, sf, spec: TableSpec) -> DataFrame:
    plan = t.table_tests(spec)
    frames = {"silver": tx.silver(spark, sf), **tx.outputs(spark, sf)}
    return checks.run_all_tests({name: frames[name] for name in plan}, plan)


@query
def table_tests_all(spark, sf):
    """All declared tests over the written tables: validated rows, summaries and raw reports."""
    return _declared_tests(spark, sf, t.SPEC)


#: Another spec of the same table: two regions, of which one never occurs, and a reason column of its own.
SECOND_SPEC = replace(
    t.SPEC,
    domains={**t.SPEC.domains, "valid_regions": ("Asia", "Mars")},
    rejects=replace(t.SPEC.rejects, reason_column="why"),
)


@query
def table_tests_second_spec(spark, sf):
    """The declared tests by the lists of another spec."""
    return _declared_tests(spark, sf, SECOND_SPEC)


@query
def invariants_second_spec(spark, sf):
    """The invariants of a split by another spec."""
    raw = tx.bronze(spark, sf)
    valid, rejected = split(raw, SECOND_SPEC)
    return refresh.invariants(raw, enrich(valid, SECOND_SPEC.derivations), rejected, spec=SECOND_SPEC)


@query
def invariants(spark, sf):
    gold = {name: frame for name, frame in tx.outputs(spark, sf).items() if "bronze" not in name and name != "silver_report"}
    return refresh.invariants(tx.bronze(spark, sf), tx.silver(spark, sf), tx.rejected(spark, sf), gold)


@query
def conservation_cases(spark, sf):
    """The split as it is, and spoilt: sale rows of one region lost, doubled, and with sender and receiver exchanged,
    which leaves every count as it was."""
    raw = tx.bronze(spark, sf)
    valid, rejected = split(raw, t.SPEC)
    chosen = F.col("transaction_type").eqNullSafe("sale") & F.col("location_region").eqNullSafe("Asia")
    exchanged = {"sending_address": "receiving_address", "receiving_address": "sending_address"}
    cases = {
        "intact": valid,
        "lost": valid.filter(~chosen),
        "doubled": valid.unionAll(valid.filter(chosen)),
        "exchanged": valid.withColumns({a: F.when(chosen, F.col(b)).otherwise(F.col(a)) for a, b in exchanged.items()}),
    }
    frames = [
        checks.conservation(raw, {"silver": side, "quarantine": rejected}).select(F.lit(case).alias("case_name"), "violations", "status")
        for case, side in cases.items()
    ]
    return reduce(DataFrame.unionByName, frames)


def _text_rows(spark, sf) -> DataFrame:
    """The raw rows as text, with cells that are no numbers and no known values."""
    rows = tx.bronze(spark, sf).select("amount", "risk_score", "location_region", "anomaly", "login_frequency")
    rows = rows.select(*(F.col(c).cast("string").alias(c) for c in rows.columns))
    junk = F.col("login_frequency").isin("6", "7")
    return rows.withColumns({c: F.when(junk, F.concat(F.lit("junk "), c)).otherwise(F.col(c)) for c in ("amount", "risk_score", "anomaly")})


@query
def quality_report_text_columns(spark, sf):
    """Rule checks over text: what is no number breaks no rule of numbers, and fails no job."""
    rules = [c for c in t.raw_checks() if isinstance(c, quality.Check) and c.name in ("amount_positive", "risk_score_range", "location_region_valid", "anomaly_valid")]
    return quality.raw_report(_text_rows(spark, sf), rules)


@query
def tests_on_text(spark, sf):
    tests = [
        *checks.accepted_range(0, 100, "risk_score"),
        *checks.accepted_range(0, None, "amount"),
        *checks.accepted_range(None, 6, "login_frequency"),
        *checks.accepted_values("anomaly", t.RISK_CLASSES),
        *checks.accepted_values("login_frequency", (1, 2, 3)),
    ]
    return checks.run_table_tests(_text_rows(spark, sf), "bronze", tests)


@query
def percent_ties(spark, sf):
    """Shares of 800, every other one of which lies on a tie of the second digit: 1 of 800 is 0.13, away from zero."""
    parts = tx.read(spark, sf, "lineitem").select(F.pmod("l_orderkey", F.lit(800)).alias("part")).distinct()
    return parts.select("part", percent(F.col("part"), F.lit(800)).alias("pct"))


@query
def whole_numbers_from_text(spark, sf):
    """Text with fractions becomes the whole part, however long the fraction; what is no number becomes NULL."""
    endings = F.array(*(F.lit(x) for x in ("", ".", ".5", ".99999999999", ".99999999999999999999", "e1", " x")))
    rows = tx.read(spark, sf, "lineitem").select("l_linenumber", F.posexplode(endings).alias("no", "ending")).distinct()
    text = F.concat(F.when(F.col("l_linenumber") % 2 == 0, "-").otherwise(""), F.col("l_linenumber"), "ending")
    return rows.select("l_linenumber", "no", soft_cast(text, StringType(), "int").alias("whole"))


# --- Charts -------------------------------------------------------------------------------------------------
def _chart(name: str, spark, sf) -> DataFrame:
    chart = t.CHARTS[name]
    return charts.chart_data(_summary(chart.table, spark, sf), chart)


for _name in t.CHARTS:
    QUERIES[f"chart_{_name}"] = partial(_chart, _name)


#: Without low risk, which the column for all other values holds.
MATRIX_CLASSES = ("moderate_risk", "high_risk")


@query
def chart_count_matrix(spark, sf):
    chart = t.CHARTS["count_by_type_and_anomaly"]
    return charts.chart_matrix(_summary(chart.table, spark, sf), chart, MATRIX_CLASSES)


@query
def chart_risk_matrix(spark, sf):
    chart = t.CHARTS["risk_heatmap"]
    return charts.chart_matrix(_summary(chart.table, spark, sf), chart, MATRIX_CLASSES)


def _detail(spark, sf, after=None) -> DataFrame:
    rows = summaries.extract(tx.silver(spark, sf), t.is_high_risk_row(), t.HIGH_RISK_COLUMNS)
    return charts.listing_page(rows, t.LISTING_COLUMNS, "transaction_datetime", after)


def _placed(page: DataFrame) -> DataFrame:
    """A page with the place of each row on it, so that the order can be compared."""
    rest = [F.asc_nulls_first(c) for c in t.LISTING_COLUMNS[1:]]
    place = F.row_number().over(Window.orderBy(F.desc_nulls_last("transaction_datetime"), *rest, "row_number"))
    return tx.as_text(page.withColumn("place", place.cast("long")).drop("row_number"), "transaction_datetime")


@query
def chart_detail_page(spark, sf):
    return _placed(_detail(spark, sf))


@query
def chart_detail_second_page(spark, sf):
    """By key: the page behind the last row of the first one."""
    return _placed(_detail(spark, sf, after=_detail(spark, sf).tail(1)[0]))


# --- Files and tables ---------------------------------------------------------------------------------------
def _csv_file(spark, sf) -> str:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    path = new_path(spark, "csv")
    tx.source_rows(spark, sf).write.csv(path, header=True)
    return path


def refresh_from_csv(spark, sf) -> Callable[[], dict[str, int]]:
    """The CSV files are written now; the refresh from them runs when the result is called."""
    path = _csv_file(spark, sf)
    return lambda: refresh.Refresh(spark, _fresh_layout(spark)).run(path, new_path(spark, "document"))


def _fresh_layout(spark) -> refresh.Layout:
    return refresh.Layout(prefix=f"lw_{uuid4().hex[:12]}_", root=new_path(spark, "layers"))


@query
def csv_roundtrip(spark, sf):
    """Source rows as CSV files, ingested with the declared schema into a sorted table, read back."""
    layout = _fresh_layout(spark)
    layout.create(spark)
    name = layout.table("bronze", t.SPEC.table)
    rows = refresh.ingest(spark, _csv_file(spark, sf), t.SPEC, "batch_1")
    tables.replace_table(rows, name, sort_by=t.SPEC.sort_by)
    stored = tables.read_table(spark, name).drop("_ingestion_time")
    stored = stored.withColumns({"amount": F.col("amount").cast("double")})
    return tx.as_text(stored, "timestamp").withColumn("risk_score", F.nanvl("risk_score", F.lit(-1.0)))


#: Which rows get a line that does not fit, by the condition on the source row.
MALFORMED = {
    "short": "login_frequency = 3 AND session_duration < 10",
    "long": "login_frequency = 4 AND session_duration < 10",
    "cell": "login_frequency = 5 AND session_duration < 10",
}


def _malformed_files(spark, sf) -> list[str]:
    """CSV folders with short lines, long lines and cells of the wrong type. Rows with an even login frequency go to files
    that name the columns in reverse, with one more that nobody declared."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    rows = tx.source_rows(spark, sf)
    names, paths = rows.columns, []
    cells = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names}
    cells["session_duration"] = F.when(F.expr(MALFORMED["cell"]), F.concat(F.lit("x"), cells["session_duration"])).otherwise(cells["session_duration"])
    cells["note"] = F.lit("n")
    for order, chosen in ((names, "login_frequency % 2 = 1"), ([*reversed(names), "note"], "login_frequency % 2 = 0")):
        short = F.concat_ws(",", *(cells[c] for c in order[:8]))
        whole = F.concat_ws(",", *(cells[c] for c in order))
        line = F.when(F.expr(MALFORMED["short"]), short).when(F.expr(MALFORMED["long"]), F.concat(whole, F.lit(",more"))).otherwise(whole)
        path = new_path(spark, "malformed")
        # one column that is the whole line, named by the whole header
        rows.filter(chosen).select(line.alias(",".join(order))).write.options(header=True, sep="\u0001", quote="").csv(path)
        paths.append(path)
    return paths


@query
def csv_malformed(spark, sf):
    """Lines and cells that do not fit, in files with different headers: the raw records in quarantine, the reasons of all
    rejected rows, and who received the valid ones."""
    spec = replace(t.SPEC, rejects=replace(t.SPEC.rejects, malformed="malformed_record"))
    layout = _fresh_layout(spark)
    run = refresh.Refresh(spark, layout, spec)
    run.write_raw(_malformed_files(spark, sf), "batch_1")
    run.write_clean()
    rejected, valid = run.table("quarantine"), run.table("silver")
    frames = {
        "raw_record": rejected.filter(f"_rejection_reason = 'malformed_record'").groupBy(F.col("_raw_record").alias("value")),
        "reason": rejected.groupBy(F.col("_rejection_reason").alias("value")),
        "receiver": valid.groupBy(F.col("receiving_address").alias("value")),
    }
    counted = [df.agg(F.count("*").alias("row_count")).select(F.lit(k).alias("section"), "value", "row_count") for k, df in frames.items()]
    return reduce(DataFrame.unionByName, counted)


@query
def partitioned_table(spark, sf):
    """A table partitioned by region and written twice, where the session overwrites single partitions; the second
    write replaces the first, also a region that only the first one had."""
    layout = _fresh_layout(spark)
    layout.create(spark)
    name = layout.table("silver", t.SPEC.table)
    clean = tx.silver(spark, sf).drop("_processing_time")
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        mars = clean.filter("amount_tier = 'micro'").withColumn("location_region", F.lit("Mars"))
        tables.replace_table(clean.unionByName(mars), name, partition_by=["location_region"])
        rows = tables.replace_table(clean, name, partition_by=["location_region"], sort_by=["transaction_date"])
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    stored = tables.read_table(spark, name).filter(F.col("location_region").isin("Asia", "Europe", "Mars"))
    return stored.groupBy("location_region").agg(
        F.count("*").alias("row_count"),
        F.round(F.sum("amount"), 2).alias("total_amount"),
        F.lit(rows).cast("long").alias("written_rows"),
    )


@query
def clustered_table(spark, sf):
    """A table whose files hold ranges of its sort columns: rows per region, the files that share a range with the file
    before them, and whether a filter on a region reads a part of the files only."""
    layout = replace(_fresh_layout(spark), clustered=True)
    layout.create(spark)
    name = layout.table("silver", t.SPEC.table)
    rows = tx.silver(spark, sf).drop("_processing_time")
    merged = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(merged)
    spark.conf.set(merged, "false")  # several files of small tables, too
    try:
        tables.replace_table(rows, name, sort_by=("location_region", "transaction_date desc"), clustered=True)
    finally:
        spark.conf.set(merged, before)
    stored = tables.read_table(spark, name).withColumn("file", F.input_file_name())
    bounds = stored.groupBy("file").agg(F.min("location_region").alias("low"), F.max("location_region").alias("high"))
    before = F.max("high").over(Window.orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1))
    overlapping = bounds.withColumn("before", before).agg(F.count_if(F.col("before") > F.col("low"))).scalar()
    files = bounds.agg(F.count("*")).scalar()
    return stored.groupBy("location_region").agg(F.count("*").alias("row_count"), F.countDistinct("file").alias("files")).select(
        "location_region", "row_count", overlapping.alias("overlapping_files"), (F.col("files") < files).alias("reads_a_part")
    )


@query
def published_together(spark, sf):
    """Two tables get new versions that are published at one moment: what their names show while the versions are being
    written, and afterwards, and what a reader sees who resolved the names before."""
    layout = _fresh_layout(spark)
    layout.create(spark)
    clean, rejected = tx.silver(spark, sf).drop("_processing_time"), tx.rejected(spark, sf)
    names = {layer: layout.table(layer, t.SPEC.table) for layer in ("silver", "quarantine")}
    tables.publish(spark, [tables.stage_table(df, name) for df, name in zip((clean, rejected), names.values(), strict=True)])
    pinned = {layer: tables.read_table(spark, name) for layer, name in names.items()}
    fresh = (clean.filter("location_region = 'Asia'"), rejected.filter("_rejection_reason = 'invalid_amount'"))
    staged = [tables.stage_table(df, name) for df, name in zip(fresh, names.values(), strict=True)]
    moments = {"while written": {layer: tables.read_table(spark, name) for layer, name in names.items()}}
    tables.publish(spark, staged)
    moments |= {"afterwards": {layer: tables.read_table(spark, name) for layer, name in names.items()}, "reader from before": pinned}
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(F.lit(moment).alias("moment"), F.lit(layer).alias("layer"), F.count("*").alias("row_count"))
            for moment, frames in moments.items()
            for layer, df in frames.items()
        ],
    )


SQL_MODEL = """
SELECT purchase_pattern, count(*) AS row_count, count(location_region) AS with_region
FROM {raw} GROUP BY purchase_pattern
"""


@query
def sql_model_table(spark, sf):
    """A SQL text over a named source, materialised as a table."""
    layout = _fresh_layout(spark)
    layout.create(spark)
    name = layout.table("quality", "patterns")
    tables.replace_table_from_sql(spark, name, SQL_MODEL, {"raw": tx.bronze(spark, sf)})
    return tables.read_table(spark, name)


@query
def codec_table(spark, sf):
    """A table written with another codec; the file names tell it."""
    layout = replace(_fresh_layout(spark), codec="zstd")
    layout.create(spark)
    name = layout.table("quality", "patterns")
    tables.replace_table(tx.bronze(spark, sf).select("purchase_pattern"), name, codec=layout.codec)
    stored = tables.read_table(spark, name).select(F.input_file_name().contains(".zstd.").alias("is_zstd"))
    return stored.agg(F.count("*").alias("row_count"), F.count_if("is_zstd").alias("zstd_rows"))


@query
def optional_table(spark, sf):
    """Row counts of a table that is there and of one that is not."""
    layout = _fresh_layout(spark)
    layout.create(spark)
    rejected = tx.rejected(spark, sf)
    tables.replace_table(rejected, layout.table("quarantine", t.SPEC.table))
    frames = []
    for table in (t.SPEC.table, "tb_missing"):
        found = tables.read_table_or_empty(spark, layout.table("quarantine", table), rejected.schema)
        frames.append(found.agg(F.lit(table).alias("table_name"), F.count("*").alias("row_count")))
    return reduce(DataFrame.unionByName, frames)


@query
def full_refresh_counts(spark, sf):
    """The whole refresh from CSV files; row counts of the tables it wrote, counted by reading them."""
    layout = _fresh_layout(spark)
    written = refresh.Refresh(spark, layout).run(_csv_file(spark, sf))
    frames = []
    for name in written:
        layer, table = name.split(".")
        stored = tables.read_table(spark, layout.table(layer, table))
        frames.append(stored.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count")))
    return reduce(DataFrame.unionByName, frames)
