"""Data-quality reports in long form, value distributions and the nested report document.

A report over any number of columns and rules is one aggregate (each task sends one row) plus one narrow
aggregate for duplicates. Nothing is collected on the driver; totals enter as scalar subqueries.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layerwright.functions.predicates import member, number, outside
from layerwright.functions.scalars import percent
from layerwright.operators.multiset import short_keys


@dataclass(frozen=True)
class Check:
    """Counts the rows where ``bad``, made for the frame's schema, is true; NULL is no error. Text that is no number
    is NULL to a check of numbers."""

    type: str
    name: str
    description: str
    bad: Callable[[StructType], Column]


@dataclass(frozen=True)
class DuplicateCheck:
    """Counts the rows that repeat a key combination. NULL equals NULL here."""

    type: str
    name: str
    description: str
    keys: tuple[str, ...]


def null_check(column: str, description: str) -> Check:
    return Check("completeness", column, description.format(column=column), lambda schema: F.col(column).isNull())


def domain_check(column: str, values) -> Check:
    values = list(values)
    text = f"{column} must be one of: {', '.join(map(str, values))}"
    return Check("validity", f"{column}_valid", text, lambda schema: ~member(column, values, schema))


def range_check(column: str, low, high) -> Check:
    text = f"{column} must be between {low} and {high}"
    return Check("validity", f"{column}_range", text, lambda schema: outside(number(column, schema), low, high))


def positive_check(column: str, description: str) -> Check:
    text = description.format(column=column)
    return Check("validity", f"{column}_positive", text, lambda schema: number(column, schema) <= 0)


def error_counts(df: DataFrame, checks) -> DataFrame:
    """One row: ``total_records`` and one error count per check, all from a single pass."""
    return df.agg(F.count("*").alias("total_records"), *(F.count_if(c.bad(df.schema)).alias(c.name) for c in checks))


def duplicate_counts(df: DataFrame, keys) -> DataFrame:
    """One row: ``total_records`` and ``error_count``, the rows beyond the first of each key combination.

    It has its own pass over the key columns only: inside ``error_counts`` a distinct count would carry every
    other counter along with each distinct key through the shuffle. Copies merge before the shuffle, and what is
    shuffled of a distinct key is at most 16 bytes; see ``short_keys``."""
    per_key = df.groupBy(*short_keys(df, keys)).agg(F.count("*").alias("copies"))
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("error_count"),
    )


def _report_row(position: int, check, errors: Column) -> Column:
    return F.struct(
        F.lit(position).alias("position"),
        F.lit(check.type).alias("check_type"),
        F.lit(check.name).alias("check_name"),
        F.lit(check.description).alias("description"),
        errors.alias("error_count"),
        F.col("total_records"),
    )


def check_results(df: DataFrame, checks) -> DataFrame:
    """One row per check, numbered in the given order."""
    frames = []
    numbered = list(enumerate(checks))
    plain = [(i, c) for i, c in numbered if isinstance(c, Check)]
    if plain:
        counts = error_counts(df, [c for _, c in plain])
        frames.append(counts.select(F.inline(F.array(*(_report_row(i, c, F.col(c.name)) for i, c in plain)))))
    for i, c in numbered:
        if isinstance(c, DuplicateCheck):
            counts = duplicate_counts(df, c.keys)
            frames.append(counts.select(_report_row(i, c, F.col("error_count")).alias("row")).select("row.*"))
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def _status() -> Column:
    return F.when(F.col("error_count") == 0, "PASS").otherwise("FAIL")


def raw_report(df: DataFrame, checks) -> DataFrame:
    """Report on unvalidated rows, by check type and name. Percentages of an empty table are NULL."""
    errors, total = F.col("error_count"), F.col("total_records")
    return (
        check_results(df, checks)
        .drop("position")
        .withColumns(
            {
                "error_pct": percent(errors, total),
                "conformance_pct": F.round((1 - F.try_divide(errors, total)) * 100, 2),
                "status": _status(),
            }
        )
        .orderBy("check_type", "check_name")
    )


def clean_report(df: DataFrame, checks, report_timestamp: str | None = None) -> DataFrame:
    """Report on validated rows, in the order of the checks. For an empty table every null check shows 0 %
    errors and every other check 0 % conformance."""
    errors, total = F.col("error_count"), F.col("total_records")
    is_null_check = F.col("check_type") == "completeness"
    null_pct = percent(errors, total, empty=0.0)
    conformance = percent(total - errors, total, empty=0.0)
    report = check_results(df, checks).withColumns(
        {
            "error_pct": F.when(is_null_check, null_pct).otherwise(F.round(100 - conformance, 2)),
            "conformance_pct": F.when(is_null_check, 100 - null_pct).otherwise(conformance),
            "status": _status(),
        }
    )
    if report_timestamp is not None:
        report = report.select(F.lit(report_timestamp).alias("report_timestamp"), "*")
    return report.orderBy("position").drop("position")


def row_total(df: DataFrame) -> Column:
    """The row count as a scalar subquery: one number, read from file footers where the format has them."""
    return df.agg(F.count("*").alias("rows")).scalar()


def distribution(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Rows and share per value, ordered by value."""
    return (
        df.groupBy(value.alias(name))
        .agg(F.count("*").alias("count"))
        .withColumn("pct", percent(F.col("count"), row_total(df), empty=0.0))
        .orderBy(name)
    )


def value_counts(df: DataFrame, dimensions: dict[str, Column], null_label: str | None = None) -> DataFrame:
    """Row counts per value of several columns in one pass, as (dimension, dim_value, record_count).

    Each row is unpivoted inside the scan stage and counted there, so the shuffle carries one row per value
    and task. Grouping by all columns at once would be cheaper for tidy data but would multiply their value
    counts for dirty data."""
    texts = [column.cast("string") for column in dimensions.values()]
    if null_label is not None:
        texts = [F.coalesce(text, F.lit(null_label)) for text in texts]
    wide = df.select(*(text.alias(name) for text, name in zip(texts, dimensions)))
    return (
        wide.unpivot([], list(dimensions), "dimension", "dim_value")
        .groupBy("dimension", "dim_value")
        .agg(F.count("*").alias("record_count"))
    )


def distributions(df: DataFrame, dimensions: dict[str, Column], null_label: str | None = None) -> DataFrame:
    """``value_counts`` with the share of all rows, most frequent values first."""
    counts = value_counts(df, dimensions, null_label)
    counts = counts.withColumn("pct", percent(F.col("record_count"), row_total(df)))
    return counts.orderBy("dimension", F.desc("record_count"), "dim_value")


def summary(silver_rows: Column, rejected_rows: Column, errors: Column) -> dict[str, Column]:
    """The headline figures. Errors are added up over all checks, so a row that fails three checks counts three
    times and the overall conformance can fall below zero."""
    total = silver_rows + rejected_rows
    return {
        "total_input_records": total,
        "silver_records": silver_rows,
        "quarantine_records": rejected_rows,
        "quarantine_rate_pct": percent(rejected_rows, total, empty=0.0),
        "total_quality_errors": errors,
        "overall_conformance_pct": percent(silver_rows - errors, silver_rows, empty=0.0),
    }


def report_summary(clean: DataFrame, rejected: DataFrame, checks) -> DataFrame:
    """The headline figures as one row."""
    figures = check_results(clean, checks).agg(
        F.max("total_records").alias("silver"), F.sum("error_count").alias("errors")
    )
    figures = figures.withColumn("rejected", row_total(rejected))
    parts = summary(F.col("silver"), F.col("rejected"), F.col("errors"))
    return figures.select(*(column.alias(name) for name, column in parts.items()))


def _listed(kept: Column, sort_key: Column, **fields: Column) -> Column:
    """Aggregate: the rows where ``kept`` is true, as an array of structs in the order of ``sort_key``."""
    body = F.struct(*(column.alias(name) for name, column in fields.items()))
    rows = F.collect_list(F.when(kept, F.struct(sort_key.alias("key"), body.alias("body"))))
    return F.transform(F.array_sort(rows), lambda row: row["body"])


def report_document(
    results: DataFrame,
    clean: DataFrame,
    rejected: DataFrame,
    checks,
    dimensions: dict[str, Column],
    bands: Column,
    reason_column: str,
    generated_at: str,
) -> DataFrame:
    """The whole report as one row of nested columns, ready for ``write_json_document``.

    ``results`` are the ``check_results`` of the checks, or the table that holds the ``clean_report`` of them: the
    checks, above all the one for duplicates, need not run again for the document.

    The arrays are as long as the list of checks, the declared value lists of validated columns and the list of
    reject rules, none of which grows with the data. ``document_dimensions`` of the plan makes sure of it."""
    c = F.col
    is_null_check = c("check_type") == "completeness"
    position = F.array_position(F.lit([check.name for check in checks]), c("check_name"))
    conformance = percent(c("total_records") - c("error_count"), c("total_records"), empty=0.0)
    counted_errors = results.agg(
        F.max("total_records").alias("silver"),
        F.sum("error_count").alias("errors"),
        _listed(
            is_null_check,
            position,
            column=c("check_name"),
            null_count=c("error_count"),
            null_pct=percent(c("error_count"), c("total_records"), empty=0.0),
            status=_status(),
        ).alias("completeness"),
        _listed(
            ~is_null_check,
            position,
            rule=c("check_name"),
            description=c("description"),
            error_count=c("error_count"),
            conformance_pct=conformance,
            status=_status(),
        ).alias("validity"),
    )

    band_name = "risk_score_bands"
    counted = value_counts(clean, {**dimensions, band_name: bands})
    counted = counted.withColumn("pct", percent(c("record_count"), row_total(clean), empty=0.0))
    shares = {name: (name, name) for name in dimensions} | {band_name: (band_name, "band")}
    spread = counted.agg(
        F.struct(
            *(
                _listed(
                    c("dimension") == dimension,
                    c("dim_value"),
                    **{label: c("dim_value"), "count": c("record_count"), "pct": c("pct")},
                ).alias(name)
                for name, (dimension, label) in shares.items()
            )
        ).alias("distributions")
    )

    reasons = rejected.groupBy(c(reason_column).alias("reason")).agg(F.count("*").alias("n"))
    reasons = reasons.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rejected"),
        F.collect_list(F.struct((-c("n")).alias("key"), "reason", "n")).alias("list"),
    )

    one_row = clean.sparkSession.range(0, 1, 1, numPartitions=1).select(
        counted_errors.select(F.struct("*")).scalar().alias("r"),
        spread.scalar().alias("distributions"),
        reasons.select(F.struct("*")).scalar().alias("q"),
    )
    parts = summary(c("r.silver"), c("q.rejected"), c("r.errors"))
    total = c("r.silver") + c("q.rejected")
    return one_row.select(
        F.lit(generated_at).alias("generated_at"),
        F.struct(*(column.alias(name) for name, column in parts.items())).alias("summary"),
        c("r.completeness").alias("completeness"),
        c("r.validity").alias("validity"),
        c("distributions"),
        F.transform(
            F.array_sort(c("q.list")),
            lambda row: F.struct(
                row["reason"].alias("reason"),
                row["n"].alias("count"),
                percent(row["n"], total, empty=0.0).alias("pct"),
            ),
        ).alias("quarantine_rejection_reasons"),
    )
