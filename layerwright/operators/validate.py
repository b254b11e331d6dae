"""Validity of rows, the split into clean and rejected rows, and reject reasons.

All of it is one narrow projection or filter: no shuffle, whatever the distribution of the data.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layerwright.functions.predicates import compare, every, first_match, holds, member, number, outside
from layerwright.functions.scalars import percent
from layerwright.spec import RAW_RECORD, Condition, Requirement, TableSpec


class Split(NamedTuple):
    valid: DataFrame
    rejected: DataFrame


def _required(requirement: Requirement, spec: TableSpec, schema: StructType) -> Column:
    name = requirement.column
    if requirement.test == "not_null":
        return F.col(name).isNotNull()
    if requirement.test == "in":
        return member(name, spec.domain(requirement.values_ref), schema)
    if requirement.test == "above":
        return compare(number(name, schema), ">", requirement.value)
    return ~outside(number(name, schema), requirement.min, requirement.max)


def valid_mask(spec: TableSpec, schema: StructType) -> Column:
    """True for a row that meets every requirement. NULL (not false) where a NULL leaves it open."""
    sound = [F.col(RAW_RECORD).isNull()] if _rejects_malformed(spec, schema) else []
    return every([*(_required(r, spec, schema) for r in spec.requirements), *sound])


def _rejects_malformed(spec: TableSpec, schema: StructType) -> bool:
    return spec.rejects.malformed is not None and RAW_RECORD in schema.names


def _matches(condition: Condition, spec: TableSpec, schema: StructType) -> Column:
    if condition.type == "not_in":
        return ~member(condition.column, spec.domain(condition.values_ref), schema)
    value = number(condition.column, schema)
    if condition.type == "null_or_range":
        return value.isNull() | outside(value, condition.min, condition.max)
    return value.isNull() | compare(value, condition.operator, condition.value)


def reject_reason(spec: TableSpec, schema: StructType) -> Column:
    """Reason of the first matching rule, else ``other``. A NULL matches no list rule."""
    cases = [(_matches(rule.condition, spec, schema), rule.reason) for rule in spec.rejects.rules]
    if _rejects_malformed(spec, schema):
        cases.insert(0, (F.col(RAW_RECORD).isNotNull(), spec.rejects.malformed))
    return first_match(cases, F.lit("other"))


def label_rejects(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.withColumns(
        {
            spec.rejects.reason_column: reject_reason(spec, df.schema),
            spec.rejects.time_column: F.current_timestamp(),
        }
    )


def split(df: DataFrame, spec: TableSpec) -> Split:
    """Every row lands on exactly one side: a row whose mask is NULL counts as rejected.

    The valid side's filter is pushed into the scan. The rejected side's is not, on purpose: file statistics may
    leave NaN out, and a row group skipped by them could hide a row that is rejected for its NaN."""
    mask = valid_mask(spec, df.schema)
    return Split(df.filter(mask), label_rejects(df.filter(~holds(mask)), spec))


def split_counts(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Sizes of input and both sides in one pass."""
    valid = holds(valid_mask(spec, df.schema))
    return df.agg(
        F.count("*").alias("input_rows"),
        F.count_if(valid).alias("valid_rows"),
        F.count_if(~valid).alias("rejected_rows"),
    )


def reject_counts(rejected: DataFrame, spec: TableSpec, input_total: Column) -> DataFrame:
    """Rejected rows per reason with their share of all input rows, most frequent first."""
    return (
        rejected.groupBy(F.col(spec.rejects.reason_column).alias("reason"))
        .agg(F.count("*").alias("count"))
        .withColumn("pct", percent(F.col("count"), input_total, empty=0.0))
        .orderBy(F.desc("count"), "reason")
    )
