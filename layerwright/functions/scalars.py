"""Scalar expressions shared by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from layerwright.functions.predicates import bound, first_match

_WHOLE_NUMBERS = {"tinyint", "byte", "smallint", "short", "int", "integer", "bigint", "long"}


# A plain decimal number: sign, digits, point, digits; with digits on one side of the point at least.
_DECIMAL_TEXT = r"^\s*([+-]?)(?:(\d+)\.\d*|\.\d+)\s*$"


def soft_cast(column: Column, source: DataType, target: str) -> Column:
    """Cast that yields NULL where the value does not fit. Text such as ``3.7`` becomes the whole number 3: the
    fraction is cut off as text, however long it is, so nothing is rounded up."""
    if isinstance(source, StringType) and target.lower() in _WHOLE_NUMBERS:
        whole = F.concat(F.regexp_extract(column, _DECIMAL_TEXT, 1), F.lit("0"), F.regexp_extract(column, _DECIMAL_TEXT, 2))
        column = F.when(column.rlike(_DECIMAL_TEXT), whole).otherwise(column).try_cast("decimal(38,10)")
    return column.try_cast(target)


def percent(part: Column, total: Column, empty: float | None = None) -> Column:
    """``part`` in percent of ``total`` with two digits, ties away from zero (1 of 800 is 0.13); ``empty`` is the
    answer for a total of zero."""
    share = F.round(F.try_divide(part * 100, total), 2)  # in this order a tie is one in binary, too
    return share if empty is None else F.coalesce(share, F.lit(float(empty)))


def bands(column: Column, uppers, labels, null_label: str | None = None) -> Column:
    """Label of the first inclusive upper bound that holds the value, else the last label."""
    cases = [(column <= F.lit(bound(upper)), label) for upper, label in zip(uppers, labels)]
    if null_label is not None:
        cases.insert(0, (column.isNull(), null_label))
    return first_match(cases, F.lit(labels[len(uppers)]))


def tiers(column: Column, buckets) -> Column:
    """Label of the first exclusive upper bound above the value, else the label of the rest."""
    rest = [b.label for b in buckets if b.is_rest]
    cases = [(column < F.lit(bound(b.max)), b.label) for b in buckets if not b.is_rest]
    return first_match(cases, F.lit(rest[-1] if rest else None).cast("string"))
