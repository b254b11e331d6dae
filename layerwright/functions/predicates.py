"""Boolean Column expressions that keep SQL's three-valued logic explicit."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType, StructType

# Comparison operators a spec may name.
COMPARISONS = {
    ">=": operator.ge,
    ">": operator.gt,
    "<=": operator.le,
    "<": operator.lt,
    "==": operator.eq,
    "!=": operator.ne,
}


def bound(value):
    """A whole float as int: comparing a decimal column with it needs no cast, so the filter reaches the scan."""
    if isinstance(value, float) and value.is_integer() and abs(value) < 2**53:
        return int(value)
    return value


def number(name: str, schema: StructType) -> Column:
    """The column as a number. Numeric columns stay as they are; text that is no number becomes NULL."""
    column = F.col(f"`{name}`")
    return column if isinstance(schema[name].dataType, NumericType) else column.try_cast("double")


def member(name: str, values, schema: StructType) -> Column:
    """Membership in a list. Where either side is text, both are compared as text, so no value has to be read as a
    number; an empty list has no members. NULL stays NULL unless the list is empty."""
    column, values = F.col(f"`{name}`"), list(values)
    if isinstance(schema[name].dataType, StringType) or any(isinstance(v, str) for v in values):
        column, values = column.cast("string"), [str(v) for v in values]
    return column.isin(values)


def compare(column: Column, op: str, value) -> Column:
    if op not in COMPARISONS:
        raise ValueError(f"unknown operator {op!r}")
    return COMPARISONS[op](column, F.lit(bound(value)))


def outside(column: Column, low=None, high=None) -> Column:
    """True below ``low`` or above ``high`` (both inclusive bounds, each optional); NULL stays NULL."""
    limits = []
    if low is not None:
        limits.append(column < F.lit(bound(low)))
    if high is not None:
        limits.append(column > F.lit(bound(high)))
    return reduce(operator.or_, limits) if limits else F.lit(False)


def every(conditions) -> Column:
    return reduce(operator.and_, conditions, F.lit(True))


def holds(condition: Column) -> Column:
    """The condition with NULL read as false, so that ``c`` and ``~c`` cover every row exactly once."""
    return F.coalesce(condition, F.lit(False))


def first_match(cases, default: Column) -> Column:
    """Ordered (condition, label) pairs: the first condition that is true decides."""
    return F.coalesce(*(F.when(condition, F.lit(label)) for condition, label in cases), default)
