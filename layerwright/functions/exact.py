"""Sums of doubles that do not depend on the order of rows, tasks and partitions.

Adding doubles rounds after each step, so the last digits of a sum tell in which order its rows came, and a rounded
figure next to a tie may flip from run to run. Here every double is cut into whole numbers of 26 bits: the upper and
lower half of its whole part, and of its fraction in units of 2^-52. Whole numbers add up exactly in any order, for 2^36
rows, and only the four finished sums are put together as doubles. Digits below 2^-52 are cut off before, from
each value alike. Values of 2^53 and more, infinities and NaN have no fraction to lose and are added as they are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HALF, _UNIT = 26, float(1 << 52)
PARTS = ("upper", "lower", "fraction_upper", "fraction_lower", "large", "count")


def sum_parts(column: Column) -> dict[str, Column]:
    """Aggregates that can be merged: adding up each of them over groups gives those of the union."""
    value = column.cast("double")
    ordinary = F.when(F.abs(value) < float(1 << 53), value)
    whole = F.floor(ordinary)
    fraction = F.floor((ordinary - whole) * _UNIT)
    low = F.lit((1 << _HALF) - 1).cast("long")
    return {
        "upper": F.sum(F.shiftright(whole, _HALF)),
        "lower": F.sum(whole.bitwiseAND(low)),
        "fraction_upper": F.sum(F.shiftright(fraction, _HALF)),
        "fraction_lower": F.sum(fraction.bitwiseAND(low)),
        "large": F.sum(F.when(ordinary.isNull(), value)),
        "count": F.count(value),
    }


def total(parts: dict[str, Column]) -> Column:
    """The sum; NULL where there was no value."""
    part = {name: F.coalesce(column.cast("double"), F.lit(0.0)) for name, column in parts.items()}
    whole = part["upper"] * float(1 << _HALF) + part["lower"]
    fraction = part["fraction_upper"] / float(1 << _HALF) + part["fraction_lower"] / _UNIT
    return F.when(parts["count"] > 0, whole + fraction + part["large"])


def exact_sum(column: Column) -> Column:
    return total(sum_parts(column))


def exact_avg(column: Column) -> Column:
    parts = sum_parts(column)
    return total(parts) / parts["count"]
