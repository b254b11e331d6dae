"""Group-bys and listings that dashboards put on top of the summary tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from layerwright.operators.summaries import aggregated


@dataclass(frozen=True)
class Chart:
    """``series`` splits each bar or line; ``aggregate`` is sum or avg."""

    table: str
    keys: tuple[str, ...]
    aggregate: str
    column: str
    label: str
    series: str | None = None


def chart_data(df: DataFrame, chart: Chart) -> DataFrame:
    """Long form: one row per key (and series value)."""
    keys = [*chart.keys, *([chart.series] if chart.series else [])]
    return df.groupBy(*keys).agg(aggregated(chart.aggregate, chart.column, df.schema).alias(chart.label))


def chart_matrix(df: DataFrame, chart: Chart, series_values, rest: str = "other") -> DataFrame:
    """Wide form: one column per series value, and one named ``rest`` over all other values and NULL. The values are
    given, so no job has to look for them."""
    values = list(series_values)
    if rest in values:
        raise ValueError(f"the column {rest!r} for other values is a series value")
    series = F.when(F.col(chart.series).isin(values), F.col(chart.series)).otherwise(rest)
    grouped = df.withColumn(chart.series, series).groupBy(*chart.keys).pivot(chart.series, [*values, rest])
    return grouped.agg(aggregated(chart.aggregate, chart.column, df.schema))


def listing_page(df: DataFrame, columns, newest_first: str, after: Row | None = None, size: int = 25) -> DataFrame:
    """One page of a detail table, newest rows first and rows without time last. ``after`` is the last row of the
    page before, with ``row_number`` in it: the page starts behind it by a filter, so a deep page costs no more than
    the first. The other columns and, for equal rows, a number among them settle the order, so pages neither
    overlap nor skip rows.
    """
    rest = [c for c in columns if c != newest_first]
    rows = df.select(*columns)
    if after is not None:
        rows = rows.filter(~_before(rows, newest_first, rest, after))
        if after[newest_first] is not None:  # follows from the filter above, in a form that reaches the scan
            rows = rows.filter((F.col(newest_first) <= F.lit(after[newest_first])) | F.col(newest_first).isNull())
        else:
            rows = rows.filter(F.col(newest_first).isNull())
    # the row_number counts equal rows; only rows of the page and those equal to its start need one
    at_most = size if after is None else size + after["row_number"]
    head = rows.orderBy(F.desc_nulls_last(newest_first), *(F.asc_nulls_first(c) for c in rest)).limit(at_most)
    equal = Window.partitionBy(*columns).orderBy(F.lit(1))
    head = head.withColumn("row_number", F.row_number().over(equal))
    if after is not None:
        same = F.lit(True)
        for c in columns:
            same = same & F.col(c).eqNullSafe(F.lit(after[c]).cast(df.schema[c].dataType))
        head = head.filter(~(same & (F.col("row_number") <= after["row_number"])))
    order = [F.desc_nulls_last(newest_first), *(F.asc_nulls_first(c) for c in rest), "row_number"]
    return head.orderBy(*order).limit(size)


def _before(rows: DataFrame, newest_first: str, rest: list[str], after: Row) -> Column:
    """True for rows that come before ``after``. Never NULL."""
    value = lambda c: F.lit(after[c]).cast(rows.schema[c].dataType)
    out, equal = F.lit(False), F.lit(True)
    for c in (newest_first, *rest):
        column = F.col(c)
        if c == newest_first:  # descending, NULL last
            less = column.isNotNull() if after[c] is None else F.coalesce(column > value(c), F.lit(False))
        else:  # ascending, NULL first
            less = F.lit(False) if after[c] is None else F.coalesce(column < value(c), F.lit(True))
        out = out | (equal & less)
        equal = equal & column.eqNullSafe(value(c))
    return out
