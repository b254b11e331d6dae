"""Grouped summaries, row extracts and latest-per-key top lists.

A summary is data: its keys and its measures. Sums and averages of doubles do not depend on the order or the partitions
of the rows (``functions/exact.py``). Two plans compute it, with the same result:

* ``summarise`` groups the rows directly. Map-side partial aggregation sends one row per group and task over
  the network, so a key that owns a third of all rows costs no more than any other.
* ``rollup`` groups the rows once by the keys of several summaries and keeps parts that can be merged (counts,
  sums, minima, maxima). ``summarise_rollup`` then derives each summary from that small table, so the big table
  is read once for all of them. Put summaries together whose keys have few values between them: each task holds
  one entry per combination. A summary with a fine key, such as a date, is better grouped directly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, FractionalType, StructType

from layerwright.functions import exact


@dataclass(frozen=True)
class Measure:
    """``kind`` is rows, rows_where, sum, avg, min or max. ``where`` is the SQL condition of rows_where."""

    name: str
    kind: str
    column: str | None = None
    digits: int | None = None
    where: str | None = None


@dataclass(frozen=True)
class Summary:
    keys: tuple[str, ...]
    measures: tuple[Measure, ...]
    order_by_desc: str | None = None


def _rounded(column: Column, measure: Measure) -> Column:
    return (column if measure.digits is None else F.round(column, measure.digits)).alias(measure.name)


def _ordered(df: DataFrame, summary: Summary) -> DataFrame:
    if summary.order_by_desc is None:
        return df
    return df.orderBy(F.desc(summary.order_by_desc), *summary.keys)


def _is_double(schema: StructType, measure: Measure) -> bool:
    return measure.kind in ("sum", "avg") and isinstance(schema[measure.column].dataType, FractionalType) and not isinstance(
        schema[measure.column].dataType, DecimalType
    )


def aggregated(kind: str, column: str, schema: StructType) -> Column:
    """A sum, average, minimum or maximum; sums and averages of doubles do not depend on the order of rows."""
    if _is_double(schema, Measure("", kind, column)):
        return exact.exact_sum(F.col(column)) if kind == "sum" else exact.exact_avg(F.col(column))
    return getattr(F, kind)(column)


def _direct(measure: Measure, schema: StructType) -> Column:
    match measure.kind:
        case "rows":
            return F.count("*")
        case "rows_where":
            return F.count_if(F.expr(measure.where))
        case "sum" | "avg" | "min" | "max":
            return aggregated(measure.kind, measure.column, schema)
    raise ValueError(f"unknown kind of measure {measure.kind!r}")


def summarise(df: DataFrame, summary: Summary) -> DataFrame:
    """One row per key combination, rows grouped directly."""
    measures = [_rounded(_direct(m, df.schema), m) for m in summary.measures]
    return _ordered(df.groupBy(*summary.keys).agg(*measures), summary)


def _exact_name(column: str, part: str) -> str:
    return f"exact {part} of {column}"


def _parts(measure: Measure, schema: StructType) -> dict[str, Column]:
    """Mergeable parts of a measure, by the column name they have in the rollup."""
    c = measure.column
    match measure.kind:
        case "rows":
            return {"rows": F.count("*")}
        case "rows_where":
            return {f"rows where {measure.where}": F.count_if(F.expr(measure.where))}
        case "sum" | "avg" if _is_double(schema, measure):
            return {_exact_name(c, name): part for name, part in exact.sum_parts(F.col(c)).items()}
        case "sum":
            return {f"sum of {c}": F.sum(c)}
        case "avg":
            return {f"sum of {c}": F.sum(c), f"count of {c}": F.count(c)}
        case "min":
            return {f"min of {c}": F.min(c)}
        case "max":
            return {f"max of {c}": F.max(c)}
    raise ValueError(f"unknown kind of measure {measure.kind!r}")


def _merged(measure: Measure, columns: list[str]) -> Column:
    c = measure.column
    if measure.kind in ("sum", "avg") and _exact_name(c, "count") in columns:
        parts = {name: F.sum(f"`{_exact_name(c, name)}`") for name in exact.PARTS}
        return exact.total(parts) if measure.kind == "sum" else F.try_divide(exact.total(parts), parts["count"])
    match measure.kind:
        case "rows":
            return F.sum("rows")
        case "rows_where":
            return F.sum(f"`rows where {measure.where}`")
        case "min" | "max":
            return getattr(F, measure.kind)(f"`{measure.kind} of {c}`")
        case "avg":
            return F.try_divide(F.sum(f"`sum of {c}`").cast("double"), F.sum(f"`count of {c}`"))
    return F.sum(f"`sum of {c}`")


def rollup(df: DataFrame, summaries) -> DataFrame:
    """Mergeable parts of the summaries, grouped by the union of their keys: one scan, one shuffle."""
    keys = list(dict.fromkeys(key for s in summaries for key in s.keys))
    parts = {name: part for s in summaries for m in s.measures for name, part in _parts(m, df.schema).items()}
    return df.groupBy(*keys).agg(*(part.alias(name) for name, part in parts.items()))


def summarise_rollup(rolled: DataFrame, summary: Summary) -> DataFrame:
    """The summary from a ``rollup`` that covers it; equals ``summarise`` on the rows."""
    measures = [_rounded(_merged(m, rolled.columns), m) for m in summary.measures]
    return _ordered(rolled.groupBy(*summary.keys).agg(*measures), summary)


def extract(df: DataFrame, condition: Column, columns) -> DataFrame:
    """Chosen columns of the matching rows; the condition and the column list reach the scan."""
    return df.filter(condition).select(*columns)


def latest_per_key(df: DataFrame, key: str, newest_first) -> DataFrame:
    """The first row of each key under an ordering that leaves no ties open.

    This returns whole rows. Spark keeps one row per key and task before the shuffle (window group limit), so a
    hot key moves as many rows as there are tasks, not as many as it owns.
    """
    window = Window.partitionBy(key).orderBy(*newest_first)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def top_latest(
    df: DataFrame, *, where: Column, key: str, time: str, measure: str, k: int, digits: int | None = None
) -> DataFrame:
    """Of each key's latest row, the ``k`` with the largest measure. Of several rows at the latest moment the
    one with the largest measure counts; equal measures are listed by key.

    Only time and measure of the latest row are wanted, so the largest (time, measure) pair per key is an
    aggregate that merges within each task. It sorts by key alone, where a window sorts by all three."""
    pair = F.max(F.struct(F.col(time), F.col(measure))).alias("latest")
    latest = df.filter(where).groupBy(key).agg(pair).select(key, "latest.*")
    shown = F.col(measure) if digits is None else F.round(measure, digits)
    return latest.orderBy(F.desc(measure), key).limit(k).select(key, shown.alias(measure), time)


def stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("_created_at", F.current_timestamp())
