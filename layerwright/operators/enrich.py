"""Derived columns from declared rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType

from layerwright.functions.predicates import compare, member, number
from layerwright.functions.scalars import soft_cast, tiers
from layerwright.spec import Derivation


def _moment(rule: Derivation, schema: StructType) -> Column:
    """The source as a timestamp, NULL where it is none; with a numeric pre-cast it holds epoch seconds."""
    source, kind = F.col(rule.source), schema[rule.source].dataType
    if rule.source_cast:
        if isinstance(kind, TimestampNTZType):
            source = source.cast("timestamp")  # a timestamp without zone has no epoch seconds of its own
        source = soft_cast(source, kind, rule.source_cast)
    return source.try_cast("timestamp")


def derived(rule: Derivation, schema: StructType) -> Column:
    match rule.transform:
        case "cast":
            return soft_cast(F.col(rule.source), schema[rule.source].dataType, rule.type)
        case "to_timestamp":
            return _moment(rule, schema)
        case "to_date":
            return F.to_date(_moment(rule, schema))
        case "isin":
            return member(rule.source, rule.values, schema)
        case "threshold":
            return compare(number(rule.source, schema), rule.operator, rule.value)
        case "buckets":
            return tiers(number(rule.source, schema), rule.buckets)
        case "current_timestamp":
            return F.current_timestamp()


def enrich(df: DataFrame, rules) -> DataFrame:
    """Apply the rules in order; a rule sees what earlier rules made of its source. Rules that do not depend
    on each other share one projection, which keeps the plan flat however long the list is."""
    batch: dict[str, Column] = {}
    for rule in rules:
        if rule.source in batch or rule.column in batch:
            df, batch = df.withColumns(batch), {}
        batch[rule.column] = derived(rule, df.schema)
    return df.withColumns(batch) if batch else df
