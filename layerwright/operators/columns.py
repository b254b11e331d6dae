"""Column operations of the first layer: rename, drop, cast, audit columns."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.functions.scalars import soft_cast
from layerwright.spec import TableSpec

log = logging.getLogger(__name__)


def _present(df: DataFrame, names, action: str) -> list[str]:
    """Those names the frame has; the others are reported and left alone."""
    for name in names:
        if name not in df.columns:
            log.warning("%s skipped: there is no column %r", action, name)
    return [name for name in names if name in df.columns]


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    for old, new in names.items():  # one after the other: a new name may be renamed again
        if _present(df, [old], "rename"):
            df = df.withColumnRenamed(old, new)
    return df


def drop(df: DataFrame, names) -> DataFrame:
    return df.drop(*_present(df, names, "drop"))


def cast(df: DataFrame, types: dict[str, str]) -> DataFrame:
    present = _present(df, types, "cast")
    return df.withColumns({c: soft_cast(F.col(c), df.schema[c].dataType, types[c]) for c in present})


def apply_column_ops(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rename, then drop, then cast."""
    return cast(drop(rename(df, spec.rename), spec.drop), spec.cast)


def with_audit(df: DataFrame, source: str, batch_id: str) -> DataFrame:
    return df.withColumns(
        {"_ingestion_time": F.current_timestamp(), "_source_file": F.lit(source), "_batch_id": F.lit(batch_id)}
    )
