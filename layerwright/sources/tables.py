"""Catalog tables: scans and create-or-replace writes. In the session catalog a table is a name over versions."""

from __future__ import annotations

from dataclasses import replace
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layerwright.sources import versions
from layerwright.sources.versions import quoted as _quoted


def _has_own_catalog(spark: SparkSession, name: str) -> bool:
    """True for ``catalog.namespace.table`` names whose catalog is configured in the session."""
    parts = name.split(".")
    return len(parts) > 2 and spark.conf.get(f"spark.sql.catalog.{parts[0]}", None) is not None


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(_quoted(name))


def read_table_or_empty(spark: SparkSession, name: str, schema: StructType) -> DataFrame:
    """The table, or no rows of ``schema`` where it does not exist."""
    if spark.catalog.tableExists(_quoted(name)):
        return read_table(spark, name)
    return spark.createDataFrame([], schema)


def ensure_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {_quoted(name)}{where}")


def _order(terms) -> list[Column]:
    """Columns to sort by, from terms such as ``day``, ``day desc`` or ``region, day desc``."""
    directions = {"": F.asc, "asc": F.asc, "desc": F.desc}
    order = []
    for term in ",".join(terms).split(",") if terms else []:
        name, _, direction = term.strip().partition(" ")
        if direction.strip().lower() not in directions:
            raise ValueError(f"cannot sort by {term.strip()!r}")
        order.append(directions[direction.strip().lower()](name))
    return order


#: Table properties that hold the codec and the write order where a configured catalog keeps the files.
CODEC_PROPERTY, ORDER_PROPERTY = "write.parquet.compression-codec", "write.sort-by"


#: Rows that a task of a clustered write sorts, about.
CLUSTER_ROWS = 500_000


def _ranges(df: DataFrame) -> int:
    """So many ranges that none of them grows with the table; those of the session at least."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // CLUSTER_ROWS))


def stage_table(
    df: DataFrame,
    name: str,
    *,
    partition_by=(),
    sort_by=(),
    clustered: bool = False,
    compact: bool = False,
    source_format: str = "parquet",
    codec: str = "snappy",
    properties: dict[str, str] | None = None,
) -> versions.Version:
    """Write ``df`` as the next version of a table, which nobody sees before it is published. Its rows are counted
    while they are written. A write that fails leaves nothing behind.

    In a configured catalog there are no versions: the table is replaced in one commit, at once; codec and write order
    become table properties there.

    Partition columns may be skewed (one value with a third of all rows) or rare. The rebalance hint lets
    adaptive execution split the first kind over many tasks and merge the second kind, so neither one huge
    task nor a flood of small files appears. ``compact`` does the same without columns, for rows that are few
    compared with the scan they come from and would else leave one tiny file per scan task. Other writes do
    not shuffle.

    ``sort_by`` alone orders the rows inside each file. ``clustered`` also deals them by ranges of the sort columns, so that
    files do not overlap and a filter on them reads a few files: Spark samples the rows for the bounds (one more pass
    over the input) and shuffles them once. A hash of the row comes last among the range columns, so a value that a third
    of all rows share spans many files instead of one. The rows are counted first (a pass without columns), and the ranges are as
    many as it takes for a task to sort ``CLUSTER_ROWS`` rows or so, however large the table. The count sits above every shuffle, so a stage that is run again after a lost executor does not
    count twice.
    """
    spark = df.sparkSession
    if clustered and (partition_by or sort_by):
        row_hash = F.xxhash64(*(F.col(f"`{c}`") for c in df.columns))
        df = df.repartitionByRange(_ranges(df), *(F.col(f"`{c}`") for c in partition_by), *_order(sort_by), row_hash)
    elif partition_by or compact:
        df = df.hint("rebalance", *(F.col(c) for c in partition_by))
    if partition_by or sort_by:
        df = df.sortWithinPartitions(*partition_by, *_order(sort_by))
    written = Observation()
    df = df.observe(written, F.count("*").alias("rows"))

    if _has_own_catalog(spark, name):
        writer = df.writeTo(_quoted(name)).using(source_format)
        recorded = {CODEC_PROPERTY: codec} | ({ORDER_PROPERTY: ", ".join(sort_by)} if sort_by else {})
        for key, value in (recorded | (properties or {})).items():
            writer = writer.tableProperty(key, value)
        if partition_by:
            writer = writer.partitionedBy(*(F.col(c) for c in partition_by))
        writer.createOrReplace()
        return versions.Version(name, name, "", written.get["rows"])
    version = versions.fresh(spark, name)
    writer = df.write.format(source_format).option("compression", codec).option("path", version.path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.saveAsTable(_quoted(version.table))
    except BaseException:
        versions.discard(spark, version)
        raise
    return replace(version, rows=written.get["rows"])


def publish(
    spark: SparkSession,
    staged: list[versions.Version],
    properties: dict[str, str] | None = None,
    retain: timedelta = versions.RETAIN,
) -> None:
    """Let the names of all staged versions show them, at one moment; see ``sources/versions.py``."""
    versions.publish(spark, [v for v in staged if v.path], properties, retain)


def replace_table(
    df: DataFrame,
    name: str,
    *,
    properties: dict[str, str] | None = None,
    retain: timedelta = versions.RETAIN,
    **how,
) -> int:
    """Write ``df`` as the whole new content of a table and return its row count. ``how`` is that of ``stage_table``.

    A configured catalog replaces the table in one commit. In the session catalog a new version is written and then
    shown under the name by one metadata call: a write that fails leaves the old content as it was, the name is
    never missing, nothing of the old content can shine through, whatever the session's partition overwrite mode,
    and who still reads the old version can do so until it is collected, ``retain`` after the swap."""
    version = stage_table(df, name, properties=properties, **how)
    publish(df.sparkSession, [version], properties, retain)
    return version.rows


def replace_table_from_sql(
    spark: SparkSession, name: str, query: str, sources: dict[str, DataFrame] | None = None, **how
) -> int:
    """Materialise the result of a SQL text. ``{word}`` in it stands for the frame ``sources[word]``."""
    return replace_table(spark.sql(query, **(sources or {})), name, **how)


def write_json_document(document: DataFrame, path: str) -> None:
    """One-row frame as one JSON text file under ``path``."""
    text = F.to_json(F.struct(*document.columns), {"ignoreNullFields": "false", "pretty": "true"})
    document.select(text.alias("value")).write.mode("overwrite").text(path)
