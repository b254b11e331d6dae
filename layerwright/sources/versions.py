"""Tables as versions behind a name: written aside, published by one metadata call, collected later.

The name of a table is a view. Each write makes a version: an external table of its own, in a folder of its own, in
the namespace ``<namespace>__versions``. Publishing points the view at the version with one ``CREATE OR REPLACE VIEW``, so the
name is never missing and never half written, and a reader that has resolved the name keeps reading the files of the
version it found. Old versions go when they have been out of use for ``retain``.

Several names are published together through a switch, a view of one row: first every name becomes "the old version while
the switch is off, the new one while it is on", which changes nothing anybody sees; then the switch is turned on,
one call; then the names are cleared of the switch, which again changes nothing. A run that stops anywhere leaves
either all old or all new rows. Spark folds the switch to a constant when it plans a query, so only one side is read.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime, timedelta
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from layerwright.sources.scratch import remove

VERSION, SWITCH, REPLACED = "layerwright.version", "layerwright.switch", "layerwright.replaces"
RETAIN = timedelta(hours=1)
_STAMP = "%Y%m%dt%H%M%S%f"


def quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def literal(value: str) -> str:
    """A text as SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Version:
    """A written version of a table: the public name, the name of the version's own table, its folder and its rows."""

    name: str
    table: str
    path: str
    rows: int = -1


def _namespace(spark: SparkSession, name: str) -> str:
    return name.rpartition(".")[0] or spark.catalog.currentDatabase()


def _full(spark: SparkSession, name: str) -> str:
    return f"{_namespace(spark, name)}.{name.rpartition('.')[2]}"


def _folder(spark: SparkSession, name: str) -> str:
    found = spark.catalog.getDatabase(quoted(_namespace(spark, name)))
    return f"{found.locationUri.rstrip('/')}/{name.rpartition('.')[2]}"


def fresh(spark: SparkSession, name: str) -> Version:
    """A version to be: nothing is written yet, no one has its name."""
    mark = f"{datetime.now(UTC).strftime(_STAMP)}_{uuid4().hex[:8]}"
    namespace = f"{_namespace(spark, name)}__versions"
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {quoted(namespace)}")
    full = _full(spark, name)
    return Version(full, f"{namespace}.{full.rpartition('.')[2]}__{mark}", f"{_folder(spark, full)}--{mark}")


def discard(spark: SparkSession, version: Version) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {quoted(version.table)}")
    remove(spark, version.path)


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    if not spark.catalog.tableExists(quoted(name)):
        return {}
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {quoted(name)}").collect()}


def _is_on(spark: SparkSession, switch: str) -> bool:
    return spark.catalog.tableExists(quoted(switch)) and bool(spark.table(quoted(switch)).first()["is_on"])


def live(spark: SparkSession, name: str) -> str | None:
    """The version's table that the name shows now, None if it shows none."""
    known = _properties(spark, _full(spark, name))
    if SWITCH in known and not _is_on(spark, known[SWITCH]):
        return known.get(REPLACED)
    return known.get(VERSION)


def define(spark: SparkSession, name: str, body: str, properties: dict[str, str]) -> None:
    """Create or replace a view: one metadata call, old or new for whoever looks."""
    listed = ", ".join(f"{literal(key)} = {literal(value)}" for key, value in properties.items())
    namespace = name.rpartition(".")[0]
    if not spark.catalog.databaseExists(quoted(namespace)):
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {quoted(namespace)}")
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(name)} TBLPROPERTIES ({listed}) AS {body}")


def _make_room(spark: SparkSession, name: str) -> None:
    """A table from elsewhere that has the name is in the way of the view."""
    if spark.catalog.tableExists(quoted(name)) and spark.catalog.getTable(quoted(name)).tableType != "VIEW":
        spark.sql(f"DROP TABLE {quoted(name)}")


def _show(spark: SparkSession, version: Version, properties: dict[str, str]) -> None:
    define(spark, version.name, f"SELECT * FROM {quoted(version.table)}", {**properties, VERSION: version.table})


def _columns(df: DataFrame, like: DataFrame) -> str:
    """The frame's columns in the order of the other's, NULL for those it lacks or has with another type."""
    own = dict(df.dtypes)
    return ", ".join(
        f"`{c}`" if own.get(c) == kind else f"CAST(NULL AS {kind}) AS `{c}`" for c, kind in like.dtypes
    )


def publish(
    spark: SparkSession, versions: list[Version], properties: dict[str, str] | None = None, retain: timedelta = RETAIN
) -> None:
    """Let all names show their new versions, at one moment."""
    properties = properties or {}
    for version in versions:
        _make_room(spark, version.name)
    if len(versions) > 1:
        switch = f"{versions[0].table.rpartition('.')[0]}.switch_{uuid4().hex}"
        _turn(spark, switch, False)
        for version in versions:
            _guard(spark, version, switch, properties)
        _turn(spark, switch, True)
    for version in versions:
        _show(spark, version, properties)
    if len(versions) > 1:
        spark.sql(f"DROP VIEW IF EXISTS {quoted(switch)}")
    for version in versions:
        collect(spark, version.name, retain)


def _turn(spark: SparkSession, switch: str, on: bool) -> None:
    define(spark, switch, f"SELECT {str(on).lower()} AS is_on", {"layerwright.kind": "switch"})


def _guard(spark: SparkSession, version: Version, switch: str, properties: dict[str, str]) -> None:
    """The name shows its present version while the switch is off. While names are switched, a column whose type
    changes is NULL on the old side and a column that goes is missing: the new version's columns are shown."""
    new, old = spark.table(quoted(version.table)), live(spark, version.name)
    body = f"SELECT {_columns(new, new)} FROM {quoted(version.table)} WHERE (SELECT is_on FROM {quoted(switch)})"
    kept = {}
    if old is not None and spark.catalog.tableExists(quoted(old)):
        columns = _columns(spark.table(quoted(old)), new)
        body += f" UNION ALL SELECT {columns} FROM {quoted(old)} WHERE NOT (SELECT is_on FROM {quoted(switch)})"
        kept = {REPLACED: old}
    define(spark, version.name, body, {**properties, VERSION: version.table, SWITCH: switch, **kept})


def _stamp(mark: str) -> datetime | None:
    try:
        return datetime.strptime(mark.partition("_")[0], _STAMP).replace(tzinfo=UTC)
    except ValueError:
        return None


def folders(spark: SparkSession, name: str) -> list[tuple[str, str]]:
    """(mark, folder) of all versions on disk, oldest first, also of those that a catalog in memory has forgotten."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{_folder(spark, _full(spark, name))}--*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    paths = [str(status.getPath().toString()) for status in found or ()]
    return sorted((path.rpartition("--")[2], path) for path in paths)


def collect(spark: SparkSession, name: str, retain: timedelta = RETAIN) -> list[str]:
    """Remove versions that were replaced longer ago than ``retain``, and those older than the present one that never
    were shown. The version that the name shows and newer ones stay. Returns the folders that went."""
    full = _full(spark, name)
    shown = live(spark, full)
    if shown is None:
        return []
    present, gone = shown.rpartition("__")[2], []
    found = [(mark, path) for mark, path in folders(spark, full) if _stamp(mark) is not None and mark <= present]
    for (mark, path), (following, _) in zip(found, found[1:], strict=False):
        if datetime.now(UTC) - _stamp(following) >= retain:
            discard(spark, Version(full, f"{_namespace(spark, full)}__versions.{full.rpartition('.')[2]}__{mark}", path))
            gone.append(path)
    return gone
