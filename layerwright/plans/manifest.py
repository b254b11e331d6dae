"""What a run has finished so far, so that a run that was stopped goes on from there.

The manifest is a view next to the versions it lists, replaced by one metadata call after each step: one row per written
version with the step it belongs to and the fingerprint of the input. It lives as long as the catalog that knows these
versions, and anybody can read it with SQL.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from layerwright.operators import multiset
from layerwright.sources import versions
from layerwright.sources.versions import Version, quoted

COLUMNS = ("fingerprint", "step", "table_name", "version", "path", "row_count")


def fingerprint(spark: SparkSession, path: str | list[str], *settings) -> str:
    """Names, sizes and times of the input files, and the settings of the run. File contents are not read."""
    files = spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")
    sums = multiset.checksum([F.col(c) for c in files.columns])
    row = files.agg(*(value.alias(name) for name, value in sums.items())).first()
    return hashlib.sha256(repr((tuple(row), settings)).encode()).hexdigest()


@dataclass(frozen=True)
class Manifest:
    spark: SparkSession
    name: str

    def read(self) -> dict[str, dict[str, list[Version]]]:
        """Versions by fingerprint and step, in the order of the steps."""
        found: dict[str, dict[str, list[Version]]] = {}
        if self.spark.catalog.tableExists(quoted(self.name)):
            for mark, step, *version in self.spark.table(quoted(self.name)).orderBy("place").select(*COLUMNS).collect():
                found.setdefault(mark, {}).setdefault(step, []).append(Version(*version))
        return found

    def finished(self, mark: str) -> dict[str, list[Version]]:
        """The steps that a run over this input has finished, up to the first whose versions are not all there. What a
        run over other input has left behind is removed."""
        runs = self.read()
        for other in runs.keys() - {mark}:
            for version in sum(runs[other].values(), []):
                if versions.live(self.spark, version.name) != version.table and version.path:
                    versions.discard(self.spark, version)
        done = {}
        for step, written in runs.get(mark, {}).items():
            if not all(self.spark.catalog.tableExists(quoted(version.table)) for version in written):
                break
            done[step] = written
        return done

    def record(self, mark: str, steps: dict[str, list[Version]]) -> None:
        rows = [
            (i, mark, step, version.name, version.table, version.path, version.rows)
            for i, (step, version) in enumerate((step, version) for step, written in steps.items() for version in written)
        ]
        body = ", ".join(f"({', '.join(f'{v}L' if isinstance(v, int) else versions.literal(v) for v in row)})" for row in rows)
        versions.define(self.spark, self.name, f"SELECT * FROM VALUES {body} AS run(place, {', '.join(COLUMNS)})", {"layerwright.kind": "manifest"})

    def clear(self) -> None:
        self.spark.sql(f"DROP VIEW IF EXISTS {quoted(self.name)}")
