"""Full refresh of all layers from a raw file: raw -> validated and rejected -> summaries, reports, tests.

Each layer is written as a table before the next one reads it, so a lost executor costs the tasks of one layer
and a second run replaces every table with the same content. The tables of a run become visible together, at its end; a
run that was stopped goes on after the last layer it finished.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from datetime import UTC, datetime, timedelta
from functools import partial
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from layerwright.operators import checks, quality, summaries
from layerwright.operators.columns import apply_column_ops, with_audit
from layerwright.operators.enrich import enrich
from layerwright.operators.validate import split
from layerwright.plans import transactions as tx
from layerwright.plans.manifest import Manifest, fingerprint
from layerwright.sources.files import read_csv
from layerwright.sources.scratch import written
from layerwright.sources.tables import (
    ensure_namespace,
    publish,
    read_table,
    read_table_or_empty,
    stage_table,
    write_json_document,
)
from layerwright.sources.versions import RETAIN, Version
from layerwright.spec import RAW_RECORD, TableSpec

LAYERS = ("bronze", "silver", "quarantine", "gold", "quality")  # fixed values: namespaces


@dataclass(frozen=True)
class Layout:
    """Where the layers live: an optional configured catalog, a prefix for the namespaces, an optional root
    folder for them; format, codec and properties of the tables; how long replaced versions stay; whether the raw table
    is dealt by ranges of its sort columns."""

    catalog: str | None = None
    prefix: str = ""
    root: str | None = None
    source_format: str = "parquet"
    codec: str = "snappy"
    properties: Mapping[str, str] = field(default_factory=dict)
    retain: timedelta = RETAIN
    clustered: bool = False

    def namespace(self, layer: str) -> str:
        name = f"{self.prefix}{layer}"
        return f"{self.catalog}.{name}" if self.catalog else name

    def table(self, layer: str, table: str) -> str:
        return f"{self.namespace(layer)}.{table}"

    def location(self, layer: str) -> str | None:
        return f"{self.root}/{self.prefix}{layer}" if self.root else None

    def create(self, spark: SparkSession) -> None:
        for layer in LAYERS:
            ensure_namespace(spark, self.namespace(layer), self.location(layer))


def ingest(
    spark: SparkSession, path: str | list[str], spec: TableSpec, batch_id: str | None = None, raw_record: bool = False
) -> DataFrame:
    """Raw rows with declared types and audit columns; with ``raw_record``, also the lines that did not fit."""
    raw = apply_column_ops(read_csv(spark, path, spec, raw_record), spec)
    return with_audit(raw, spec.key, batch_id or datetime.now().strftime("%Y%m%d_%H%M%S"))


def shared_rollup(silver: DataFrame) -> DataFrame:
    return summaries.rollup(silver, [tx.SUMMARIES[name] for name in tx.SHARED_ROLLUP])


def gold_frames(silver: DataFrame, rolled: DataFrame | None = None) -> dict[str, DataFrame]:
    """The seven tables of the last layer. With ``rolled``, a written ``shared_rollup``, four of the summaries
    come from it, and the validated table is read four times instead of seven."""
    frames = {}
    for name, summary in tx.SUMMARIES.items():
        if rolled is not None and name in tx.SHARED_ROLLUP:
            frames[name] = summaries.summarise_rollup(rolled, summary)
        else:
            frames[name] = summaries.summarise(silver, summary)
    frames["high_risk_transactions"] = summaries.extract(silver, tx.is_high_risk_row(), tx.HIGH_RISK_COLUMNS)
    frames["top_sale_receivers"] = summaries.top_latest(silver, **tx.top_receivers_args())
    return frames


def report_frames(
    bronze: DataFrame, silver: DataFrame, generated_at: str, spec: TableSpec = tx.SPEC
) -> dict[str, DataFrame]:
    return {
        "silver_report": quality.clean_report(silver, tx.clean_checks(spec), generated_at),
        "bronze_quality_report": quality.raw_report(bronze, tx.raw_checks(spec)),
        "bronze_quality_distributions": quality.distributions(bronze, tx.raw_dimensions(), tx.NULL_LABEL),
    }


def report_document(
    silver: DataFrame,
    rejected: DataFrame,
    generated_at: str,
    spec: TableSpec = tx.SPEC,
    results: DataFrame | None = None,
) -> DataFrame:
    """The nested report. With ``results``, the written report of the valid rows, no check runs again."""
    return quality.report_document(
        quality.check_results(silver, tx.clean_checks(spec)) if results is None else results,
        silver,
        rejected,
        tx.clean_checks(spec),
        tx.document_dimensions(spec),
        tx.clean_bands(),
        spec.rejects.reason_column,
        generated_at,
    )


def _write_all(jobs: list[Callable[[], Any]]) -> list:
    """Run writes that do not depend on each other side by side: the last, slow tasks of one leave executors idle
    that the next can use."""
    with ThreadPoolExecutor(max_workers=4) as pool:
        return list(pool.map(lambda job: job(), jobs))


Tables = dict[tuple[str, str], Version]


@dataclass(frozen=True)
class Refresh:
    """The steps of a refresh. Each reads the tables of the step before and replaces its own, so steps can be run
    one by one, in separate applications, or again; the tables of a step become visible together. ``run`` does all
    steps and lets all tables become visible together. They return the row counts of the tables they wrote."""

    spark: SparkSession
    layout: Layout = Layout()
    spec: TableSpec = tx.SPEC
    #: Versions that this run has written and not yet published; its later steps read them.
    pending: Mapping[tuple[str, str], Version] = field(default_factory=dict)

    def __post_init__(self):
        zone = self.spark.conf.get("spark.sql.session.timeZone")
        if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
            raise ValueError(f"dates of a refresh are UTC dates: set spark.sql.session.timeZone to UTC, not {zone}")

    def _stage(self, frames: dict[tuple[str, str], DataFrame], **how) -> Tables:
        for layer in dict.fromkeys(layer for layer, _ in frames):
            ensure_namespace(self.spark, self.layout.namespace(layer), self.layout.location(layer))
        how |= {"source_format": self.layout.source_format, "codec": self.layout.codec}
        how["properties"] = dict(self.layout.properties)
        jobs = [
            partial(stage_table, df, self.layout.table(layer, table), compact=layer == "quarantine", **how)
            for (layer, table), df in frames.items()
        ]
        return dict(zip(frames, _write_all(jobs), strict=True))

    def _publish(self, tables: Tables) -> dict[str, int]:
        publish(self.spark, list(tables.values()), dict(self.layout.properties), self.layout.retain)
        return {".".join(name): version.rows for name, version in tables.items()}

    def table(self, layer: str, table: str | None = None) -> DataFrame:
        name = (layer, table or self.spec.table)
        return read_table(self.spark, self.pending[name].table if name in self.pending else self.layout.table(*name))

    def rejected(self, like: DataFrame) -> DataFrame:
        """The rejected rows; none where that table was never written."""
        if ("quarantine", self.spec.table) in self.pending:
            return self.table("quarantine")
        schema = split(like, self.spec).rejected.schema
        return read_table_or_empty(self.spark, self.layout.table("quarantine", self.spec.table), schema)

    def stage_raw(self, path: str, batch_id: str | None = None) -> Tables:
        rows = ingest(self.spark, path, self.spec, batch_id, raw_record=True)
        how = {"partition_by": self.spec.partition_by, "sort_by": self.spec.sort_by, "clustered": self.layout.clustered}
        return self._stage({("bronze", self.spec.table): rows}, **how)

    def stage_clean(self) -> Tables:
        valid, rejected = split(self.table("bronze"), self.spec)
        silver = enrich(valid.drop(RAW_RECORD), self.spec.derivations)
        return self._stage({("silver", self.spec.table): silver, ("quarantine", self.spec.table): rejected})

    def stage_summaries(self) -> Tables:
        silver = self.table("silver")
        with written(shared_rollup(silver), "rollup") as rolled:
            return self._stage({("gold", t): summaries.stamped(df) for t, df in gold_frames(silver, rolled).items()})

    def stage_reports(self, now: str) -> Tables:
        frames = report_frames(self.table("bronze"), self.table("silver"), now, self.spec)
        return self._stage({("quality", table): df for table, df in frames.items()})

    def write_document(self, path: str, now: str) -> None:
        silver, results = self.table("silver"), self.table("quality", "silver_report")
        document = report_document(silver, self.rejected(self.table("bronze")), now, self.spec, results)
        write_json_document(document, path)

    def write_raw(self, path: str, batch_id: str | None = None) -> dict[str, int]:
        return self._publish(self.stage_raw(path, batch_id))

    def write_clean(self) -> dict[str, int]:
        return self._publish(self.stage_clean())

    def write_summaries(self) -> dict[str, int]:
        return self._publish(self.stage_summaries())

    def write_reports(self, document_path: str | None = None) -> dict[str, int]:
        now = datetime.now(UTC).isoformat()
        counts = self._publish(self.stage_reports(now))
        if document_path:
            self.write_document(document_path, now)
        return counts

    def manifest(self) -> Manifest:
        return Manifest(self.spark, f"{self.layout.namespace('bronze')}__versions.run_{self.spec.table}")

    def run(self, path: str, document_path: str | None = None) -> dict[str, int]:
        """Rebuild every table from the raw file or folder at ``path``. All tables show their new rows at one moment, after
        the last one is written. If an earlier run over the same files and spec was stopped, the layers it had finished
        are taken over. (Tables of a configured catalog are replaced one by one, each in one commit.)"""
        self.layout.create(self.spark)
        now = datetime.now(UTC).isoformat()
        steps = {
            "raw": lambda run: run.stage_raw(path),
            "clean": lambda run: run.stage_clean(),
            "summaries": lambda run: run.stage_summaries(),
            "reports": lambda run: run.stage_reports(now),
        }
        own_catalog = self.layout.catalog is not None
        mark = "" if own_catalog else fingerprint(self.spark, path, repr(self.spec), repr(self.layout))
        done = {} if own_catalog else self.manifest().finished(mark)
        run = self
        for step, stage in steps.items():
            if step in done:
                tables = run._known(done[step])
            else:
                tables = stage(run)
                done[step] = list(tables.values())
                if not own_catalog:
                    self.manifest().record(mark, done)
            run = replace(run, pending={**run.pending, **tables})
        counts = self._publish(dict(run.pending))
        if document_path:
            run.write_document(document_path, now)
        if not own_catalog:
            self.manifest().clear()
        return counts

    def _known(self, found: list[Version]) -> Tables:
        """The versions of a finished step by layer and table."""
        layers = {self.layout.namespace(layer): layer for layer in LAYERS}
        names = [version.name.rpartition(".") for version in found]
        return {(layers[namespace], table): version for (namespace, _, table), version in zip(names, found, strict=True)}

    def tests(self, examples: int = 0) -> DataFrame:
        """All declared tests over the tables of a finished refresh."""
        plan = tx.table_tests(self.spec)
        layer = {name: "quality" if name.startswith("bronze_") else "gold" for name in plan}
        frames = {name: self.table(layer[name], name) for name in plan if name != "silver"}
        return checks.run_all_tests({"silver": self.table("silver"), **frames}, plan, examples)

    def invariants(self) -> DataFrame:
        bronze = self.table("bronze")
        gold = {name: self.table("gold", name) for name in (*tx.SUMMARIES, "high_risk_transactions", "top_sale_receivers")}
        return invariants(bronze, self.table("silver"), self.rejected(bronze), gold, self.spec)

    def write_tests(self) -> dict[str, int]:
        """The results of all tests, with examples, and invariants as tables ``table_tests`` and ``invariants`` of the
        quality layer."""
        results = {("quality", "table_tests"): self.tests(examples=3), ("quality", "invariants"): self.invariants()}
        return self._publish(self._stage(results))


def conserved_columns(bronze: DataFrame, parts: dict[str, DataFrame], spec: TableSpec = tx.SPEC) -> dict[str, str]:
    """The columns that a row keeps on its way through the split, with the type in which both sides can be compared:
    all that no rule derives anew, and those that a rule merely casts."""
    derived = {rule.column: rule for rule in spec.derivations}
    kept = {}
    for name, kind in bronze.dtypes:
        rule = derived.get(name)
        if all(name in part.columns for part in parts.values()) and (
            rule is None or (rule.transform == "cast" and rule.source == name)
        ):
            kept[name] = kind if rule is None else rule.type
    return kept


def invariants(
    bronze: DataFrame,
    silver: DataFrame,
    rejected: DataFrame,
    gold: dict[str, DataFrame] | None = None,
    spec: TableSpec = tx.SPEC,
) -> DataFrame:
    """Row conservation, the row-level truths of both sides of the split, and that no table is empty."""
    own = {"silver": tx.clean_invariants(spec), "quarantine": tx.reject_invariants(spec)}
    parts = {"silver": silver, "quarantine": rejected}
    result = checks.conservation(bronze, parts, conserved_columns(bronze, parts, spec), own, "bronze")
    for table, frame in (gold or {}).items():
        result = result.unionByName(checks.run_invariants(frame, table, {}))
    return result
