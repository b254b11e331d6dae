"""Declarative description of one table: schema, column operations, validity, derived columns, reject reasons.

A spec is a small driver-side object. It is checked when it is built, so a typo in a transform, a condition
or an operator fails before any job starts. The ``operators`` package compiles it to Column expressions.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any

from layerwright.functions.predicates import COMPARISONS

# The words a spec file may use.
TRANSFORMS = ("cast", "to_timestamp", "to_date", "isin", "threshold", "buckets", "current_timestamp")
CONDITIONS = ("null_or_threshold", "not_in", "null_or_range")
REQUIREMENTS = ("not_null", "above", "in", "between")

#: The column with the line of a raw file that does not fit the declared columns.
RAW_RECORD = "_raw_record"


def _known(word: str | None, allowed, what: str) -> None:
    if word not in allowed:
        raise ValueError(f"unknown {what} {word!r}; expected one of {', '.join(allowed)}")


def _known_parts(cls: type, raw: Mapping) -> dict:
    """Those entries that the class has fields for; notes and other extras in a spec file do no harm."""
    return {f.name: raw[f.name] for f in fields(cls) if f.name in raw}


def _names(value: Any) -> tuple[str, ...]:
    """One name, a list of names or nothing, as a tuple."""
    if value is None:
        return ()
    return tuple(map(str, value)) if isinstance(value, (list, tuple)) else (str(value),)


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    nullable: bool = True
    precision: int | None = None
    scale: int | None = None


@dataclass(frozen=True)
class Bucket:
    """A labelled upper bound (exclusive). Without a bound it is the label of everything else."""

    label: str
    max: float | None = None
    otherwise: bool = False

    @property
    def is_rest(self) -> bool:
        return self.otherwise or self.max is None


@dataclass(frozen=True)
class Derivation:
    """One derived (or replaced) column."""

    column: str
    transform: str
    source: str | None = None
    type: str | None = None
    source_cast: str | None = None
    values: tuple = ()
    operator: str | None = None
    value: float | None = None
    buckets: tuple[Bucket, ...] = ()

    def __post_init__(self):
        _known(self.transform, TRANSFORMS, f"transform for column {self.column!r}:")
        if self.transform == "threshold":
            _known(self.operator, COMPARISONS, f"operator for column {self.column!r}:")
        if self.transform == "buckets" and all(b.is_rest for b in self.buckets):
            raise ValueError(f"buckets of column {self.column!r} have no upper bound at all")

    @classmethod
    def from_dict(cls, raw: Mapping) -> Derivation:
        parts = _known_parts(cls, raw)
        parts["values"] = tuple(parts.get("values") or ())
        parts["buckets"] = tuple(Bucket(**_known_parts(Bucket, b)) for b in parts.get("buckets") or ())
        return cls(**parts)


@dataclass(frozen=True)
class Requirement:
    """One condition that a row must meet to be valid. A NULL never meets it."""

    column: str
    test: str
    value: float | None = None
    values_ref: str | None = None
    min: float | None = None
    max: float | None = None

    def __post_init__(self):
        _known(self.test, REQUIREMENTS, f"test for column {self.column!r}:")


@dataclass(frozen=True)
class Condition:
    type: str
    column: str | None = None
    operator: str | None = None
    value: float | None = None
    values_ref: str | None = None
    min: float | None = None
    max: float | None = None

    def __post_init__(self):
        _known(self.type, CONDITIONS, "reject condition")
        if self.type == "null_or_threshold":
            _known(self.operator, COMPARISONS, f"operator for column {self.column!r}:")


@dataclass(frozen=True)
class RejectRule:
    reason: str
    condition: Condition


@dataclass(frozen=True)
class Rejects:
    """How invalid rows are labelled: the first rule that matches gives the reason. With ``malformed``, a row whose raw
    record did not fit the declared columns is invalid, and that is its reason before all rules."""

    reason_column: str = "_rejection_reason"
    time_column: str = "_quarantine_time"
    rules: tuple[RejectRule, ...] = ()
    malformed: str | None = None

    @classmethod
    def from_dict(cls, raw: Mapping) -> Rejects:
        return cls(
            reason_column=raw["rejection_column"],
            time_column=raw["timestamp_column"],
            rules=tuple(RejectRule(r["reason"], Condition(**r["condition"])) for r in raw.get("rules") or ()),
            malformed=raw.get("malformed_reason"),
        )


# What makes a transaction row valid when a spec file does not list its own rules.
TRANSACTION_REQUIREMENTS = (
    Requirement("timestamp", "not_null"),
    Requirement("sending_address", "not_null"),
    Requirement("receiving_address", "not_null"),
    Requirement("amount", "above", value=0),
    Requirement("transaction_type", "in", values_ref="valid_transaction_types"),
    Requirement("location_region", "in", values_ref="valid_regions"),
    Requirement("anomaly", "in", values_ref="valid_anomalies"),
    Requirement("risk_score", "between", min=0, max=100),
)


@dataclass(frozen=True)
class TableSpec:
    key: str
    table: str
    fields: tuple[Field, ...] = ()
    rename: Mapping[str, str] = field(default_factory=dict)
    drop: tuple[str, ...] = ()
    cast: Mapping[str, str] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()
    domains: Mapping[str, tuple] = field(default_factory=dict)
    requirements: tuple[Requirement, ...] = TRANSACTION_REQUIREMENTS
    derivations: tuple[Derivation, ...] = ()
    rejects: Rejects = Rejects()

    def domain(self, name: str | None) -> list:
        """Values of a named list; a list nobody declared is empty."""
        return list(self.domains.get(name, ()))

    @classmethod
    def from_dict(cls, key: str, raw: Mapping) -> TableSpec:
        validation = dict(raw.get("validation") or {})
        rules = validation.pop("rules", None)
        silver = raw.get("silver") or {}
        rejects = silver.get("quarantine")
        return cls(
            key=key,
            table=raw["table"],
            fields=tuple(Field(**_known_parts(Field, f)) for f in raw.get("schema") or ()),
            rename=dict(raw.get("rename_columns") or {}),
            drop=_names(raw.get("drop_columns")),
            cast=dict(raw.get("cast_columns") or {}),
            partition_by=_names(raw.get("partition_by")),
            sort_by=_names(raw.get("sort_order")),
            domains={name: tuple(values or ()) for name, values in validation.items()},
            requirements=TRANSACTION_REQUIREMENTS if rules is None else tuple(Requirement(**r) for r in rules),
            derivations=tuple(map(Derivation.from_dict, silver.get("enrichment") or ())),
            rejects=Rejects.from_dict(rejects) if rejects else Rejects(),
        )


def load_spec(path: str | Path, key: str) -> TableSpec:
    """The spec of source file ``key`` from a YAML or JSON file with a top-level ``files`` mapping."""
    path = Path(path)
    if path.suffix == ".json":
        content = json.loads(path.read_text())
    else:
        import yaml  # only needed for YAML spec files

        content = yaml.safe_load(path.read_text())
    files = (content or {}).get("files") or {}
    if key not in files:
        raise KeyError(f"{path} describes no source file {key!r}")
    return TableSpec.from_dict(key, files[key])
