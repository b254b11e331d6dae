import json

import pytest
import yaml
from pyspark.sql import types as T

from layerwright.plans.transactions import SPEC
from layerwright.sources.files import spark_schema
from layerwright.spec import Bucket, Condition, Derivation, Field, Requirement, TableSpec, load_spec

YAML = """
files:
  a.csv:
    table: tb_a
    schema:
      - {name: id, type: BIGINT, nullable: false, description: a note}
      - {name: price, type: decimal, precision: 10, scale: 0}
      - {name: cost, type: Decimal}
      - {name: blob, type: geometry}
    validation:
      valid_regions: [x, y]
    silver:
      enrichment:
        - {column: big, transform: threshold, source: id, operator: ">", value: 3}
        - column: size
          transform: buckets
          source: id
          buckets: [{label: s, max: 2}, {label: l, otherwise: true}]
      quarantine:
        rejection_column: why
        timestamp_column: at
        rules:
          - reason: bad
            condition: {type: not_in, column: region, values_ref: valid_regions}
    partition_by: region
    sort_order: [id, region]
    rename_columns: {a: b}
    drop_columns: [c]
    cast_columns: {id: string}
  bare.csv:
    table: tb_bare
"""


def test_yaml_file(tmp_path):
    path = tmp_path / "tables.yml"
    path.write_text(YAML)
    spec = load_spec(path, "a.csv")
    assert (spec.key, spec.table) == ("a.csv", "tb_a")
    assert spec.partition_by == ("region",) and spec.sort_by == ("id", "region")
    assert spec.rename == {"a": "b"} and spec.drop == ("c",) and spec.cast == {"id": "string"}
    assert spec.domain("valid_regions") == ["x", "y"] and spec.domain("never_declared") == []
    assert [d.transform for d in spec.derivations] == ["threshold", "buckets"]
    assert spec.derivations[1].buckets == (Bucket("s", 2), Bucket("l", otherwise=True))
    assert spec.rejects.reason_column == "why" and spec.rejects.rules[0].reason == "bad"


def test_json_file_and_minimal_entry(tmp_path):
    path = tmp_path / "tables.json"
    path.write_text(json.dumps({"files": {"bare.csv": {"table": "tb_bare"}}}))
    spec = load_spec(path, "bare.csv")
    assert spec.fields == () and spec.derivations == () and spec.rejects.rules == ()
    assert spec.rejects.reason_column == "_rejection_reason"


def test_unknown_key(tmp_path):
    path = tmp_path / "tables.yml"
    path.write_text(YAML)
    with pytest.raises(KeyError):
        load_spec(path, "other.csv")


@pytest.mark.parametrize(
    "make",
    [
        lambda: Derivation("x", "frobnicate", "y"),
        lambda: Derivation("x", "threshold", "y", operator="~", value=1),
        lambda: Derivation("x", "threshold", "y", value=1),
        lambda: Derivation("x", "buckets", "y", buckets=(Bucket("all"),)),
        lambda: Condition("is_odd", "y"),
        lambda: Condition("null_or_threshold", "y", operator="=>", value=1),
        lambda: Requirement("y", "prime"),
    ],
)
def test_wrong_words_fail_when_the_spec_is_built(make):
    with pytest.raises(ValueError):
        make()


def test_schema_words(tmp_path):
    path = tmp_path / "tables.yml"
    path.write_text(YAML)
    schema = spark_schema(load_spec(path, "a.csv"))
    assert [f.dataType for f in schema] == [
        T.LongType(), T.DecimalType(10, 0), T.DecimalType(18, 2), T.StringType(),
    ]
    assert [f.nullable for f in schema] == [False, True, True, True]


@pytest.mark.parametrize(
    ("word", "kind"),
    [
        ("string", T.StringType()), ("integer", T.IntegerType()), ("INT", T.IntegerType()), ("long", T.LongType()),
        ("double", T.DoubleType()), ("float", T.FloatType()), ("boolean", T.BooleanType()), ("bool", T.BooleanType()),
        ("timestamp", T.TimestampType()), ("date", T.DateType()),
    ],
)
def test_each_type_word(word, kind):
    assert spark_schema(TableSpec("k", "t", (Field("c", word),)))["c"].dataType == kind


def test_shipped_spec():
    assert len(SPEC.fields) == 13 and len(SPEC.derivations) == 10 and len(SPEC.rejects.rules) == 5
    assert spark_schema(SPEC)["amount"].dataType == T.DecimalType(18, 2)
    assert not any(f.nullable for f in spark_schema(SPEC))


def as_file_entry(spec):
    """A spec in the layout of a spec file."""

    def plain(part):
        return {k: list(v) if isinstance(v, tuple) else v for k, v in vars(part).items() if v not in (None, ())}

    derivations = [{**plain(d), "buckets": [plain(b) for b in d.buckets]} for d in spec.derivations]
    rules = [{"reason": r.reason, "condition": plain(r.condition)} for r in spec.rejects.rules]
    return {
        "table": spec.table,
        "schema": [plain(f) for f in spec.fields],
        "validation": {name: list(values) for name, values in spec.domains.items()},
        "silver": {
            "enrichment": derivations,
            "quarantine": {
                "rejection_column": spec.rejects.reason_column,
                "timestamp_column": spec.rejects.time_column,
                "rules": rules,
            },
        },
        "rename_columns": {},
        "partition_by": [],
        "sort_order": spec.sort_by[0],
        "drop_columns": None,
        "cast_columns": dict(spec.cast),
    }


def test_a_spec_file_gives_the_shipped_spec(tmp_path):
    path = tmp_path / "tables.yml"
    path.write_text(yaml.safe_dump({"files": {SPEC.key: as_file_entry(SPEC)}}, sort_keys=False))
    assert load_spec(path, SPEC.key) == SPEC


def test_default_rules_can_be_replaced(tmp_path):
    entry = as_file_entry(SPEC)
    entry["validation"]["rules"] = [{"column": "anomaly", "test": "in", "values_ref": "valid_anomalies"}]
    spec = TableSpec.from_dict(SPEC.key, entry)
    assert spec.requirements == (Requirement("anomaly", "in", values_ref="valid_anomalies"),)
    assert spec.domains == SPEC.domains
