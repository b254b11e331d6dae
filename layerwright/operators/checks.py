"""Table tests: declared expectations on columns, evaluated for a whole table in one pass."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layerwright.functions.predicates import member, number, outside
from layerwright.functions.scalars import soft_cast
from layerwright.operators import multiset


@dataclass(frozen=True)
class TableTest:
    """``kind`` is not_null, accepted_values, accepted_range or unique. Only not_null objects to NULL."""

    column: str
    kind: str
    values: tuple = ()
    min: float | None = None
    max: float | None = None


def not_null(*columns: str) -> list[TableTest]:
    return [TableTest(c, "not_null") for c in columns]


def accepted_values(column: str, values) -> list[TableTest]:
    return [TableTest(column, "accepted_values", values=tuple(values))]


def accepted_range(low, high, *columns: str) -> list[TableTest]:
    return [TableTest(c, "accepted_range", min=low, max=high) for c in columns]


def unique(*columns: str) -> list[TableTest]:
    return [TableTest(c, "unique") for c in columns]


def _offends(test: TableTest, schema: StructType) -> Column:
    """Text that is no number is NULL to a range, which objects to no NULL."""
    match test.kind:
        case "not_null":
            return F.col(f"`{test.column}`").isNull()
        case "accepted_values":
            return ~member(test.column, test.values, schema)
        case "accepted_range":
            return outside(number(test.column, schema), test.min, test.max)
    raise ValueError(f"unknown kind of test {test.kind!r}")


def _repeated(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their row count."""
    counts = df.filter(F.col(f"`{column}`").isNotNull()).groupBy(F.col(f"`{column}`").alias("value"))
    return counts.agg(F.count("*").alias("n_records")).filter("n_records > 1")


def offending(df: DataFrame, test: TableTest) -> DataFrame:
    """What the test objects to; no rows means it passes. Value tests list each value with its row count,
    a null test lists the column, a range test the rows."""
    if test.kind == "unique":
        return _repeated(df, test.column)
    rows = df.filter(_offends(test, df.schema))
    column = F.col(f"`{test.column}`")
    if test.kind == "accepted_values":
        return rows.groupBy(column.alias("value")).agg(F.count("*").alias("n_records"))
    return rows.select(column) if test.kind == "not_null" else rows


def _result(table: str, test: TableTest, failures: Column, examples: Column | None = None) -> Column:
    parts = [
        F.lit(table).alias("table_name"),
        F.lit(test.column).alias("column_name"),
        F.lit(test.kind).alias("test"),
        failures.alias("failures"),
        F.when(failures == 0, "PASS").otherwise("FAIL").alias("status"),
    ]
    return F.struct(*parts, *([] if examples is None else [examples.alias("examples")]))


def _examples(test: TableTest, df: DataFrame, most: int) -> list[Column]:
    """Aggregates for up to ``most`` rows that the test objects to: of each of so many classes of rows by their hash, the
    row with the least hash. They merge map-side, and the choice does not depend on the order of rows."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    mark = F.xxhash64(*columns)
    row = F.struct(mark.alias("mark"), F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("row"))
    chosen = [_offends(test, df.schema) & (F.pmod(mark, F.lit(most)) == i) for i in range(most)]
    return [F.min(F.when(of, row)).getField("row") for of in chosen]


def run_table_tests(df: DataFrame, table: str, tests, examples: int = 0) -> DataFrame:
    """One row per test: (table_name, column_name, test, failures, status). Failures are rows, for unique they
    are repeated values. All but unique tests share a single aggregate, so a table is scanned once.

    ``examples`` adds a column with rows, as JSON, that the test objects to: one at least if it fails and so many at
    most, found in the same scan. ``offending`` gives all of them. A unique test has no examples."""
    tests = list(tests)
    simple = [t for t in tests if t.kind != "unique"]
    none = F.array().cast("array<string>") if examples else None
    frames = []
    if simple:
        found = {str(i): F.count_if(_offends(t, df.schema)) for i, t in enumerate(simple)}
        if examples:
            found |= {f"{i} {k}": e for i, t in enumerate(simple) for k, e in enumerate(_examples(t, df, examples))}
        counts = df.agg(*(column.alias(name) for name, column in found.items()))
        shown = [F.array_compact(F.array(*(F.col(f"`{i} {k}`") for k in range(examples)))) if examples else None for i in range(len(simple))]
        results = F.array(*(_result(table, t, F.col(f"`{i}`"), shown[i]) for i, t in enumerate(simple)))
        frames.append(counts.select(F.inline(results)))
    for test in tests:
        if test.kind == "unique":
            keys = multiset.short_keys(df, [test.column])
            copies = df.filter(F.col(f"`{test.column}`").isNotNull()).groupBy(*keys).agg(F.count("*").alias("n_records"))
            counts = copies.agg(F.count_if(F.col("n_records") > 1).alias("failures"))
            frames.append(counts.select(F.inline(F.array(_result(table, test, F.col("failures"), none)))))
    return reduce(DataFrame.unionByName, frames)


def run_all_tests(frames: dict[str, DataFrame], plan: dict[str, list[TableTest]], examples: int = 0) -> DataFrame:
    """The tests of every planned table, as one frame."""
    return reduce(DataFrame.unionByName, (run_table_tests(frames[t], t, tests, examples) for t, tests in plan.items()))


def _facts(df: DataFrame, invariants: dict[str, Column], values: list[Column] | None = None) -> DataFrame:
    """One row: the violations of each invariant, and the checksum of ``values``."""
    counts = {name: F.count_if(bad) for name, bad in invariants.items()}
    counts |= {multiset.ROWS: F.count_if(F.lit(True))} if values is None else multiset.checksum(values)
    return df.agg(*(count.alias(name) for name, count in counts.items()))


def _found(table: str, facts: Column, invariants: dict[str, Column]) -> list[Column]:
    empty = F.when(facts.getField(multiset.ROWS) == 0, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
    broken = {"not_empty": empty} | {name: facts.getField(name) for name in invariants}
    return [_invariant(table, name, n) for name, n in broken.items()]


def run_invariants(df: DataFrame, table: str, invariants: dict[str, Column]) -> DataFrame:
    """Row-level truths of a table: counts the rows where the condition of a named invariant is true (a
    violation), and reports ``not_empty`` as well. One pass; one row tells that a table is not empty."""
    facts = _facts(df if invariants else df.limit(1), invariants).select(F.struct("*").alias("facts"))
    return facts.select(F.inline(F.array(*_found(table, F.col("facts"), invariants))))


def conservation(
    whole: DataFrame,
    parts: dict[str, DataFrame],
    columns: dict[str, str] | None = None,
    invariants: dict[str, dict[str, Column]] | None = None,
    whole_name: str = "whole",
) -> DataFrame:
    """No row lost, doubled or changed: the parts together hold the rows of the whole, each as often. Rows are compared by
    ``columns`` (name and the type to compare it as; default: all columns of the whole that each part has with the
    same type), through checksums that merge map-side.

    Violations are the rows that are missing or too many, or 1 where as many rows hold something else. With
    ``invariants`` of the whole and of parts, by name, these are counted in the same scan of each table."""
    frames = {whole_name: whole, **parts}
    if columns is None:
        kinds = [dict(part.dtypes) for part in parts.values()]
        columns = {name: kind for name, kind in whole.dtypes if all(kind == other.get(name) for other in kinds)}
    wanted = {name: (invariants or {}).get(name, {}) for name in frames}
    facts = {}
    for name, df in frames.items():
        values = [soft_cast(F.col(f"`{c}`"), df.schema[c].dataType, kind) for c, kind in columns.items()]
        facts[name] = _facts(df, wanted[name], values).select(F.struct("*")).scalar().alias(name)
    one_row = whole.sparkSession.range(0, 1, 1, numPartitions=1).select(*facts.values())
    first, *rest = (F.col(f"`{name}`") for name in frames)
    violations = F.when(multiset.same_rows(first, rest), F.lit(0).cast("long")).otherwise(
        F.greatest(F.abs(multiset.surplus(first, rest)), F.lit(1).cast("long"))
    )
    found = [_invariant("all", f"whole = {' + '.join(parts)}", violations)]
    if invariants is not None:
        found += [row for name in frames for row in _found(name, F.col(f"`{name}`"), wanted[name])]
    return one_row.select(F.inline(F.array(*found)))


def _invariant(table: str, name: str, violations: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(name).alias("invariant"),
        violations.alias("violations"),
        F.when(violations == 0, "PASS").otherwise("FAIL").alias("status"),
    )
