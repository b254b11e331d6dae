"""Small helpers that the operators share: Arrow batches in tasks, shipped code, written intermediate tables."""

from __future__ import annotations

import ctypes
import io
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import cache, partial
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.sources.scratch import write_once

__all__ = ["batches", "fresh_name", "map_batches", "pieces_of", "read", "ship", "stage_table", "strings", "write_once"]

PACKAGE = Path(__file__).resolve().parents[1]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per Spark context, as ``--py-files`` would."""
    context = spark.sparkContext
    if getattr(context, "_layerwright_shipped", False):
        return
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w") as archive:
        for path in sorted(PACKAGE.rglob("*.py")):
            archive.write(path, str(path.relative_to(PACKAGE.parent)))
    path = Path(tempfile.mkdtemp(prefix="layerwright-code-")) / "layerwright_code.zip"
    path.write_bytes(content.getvalue())
    context.addPyFile(str(path))
    context._layerwright_shipped = True


def map_batches(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str):
    """``mapInArrow`` with the package shipped to the executors. A worker stays for the next task, so at a task's end it gives
    the memory it no longer uses back."""
    ship(df.sparkSession)
    return df.mapInArrow(partial(_tidy, function=function), schema)


def _tidy(rows: Iterator[pa.RecordBatch], function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    yield from function(rows)
    give_back()


def give_back() -> None:
    """Freed memory that Arrow and the C library keep goes back to the system."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


@cache
def _trim() -> Callable[[int], int] | None:
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):  # another C library
        return None


ARROW_TYPES = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(),
    "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
    "array<double>": pa.list_(pa.float64()), "array<float>": pa.list_(pa.float32()), "float": pa.float32(),
    "array<string>": pa.list_(pa.string()),
}


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of ``name type, name type``; works in tasks, where no session is at hand."""
    return pa.schema([(name, ARROW_TYPES[kind]) for name, kind in (field.split() for field in ddl.split(","))])


def batches(columns: dict[str, list], schema: pa.Schema, rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Record batches of at most ``rows`` rows of these columns."""
    table = pa.table([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)
    yield from table.to_batches(max_chunksize=rows)


def strings(column: pa.Array) -> pa.StringArray:
    """The column as plain text with 32-bit offsets; nulls as empty."""
    column = column.cast(pa.large_string()) if not pa.types.is_string(column.type) else column
    return column.fill_null("").cast(pa.string())


def pieces_of(batch: pa.RecordBatch, column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose text sums to about ``most_bytes``; a longer text makes a slice of its own."""
    sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > most_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)


def fresh_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def stage_table(df: DataFrame, label: str) -> DataFrame:
    """A written table in the shared folder, as the next job's input."""
    return write_once(df, label)


def total_of(df: DataFrame, expression: str) -> int:
    return df.agg(F.expr(expression).cast("long")).first()[0] or 0
