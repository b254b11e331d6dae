"""Checksums of a table's rows as a multiset: the order of rows and their files do not matter, every copy counts.

A checksum is the row count, the sum of a hash of each row and the exclusive or of that hash mixed again. Each merges map-side, so
a table of any size sends one row per task, and any aggregate over the table can carry the checksum along.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The summed hash is cut into parts of so many bits: a sum of them fits a long for 2^41 rows.
_BITS, _PARTS = 22, 3

#: Bytes of the types that a key is made of without hashing.
_SIZES = {"byte": 1, "short": 2, "integer": 4, "date": 4, "long": 8, "timestamp": 8, "timestamp_ntz": 8, "boolean": 1}

ROWS, XOR = "checksum_rows", "checksum_xor"
SUMS = tuple(f"checksum_sum_{i}" for i in range(_PARTS))
FIELDS = (ROWS, *SUMS, XOR)


def _null_masks(values: list[Column]) -> list[Column]:
    """Which of the columns are NULL, as bits of whole numbers: a hash by itself skips NULL."""
    bits = [F.when(value.isNull(), F.lit(1 << i % 62)).otherwise(F.lit(0)).cast("long") for i, value in enumerate(values)]
    groups = [bits[i : i + 62] for i in range(0, len(bits), 62)]
    return [reduce(lambda a, b: a.bitwiseOR(b), group) for group in groups] or [F.lit(0).cast("long")]


def _marked(values: list[Column]) -> list[Column]:
    return [part for value in values for part in (value.isNull(), value)]


def short_keys(df: DataFrame, names) -> list[Column]:
    """Columns to group by that are equal where the named ones are; NULL equals NULL only. Keys of up to 16 bytes are
    taken as they are. Wider ones, or text, are two independent 64-bit hashes, so that what leaves a task
    per distinct key is 16 bytes however long the key is: among 10^12 keys two share both with odds of 1 to 10^15."""
    wide = sum(_SIZES.get(df.schema[name].dataType.typeName(), 99) for name in names) > 16
    values = [F.col(f"`{name}`") for name in names]
    if not wide:
        return values
    return [F.xxhash64(*_marked(values)).alias("key_1"), F.xxhash64(F.lit(_PARTS), *reversed(_marked(values))).alias("key_2")]


def checksum(values: list[Column]) -> dict[str, Column]:
    """Aggregates that make up the checksum of these columns. NULL differs from every value, and in each column."""
    # one hash over the row; the exclusive or takes a mix of it, so that the generated code stays small
    summed = F.xxhash64(*values, *_null_masks(values))
    mixed = F.xxhash64(summed)
    parts = [F.shiftrightunsigned(summed, _BITS * i).bitwiseAND(F.lit((1 << _BITS) - 1)) for i in range(_PARTS)]
    zero = F.lit(0).cast("long")
    sums = {name: F.coalesce(F.sum(part), zero) for name, part in zip(SUMS, parts, strict=True)}
    return {ROWS: F.count("*"), **sums, XOR: F.coalesce(F.bit_xor(mixed), zero)}


def _merged(field: str, tables: list[Column]) -> Column:
    values = [table.getField(field) for table in tables]
    return reduce(lambda a, b: a.bitwiseXOR(b) if field == XOR else a + b, values)


def surplus(whole: Column, parts: list[Column]) -> Column:
    """Rows that the parts have beyond the whole; negative if they miss some. Arguments are structs with the fields."""
    return _merged(ROWS, parts) - whole.getField(ROWS)


def same_rows(whole: Column, parts: list[Column]) -> Column:
    """True if the parts together hold the rows of the whole, each as often."""
    return reduce(lambda a, b: a & b, (_merged(field, parts) == whole.getField(field) for field in FIELDS))
