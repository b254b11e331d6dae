"""CSV files with a declared schema."""

from __future__ import annotations

import csv
import logging
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerwright.spec import RAW_RECORD, Field, TableSpec

log = logging.getLogger(__name__)

# Type words of a spec, in any case, and what Spark calls them.
TYPE_WORDS = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "boolean": T.BooleanType(),
    "bool": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}
DEFAULT_PRECISION, DEFAULT_SCALE = 18, 2


def _spark_type(field: Field) -> T.DataType:
    word = field.type.lower()
    if word == "decimal":
        precision = DEFAULT_PRECISION if field.precision is None else field.precision
        return T.DecimalType(precision, DEFAULT_SCALE if field.scale is None else field.scale)
    if word not in TYPE_WORDS:
        log.warning("type %r of column %r is unknown; it is read as string", field.type, field.name)
    return TYPE_WORDS.get(word, T.StringType())


def spark_schema(spec: TableSpec) -> T.StructType:
    return T.StructType([T.StructField(f.name, _spark_type(f), f.nullable) for f in spec.fields])


#: What the scan calls the line that did not fit.
CORRUPT = "_corrupt_record"


class HeaderError(ValueError):
    """A file whose header does not name the declared columns."""


def _first_line(spark: SparkSession, path: str, encoding: str) -> str | None:
    """The first line of a file of any file system that Spark reads, compressed or not; None of an empty file."""
    java, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    where = java.org.apache.hadoop.fs.Path(java.java.net.URI(path))
    stream = where.getFileSystem(conf).open(where)
    try:
        codec = java.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(where)
        content = codec.createInputStream(stream) if codec is not None else stream
        reader = java.java.io.BufferedReader(java.java.io.InputStreamReader(content, encoding), 4096)
        return reader.readLine()
    finally:
        stream.close()


def file_headers(spark: SparkSession, path: str | list[str], **options) -> dict[str, tuple[str, ...]]:
    """The header of each file that has one. Files are listed and one block of each is opened, nothing else is read, so
    this takes as long as listing does."""
    listing = {k: v for k, v in options.items() if k in ("recursiveFileLookup", "pathGlobFilter", "modifiedAfter", "modifiedBefore")}
    files = spark.read.options(**listing).text(path).inputFiles()
    encoding = options.get("encoding", options.get("charset", "UTF-8"))
    with ThreadPoolExecutor(max_workers=16) as pool:
        lines = list(pool.map(lambda file: _first_line(spark, file, encoding), files))
    headers = {}
    for file, line in zip(files, lines, strict=True):
        if line is not None:
            cells = next(csv.reader([line.removeprefix("\ufeff")], delimiter=options.get("sep", options.get("delimiter", ",")), quotechar=options.get("quote") or chr(34), skipinitialspace=True), [])
            headers[file] = tuple(cell.strip() for cell in cells)
    return headers


def _in_header_order(header: tuple[str, ...], schema: T.StructType, file: str) -> T.StructType:
    """The declared fields in the order of a header; a column nobody declared is read as text and not used."""
    names = [cell.lower() for cell in header]
    declared = {field.name.lower(): field for field in schema}
    missing = [field.name for name, field in declared.items() if name not in names]
    repeated = sorted({name for name in names if name in declared and names.count(name) > 1})
    if missing or repeated:
        fault = f"lacks {', '.join(missing)}" if missing else f"repeats {', '.join(repeated)}"
        raise HeaderError(f"the header of {file} {fault}")
    spare = [T.StructField(f"_spare_{i}", T.StringType()) for i in range(len(names))]
    return T.StructType([declared.get(name, spare[i]) for i, name in enumerate(names)])


def read_csv(
    spark: SparkSession, path: str | list[str], spec: TableSpec, raw_record: bool = False, **options
) -> DataFrame:
    """Scan CSV files that start with a header line. Nothing is inferred, so there is no extra pass over the
    data, and plain files are split into tasks of ``spark.sql.files.maxPartitionBytes``. A cell that does not
    fit its declared type becomes NULL; validation sorts such rows out.

    Columns are found by the name in each file's header, in any order and case; columns that are not declared are left
    out. A header that lacks or repeats a declared column raises ``HeaderError``. Files with one header are one scan.

    ``raw_record`` adds a column that holds the line as it stands in the file where a cell does not fit its type or
    the line has too few or too many cells, NULL everywhere else."""
    schema = spark_schema(spec)
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, header in file_headers(spark, path, **options).items():
        groups.setdefault(header, []).append(file)
    scans = []
    for header, files in groups.items():
        fields = _in_header_order(header, schema, files[0])
        columns = [F.col(f"`{name}`") for name in schema.fieldNames()]
        if raw_record:
            columns.append(_raw_record(fields).alias(RAW_RECORD))
            fields = fields.add(CORRUPT, T.StringType())
        reader = spark.read.options(header=True, columnNameOfCorruptRecord=CORRUPT, **options).schema(fields)
        scans.append(reader.csv(path if len(groups) == 1 else [unquote(file) for file in files]).select(*columns))
    if not scans:  # files without a line have no rows
        return spark.createDataFrame([], schema.add(RAW_RECORD, T.StringType()) if raw_record else schema)
    return reduce(DataFrame.unionByName, scans)


def _raw_record(fields: T.StructType) -> Column:
    """The line that did not fit. A scan only parses the columns that a query uses and finds no fault in the others, so
    this one uses all of them: whatever is asked for, the same lines misfit."""
    every = F.xxhash64(*(F.col(f"`{field.name}`") for field in fields))
    return F.when(every == 0, F.concat(CORRUPT, F.lit(""))).otherwise(F.col(CORRUPT))
