"""Intermediate results in the folder that all executors share."""

from __future__ import annotations

from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application under ``spark.checkpoint.dir``; without that setting, under the warehouse, which
    all executors reach as well, since their tables are there."""
    base = spark.conf.get(CHECKPOINT_DIR, None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{base.rstrip('/')}/{spark.conf.get('spark.app.id')}"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def write_once(df: DataFrame, label: str) -> DataFrame:
    """Write a frame that several later jobs read, and return the scan of it. The lineage ends here, a lost
    executor costs only a re-read, and later scans still prune columns and push filters down."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def written(df: DataFrame, label: str):
    """``write_once`` for the length of a block; the files are deleted at its end."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        remove(df.sparkSession, path)
