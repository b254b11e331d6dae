"""Files that hold ranges of the sort columns."""

from statistics import median
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from layerwright.plans.refresh import Layout
from layerwright.sources import tables


@pytest.fixture
def clustered(spark):
    """clustered(df, ...) writes a table in small files and gives it back with a column for the file."""

    def write(df, **how):
        layout = Layout(prefix=f"c{uuid4().hex[:8]}_")
        layout.create(spark)
        name = layout.table("bronze", "tb")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "24")
        try:
            tables.replace_table(df, name, clustered=True, **how)
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
            spark.conf.set("spark.sql.shuffle.partitions", "8")
        return tables.read_table(spark, name).withColumn("file", F.input_file_name())

    return write


def rows(spark, key):
    payload = F.sha2(F.col("id").cast("string"), 256)
    return spark.range(0, 60_000, 1, 6).select(key.alias("k"), payload.alias("payload"), F.col("id"))


def test_a_filter_reads_a_fraction_of_the_files(spark, clustered):
    stored = clustered(rows(spark, F.concat(F.lit("r"), F.col("id") * 7919 % 100)), sort_by=["k"])
    files = stored.select("file").distinct().count()
    assert files >= 10 and stored.count() == 60_000
    for value in ("r3", "r42", "r99"):
        assert stored.filter(F.col("k") == value).select("file").distinct().count() <= 2
    bounds = sorted(map(tuple, stored.groupBy("file").agg(F.min("k"), F.max("k")).drop("file").collect()))
    assert all(a[1] <= b[0] for a, b in zip(bounds, bounds[1:], strict=False))


def test_a_hot_value_spans_files_of_like_size(spark, clustered):
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("r"), F.col("id") % 50))
    stored = clustered(rows(spark, hot), sort_by=["k"])
    sizes = [r["count"] for r in stored.groupBy("file").count().collect()]
    assert stored.filter("k = 'hot'").select("file").distinct().count() >= 3
    assert max(sizes) <= 2 * median(sizes)


def test_tasks_do_not_grow_with_the_table(spark, clustered, monkeypatch):
    monkeypatch.setattr(tables, "CLUSTER_ROWS", 1_000)
    stored = clustered(rows(spark, F.concat(F.lit("r"), F.col("id") * 7919 % 100)), sort_by=["k"])
    sizes = [r["count"] for r in stored.groupBy("file").count().collect()]
    assert sum(sizes) == 60_000 and len(sizes) >= 50 and max(sizes) < 60_000 / 24
    bounds = sorted(map(tuple, stored.groupBy("file").agg(F.min("k"), F.max("k")).drop("file").collect()))
    assert all(a[1] <= b[0] for a, b in zip(bounds, bounds[1:], strict=False))


def test_order_inside_files_partitions_and_directions(spark, clustered):
    df = rows(spark, F.col("id") % 17).withColumn("part", F.when(F.col("id") % 10 < 7, "a").otherwise("b"))
    stored = clustered(df, sort_by=["k desc"], partition_by=["part"])
    in_files = {}
    for r in stored.select("file", "k").collect():
        in_files.setdefault(r.file, []).append(r.k)
    assert all(keys == sorted(keys, reverse=True) for keys in in_files.values()) and len(in_files) > 4
    bounds = stored.groupBy("part", "file").agg(F.min("k").alias("low"), F.max("k").alias("high")).collect()
    for part in "ab":
        own = sorted((r.low, r.high) for r in bounds if r.part == part)
        assert all(a[1] <= b[0] for a, b in zip(own, own[1:], strict=False))


def test_without_sort_columns_nothing_is_dealt(spark, clustered):
    assert clustered(spark.range(10)).count() == 10 and clustered(spark.range(0), sort_by=["id"]).count() == 0
