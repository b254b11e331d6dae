"""Sources, sinks and the whole refresh on files and tables."""

import datetime
import json
from dataclasses import replace
from datetime import timedelta
from pathlib import Path
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from layerwright.__main__ import main
from layerwright.plans import transactions as t
from layerwright.plans.refresh import Layout, Refresh, ingest
from layerwright.sources import tables, versions
from layerwright.sources.files import read_csv
from layerwright.sources.scratch import written, new_path, shared_folder, write_once
from test_spec import as_file_entry

HEADER = (
    "timestamp,sending_address,receiving_address,amount,transaction_type,location_region,ip_prefix,"
    "login_frequency,session_duration,purchase_pattern,age_group,risk_score,anomaly"
)
LINES = [
    "1609459200,s1,r1,796.949206,sale,Asia,10.0,3,40,focused,new,18.75,low_risk",
    "1609459200,s2,r2,12.5,scam,Europe,10.1,3,40,random,new,90,high_risk",
    "1609545600,s3,r1,20000,sale,Africa,10.1,x,40,random,new,80,low_risk",
    "3.0,s4,r4,5,sale,Asia,10.0,3,40,focused,new,18.75,low_risk",
    "1609459200,s5,r5,99999999999999999999,sale,Asia,10.0,3,40,focused,new,18.75,low_risk",
    "1609459200,s6,r6,5,sale,0,10.0,3,40,focused,new,18.75,low_risk",
    "1609459200,,r6,5,sale,Asia,10.0,3,40,focused,new,18.75,low_risk",
]


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / t.SPEC.key
    path.write_text("\n".join([HEADER, *LINES]) + "\n")
    return str(path)


@pytest.fixture
def layout():
    return Layout(prefix=f"t{uuid4().hex[:10]}_")


def test_csv_cells_that_do_not_fit_become_null(spark, csv):
    found = read_csv(spark, csv, t.SPEC).collect()
    assert len(found) == 7
    assert str(found[0]["amount"]) == "796.95" and found[2]["login_frequency"] is None
    assert found[3]["timestamp"] is None and found[4]["amount"] is None and found[6]["sending_address"] is None


def test_ingest(spark, csv):
    df = ingest(spark, csv, t.SPEC)
    row = df.first()
    assert row["timestamp"] == datetime.datetime(2021, 1, 1) and row["_source_file"] == "df_fraud_credit.csv"
    datetime.datetime.strptime(row["_batch_id"], "%Y%m%d_%H%M%S")
    assert df.columns[-3:] == ["_ingestion_time", "_source_file", "_batch_id"]


def test_refresh_end_to_end(spark, csv, layout, tmp_path):
    refresh = Refresh(spark, layout)
    written = refresh.run(csv, str(tmp_path / "report"))
    assert written["bronze.tb_fraud_credit"] == 7
    assert (written["silver.tb_fraud_credit"], written["quarantine.tb_fraud_credit"]) == (3, 4)
    assert len([name for name in written if name.startswith("gold.")]) == 7
    assert (written["quality.silver_report"], written["quality.bronze_quality_report"]) == (14, 19)
    for name, n in written.items():
        assert refresh.table(*name.split(".")).count() == n, name
    reasons = dict(refresh.table("quarantine").groupBy("_rejection_reason").count().collect())
    assert reasons == {"invalid_amount": 1, "invalid_region": 1, "other": 2}
    assert dict(refresh.table("silver").dtypes)["amount"] == "double"
    assert "_created_at" in refresh.table("gold", "risk_profile").columns
    results = refresh.tests().collect()
    assert len(results) == 87
    # a low_risk row with a high score is what this test is there to show
    assert [(r["table_name"], r["column_name"]) for r in results if r["status"] == "FAIL"] == [
        ("high_risk_transactions", "anomaly")
    ]
    assert {r["status"] for r in refresh.invariants().collect()} == {"PASS"}
    assert len(list((tmp_path / "report").glob("part-*"))) == 1


def test_second_refresh_replaces_the_first(spark, csv, layout):
    refresh = Refresh(spark, layout)
    first = refresh.run(csv)
    assert refresh.run(csv) == first


def test_a_forgotten_table_is_replaced_too(spark, layout):
    """A catalog in memory starts empty in the next application, while the folders of its tables are still there."""
    tables.ensure_namespace(spark, layout.namespace("gold"))
    name = layout.table("gold", "tb")
    tables.replace_table(spark.range(5), name)
    spark.sql(f"DROP VIEW {name}")
    assert tables.replace_table(spark.range(3), name) == 3
    assert tables.read_table(spark, name).count() == 3
    assert tables.replace_table(spark.range(4).withColumn("k", F.lit("x")), name, partition_by=["k"]) == 4
    assert tables.read_table(spark, name).count() == 4 and tables.replace_table(spark.range(2), name) == 2
    assert tables.read_table(spark, name).columns == ["id"] and tables.read_table(spark, name).count() == 2


def test_a_table_without_namespace(spark):
    name = f"tb_{uuid4().hex[:8]}"
    assert tables.replace_table(spark.range(3), name) == 3 and tables.read_table(spark, name).count() == 3


def test_steps_one_by_one(spark, csv, layout):
    written = Refresh(spark, layout).write_raw(csv, "b1")
    written |= Refresh(spark, layout).write_clean()
    written |= Refresh(spark, layout).write_summaries()
    written |= Refresh(spark, layout).write_reports()
    assert len(written) == 13


def test_command_line_with_a_spec_file(spark, csv, tmp_path, capsys):
    entry = as_file_entry(t.SPEC) | {"table": "tb_other", "partition_by": "anomaly"}
    path = tmp_path / "tables.json"
    path.write_text(json.dumps({"files": {"mine.csv": entry}}))
    given = ["--spec", str(path), "--key", "mine.csv"]
    assert main(["raw", csv, *given]) == 0 and main(["clean", *given]) == 0
    assert "quarantine.tb_other: 4 rows" in capsys.readouterr().out
    stored = tables.read_table(spark, "bronze.tb_other")
    assert stored.count() == 7 and stored.first()["_source_file"] == "mine.csv"
    assert any("anomaly=low_risk" in f for f in stored.inputFiles())


def test_command_line(spark, csv, tmp_path, capsys):
    assert main(["all", csv, "--document", str(tmp_path / "doc")]) == 0
    assert "silver.tb_fraud_credit: 3 rows" in capsys.readouterr().out
    assert main(["tests"]) == 1
    with pytest.raises(SystemExit):
        main(["raw"])


def test_partitioned_table_splits_a_hot_value(spark, layout):
    """One region holds most rows; its partition is written by several tasks, small ones by one each."""
    tables.ensure_namespace(spark, layout.namespace("silver"))
    name = layout.table("silver", "tb")
    df = spark.range(200_000).select(
        F.when(F.col("id") % 10 < 7, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 3)).alias("region"),
        F.col("id"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        rows = tables.replace_table(df.repartition(8), name, partition_by=["region"], sort_by=["id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert rows == 200_000
    stored = tables.read_table(spark, name)
    files = stored.select("region", F.input_file_name().alias("f")).distinct().groupBy("region").count().collect()
    files = dict(files)
    assert files["hot"] > 2 and stored.count() == 200_000
    assert stored.filter("region = 'r1'").select("id").rdd.isEmpty() is False


def test_few_rows_of_many_tasks_make_few_files(spark, layout):
    tables.ensure_namespace(spark, layout.namespace("quarantine"))
    few = spark.range(0, 100_000, 1, 40).filter("id % 100 = 0")
    for compact, files in ((False, 40), (True, 1)):
        name = layout.table("quarantine", f"tb_{compact}")
        assert tables.replace_table(few, name, compact=compact) == 1000
        assert len(tables.read_table(spark, name).inputFiles()) == files


def test_rows_are_sorted_within_files(spark, layout):
    tables.ensure_namespace(spark, layout.namespace("bronze"))
    name = layout.table("bronze", "tb")
    tables.replace_table(spark.range(1000).select((F.col("id") * 37 % 1000).alias("n")), name, sort_by=["n"])
    stored = tables.read_table(spark, name).select("n", F.input_file_name().alias("f")).collect()
    by_file = {}
    for row in stored:
        by_file.setdefault(row["f"], []).append(row["n"])
    assert all(numbers == sorted(numbers) for numbers in by_file.values())


def test_sort_terms(spark, layout):
    tables.ensure_namespace(spark, layout.namespace("bronze"))
    name = layout.table("bronze", "tb")
    df = spark.range(0, 6, 1, 1).select((F.col("id") % 2).alias("a"), F.col("id").alias("b"))
    tables.replace_table(df, name, sort_by=["a, b desc"])
    assert [tuple(r) for r in tables.read_table(spark, name).collect()] == [(0, 4), (0, 2), (0, 0), (1, 5), (1, 3), (1, 1)]
    with pytest.raises(ValueError):
        tables.replace_table(df, name, sort_by=["a sideways"])


def test_codec(spark, layout):
    tables.ensure_namespace(spark, layout.namespace("bronze"))
    name = layout.table("bronze", "tb")
    tables.replace_table(spark.range(10), name)
    assert all(".snappy." in f for f in tables.read_table(spark, name).inputFiles())
    tables.replace_table(spark.range(10), name, codec="zstd")
    assert all(".zstd." in f for f in tables.read_table(spark, name).inputFiles())


def test_missing_table_is_empty(spark, layout):
    tables.ensure_namespace(spark, layout.namespace("quarantine"))
    schema = spark.range(1).schema
    assert tables.read_table_or_empty(spark, layout.table("quarantine", "nothing"), schema).count() == 0
    tables.replace_table(spark.range(4), layout.table("quarantine", "something"))
    assert tables.read_table_or_empty(spark, layout.table("quarantine", "something"), schema).count() == 4


def test_sql_model(spark, layout):
    tables.ensure_namespace(spark, layout.namespace("quality"))
    name = layout.table("quality", "evens")
    rows = tables.replace_table_from_sql(spark, name, "SELECT id FROM {src} WHERE id % 2 = 0", {"src": spark.range(10)})
    assert rows == 5 and tables.read_table(spark, name).count() == 5


def test_empty_result_is_a_table_too(spark, layout):
    tables.ensure_namespace(spark, layout.namespace("gold"))
    name = layout.table("gold", "none")
    assert tables.replace_table(spark.range(0), name) == 0
    assert tables.read_table(spark, name).count() == 0
    empty = spark.range(0).withColumn("k", F.col("id") % 2)
    assert tables.replace_table(empty, layout.table("gold", "none_either"), partition_by=["k"], sort_by=["id"]) == 0


def test_configured_catalogs_create_or_replace(spark, monkeypatch):
    """No such catalog is at hand, so the calls to its writer are recorded."""
    calls = []

    class Writer:
        def __init__(self, df, name):
            self.df = df
            calls.append(("name", name))

        def __getattr__(self, call):
            return lambda *args: calls.append((call, *args)) or self

        def createOrReplace(self):  # noqa: N802
            self.df.write.format("noop").mode("overwrite").save()

    monkeypatch.setattr(type(spark.range(1)), "writeTo", lambda df, name: Writer(df, name))
    spark.conf.set("spark.sql.catalog.lake", "some.Catalog")
    try:
        rows = tables.replace_table(
            spark.range(7), "lake.gold.tb", partition_by=["id"], sort_by=["id"], source_format="tableformat",
            codec="zstd", properties={"p": "1"},
        )
    finally:
        spark.conf.unset("spark.sql.catalog.lake")
    assert rows == 7
    assert [c[0] for c in calls] == ["name", "using", *["tableProperty"] * 3, "partitionedBy"]
    assert calls[0] == ("name", "`lake`.`gold`.`tb`") and calls[1] == ("using", "tableformat")
    assert [c[1:] for c in calls[2:5]] == [(tables.CODEC_PROPERTY, "zstd"), (tables.ORDER_PROPERTY, "id"), ("p", "1")]
    assert Layout(catalog="lake").table("gold", "tb") == "lake.gold.tb"


def test_scratch_uses_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark).startswith(base) and new_path(spark, "a") != new_path(spark, "a")
    stored = write_once(spark.range(5), "five")
    assert stored.count() == 5 and all(base in f for f in stored.inputFiles())


class WithoutSharedFolder:
    """A session whose settings are given and whose checkpoint folder is not."""

    def __init__(self, spark, master):
        self.settings = {"spark.master": master, "spark.app.id": "app-1", "spark.sql.warehouse.dir": "/w/house"}
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key, default)


@pytest.mark.parametrize("master", ["yarn", "local[2]"])
def test_without_the_setting_scratch_is_in_the_warehouse(spark, master):
    assert shared_folder(WithoutSharedFolder(spark, master)) == "/w/house/_scratch/app-1"


def test_written_goes_with_its_block(spark):
    with written(spark.range(4), "four") as df:
        (folder,) = {Path(f.removeprefix("file://")).parent for f in df.inputFiles()}
        assert df.count() == 4 and folder.exists()
    assert not folder.exists()


def test_a_failed_write_leaves_the_old_rows(spark, layout):
    tables.ensure_namespace(spark, layout.namespace("gold"))
    name = layout.table("gold", "kept")
    tables.replace_table(spark.range(5), name)
    bad = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        tables.replace_table(bad, name)
    assert tables.read_table(spark, name).count() == 5
    assert [r.tableName for r in spark.sql(f"SHOW TABLES IN {layout.namespace('gold')}").collect()] == ["kept"]


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_nothing_of_the_old_content_stays(spark, layout, mode):
    tables.ensure_namespace(spark, layout.namespace("gold"))
    name = layout.table("gold", "parts")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        both = spark.createDataFrame([(1, "x"), (2, "y")], "n int, k string")
        assert tables.replace_table(both, name, partition_by=["k"]) == 2
        assert tables.replace_table(both.filter("k = 'x'"), name, partition_by=["k"]) == 1
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    stored = tables.read_table(spark, name)
    assert stored.count() == 1 and len(stored.inputFiles()) == 1
    folder = Path(stored.inputFiles()[0].removeprefix("file://")).parents[1]
    # the old version stays for those who read it, until it is collected
    assert len(list(folder.parent.glob("parts--*"))) == 2
    assert len(versions.collect(spark, name, timedelta(0))) == 1
    assert [p.name for p in folder.parent.glob("parts--*")] == [folder.name] and stored.count() == 1


def test_a_table_can_be_replaced_from_itself(spark, layout):
    tables.ensure_namespace(spark, layout.namespace("gold"))
    name = layout.table("gold", "self")
    tables.replace_table(spark.range(5), name)
    assert tables.replace_table(tables.read_table(spark, name).filter("id > 1"), name) == 3
    assert tables.read_table(spark, name).count() == 3


def test_layout_passes_format_codec_and_properties(spark, csv, layout):
    own = replace(layout, codec="zstd", properties={"team": "me"})
    Refresh(spark, own).write_raw(csv, "b1")
    name = own.table("bronze", t.SPEC.table)
    assert all(".zstd." in f for f in tables.read_table(spark, name).inputFiles())
    assert "me" in [r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()]


def test_test_results_are_tables(spark, csv, layout):
    refresh = Refresh(spark, layout)
    refresh.run(csv)
    assert refresh.write_tests() == {"quality.table_tests": 87, "quality.invariants": 20}
    assert refresh.table("quality", "table_tests").filter("status = 'FAIL'").count() == 1


def test_another_zone_is_refused(spark, layout):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError, match="UTC"):
            Refresh(spark, layout)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_report_dimensions_need_value_lists():
    rules = tuple(r for r in t.SPEC.requirements if r.column != "location_region")
    with pytest.raises(ValueError, match="location_region"):
        t.document_dimensions(replace(t.SPEC, requirements=rules))
    assert list(t.document_dimensions()) == list(t.CLEAN_DIMENSIONS)
