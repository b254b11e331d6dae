"""CSV headers and records that do not fit."""

import gzip
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from layerwright.operators.validate import split
from layerwright.plans import transactions as t
from layerwright.plans.refresh import ingest
from layerwright.sources.files import HeaderError, file_headers, read_csv, spark_schema
from layerwright.spec import RAW_RECORD, TableSpec

SMALL = TableSpec.from_dict("s.csv", {"table": "s", "schema": [{"name": n, "type": k} for n, k in (("a", "int"), ("b", "string"), ("c", "double"))]})


@pytest.fixture
def folder(tmp_path):
    """folder(name=lines) writes files and gives the path of their folder."""

    def make(**files):
        for name, lines in files.items():
            (tmp_path / f"{name}.csv").write_text("\n".join(lines) + ("\n" if lines else ""))
        return str(tmp_path)

    return make


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_columns_are_read_by_name(spark, folder):
    path = folder(x=["a,b,c", "1,x,1.5"], y=["c,a,b", "2.5,2,y"], z=['B , "A",extra,c', "z,3,no,3.5"])
    found = read_csv(spark, path, SMALL)
    assert found.columns == ["a", "b", "c"] and rows(found) == [(1, "x", 1.5), (2, "y", 2.5), (3, "z", 3.5)]


def test_swapped_sender_and_receiver(spark, folder):
    """The two have the same type, so reading by place would not show."""
    names = t.SPEC.fields
    header = [f.name for f in names]
    line = dict(zip(header, "1609459200,s1,r1,796.95,sale,Asia,10.0,3,40,focused,new,18.75,low_risk".split(","), strict=True))
    header[1], header[2] = header[2], header[1]
    row = read_csv(spark, folder(x=[",".join(header), ",".join(line[c] for c in header)]), t.SPEC).first()
    assert (row["sending_address"], row["receiving_address"]) == ("s1", "r1")


@pytest.mark.parametrize(("header", "fault"), [("a,c", "lacks b"), ("a,b,c,A", "repeats a"), ("1,x,1.5", "lacks a, b, c")])
def test_a_header_without_the_columns_is_refused(spark, folder, header, fault):
    with pytest.raises(HeaderError, match=fault):
        read_csv(spark, folder(x=["a,b,c", "1,x,1.5"], y=[header, "1,2,3,4"]), SMALL)


def test_files_with_one_header_are_one_scan(spark, folder):
    found = read_csv(spark, folder(x=["a,b,c", "1,x,1.5"], y=["a,b,c", "2,y,2.5"], empty=[]), SMALL)
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1 and found.count() == 2


def test_empty_and_header_only_files(spark, folder, tmp_path):
    assert read_csv(spark, folder(x=[]), SMALL).schema == spark_schema(SMALL)
    assert read_csv(spark, folder(x=["a,b,c"]), SMALL, raw_record=True).collect() == []


def test_compressed_files_byte_order_mark_and_separator(spark, tmp_path):
    with gzip.open(tmp_path / "x.csv.gz", "wt", encoding="utf-8-sig") as file:
        file.write("b;a;c\nx;1;1.5\n")
    path = str(tmp_path)
    assert list(file_headers(spark, path, sep=";").values()) == [("b", "a", "c")]
    assert rows(read_csv(spark, path, SMALL, sep=";")) == [(1, "x", 1.5)]


def test_odd_file_names(spark, tmp_path):
    for name, header, line in (("a b%20.csv", "a,b,c", "1,x,1.5"), ("é#1.csv", "c,b,a", "2.5,y,2")):
        (tmp_path / name).write_text(f"{header}\n{line}\n")
    assert rows(read_csv(spark, str(tmp_path), SMALL)) == [(1, "x", 1.5), (2, "y", 2.5)]


def test_records_that_do_not_fit_are_kept_as_they_stand(spark, folder):
    lines = ["a,b,c", "1,x,1.5", "no,x,1.5", "1,x", "1,x,1.5,more", ",,", '2,"q,q",oops']
    found = read_csv(spark, folder(x=lines), SMALL, raw_record=True)
    kept = {r[RAW_RECORD]: (r.a, r.b, r.c) for r in found.collect() if r[RAW_RECORD] is not None}
    assert kept == {"no,x,1.5": (None, "x", 1.5), "1,x": (1, "x", None), "1,x,1.5,more": (1, "x", 1.5), '2,"q,q",oops': (2, "q,q", None)}
    assert found.filter(f"{RAW_RECORD} is null").count() == 2
    # whichever columns are asked for
    assert found.select("a", RAW_RECORD).filter(f"{RAW_RECORD} is not null").count() == 4


def test_malformed_records_go_to_the_rejected_side(spark, folder):
    header = ",".join(f.name for f in t.SPEC.fields)
    good = "1609459200,s1,r1,796.95,sale,Asia,10.0,3,40,focused,new,18.75,low_risk"
    path = folder(x=[header, good, good.replace(",3,40", ",x,40"), good.replace(",Asia", ",0"), good + ",more", good[:30]])
    raw = ingest(spark, path, t.SPEC, "b", raw_record=True)
    assert split(raw, t.SPEC).valid.count() == 3  # as ever: what does not fit is NULL, and two of these rows do without
    strict = replace(t.SPEC, rejects=replace(t.SPEC.rejects, malformed="malformed"))
    valid, rejected = split(raw, strict)
    found = {r[RAW_RECORD]: r["_rejection_reason"] for r in rejected.collect()}
    assert valid.count() == 1 and list(found.values()).count("malformed") == 3 and found[None] == "invalid_region"
    assert {k for k, v in found.items() if v == "malformed"} == {good.replace(",3,40", ",x,40"), good + ",more", good[:30]}
    assert "malformed" in str(t.reject_invariants(strict)["reason_known"])
    # rows that never were lines of a file have no such column
    assert split(raw.drop(RAW_RECORD), strict).valid.count() == 3


def test_spec_files_may_name_the_reason():
    entry = {"table": "x", "silver": {"quarantine": {"rejection_column": "why", "timestamp_column": "at", "malformed_reason": "bad_line"}}}
    assert TableSpec.from_dict("x.csv", entry).rejects.malformed == "bad_line"


def test_headers_come_from_the_first_block_only(spark, folder):
    path = folder(x=["a,b,c", *["1,x,1.5"] * 50_000])
    assert list(file_headers(spark, path).values()) == [("a", "b", "c")]
    assert read_csv(spark, path, SMALL).agg(F.count("*")).first()[0] == 50_000
