"""The stages one after the other over a small table with planted cases, and the registered queries."""

import corpus_pipeline
import pytest

import __spark_entry__ as entry
from layerwright.llm import quality, queries, simhash, substrings

SF = "/root/testdata/sf0.001"


def test_stage_names_and_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "language_id", "near_duplicates", "repeated_passages", "sequence_packing"]
    assert {f"op{i}" for i in range(1, 14)} == {name.split("_")[0] for name in queries.QUERIES}
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())
    assert set(queries.ORACLE) <= set(queries.QUERIES)


@pytest.fixture(scope="module")
def planted(spark, docs, tmp_path_factory):
    sample = spark.read.parquet(f"{SF}/documents.parquet")
    ids = [r.doc_id for r in quality.judge(sample).filter("kept").orderBy("doc_id").collect()]
    texts = {r.doc_id: r.text for r in sample.collect()}
    long = [i for i in ids if len(texts[i].split()) > 300]
    passage = " ".join(texts[long[0]].split()[100:170])
    host = texts[long[3]].split()
    extra = [
        (5000, texts[long[1]], "en"),  # an exact copy
        (5001, " ".join([*host[:150], passage, *host[150:]][::-1]), "en"),  # a repeated passage in another text
        (5002, "### " * 200, "en"),
        (5003, "жщю яцф пук " * 5 + "ывап олдж эъхз щшгн екуц йфыч ячсм итьб юждл орпа вфыц уке " * 12, "en"),
        (5004, None, "en"),
    ]
    columns = sample.columns
    frame = sample.unionByName(docs(*extra).select(*columns))
    folder = tmp_path_factory.mktemp("pipeline")
    frame.write.parquet(f"{folder}/documents.parquet")
    return str(folder), long, passage


def test_stages(spark, planted):
    folder, long, passage = planted
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    tables = []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frame, folder).write.parquet(f"{folder}/stage{number}")
        tables.append(spark.read.parquet(f"{folder}/stage{number}"))
        if number < 4:
            assert tables[-1].columns == frame.columns
        frame = tables[-1]
    kept, spoken, single, cut, packed = (t.collect() for t in tables)
    ids = lambda rows: {r.doc_id for r in rows}
    assert not ids(kept) & {5002, 5004} and set(long) | {5000} <= ids(kept)
    assert 5003 not in ids(spoken) and set(long) <= ids(spoken)
    assert 5000 not in ids(single) and len(ids(single)) == len(single)
    groups = {r.component_id for r in simhash.linked(tables[1]).collect()}
    assert ids(single) == groups
    texts = {r.doc_id: r.text for r in cut}
    assert sum(passage[40:-40] in t for t in texts.values()) == 1
    assert substrings.passages(tables[3]).filter("end_word - start_word > 60").count() <= 2
    assert ids(packed) == ids(cut)
    final = corpus_pipeline.run(spark, folder).collect()
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in final) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in packed)


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_queries_cover_their_table(spark, name):
    frame = queries.QUERIES[name](spark, SF)
    rows = frame.collect()
    assert frame.columns and rows
    table = {"op1": "pages", "op5": "embeddings"}.get(name.split("_")[0], "documents")
    if name.split("_")[0] in ("op1", "op3", "op5", "op8", "op9", "op10"):
        assert len(rows) == spark.read.parquet(f"{SF}/{table}.parquet").count()
