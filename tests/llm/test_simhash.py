import random

import numpy as np
import pyarrow as pa
import xxhash

from layerwright.llm import simhash


def plain(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = lower.encode().split()
    spans = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in spans]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(codes, most=4):
    """codes: {doc_id: code}"""
    ids, root = sorted(codes), {i: i for i in codes}
    for a in ids:
        for b in ids:
            if a < b and bin(codes[a] ^ codes[b]).count("1") <= most:
                ra, rb = root[a], root[b]
                if ra != rb:
                    low, high = min(ra, rb), max(ra, rb)
                    root = {k: low if v == high else v for k, v in root.items()}
    return root


def test_fingerprints(spark):
    texts = ["", " \n", "one", "A b", "a B c D", "É é x\xa0y z Z", "w " * 5000, "a b c d e f g a b c d"]
    assert simhash.fingerprints(pa.array(texts)).tolist() == [plain(t) for t in texts]
    frame = spark.createDataFrame([("a b c d",)], "s string").selectExpr("xxhash64(s) h").first()
    assert simhash.fingerprints(pa.array(["A b c D"])).view(np.int64)[0] == frame.h


def test_gray_order():
    rank = simhash.gray_rank(np.array([i ^ (i >> 1) for i in range(64)], np.uint64))
    assert rank.tolist() == list(range(64))


def test_index_finds_every_pair():
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 62, 40, dtype=np.uint64)
    codes = [c ^ sum((np.uint64(1) << np.uint64(b) for b in rng.integers(0, 64, k)), np.uint64(0)) for c in base for k in (0, 1, 2, 3, 5)]
    codes = np.unique(np.array([*codes, 0, (1 << 64) - 1], np.uint64))
    index = simhash.GrayIndex(codes, fan=4)
    found = {(i, j) for a, b in index.links(4, block=7) for i, j in zip(a.tolist(), b.tolist(), strict=True)}
    n = len(codes)
    assert found == {(i, j) for i in range(n) for j in range(i + 1, n) if int(index.codes[i] ^ index.codes[j]).bit_count() <= 4}


def near_copies(prose, n=150):
    rng, out = random.Random(9), []
    for i in range(n):
        words = prose(300, i % 30).split()
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = "zz"
        out.append((i, " ".join(words)))
    return out


def test_components(docs, prose, monkeypatch):
    rows = [*near_copies(prose), (500, None), (501, ""), (502, " \t"), (503, "one"), (503, "one"), (504, "ONE")]
    want = plain_components({i: plain(t) for i, t in rows})
    for group in (4096, 3):  # the small one deals every group in chunks
        monkeypatch.setattr(simhash, "GROUP", group)
        out = simhash.linked(docs(*rows, clash=True)).collect()
        assert len(out) == len(rows)
        assert {r.doc_id: (r.code % (1 << 64), r.component_id) for r in out} == {i: (plain(t), want[i]) for i, t in rows}
    assert len(set(want.values())) < 120


def test_sample(sample):
    texts = {r.doc_id: r.text for r in sample.collect()}
    want = plain_components({i: plain(t) for i, t in texts.items()})
    assert {r.doc_id: r.component_id for r in simhash.linked(sample).collect()} == want


def test_one_document_of_each_group_stays(docs, prose):
    rows = near_copies(prose, 60)
    frame = docs(*rows, (3, rows[3][1]), (None, "no id"), (None, "no id"), clash=True)
    want = plain_components({i: plain(t) for i, t in rows})
    out = simhash.deduplicated(frame)
    assert out.columns == frame.columns
    ids = [r.doc_id for r in out.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(want.values())) and ids.count(None) == 2


def test_texts_that_share_a_doc_id(docs, prose):
    one, two, three, four = (prose(80, i) for i in (1, 2, 3, 4))
    rows = [(5, one), (5, two), (5, two), (9, one), (8, two), (7, three), (6, four), (7, four)]
    out = simhash.deduplicated(docs(*rows, clash=True)).collect()
    # 5 stays for both its texts, 7 for its first; its second belongs to 6
    assert sorted((r.doc_id, r.text) for r in out) == sorted([(5, one), (5, two), (7, three), (6, four)])


def test_null_ids_and_empty_table(docs):
    out = simhash.linked(docs((None, "a b c d e"), (5, "a b c d e"), (None, "q w e r t"))).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in out) == [(-1, -1), (-1, 5), (5, 5)]
    assert simhash.linked(docs().limit(0)).collect() == [] and simhash.deduplicated(docs().limit(0)).collect() == []
