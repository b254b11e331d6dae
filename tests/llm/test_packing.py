import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from layerwright.llm import packing
from layerwright.llm import spark as spark_helpers

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize(
    "text",
    ["", "it's I'LL don't''s x's", "a\x1cb c\x85d\xa0e\u2003f", "Ä́ é é ́x ΑΣ ΑΣ. İx 12a3 ½²", "漢字 ﬁ ⅷ Ⅷ", "a,.b ..,!! ;", "<|startoftext|> hi", " \n\t ",
     "<|endoftext|> ok", "a<|endoftext|>b <|endoftext|><|startoftext|>", "<|endoftext", "< |endoftext|>", "É<|ENDOFTEXT|>é  <|endoftext|>  é"],
)
def test_ids_are_those_of_the_library(tokenizer, text):
    ids = packing.WordIds(PATH).encode(text, odd=True)
    assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_bounded_memory_does_not_change_ids(tokenizer):
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("abcé'1,") for _ in range(5)) for _ in range(500))
    ids = packing.WordIds(PATH, most=20).encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def check(rows, texts, tokenizer, capacity):
    """Every piece of every text once, in gapless sequences of at most ``capacity``; texts: list of (doc_id, text)."""
    want = []
    for doc_id, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            own = ids[at : at + capacity]
            want.append((doc_id, piece, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted((tuple(r[:5]) for r in rows), key=key) == sorted(want, key=key)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_whole_table(sample, tokenizer):
    rows = packing.pack(sample, PATH).collect()
    found = check(rows, [(r.doc_id, r.text) for r in sample.collect()], tokenizer, 2048)
    assert found <= -(-sum(r.length for r in rows) // 2048) + 1


def test_odd_rows_and_small_capacity(docs, tokenizer):
    texts = [(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (None, "x " * 40), (4, "word " * 5000), (5, "zq" * 3000)]
    rows = packing.pack(docs(*texts, clash=True), PATH, capacity=16).select(*packing.PIECES.replace(" long", "").replace(" int", "").split(", "), "sequence_id", "offset").collect()
    check(rows, texts, tokenizer, 16)


def test_ids_on_demand(docs, tokenizer):
    rows = packing.pack(docs((1, "hello world " * 20)), PATH, capacity=16, with_ids=True).orderBy("piece").collect()
    assert [i for r in rows for i in r.ids] == [*tokenizer.encode("hello world " * 20, add_special_tokens=False).ids, 0]


def test_empty_table(docs):
    assert packing.pack(docs().limit(0), PATH).collect() == []


def sound(sizes, bins, capacity):
    assert (bins >= 0).all() and set(bins.tolist()) == set(range(bins.max() + 1))
    assert packing.fills(sizes, bins).max() <= capacity


def test_crossover_keeps_injected_bins_and_every_item():
    rng = np.random.default_rng(4)
    for _ in range(50):
        sizes = np.sort(rng.integers(1, 60, 80))[::-1]
        a, b = (packing.fresh(sizes, 100, rng.permutation(80)) for _ in range(2))
        child = packing.crossover(sizes, a, b, 100, rng)
        sound(sizes, child, 100)
        # injected bins stay together; displaced items may have joined them
        together = sum(len(set(child[b == k].tolist())) == 1 for k in range(b.max() + 1))
        assert together >= (b.max() + 1) // 4


def test_evolution_never_gets_worse_and_finds_a_perfect_packing():
    rng = np.random.default_rng(5)
    for _ in range(10):
        cuts = [np.diff(np.r_[0, np.sort(rng.choice(np.arange(1, 100), 3, replace=False)), 100]) for _ in range(30)]
        sizes = np.sort(np.concatenate(cuts))[::-1]
        start = [packing.fresh(sizes, 100, np.argsort(-sizes * rng.uniform(0.7, 1, len(sizes)), kind="stable")) for _ in range(6)]
        end = packing.evolve(sizes, start, 100, rng, 60)
        sound(sizes, end[0], 100)
        assert end[0].max() <= min(p.max() for p in start) and end[0].max() + 1 <= 31


def test_shards_of_one_third_equal_rows(spark):
    rows = spark.range(6000).selectExpr("id as row", "if(id % 3 = 0, 700, 1 + id % 600) as length")
    out = packing.packed(rows, 2048).collect()
    assert sorted(r.row for r in out) == list(range(6000))
    total = rows.groupBy().sum("length").first()[0]
    assert len({r.sequence_id for r in out}) <= total / 2048 * 1.01 + 1


def test_words_are_remembered_once():
    ids = packing.WordIds(PATH)
    ids.encode("Word word WORD, word. (word) other-word x1")
    assert not [part for part in ids.parts if part.isalpha() and part.islower()] and "word" in ids and "other" in ids


def test_a_task_gives_memory_back_at_its_end(monkeypatch):
    calls = []
    monkeypatch.setattr(spark_helpers, "give_back", lambda: calls.append(1))
    rows = spark_helpers._tidy(iter([1, 2, 3]), lambda part: (x + 1 for x in part))
    assert next(rows) == 2 and not calls
    assert list(rows) == [3, 4] and calls == [1]
    monkeypatch.undo()
    spark_helpers.give_back()
