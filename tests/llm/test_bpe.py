import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from layerwright.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def coder():
    return bpe.Encoder(PATH, bpe.PATTERN)


@pytest.fixture(scope="module")
def library(coder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks.ids, special_tokens={})


def same(coder, library, texts):
    for text, ids in zip(texts, coder.encode(pa.array(texts, pa.string())), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text), text[:60]
        assert coder.decode(ids) == text.encode()


def test_pattern(coder):
    assert bpe.PATTERN == public_tokenizers.PATTERN


def test_random_text(coder, library):
    rng = random.Random(1)
    letters = " '\n\t\x85\xa0 abstrevlmdABÅßé²½1٣中文😀!?_-\x1cćᾳɏɐ"
    same(coder, library, ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(3000)])


def test_long_and_odd_pieces(coder, library):
    same(coder, library, ["", "a" * 3000 + " " * 2000 + "x", "the" * 2000, "=-" * 2000, "'" * 50, "don't 'tis ''s I'LL we'll'll", "\r\n \n", "é" * 700])


def test_both_trees_agree(coder):
    rng = random.Random(2)
    pieces = list({bytes(rng.choice(b"abcdeth ing\xc3\xa9") for _ in range(rng.randrange(2, 90))) for _ in range(800)})
    pieces = [p for p in pieces if p not in coder.ranks.ids]
    assert [np.frombuffer(x, "<u4").tolist() for x in bpe.merge_pieces(pieces, coder.ranks)] == [bpe.merge_piece(p, coder.ranks) for p in pieces]


def test_memory_is_bounded(library):
    small = bpe.Encoder(PATH, bpe.PATTERN, most=10)
    for i in range(5):
        same(small, library, [f"word{i} {k}" for k in range(40)])
    assert len(small.known) < 200


def test_digests(sample, docs, library, coder):
    texts = {r.doc_id: r.text for r in sample.collect()}
    for frame, own in ((sample, texts), (docs((1, None), (2, ""), (3, "a'll"), (3, "a'll"), clash=True), {1: "", 2: "", 3: "a'll"})):
        out = bpe.digests(frame, PATH).collect()
        assert len(out) == frame.count()
        for r in out:
            ids = library.encode_ordinary(own[r.doc_id])
            assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(own[r.doc_id].encode()).hexdigest()
    assert bpe.digests(docs().limit(0), PATH).collect() == []


def test_ids(docs, library):
    (row,) = bpe.encoded(docs((1, "Hello, world's end")), PATH).collect()
    assert row.ids == library.encode_ordinary("Hello, world's end")
