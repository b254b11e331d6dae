import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from layerwright.llm import language


def plain_grams(text):
    clean = "".join(c.lower()[0] if c.isalpha() else " " for c in text)
    squeezed = []
    for i, c in enumerate(clean):
        if c != " " or (i and clean[i - 1] != " "):
            squeezed.append(c)
    padded = "   " + "".join(squeezed)
    return [padded[i : i + 4] for i in range(len(padded) - 3)]


def plain_probability(counts, gram, floor):
    """Interpolated Kneser-Ney by its formula."""
    tables, grams = [], Counter(counts)
    for _ in range(4):
        tables.insert(0, grams)
        grams = Counter(g[1:] for g in grams)
    p = floor
    for order, table in enumerate(tables, 1):
        ones, twos = sum(v == 1 for v in table.values()), sum(v == 2 for v in table.values())
        discount = min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones else 0.5
        own = gram[4 - order :]
        same = {g: v for g, v in table.items() if g[:-1] == own[:-1]}
        if same:
            total = sum(same.values())
            rest = 1 - sum(max(v - discount, 0) / total for v in same.values())
            p = max(same.get(own, 0) - discount, 0) / total * (own in same) + rest * p
    return p


def key_of(gram):
    return sum(ord(c) << 16 * (3 - i) for i, c in enumerate(gram))


def test_grams():
    texts = ["", "  ", "Ab, c!", "x", "É1é  ß", "ab"]
    keys, owner, count = language.letters(pa.array(texts))
    for i, text in enumerate(texts):
        assert keys[owner == i].tolist() == [key_of(g) for g in plain_grams(text)]
        assert count[i] == sum(c.isalpha() for c in text)


def test_probabilities_by_formula():
    counts = Counter(plain_grams("the cat sat on the mat and the dog sat on the cat"))
    keys = np.array([key_of(g) for g in counts], np.uint64)
    model = language.KneserNey(keys, np.array(list(counts.values())))
    for gram in ["the ", " cat", "xyza", "aaat", "   t", "   q", "n th"]:
        want = plain_probability(counts, gram, model.floor)
        assert math.isclose(model.bits(np.array([key_of(gram)], np.uint64))[0], -math.log2(want), rel_tol=1e-9), gram


def test_counts_cover_all_documents(spark, docs):
    rows = [(1, "abc ab", "x"), (2, "abc", "x"), (3, "abc", "y"), (4, None, "x"), (5, "zzz", None)]
    want = Counter((lang, g) for _, t, lang in rows if t and lang for g in plain_grams(t))
    got = {(r.lang, r.key): r.n for r in language.gram_counts(docs(*rows)).collect()}
    assert got == {(lang, key_of(g)): n for (lang, g), n in want.items()}


def test_rare_grams_of_a_large_language_are_kept(docs):
    rows = [(i, "ab cd " * 50_000, "xx") for i in range(6)] + [(9, "rare", "xx")]
    got = {r.key: r.n for r in language.gram_counts(docs(*rows)).collect()}
    assert all(got.get(key_of(g)) == 1 for g in plain_grams("rare"))


def corpus():
    rng = random.Random(1)
    parts = {"xx": "ba ko ri tu ma".split(), "yy": "sch ung der ein icht".split(), "zz": "éau oux tré ais".split()}
    rows = []
    for i in range(300):
        lang = ("xx", "yy", "zz")[i % 3]
        text = " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(5, 60)))
        rows.append((i, text, lang))
    return rows


def test_prediction_uses_the_text_alone_and_not_the_held_out(spark, docs):
    rows = corpus()
    odd = [(1000, None, "xx"), (1001, "12 !", "xx"), (1002, "", None), (None, rows[0][1], None), (1004, "жщю яцф " * 40, None), (1005, "baKO", None)]
    out = {r.doc_id: r for r in language.identified(docs(*rows, *odd, clash=True)).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert {r.doc_id for r in out.values() if r.held_out and r.doc_id < 1000} == {r[0] for r in held} and not out[None].held_out
    assert all(out[i].lang_pred == lang and out[i].accepted for i, _, lang in rows)
    assert [(out[i].lang_pred, out[i].score, out[i].accepted) for i in (1000, 1001, 1002)] == [("und", 0.0, False)] * 3
    assert out[None].lang_pred == "xx" and out[1005].lang_pred == "xx" and not out[1004].accepted
    assert all(0 <= r.score <= 1 for r in out.values())
    # other labels of held-out documents change nothing
    wrong = [(i, t, "yy" if zlib.crc32(str(i).encode()) % 5 == 0 else lang) for i, t, lang in rows]
    again = {r.doc_id: r.score for r in language.identified(docs(*wrong)).collect()}
    assert all(again[i] == out[i].score for i, _, _ in rows)


@pytest.mark.parametrize("share", [0.01, 0.1, 0.33])
def test_any_share_of_foreign_documents_is_rejected(docs, share):
    rows = corpus()
    foreign = [(1000 + i, f"жщю яцф {'ъыэ' * (i % 7 + 1)} " * 40, None) for i in range(round(300 * share / (1 - share)))]
    out = {r.doc_id: r.accepted for r in language.identified(docs(*rows, *foreign)).collect()}
    assert all(out[i] for i, _, _ in rows) and not any(out[i] for i, _, _ in foreign)


def test_held_out_accuracy(sample):
    truth = {r.doc_id: r.lang for r in sample.collect()}
    out = [r for r in language.identified(sample).collect() if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in out) >= 0.97 * len(out)


def test_accepted_keeps_columns(docs):
    frame = docs(*corpus(), (1001, "12", "xx"), clash=True)
    out = language.accepted(frame)
    assert out.columns == frame.columns and {r.doc_id for r in out.collect()} == set(range(300))


def test_accepted_judges_each_row(docs):
    rows = corpus()
    foreign = "жщю яцф " * 40
    odd = [(None, rows[0][1], "xx"), (None, rows[1][1], None), (None, foreign, None), (7, foreign, None), (8, rows[8][1], rows[8][2])]
    out = [(r.doc_id, r.text) for r in language.accepted(docs(*rows, *odd)).collect()]
    want = [(i, t) for i, t, _ in [*rows, *odd] if t != foreign]
    assert sorted(out, key=str) == sorted(want, key=str)


def test_nothing_to_learn_from_and_empty_table(docs):
    assert [r.lang_pred for r in language.identified(docs((1, "abc", None), (2, "x", None))).collect()] == ["und", "und"]
    assert language.identified(docs().limit(0)).collect() == []
