"""Exact duplicates against grouping by the normalised text itself."""

import hashlib
import random
import re

import pytest

pytest.importorskip("layerwright.llm")
from layerwright.llm import recipes  # noqa: E402


def brute(rows):
    """(doc_id, keep_id, group_size, text digest) of each row, and the number of kept rows per text."""
    texts = [re.sub(r"[\x20\x09-\x0d]+", " ", text or "") for _, text in rows]
    groups = {}
    for (doc_id, _), text in zip(rows, texts, strict=True):
        groups.setdefault(text, []).append(doc_id)
    least = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(
        str((doc_id, least[t], len(groups[t]), hashlib.sha256(t.encode()).hexdigest()))
        for (doc_id, _), t in zip(rows, texts, strict=True)
    )


def check(frame, rows, **how):
    found = recipes.classes(frame, **how).collect()
    assert sorted(str((r.doc_id, r.keep_id, r.group_size, r.text_sha256)) for r in found) == brute(rows)
    kept = [r for r in found if r.kept]
    assert len(kept) == len({r.text_sha256 for r in found}) and all(r.doc_id == r.keep_id for r in kept)


def cases(prose):
    long = prose(9_000, 3)
    rows = [(i, prose(40 + i % 5 * 300, i % 17)) for i in range(120)]
    rows += [(300, None), (301, ""), (302, " "), (303, "\t\n "), (304, "a b"), (305, "a  b"), (306, "a b"), (307, " a b")]
    rows += [(308, "a b "), (309, "a\x0bb"), (310, "a\x1cb"), (310, "a\x0cb"), (None, "a b"), (None, "only here"), (None, "only here")]
    rows += [(400, long), (401, long), (402, long + "x"), (403, "x" + long), (404, long.replace(" ", "\n", 50)), (405, "y" * 100_000)]
    rows += [(406, "y" * 100_000), (407, "y" * 99_999), (408, long[:-1] + "é"), (400, long)]
    return rows


def test_classes_equal_brute_force(docs, prose):
    rows = cases(prose)
    frame = docs(*rows, clash=True)
    for parts in (1, 5):
        check(frame.repartition(parts), rows)


def test_identifiers_that_collide_are_drawn_anew(docs, prose, monkeypatch):
    """One byte per identifier: some of a few hundred different chunks share one, and no two texts may become one."""
    rows = [(i, prose(12, i)) for i in range(700)] * 2
    widths = []
    write = recipes.partial
    monkeypatch.setattr(recipes, "partial", lambda f, **k: widths.append(k["width"]) or write(f, **k))
    check(docs(*rows), rows, width=1)
    assert max(widths) > 1


def test_a_text_is_cut_alike_anywhere():
    rng = random.Random(2)
    text = bytes(rng.randrange(97, 123) for _ in range(60_000))

    def lengths(before):
        marks = recipes.cut_marks(before + text)
        ends = recipes.ends_of(len(before), len(before) + len(text), marks[marks > len(before)].tolist())
        return [e - len(before) for e in ends]

    alone = lengths(b"")
    assert alone == lengths(b"other text " * 20) and alone[-1] == len(text) and len(alone) > 10
    sizes = [b - a for a, b in zip([0, *alone], alone, strict=False)]
    assert all(recipes.LEAST <= s <= recipes.MOST for s in sizes[:-1])
    # an insertion changes the chunks around it only
    changed = text[:30_000] + b"inserted" + text[30_000:]
    ends = recipes.ends_of(0, len(changed), recipes.cut_marks(changed).tolist())
    assert len(set(alone[-5:]) & {e - 8 for e in ends}) == 5 and set(alone[:5]) <= set(ends)
    assert recipes.ends_of(0, 50_000, []) == [16_384, 32_768, 49_152, 50_000] and recipes.ends_of(7, 7, []) == []


def test_normalised():
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice(" \t\n\x0b\x0c\rab\x1c\x85 é") for _ in range(rng.randrange(0, 12)))
        assert recipes.normalised(text.encode()).decode() == re.sub(r"[\x20\x09-\x0d]+", " ", text)


def test_deduplicated_keeps_columns_and_one_row_per_text(docs, prose):
    rows = cases(prose)
    frame = docs(*rows, clash=True)
    left = recipes.deduplicated(frame)
    assert left.columns == frame.columns
    texts = [re.sub(r"[\x20\x09-\x0d]+", " ", r.text or "") for r in left.collect()]
    assert len(texts) == len(set(texts)) == len({re.sub(r"[\x20\x09-\x0d]+", " ", t or "") for _, t in rows})


def test_empty_table(docs):
    assert recipes.classes(docs((1, "a")).limit(0)).count() == 0
    assert recipes.deduplicated(docs((1, "a")).limit(0)).count() == 0


def test_bitmap_has_every_shared_recipe(docs, prose):
    made = recipes.recipes(docs(*[(i, prose(9, i % 300)) for i in range(500)]))
    bits = recipes.shared_bitmap(made)
    marks = [r.mark for r in made.groupBy("recipe", "mark").count().filter("count > 1").collect()]
    assert len(marks) == 200 and all(bits[m % (8 * len(bits)) >> 3] >> (m & 7) & 1 for m in marks)
    assert sum(bin(b).count("1") for b in bits) <= 200
