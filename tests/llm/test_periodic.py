"""Runs against brute force over all periods and starts."""

import hashlib
import random
import zlib

import numpy as np
import pytest

pytest.importorskip("layerwright.llm")
from layerwright.llm import periodic, queries  # noqa: E402


def brute(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            size = i - start + q
            if i > start and size >= max(6, 4 * q):
                found.setdefault((start, size), q)
            i += i == start
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def periodic_words(rng, n, letters):
    words = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randrange(0, 5)):
        cycle = [rng.randrange(letters) for _ in range(rng.randrange(1, 9))]
        start = rng.randrange(max(n, 1))
        for i in range(start, min(n, start + rng.randrange(1, 60))):
            words[i] = cycle[(i - start) % len(cycle)]
    return [b"%d" % w for w in words]


def test_runs_equal_brute_force():
    rng = random.Random(5)
    for _ in range(1500):
        words = periodic_words(rng, rng.randrange(0, 120), rng.choice((1, 2, 3, 5, 40)))
        assert periodic.runs_of(periodic.word_numbers(words)) == brute(words), words


def test_suffix_order_of_many_words():
    """Texts of 65,536 and more words take another key of their windows."""
    rng = random.Random(6)
    words = [b"%d" % rng.randrange(9) for _ in range(70_000)]
    words[30_000:30_400] = [b"x", b"y"] * 200
    numbers = periodic.word_numbers(words)
    order, match = periodic.suffix_order(numbers)
    for at in rng.sample(range(1, len(order)), 200):
        i, j, n = int(order[at - 1]), int(order[at]), int(match[at])
        assert words[i : i + n] == words[j : j + n] and words[i : i + 20] < words[j : j + 20] or numbers[i + n : i + n + 1].size == 0 or numbers[j + n] > numbers[i + n]
        assert words[i : i + n + 1] != words[j : j + n + 1]
    runs = periodic.runs_of(numbers)
    assert any(s <= 30_000 and s + n >= 30_400 and q == 2 for s, n, q in runs)
    for s, n, q in runs:
        assert words[s : s + n - q] == words[s + q : s + n] and n >= max(6, 4 * q)


def test_one_word_repeated_and_no_run():
    assert periodic.runs_of(periodic.word_numbers([b"a"] * 5_000)) == [(0, 5_000, 1)]
    assert periodic.runs_of(periodic.word_numbers([b"a"] * 5)) == []
    assert periodic.runs_of(periodic.word_numbers([b"a", b"b"] * 3 + [b"a"])) == []
    assert periodic.runs_of(periodic.word_numbers([b"a", b"b"] * 4)) == [(0, 8, 2)]
    assert periodic.runs_of(periodic.word_numbers([])) == []


def test_kept_words():
    assert periodic.kept_words(10, [(1, 8, 2)]).tolist() == [True] * 3 + [False] * 6 + [True]
    assert periodic.kept_words(0, []).tolist() == np.zeros(0, bool).tolist()


def expected(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    milli = 1000 * best[1] // best[2] if runs else None
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    digests = [hashlib.sha256(x).hexdigest() for x in (lines.encode(), b" ".join(collapsed(words, runs)))]
    return (doc_id, len(runs), *best, milli, *digests)


def test_query_on_a_small_table(spark, docs, prose, tmp_path):
    rng = random.Random(8)
    rows = [(i, " ".join(w.decode() for w in periodic_words(rng, rng.randrange(0, 90), rng.choice((1, 3, 30))))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, "a b " * 40), (204, "a\x0bb\x0c" * 9), (205, prose(3000, 4))]
    rows += [(206, "na " * 20_000), (206, "na " * 20_000), (None, "so " * 9), (207, "x" * 100_000)]
    docs(*rows, clash=True).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op11_maximal_pair_runs(spark, str(tmp_path)).collect()
    wanted = [expected(*row) if len(row[1] or "") < 20_000 or row[0] == 207 else None for row in rows]
    assert len(found) == len(rows)
    assert {tuple(r) for r in found if r["doc_id"] != 206} == {w for w in wanted if w}
    hot = [r for r in found if r["doc_id"] == 206]
    assert len(hot) == 2 and all(r["n_runs"] == 1 and r["period"] == 1 and r["length"] == 20_000 for r in hot)


def test_empty_table(docs):
    assert periodic.digests(periodic.found(periodic.with_planted(docs((1, "a")).limit(0)))).count() == 0


def test_partitioning_does_not_matter(docs, prose):
    frame = docs(*[(i, prose(50, i) + " tick tock" * (i % 9)) for i in range(60)])
    rows = [sorted(map(str, periodic.found(frame.repartition(n)).collect())) for n in (1, 7)]
    assert rows[0] == rows[1]
