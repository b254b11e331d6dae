import math
from collections import Counter

import numpy as np

from layerwright.llm import quality


def base(text):
    text = text or ""
    words = [w.decode() for w in text.encode().split()]
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated), failed


def counts(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_counts_by_brute_force(sample, docs):
    texts = {r.doc_id: r.text for r in sample.collect()}
    assert {r.doc_id: counts(r) for r in quality.judge(sample).collect()} == {i: base(t) for i, t in texts.items()}
    odd = [(1, None), (2, ""), (3, " \n\t\x0b"), (4, "a\n a\na\n\na\xa0b\r\na\r"), (5, "x " * 70), (6, "é" * 3 + " |#" * 60), (7, "w" * 300_000)]
    out = quality.judge(docs(*odd, odd[3], clash=True)).collect()
    assert len(out) == 8 and all(counts(r) == base(dict(odd)[r.doc_id]) for r in out)
    assert not any(r.kept for r in out)


def test_distance_by_definition():
    p, q = np.array([[3.0, 1.0, 0.0]]), np.array([0.25, 0.25, 0.5])
    m = [(a / 4 + b) / 2 for a, b in zip(p[0], q, strict=True)]
    kl = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m, strict=True) if a)
    assert abs(quality.distance(p, q)[0] - math.sqrt((kl(p[0] / 4) + kl(q)) / 2)) < 1e-12
    assert quality.distance(np.array([[1.0, 0]]), np.array([0, 1.0]))[0] == 1


def test_prose_stays_and_junk_goes(docs, prose):
    good = [(i, prose(60 + 5 * i, i)) for i in range(60)]
    symbols = [(100 + i, " ".join(w + "&&&" for w in prose(200, i).split())) for i in range(3)]
    strange = [(200 + i, " ".join(f"zq{i}{k}vx" for k in range(300))) for i in range(3)]
    out = {r.doc_id: r for r in quality.judge(docs(*good, *symbols, *strange, (300, prose(200, 1), None))).collect()}
    assert all(out[i].kept for i, _ in good) and out[300].kept
    assert not any(out[i].kept for i, _ in [*symbols, *strange]) and not any(out[i].base_failed for i, _ in [*symbols, *strange])


def test_references_are_counts_of_all_passing_documents(docs, prose):
    rows = [(i, prose(80, i), "xx" if i % 2 else "yy") for i in range(20)] + [(90, "short", "xx"), (91, prose(80, 3), None)]
    refs = quality.references(docs(*rows), quality.Limits(common_words=5)).collect()
    for lang in ("xx", "yy"):
        words = Counter(w for _, t, g in rows[:20] if g == lang for w in t.split())
        top = sorted(words.items(), key=lambda x: (-x[1], x[0].encode()))[:5]
        assert sorted((bytes(r.item).decode(), r.n) for r in refs if r.lang == lang and r.kind == "word") == sorted(top)
        assert [r.n for r in refs if r.lang == lang and r.kind == "words"] == [sum(words.values())]
        assert [r.n for r in refs if r.lang == lang and r.kind == "documents"] == [10]


def test_filter_keeps_columns_and_agrees_with_verdicts(sample):
    kept = {r.doc_id for r in quality.judge(sample).filter("kept").collect()}
    out = quality.passed(sample)
    assert out.schema == sample.schema and {r.doc_id for r in out.collect()} == kept


def test_empty_table(docs):
    assert quality.judge(docs().limit(0)).collect() == [] and quality.passed(docs().limit(0)).collect() == []


def test_every_language_has_its_reference(docs):
    """More languages than any list of common ones; half of the common words are shared by all."""
    shared = [f"all{k}" for k in range(20)]
    text = lambda lang, i: " ".join(w for k in range(60) for w in (shared[(k + i) % 20], f"w{lang}x{(k * 7 + i) % 30}"))
    rows = [(lang * 2 + i, text(lang, i), f"l{lang:03d}") for lang in range(300) for i in range(2)]
    out = quality.judge(docs(*rows)).collect()
    assert len(out) == 600 and all(r.kept and r.nearest_lang == f"l{r.doc_id // 2:03d}" for r in out)


def test_sparse_distances_by_definition(docs, prose, monkeypatch):
    rows = [(i, prose(60 + i, i) + " " + f"own{i % 3} " * (i % 7), f"l{i % 3}") for i in range(30)]
    refs = quality.references(docs(*rows), quality.Limits(common_words=40))
    model = quality.read_model(refs)
    stored = {}
    for r in refs.collect():
        stored.setdefault((r.lang, r.kind), {})[bytes(r.item).decode()] = r.n
    texts = [t for _, t, _ in rows] + ["none of these " * 20]
    got = quality._measure(quality.strings(quality.pa.array(texts)), quality.Limits())
    words = got["words"]
    for bound in (1_000_000, 7):
        monkeypatch.setattr(quality, "POSTINGS", bound)
        by_word = quality.word_distances(words.owner, words.keys, got["n_words"], model)
        by_class = quality.class_distances(got["classes"], model)
        for i, lang in enumerate(model.langs):
            common, total = stored[lang, "word"], stored[lang, "words"][""]
            share = np.array([*common.values(), total - sum(common.values())]) / total
            classes = np.array([stored[lang, "class"].get(c, 0) for c in quality.CLASSES], float)
            for j, text in enumerate(texts):
                counts = Counter(text.split())
                own = [counts[w] for w in common]
                row = np.array([[*own, sum(counts.values()) - sum(own)]], float)
                assert abs(by_word[i, j] - quality.distance(row, share)[0]) < 1e-7
                assert abs(by_class[i, j] - quality.distance(got["classes"][j : j + 1], classes / classes.sum())[0]) < 1e-7
    monkeypatch.setattr(quality, "CELLS", 5)
    few = {r.doc_id: r for r in quality.judge(docs(*rows)).collect()}
    monkeypatch.undo()
    assert few == {r.doc_id: r for r in quality.judge(docs(*rows)).collect()}


def test_distance_by_chance():
    share = np.array([0.3, 0.2, 0.1, 0.05, 0.35])
    rng = np.random.default_rng(1)
    for i, n in enumerate(quality.LENGTHS[:6]):
        drawn = rng.poisson(n * share, (20_000, len(share))) / n
        m = (drawn + share) / 2
        with np.errstate(divide="ignore", invalid="ignore"):
            part = np.where(drawn > 0, drawn * np.log2(drawn / m), 0) + share * np.log2(share / m)
        assert abs(quality.by_chance(share)[i] - (part.sum(1).mean() / 2) ** 0.5) < 2e-3
