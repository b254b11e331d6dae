"""Quality rules: counts of a text, and its distance from the usual text of a language.

``references`` gathers, over all documents that pass the count rules, two histograms per language: character classes
and common words (plus one bin for all other words). ``judge`` compares each document with every reference by
Jensen-Shannon distance (base 2, so 0 to 1) and rejects it if even the nearest reference is further away than a limit
that shrinks with the length of the text. A distance counts only for texts of a minimum length, as histograms of short texts are far from any reference by chance.

Defined results. A null or empty text has no words: all counts 0, ``base_failed`` true, ``kept`` false, distances null.
A document without a language adds to no reference but is judged like the others. Without any reference (no document
with a language passes the count rules) the distances are null and the count rules alone decide. Repeated rows are
judged alike, each by itself. Ties between common words go to the smaller word, between languages to the smaller name.
Very long texts are held by one task, at some 60 bytes of memory per byte of text. Every language has its reference, however
many there are; texts are compared with a bounded number of languages at once, over the words they have in common.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerwright.llm.spark import arrow_schema, batches, map_batches, pieces_of, stage_table, strings
from layerwright.llm.words import find_words, inside, per_text, window_keys

SYMBOLS = b"#*$%&|<>"
SLICE = 1 << 20  # bytes of text that are worked on at once
CELLS = 500_000  # distances of texts from languages that are held at once
POSTINGS = 1_000_000  # common words of texts, once per language that has them, that are held at once
CLASSES = ("lower", "upper", "digit", "space", "symbol", "stop", "mark", "beyond_ascii", "control")
_PLAIN = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
JUDGED = (
    f"{_PLAIN}, base_failed boolean, kept boolean, char_distance double, word_distance double, nearest_lang string"
)
PARTIAL = "lang string, kind string, item binary, n long"


@dataclass(frozen=True)
class Limits:
    min_words: int = 50  # of a document at all
    repeat_percent: int = 50  # of the words may be in repeated windows
    common_words: int = 200  # bins per language
    min_chars: int = 100  # for the character distance to count
    min_common: int = 50  # words, for the word distance to count
    char_distance: float = 0.26  # the limit for endless texts
    char_chance: float = 1.2  # over the root of the length is added, as histograms of short texts vary more
    word_distance: float = 0.50
    word_chance: float = 0.6
    beyond_chance: float = 0.08  # a text drawn from the reference itself is this far within the limit on average


def _classes() -> np.ndarray:
    table = np.full(256, 8, np.uint8)
    table[33:127] = 6
    table[ord("a") : ord("z") + 1] = 0
    table[ord("A") : ord("Z") + 1] = 1
    table[ord("0") : ord("9") + 1] = 2
    table[list(b" \t\n\x0b\x0c\r")] = 3
    table[list(SYMBOLS)] = 4
    table[list(b".,;:!?")] = 5
    table[0x80:0xC0] = 15  # later bytes of a character
    table[0xC0:] = 7
    return table


_CLASS_OF = _classes()


def _measure(texts: pa.StringArray, limits: Limits) -> dict:
    words = find_words(texts)
    n, counts = len(texts), words.counts
    byte_owner = np.repeat(np.arange(n), np.diff(words.offsets))
    classes = np.bincount(byte_owner * 16 + _CLASS_OF[words.data], minlength=n * 16).reshape(n, 16)[:, : len(CLASSES)]
    windows, good = window_keys(words.keys, 3), inside(words, 3)
    at = np.flatnonzero(good)
    repeated = np.zeros(len(words.keys), bool)
    if len(at):
        owner = words.owner[at].astype(np.uint64)
        own = windows[at] ^ (owner * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(own, kind="stable")
        same = own[order][1:] == own[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        hit = at[twice]
        for k in range(3):
            repeated[hit + k] = True
    lines = []
    for text in texts.to_pylist():
        filled = [line for line in text.encode().split(b"\n") if line.strip()] if "\n" in text else ()
        lines.append(len(filled) - len(set(filled)))
    repeats = per_text(repeated, words.first)
    return {
        "words": words,
        "classes": classes,
        "n_words": counts,
        "word_chars": classes.sum(1) - classes[:, 3],
        "n_symbols": classes[:, 4],
        "n_dup_lines": np.array(lines, np.int64),
        "n_repeat_words": repeats,
        "base_failed": (counts < limits.min_words) | (100 * repeats > limits.repeat_percent * counts),
    }


def _gather(rows: Iterator[pa.RecordBatch], limits: Limits) -> Iterator[pa.RecordBatch]:
    """Partial counts per language: of the words, and of the character classes, of documents that pass."""
    schema = arrow_schema(PARTIAL)
    classes: dict[str, np.ndarray] = {}
    documents: dict[str, int] = {}
    totals: dict[str, int] = {}
    found: dict[str, list] = {}
    size = 0

    def flush():
        for lang, parts in found.items():
            keys, index = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            n = np.bincount(index, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64)
            names = np.empty(len(keys), object)
            names[index] = np.concatenate([p[2] for p in parts])
            yield from batches(
                {"lang": [lang] * len(keys), "kind": ["word"] * len(keys), "item": names.tolist(), "n": n.tolist()}, schema
            )
        found.clear()

    for batch in rows:
        for part in pieces_of(batch, "text", SLICE):
            got = _measure(strings(part.column("text")), limits)
            words, langs = got["words"], part.column("lang").to_pylist()
            fit = ~got["base_failed"]
            for lang in {x for x, ok in zip(langs, fit, strict=True) if ok and x is not None}:
                mine = fit & np.array([x == lang for x in langs])
                classes[lang] = classes.get(lang, 0) + got["classes"][mine].sum(0)
                documents[lang] = documents.get(lang, 0) + int(mine.sum())
                totals[lang] = totals.get(lang, 0) + int(words.counts[mine].sum())
                at = np.flatnonzero(np.repeat(mine, words.counts))
                keys, first, n = np.unique(words.keys[at], return_index=True, return_counts=True)
                spans = zip(words.starts[at[first]].tolist(), words.ends[at[first]].tolist(), strict=True)
                whole = words.data.tobytes()
                names = np.empty(len(keys), object)
                names[:] = [whole[a:b] for a, b in spans]
                found.setdefault(lang, []).append((keys, n, names))
                size += len(keys)
            if size > 600_000:
                yield from flush()
                size = 0
    yield from flush()
    for lang, n in classes.items():
        items = [name.encode() for name in CLASSES] + [b"", b""]
        kinds = ["class"] * len(CLASSES) + ["documents", "words"]
        counts = [*n.tolist(), documents[lang], totals[lang]]
        yield from batches({"lang": [lang] * len(items), "kind": kinds, "item": items, "n": counts}, schema)


def references(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Rows ``lang, kind, item, n``: the class counts, the document count, the word total (kind ``words``) and the
    counts of the common words of each language, over all documents that pass the count rules."""
    found = map_batches(docs.select("text", "lang"), partial(_gather, limits=limits), PARTIAL)
    totals = found.groupBy("lang", "kind", "item").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "item"))
    return totals.withColumn("_rank", rank).filter(F.col("_rank") <= limits.common_words).drop("_rank")


@dataclass(frozen=True)
class Model:
    langs: list[str]  # sorted
    classes: np.ndarray  # language x class, shares
    keys: np.ndarray  # of all common words, sorted
    first: np.ndarray  # per key, and one more, where its languages begin in the next two
    lang_of: np.ndarray
    share_of: np.ndarray
    rest: np.ndarray  # per language, the share of all other words
    chance: np.ndarray  # language x length, the distance by chance at LENGTHS


def read_model(refs: DataFrame, limits: Limits = Limits()) -> Model:
    """The references of every language on the driver: ``common_words`` numbers and a few more per language."""
    rows = refs.select("lang", "kind", "item", "n").toArrow()
    at = {lang: i for i, lang in enumerate(sorted(set(rows.column("lang").to_pylist())))}
    size = len(at)
    lang = np.array([at[x] for x in rows.column("lang").to_pylist()], np.int64)
    kind, item = np.array(rows.column("kind").to_pylist(), object), np.array(rows.column("item").to_pylist(), object)
    n = rows.column("n").to_numpy()
    classes = np.zeros((size, len(CLASSES)))
    for i, name in enumerate(CLASSES):
        mine = (kind == "class") & (item == name.encode())
        classes[lang[mine], i] = n[mine]
    totals = np.zeros(size)
    totals[lang[kind == "words"]] = n[kind == "words"]
    word = kind == "word"
    keys = find_words(pa.array([w.decode() for w in item[word]], pa.string())).keys
    owner, share = lang[word], n[word] / totals[lang[word]]
    order = np.lexsort((owner, keys))
    keys, owner, share = keys[order], owner[order], share[order]
    every, first = np.unique(keys, return_index=True)
    rest = np.clip(1 - np.bincount(owner, share, size), 0, 1)
    chance = np.array([by_chance(np.append(share[owner == i], rest[i])) for i in range(size)]).reshape(size, len(LENGTHS))
    whole = np.maximum(classes.sum(1, keepdims=True), 1)
    return Model(list(at), classes / whole, every, np.append(first, len(keys)), owner, share, rest, chance)


def distance(counts: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance, base 2, of each row of counts from the shares."""
    p = counts / np.maximum(counts.sum(1, keepdims=True), 1)
    m = (p + share) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(1)
        right = np.where(share > 0, share * np.log2(share / m), 0).sum(1)
    return np.sqrt(np.clip((left + right) / 2, 0, 1))


def _part(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """What a bin with the shares p and q adds to twice the squared distance."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(p > 0, p * np.log2(2 * p / (p + q)), 0) + np.where(q > 0, q * np.log2(2 * q / (p + q)), 0)


def class_distances(classes: np.ndarray, model: Model) -> np.ndarray:
    """Language x text: the distance of the texts' class counts from each language."""
    p = classes / np.maximum(classes.sum(1, keepdims=True), 1)
    total = np.zeros((len(model.langs), len(classes)))
    for i in range(classes.shape[1]):
        total += _part(p[None, :, i], model.classes[:, i, None])
    return np.sqrt(np.clip(total / 2, 0, 1))


def word_distances(owner: np.ndarray, keys: np.ndarray, n_words: np.ndarray, model: Model) -> np.ndarray:
    """Language x text: the distance of the texts' words from each language. Only words that a text has and a language
    counts as common are looked at: a bin that the text leaves empty adds its share, so those add up to what is left."""
    size, n = len(model.langs), len(n_words)
    at = np.minimum(np.searchsorted(model.keys, keys), len(model.keys) - 1)
    known = model.keys[at] == keys
    pairs, times = np.unique(owner[known] * len(model.keys) + at[known], return_counts=True)
    text, at = pairs // len(model.keys), pairs % len(model.keys)
    seen, met = np.zeros(size * n), np.zeros(size * n)
    found = np.zeros(size * n)
    fan = model.first[at + 1] - model.first[at]
    ends = np.cumsum(fan)
    begin = 0
    while begin < len(pairs):  # a bounded number of (text, word, language) at once
        end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + POSTINGS, "right")))
        width = fan[begin:end]
        of = np.repeat(np.arange(begin, end), width)
        post = model.first[at[of]] + np.arange(len(of)) - np.repeat(np.cumsum(width) - width, width)
        cell, q = model.lang_of[post] * n + text[of], model.share_of[post]
        p = times[of] / n_words[text[of]]
        found += np.bincount(cell, _part(p, q), size * n)
        seen += np.bincount(cell, times[of], size * n)
        met += np.bincount(cell, q, size * n)
        begin = end
    found, seen, met = (x.reshape(size, n) for x in (found, seen, met))
    rest = np.broadcast_to(model.rest[:, None], (size, n))
    others = np.maximum(n_words - seen, 0) / np.maximum(n_words, 1)
    return np.sqrt(np.clip((found + _part(others, rest) + np.maximum(1 - rest - met, 0)) / 2, 0, 1))


LENGTHS = np.array([50, 70, 100, 140, 200, 280, 400, 800, 1600, 6400])


def by_chance(share: np.ndarray) -> np.ndarray:
    """The usual distance from the shares of texts of LENGTHS words that are drawn from them. A bin adds a function of
    the words expected in it alone, over the length of the text."""
    usual = np.log(_EXPECTED), _by_expected()
    share = np.maximum(share[share > 0], 1e-6)
    return np.array([(np.interp(np.log(n * share), *usual).sum() / n) ** 0.5 for n in LENGTHS])


_EXPECTED = np.geomspace(1e-6 * LENGTHS[0], LENGTHS[-1], 2000)


@cache
def _by_expected() -> np.ndarray:
    """What a bin with so many words expected adds on average, times the length, if their number is a Poisson one."""
    out = []
    for mean in _EXPECTED:
        k = np.arange(max(0, int(mean - 8 * mean**0.5)), int(mean + 8 * mean**0.5 + 12))
        log_p = k * np.log(mean) - mean - np.cumsum(np.r_[_log_factorial(k[0]), np.log(k[1:])])
        out.append(max(float((np.exp(log_p) * _part(k.astype(float), np.array(mean))).sum()) / 2, 0.0))
    return np.array(out)


def _log_factorial(k: int) -> float:
    return float(np.log(np.arange(1, k + 1)).sum())


def _nearest(got: dict, rows: slice, model: Model, limits: Limits) -> tuple:
    """Of some texts: the nearest language, how far beyond its limit they are, both distances and whether they count."""
    words, n_words, classes = got["words"], got["n_words"][rows], got["classes"][rows]
    keys = words.keys[words.first[rows.start] : words.first[rows.stop]]
    by_class = class_distances(classes, model)
    by_word = word_distances(np.repeat(np.arange(len(n_words)), n_words), keys, n_words, model)
    n_chars = classes.sum(1)
    enough_chars, enough_words = n_chars >= limits.min_chars, n_words >= limits.min_common
    most_char = limits.char_distance + limits.char_chance / np.sqrt(np.maximum(n_chars, 1))
    most_word = limits.word_distance + limits.word_chance / np.sqrt(np.maximum(n_words, 1))
    left = np.clip(np.searchsorted(LENGTHS, n_words, "right") - 1, 0, len(LENGTHS) - 2)
    part = np.clip((n_words - LENGTHS[left]) / (LENGTHS[left + 1] - LENGTHS[left]), 0, 1)
    usual = model.chance[:, left] * (1 - part) + model.chance[:, left + 1] * part
    most_word = np.maximum(most_word, usual + limits.beyond_chance)
    excess = np.maximum(np.where(enough_chars, by_class / most_char, 0), np.where(enough_words, by_word / most_word, 0))
    best = excess.argmin(0) * (enough_chars | enough_words)
    at = best, np.arange(len(n_words))
    return best, excess.min(0), by_class[at], by_word[at], enough_chars, enough_words


def _judge(rows: Iterator[pa.RecordBatch], model: Model, limits: Limits) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(JUDGED)
    for batch in rows:
        for part in pieces_of(batch, "text", SLICE):
            got = _measure(strings(part.column("text")), limits)
            words, n = got["words"], part.num_rows
            columns = {k: got[k].tolist() for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
            kept, chars, common, nearest = ~got["base_failed"], None, None, [None] * n
            if model.langs:
                step = max(1, CELLS // len(model.langs))
                near = [_nearest(got, slice(a, min(a + step, n)), model, limits) for a in range(0, n, step)]
                best, excess, by_class, by_word, enough_chars, enough_words = map(np.concatenate, zip(*near, strict=True))
                pick = lambda values, ok: [x if o else None for x, o in zip(values.tolist(), ok, strict=True)]
                chars, common = pick(by_class, enough_chars), pick(by_word, enough_words)
                nearest = [model.langs[b] if o else None for b, o in zip(best, enough_chars | enough_words, strict=True)]
                kept = kept & (excess <= 1)
            columns |= {
                "doc_id": part.column("doc_id").to_pylist(),
                "base_failed": got["base_failed"].tolist(),
                "kept": kept.tolist(),
                "char_distance": chars or [None] * n,
                "word_distance": common or [None] * n,
                "nearest_lang": nearest,
            }
            yield from batches(columns, schema)


def judge(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per document: the counts, ``base_failed``, ``kept``, both distances from the nearest reference."""
    model = read_model(stage_table(references(docs, limits), "quality-references"), limits)
    return map_batches(docs.select("doc_id", "text"), partial(_judge, model=model, limits=limits), JUDGED)


def passed(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The documents that are kept, with their columns, in one more pass over the text and no shuffle."""
    model = read_model(stage_table(references(docs, limits), "quality-references"), limits)
    return map_batches(docs, partial(_keep, model=model, limits=limits), docs.schema)


def _keep(rows: Iterator[pa.RecordBatch], model: Model, limits: Limits) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        for part in pieces_of(batch, "text", SLICE):
            verdicts = [x for out in _judge(iter([part]), model, limits) for x in out.column("kept").to_pylist()]
            yield part.filter(pa.array(verdicts, pa.bool_()))
