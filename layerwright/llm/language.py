"""Language identification by interpolated Kneser-Ney models of characters, one per language.

Text is lower-cased, every run of other characters than letters becomes one space, and a text starts after spaces, so
every letter has a full context. The job counts, over all documents to learn from, the 4-grams of each language; the
lower orders follow from these, as Kneser-Ney counts in how many contexts an n-gram occurs. A model keeps its
n-grams as sorted arrays of 64-bit keys with their discounted shares and, per context, the weight of the next
lower order. No n-gram is left out, so the counts of counts and the discounts are those of the whole text at every size.
The models are built on the driver and broadcast, so the distinct 4-grams of all languages have to fit there.

The prediction is the language with the lowest cross-entropy per character, ties to the smaller name. The score is the
posterior of that language for a typical character times ``SHARPNESS``. A text is rejected if its cross-entropy is further
above the usual one of its predicted language than the documents learnt from justify; the limit comes from those of them
that are predicted to be in their own language, so texts without a language, however many, do not move it.

Defined results. Text that is null or has no letter: ``und``, score 0, not accepted. Without a document to learn from
all is ``und``. A null doc_id or lang is not learnt from; a null doc_id is not held out. Repeated rows count each. Rows with
a null or repeated doc_id are accepted or not by their own text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.llm.spark import arrow_schema, batches, map_batches, pieces_of, stage_table, strings
from layerwright.llm.words import code_points, text_bytes

ORDER = 4
SLICE = 2 << 20  # bytes of text that are worked on at once
SHARPNESS = 8.0
UNKNOWN = "und"
GRAMS = "lang string, key long, n long"


@cache
def _alphabet() -> np.ndarray:
    """Each code point's lower-case form in 16 bits if it is a letter, else a space."""
    table = np.full(0x110000, 32, np.uint16)
    for code in range(0x110000):
        if not 0xD800 <= code < 0xE000 and (letter := chr(code)).isalpha():
            low = ord(letter.lower()[0])
            table[code] = (low ^ (low >> 16) * 0x9E5) & 0xFFFF
    return table


def letters(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The 4-gram key at each letter or following space of all texts, the text of each, the letters per text."""
    data, offsets = text_bytes(texts)
    codes = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), "<u4")
    firsts = np.zeros(len(data) + 1, np.int64)
    np.cumsum(code_points(data), out=firsts[1:])
    bounds = firsts[offsets]
    n = len(texts)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    letter = _alphabet()[codes]
    solid = letter != 32
    count = np.bincount(owner[solid], minlength=n)
    before = np.zeros(len(codes), bool)
    before[1:] = solid[:-1]
    before[bounds[:-1][bounds[:-1] < len(codes)]] = False
    keep = solid | before
    letter, owner = letter[keep], owner[keep]
    key = letter.astype(np.uint64)
    starts = np.searchsorted(owner, np.arange(n + 1))
    place = np.arange(len(letter)) - starts[owner]
    for back in range(1, ORDER):
        earlier = np.full(len(letter), 32, np.uint64)
        earlier[back:] = letter[:-back]
        earlier[place < back] = 32
        key |= earlier << np.uint64(16 * back)
    return key, owner, count


def unique(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the place of each key among them, by hashing rather than sorting."""
    import pandas as pd

    index, values = pd.factorize(keys)
    return values, index


def _count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(GRAMS)
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def out(lang, keys, n):
        yield from batches({"lang": [lang] * len(keys), "key": keys.view(np.int64), "n": n}, schema)

    for batch in rows:
        for part in pieces_of(batch, "text", SLICE):
            langs = part.column("lang").to_pylist()
            names = sorted(set(langs))
            number = np.array([names.index(x) for x in langs])
            keys, owner, _ = letters(strings(part.column("text")))
            for i, lang in enumerate(names):
                values, index = unique(keys[number[owner] == i])
                n = np.bincount(index, minlength=len(values))
                if lang in held:
                    values = np.concatenate([held[lang][0], values])
                    values, index = unique(values)
                    n = np.bincount(index, np.concatenate([held[lang][1], n]), len(values)).astype(np.int64)
                held[lang] = values, n
            if sum(len(v) for v, _ in held.values()) > 2_000_000:
                for lang, (values, n) in held.items():
                    yield from out(lang, values, n)
                held.clear()
    for lang, (values, n) in held.items():
        yield from out(lang, values, n)


def gram_counts(docs: DataFrame) -> DataFrame:
    """``lang, key, n``: the 4-grams of all documents with a language."""
    known = docs.filter("lang is not null and text is not null").select("lang", "text")
    return stage_table(map_batches(known, _count, GRAMS).groupBy("lang", "key").agg(F.sum("n").alias("n")), "grams")


class KneserNey:
    """One language. shares[k], weights[k]: sorted keys and values of order k + 1, and of its contexts."""

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        self.shares, self.weights = [], []
        for order in range(ORDER, 0, -1):
            sort = np.argsort(keys)
            keys, n = keys[sort], n[sort].astype(float)
            ones, twos = (n == 1).sum(), (n == 2).sum()
            discount = min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones else 0.5
            contexts, place = np.unique(keys >> np.uint64(16), return_inverse=True)
            total = np.bincount(place, n)
            share = np.maximum(n - discount, 0) / total[place]
            self.shares.insert(0, (keys, share))
            self.weights.insert(0, (contexts, 1 - np.bincount(place, share)))
            shorter = keys & np.uint64((1 << 16 * (order - 1)) - 1)
            keys, n = np.unique(shorter, return_counts=True)
        self.floor = 1 / 4096  # of a character never seen

    @staticmethod
    def _find(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray, missing: float) -> np.ndarray:
        at = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
        return np.where(table[0][at] == keys, table[1][at], missing)

    def bits(self, keys: np.ndarray) -> np.ndarray:
        """-log2 of the probability of each 4-gram's last character after the others."""
        p = np.full(len(keys), self.floor)
        for order in range(1, ORDER + 1):
            own = keys & np.uint64((1 << 16 * order) - 1)
            p = self._find(self.shares[order - 1], own, 0.0) + self._find(self.weights[order - 1], own >> np.uint64(16), 1.0) * p
        return -np.log2(np.maximum(p, 1e-12))


def read_models(counts: DataFrame) -> dict[str, KneserNey]:
    """The models, from all counts."""
    table = counts.toArrow() if counts.take(1) else None
    if table is None:
        return {}
    names = table.column("lang").combine_chunks().dictionary_encode()
    codes = names.indices.to_numpy()
    keys = table.column("key").to_numpy().view(np.uint64)
    n = table.column("n").to_numpy()
    by_name = {lang: i for i, lang in enumerate(names.dictionary.to_pylist())}
    return {lang: KneserNey(keys[codes == i], n[codes == i]) for lang, i in sorted(by_name.items())}


SCORED = "doc_id long, lang string, lang_pred string, score double, bits double, n_letters long"


def _score(texts: pa.StringArray, models: dict[str, KneserNey]) -> tuple[list, list, list, np.ndarray]:
    keys, owner, count = letters(texts)
    n = len(texts)
    values, index = unique(keys)
    sizes = np.maximum(np.bincount(owner, minlength=n), 1)
    means = np.array([np.bincount(owner, m.bits(values)[index], n) / sizes for m in models.values()]).reshape(-1, n)
    names = list(models)
    if not names:
        return [UNKNOWN] * n, [0.0] * n, [None] * n, count
    best = means.argmin(0)
    low = means[best, np.arange(n)]
    score = 1 / np.exp2(-SHARPNESS * np.minimum(means - low, 60)).sum(0)
    some = (count > 0).tolist()
    return (
        [names[b] if ok else UNKNOWN for b, ok in zip(best, some, strict=True)],
        [float(x) if ok else 0.0 for x, ok in zip(score, some, strict=True)],
        [float(x) if ok else None for x, ok in zip(low, some, strict=True)],
        count,
    )


def _predict(rows: Iterator[pa.RecordBatch], models) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(SCORED)
    for batch in rows:
        for part in pieces_of(batch, "text", SLICE):
            lang, score, bits, count = _score(strings(part.column("text")), models.value)
            own = {c: part.column(c).to_pylist() for c in ("doc_id", "lang")}
            yield from batches({**own, "lang_pred": lang, "score": score, "bits": bits, "n_letters": count}, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """One document in five, by a checksum of its number, is kept from learning."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def learnt(docs: DataFrame) -> DataFrame:
    return docs.filter(~held_out()).filter("doc_id is not null")


def scored(docs: DataFrame, models) -> DataFrame:
    """``doc_id, lang, lang_pred, score, bits, n_letters`` of each document, predicted from its text alone."""
    return map_batches(docs.select("doc_id", "lang", "text"), partial(_predict, models=models), SCORED)


def limits(found: DataFrame, deviations: float = 12.0, least_margin: float = 2.0) -> DataFrame:
    """``lang_pred, limit``, from the scored documents that were learnt from and are predicted to be in their own language:
    the median of their bits plus ``deviations`` standard deviations, ``least_margin`` at least. The deviation is that
    of a normal distribution with their median absolute deviation, so odd documents do not move it."""
    own = learnt(found).filter("lang = lang_pred")
    middle = lambda value: F.percentile_approx(value, 0.5, 10_000)
    usual = own.groupBy("lang_pred").agg(middle("bits").alias("middle"))
    # one row per learnt language
    far = own.join(F.broadcast(usual), "lang_pred").groupBy("lang_pred", "middle")
    spread = 1.4826 * middle(F.abs(F.col("bits") - F.col("middle")))
    return far.agg(spread.alias("spread")).select(
        "lang_pred", (F.col("middle") + F.greatest(deviations * F.col("spread"), F.lit(least_margin))).alias("limit")
    )


def identified(docs: DataFrame, deviations: float = 12.0, least_margin: float = 2.0, chance: float = 16.0) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, bits, n_letters, accepted``, learning from the documents that are not
    held out. Accepted: the bits are at most the limit of the predicted language plus ``chance`` over the root of the
    number of letters, as the mean of a short text varies more."""
    models = docs.sparkSession.sparkContext.broadcast(read_models(gram_counts(learnt(docs))))
    found = stage_table(scored(docs, models), "languages").withColumn("held_out", held_out())
    joined = found.join(F.broadcast(limits(found, deviations, least_margin)), "lang_pred", "left")
    return joined.select(
        "doc_id", "held_out", "lang_pred", "score", "bits", "n_letters",
        F.coalesce(F.col("bits") <= F.col("limit") + chance / F.sqrt("n_letters"), F.lit(False)).alias("accepted"),
    )


def accepted(docs: DataFrame, chance: float = 16.0) -> DataFrame:
    """The documents in a language that was learnt, with their columns, in one more pass over the text and no shuffle.
    Each row is judged by its own text, so rows without doc_id and rows that repeat one are kept or not like others."""
    models = docs.sparkSession.sparkContext.broadcast(read_models(gram_counts(learnt(docs))))
    found = stage_table(scored(learnt(docs), models), "languages")
    most = {r["lang_pred"]: r["limit"] for r in limits(found).collect()}  # one row per learnt language
    return map_batches(docs, partial(_keep, models=models, most=most, chance=chance), docs.schema)


def _keep(rows: Iterator[pa.RecordBatch], models, most: dict[str, float], chance: float) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        for part in pieces_of(batch, "text", SLICE):
            lang, _, bits, count = _score(strings(part.column("text")), models.value)
            verdicts = [
                x is not None and name in most and x <= most[name] + chance / n**0.5
                for name, x, n in zip(lang, bits, count.tolist(), strict=True)
            ]
            yield part.filter(pa.array(verdicts, pa.bool_()))
