"""Classifier chains: categories are predicted one after the other, each by a linear model over the words and the
probabilities of the categories before it.

Features are hashed words (lower case, without closing punctuation) and their first 4, 5 and 6 bytes, present or not; of
these a model uses those whose rate differs between its two classes by ``LEAST_Z`` standard errors. Later models learn with
out-of-fold probabilities: every labelled document gets those of a model that did not see its fold, so that they are as
uncertain as those of new documents. The threshold of a category is the one of best F1 on the out-of-fold
probabilities.

The models learn on at most ``SAMPLE`` labelled documents, those with the smallest hash of their doc_id. All documents are
then classified in one pass, without a shuffle.

Defined results. A null or empty text has no features: the models' base rates. Null labels are left out of their
category. A category with one class only, or no labelled document at all, has its rate (or 0) as probability and is never
predicted. Repeated rows are classified alike; of repeated labels of a document the greatest counts. A null doc_id is
classified but not learnt from.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.llm.spark import arrow_schema, batches, map_batches, pieces_of, strings
from layerwright.llm.words import find_words, prefix_keys

SAMPLE = 8000
FOLDS = 5
BUCKETS = 1 << 20
PREFIXES = (4, 5, 6)
LEAST_Z = 4.0
_CLOSING = np.zeros(256, bool)
_CLOSING[list(b".,;:!?\"')]}")] = True


def features(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of each word and beginning of a word, repeats included."""
    words = find_words(texts, lower=True)
    data, starts, ends = words.data, words.starts, words.ends.copy()
    for _ in range(2):
        ends -= (ends - starts > 1) & _CLOSING[data[ends - 1]] if len(ends) else 0
    cuts = [ends, *(np.minimum(ends, starts + n) for n in PREFIXES)]
    owner, out_owner, out_bucket = words.owner, [], []
    for i, key in enumerate(prefix_keys(data, starts, words.ends, cuts)):
        keep = slice(None) if i == 0 else np.flatnonzero(ends - starts > PREFIXES[i - 1])
        out_owner.append(owner[keep])
        out_bucket.append(((key[keep] + np.uint64(i)) % np.uint64(BUCKETS)).astype(np.int64))
    return np.concatenate(out_owner), np.concatenate(out_bucket)


FEATURES = "doc_id long, buckets array<int>"


def _featurise(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(FEATURES)
    for batch in rows:
        for part in pieces_of(batch, "text", 4 << 20):
            owner, bucket = features(strings(part.column("text")))
            both = np.unique(owner * BUCKETS + bucket)
            edges = np.searchsorted(both // BUCKETS, np.arange(part.num_rows + 1))
            values = pa.array((both % BUCKETS).astype(np.int32))
            lists = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), values)
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), lists], schema=schema)


@dataclass(frozen=True)
class Linear:
    """A logistic model of some buckets and of the log-odds of earlier categories."""

    buckets: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    bias: float

    def odds(self, sums: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        return self.bias + sums + earlier @ self.earlier


def log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


class Rows:
    """Documents with their buckets, as compressed rows."""

    def __init__(self, offsets: np.ndarray, buckets: np.ndarray):
        self.n, self.buckets = len(offsets) - 1, buckets
        self.owner = np.repeat(np.arange(self.n), np.diff(offsets))

    def sums(self, model: Linear) -> np.ndarray:
        dense = np.zeros(BUCKETS)
        dense[model.buckets] = model.weights
        return np.bincount(self.owner, dense[self.buckets], self.n)


def fit(rows: Rows, label: np.ndarray, use: np.ndarray, earlier: np.ndarray, steps: int = 100, ridge: float = 1.0) -> Linear:
    """A model of the rows in ``use``, by accelerated gradient steps."""
    positive = use & (label > 0)
    n, m = use.sum(), positive.sum()
    none = Linear(np.zeros(0, np.int64), np.zeros(0), np.zeros(earlier.shape[1]), float(log_odds(np.array(m / max(n, 1)))))
    if m == 0 or m == n:
        return none
    entry = use[rows.owner]
    have = np.bincount(rows.buckets[entry], minlength=BUCKETS)
    with_label = np.bincount(rows.buckets[positive[rows.owner]], minlength=BUCKETS)
    rate = m / n
    z = (with_label - have * rate) / np.sqrt(np.maximum(have * rate * (1 - rate), 1e-9))
    chosen = np.flatnonzero((np.abs(z) >= LEAST_Z) & (have >= 3))
    place = np.full(BUCKETS, -1)
    place[chosen] = np.arange(len(chosen))
    mine = entry & (place[rows.buckets] >= 0)
    number = np.cumsum(use) - 1
    owner, column = number[rows.owner[mine]], place[rows.buckets[mine]]
    y, extra = (label[use] > 0).astype(float), log_odds_scaled(earlier[use])
    k, e = len(chosen), extra.shape[1]
    w, ahead, t = np.zeros(k + e + 1), np.zeros(k + e + 1), 1.0
    w[-1] = ahead[-1] = none.bias
    curve = 0.25 * power_norm(owner, column, extra, k, n) + ridge
    for _ in range(steps):
        z_ = np.bincount(owner, ahead[column], n) + extra @ ahead[k : k + e] + ahead[-1]
        error = logistic(z_) - y
        gradient = np.concatenate([np.bincount(column, error[owner], k), extra.T @ error, [error.sum()]])
        gradient[:-1] += ridge * ahead[:-1]
        new = ahead - gradient / curve
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return Linear(chosen, w[:k], w[k : k + e], float(w[-1]))


def log_odds_scaled(p: np.ndarray) -> np.ndarray:
    return log_odds(p) / 4


def power_norm(owner, column, extra, k: int, n: int, rounds: int = 12) -> float:
    """The largest eigenvalue of the features' Gram matrix, from above."""
    v = np.ones(k + extra.shape[1] + 1)
    size = 1.0
    for _ in range(rounds):
        v /= np.linalg.norm(v)
        z = np.bincount(owner, v[column], n) + extra @ v[k:-1] + v[-1]
        v = np.concatenate([np.bincount(column, z[owner], k), extra.T @ z, [z.sum()]])
        size = float(np.linalg.norm(v))
    return 1.1 * size


@dataclass(frozen=True)
class Chain:
    categories: tuple[str, ...]
    models: tuple[Linear, ...]
    thresholds: tuple[float, ...]

    def probabilities(self, rows: Rows) -> np.ndarray:
        out = np.zeros((rows.n, 0))
        for model in self.models:
            p = logistic(model.odds(rows.sums(model), log_odds_scaled(out)))
            out = np.column_stack([out, p])
        return out


def best_threshold(p: np.ndarray, label: np.ndarray) -> float:
    """The cut of best F1, in the middle of the gap below the last accepted probability; above 1 without positives."""
    if not label.any():
        return 2.0
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(label[order])
    f1 = 2 * hits / (np.arange(1, len(p) + 1) + label.sum())
    last = np.append(p[order][1:] != p[order][:-1], True)  # only between different probabilities
    i = int(np.argmax(np.where(last, f1, -1)))
    below = p[order][i + 1] if i + 1 < len(p) else 0.0
    return float((p[order][i] + below) / 2)


def learn(rows: Rows, labels: np.ndarray, folds: np.ndarray, categories: Sequence[str]) -> Chain:
    """labels: one column per category, NaN where there is none. folds: of each row, from 0."""
    models, thresholds, earlier = [], [], np.zeros((rows.n, 0))
    for c in range(len(categories)):
        known = ~np.isnan(labels[:, c])
        label = np.nan_to_num(labels[:, c])
        out_of_fold = np.zeros(rows.n)
        for fold in range(FOLDS):
            mine = folds == fold
            model = fit(rows, label, known & ~mine, earlier)
            p = logistic(model.odds(rows.sums(model), log_odds_scaled(earlier)))
            out_of_fold[mine] = p[mine]
        models.append(fit(rows, label, known, earlier))
        both = 0 < label[known].sum() < known.sum()
        thresholds.append(best_threshold(out_of_fold[known], label[known] > 0) if both else 2.0)
        earlier = np.column_stack([earlier, out_of_fold])
    return Chain(tuple(categories), tuple(models), tuple(thresholds))


def learnt(docs: DataFrame, labels: DataFrame, categories: Sequence[str]) -> Chain:
    """The chain from a bounded sample of the labelled documents."""
    once = labels.filter("doc_id is not null").groupBy("doc_id").agg(*(F.max(F.col(c).cast("double")).alias(c) for c in categories))
    chosen = once.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    # at most SAMPLE rows
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id")), "doc_id").dropDuplicates(["doc_id"])
    made = map_batches(texts, _featurise, FEATURES)
    table = made.join(F.broadcast(chosen), "doc_id").orderBy("doc_id").toArrow().combine_chunks()
    lists = table.column("buckets").combine_chunks() if table.num_rows else pa.array([], pa.list_(pa.int32()))
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    offsets = np.r_[0, np.cumsum(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))].astype(np.int64)
    rows = Rows(offsets, lists.flatten().to_numpy().astype(np.int64))
    values = [np.asarray(table.column(c).to_numpy(), float) if table.num_rows else np.zeros(0) for c in categories]
    ids = table.column("doc_id").to_numpy() if table.num_rows else np.zeros(0, np.int64)
    folds = ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(FOLDS)
    return learn(rows, np.column_stack(values), folds.astype(np.int64), categories)


def _classify(rows: Iterator[pa.RecordBatch], chain, ddl: str) -> Iterator[pa.RecordBatch]:
    schema, chain = arrow_schema(ddl), chain.value
    used = np.zeros(BUCKETS, bool)
    for model in chain.models:
        used[model.buckets] = True
    for batch in rows:
        for part in pieces_of(batch, "text", 4 << 20):
            n = part.num_rows
            owner, bucket = features(strings(part.column("text")))
            mine = used[bucket]
            both = np.unique(owner[mine] * BUCKETS + bucket[mine])
            found = Rows(np.searchsorted(both // BUCKETS, np.arange(n + 1)), both % BUCKETS)
            p = chain.probabilities(found)
            columns = {"doc_id": part.column("doc_id").to_pylist()}
            for i, (name, threshold) in enumerate(zip(chain.categories, chain.thresholds, strict=True)):
                columns[f"p_{name}"] = p[:, i]
                columns[name] = p[:, i] >= threshold
            yield from batches(columns, schema)


def classified(docs: DataFrame, labels: DataFrame, categories: Sequence[str]) -> DataFrame:
    """``doc_id`` and, per category, its probability ``p_<category>`` and the verdict ``<category>``."""
    chain = docs.sparkSession.sparkContext.broadcast(learnt(docs, labels, categories))
    ddl = "doc_id long" + "".join(f", p_{name} double, {name} boolean" for name in categories)
    return map_batches(docs.select("doc_id", "text"), partial(_classify, chain=chain, ddl=ddl), ddl)
