import random

import numpy as np
import pyarrow as pa

from layerwright.llm import toxicity


def corpus(prose, n=240):
    rng, rows, labels = random.Random(5), [], []
    for i in range(n):
        insult, threat = rng.random() < 0.3, False
        text = prose(rng.randrange(20, 80), i)
        if insult:
            text += " idiotic moronish."
            threat = rng.random() < 0.5
            if threat:
                text += " hurting!"
        rows.append((i, text))
        if i % 4:
            labels.append((i, int(insult), int(threat)))
    return rows, labels


def test_chain_finds_categories(spark, docs, prose):
    rows, labels = corpus(prose)
    frame = spark.createDataFrame(labels, "doc_id long, insult int, threat int")
    out = toxicity.classified(docs(*rows, (900, None), (901, ""), clash=True), frame, ("insult", "threat")).collect()
    truth = {i: ("moronish" in t, "hurting" in t) for i, t in rows}
    held = [r for r in out if r.doc_id % 4 == 0 and r.doc_id < 900]
    assert sum((r.insult, r.threat) == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.p_insult <= 1 and 0 <= r.p_threat <= 1 for r in out)
    assert [r.insult for r in out if r.doc_id >= 900] == [False, False]


def test_earlier_probability_feeds_later_models():
    """The second category has no features of its own: only the first one tells."""
    rng = np.random.default_rng(1)
    first = rng.random(400) < 0.5
    offsets = np.arange(401)
    rows = toxicity.Rows(offsets, np.where(first, 5, 6).astype(np.int64))
    labels = np.column_stack([first, first]).astype(float)
    chain = toxicity.learn(rows, labels, np.arange(400) % toxicity.FOLDS, ("a", "b"))
    assert chain.models[1].earlier.shape == (1,) and chain.models[1].earlier[0] > 0
    assert ((chain.probabilities(rows)[:, 1] > 0.5) == first).all()


def test_gradient_descent_reaches_the_optimum():
    rng = np.random.default_rng(2)
    dense = rng.random((300, 6)) < 0.4
    y = dense[:, 0] ^ (rng.random(300) < 0.1)
    owner, bucket = np.nonzero(dense)
    rows = toxicity.Rows(np.searchsorted(owner, np.arange(301)), bucket)
    model = toxicity.fit(rows, y.astype(float), np.ones(300, bool), np.zeros((300, 0)))
    p = toxicity.logistic(model.odds(rows.sums(model), np.zeros((300, 0))))
    gradient = np.array([((p - y) * dense[:, b]).sum() for b in model.buckets]) + model.weights
    assert 0 in model.buckets and np.abs(gradient).max() < 0.05 and abs((p - y).sum()) < 0.05


def test_features_are_words_and_beginnings_without_closing_marks():
    owner, bucket = toxicity.features(pa.array(["Stupidly!? x", "stupidly", None, ""]).fill_null(""))
    of = lambda i: set(bucket[owner == i].tolist())
    assert len(of(1)) == 4 and of(1) < of(0) and not of(2) and not of(3)


def test_no_labels_one_class_and_null_labels(spark, docs, prose):
    frame = docs((1, prose(9, 1)), (2, prose(9, 2)), (2, prose(9, 2)), (None, "x"))
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.toxic for r in toxicity.classified(frame, none, ("toxic",)).collect()] == [False] * 4
    one = spark.createDataFrame([(1, 1), (2, 1), (2, None), (None, 0)], "doc_id long, toxic int")
    out = toxicity.classified(frame, one, ("toxic",)).collect()
    assert not any(r.toxic for r in out) and all(r.p_toxic > 0.9 for r in out)
    empty = toxicity.classified(docs().limit(0), one, ("toxic",))
    assert empty.collect() == []


def test_threshold():
    assert toxicity.best_threshold(np.array([0.9, 0.8, 0.3, 0.1]), np.array([True, True, False, False])) == (0.8 + 0.3) / 2
    assert toxicity.best_threshold(np.array([0.9]), np.array([False])) > 1
