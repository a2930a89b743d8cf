from __future__ import annotations

import random

import numpy as np
import pytest

from skyledger.llm import toxicity as tx
from skyledger.llm.shingles import prefix_hashes
from tests.llm.support import ODD_ROWS, documents


def rows(seed=1, n=400):
    """Insults come with a probability, threats only among insults, and both show in words."""
    pick = random.Random(seed)
    plain = [f"word{k}" for k in range(200)]
    docs, labels = [], []
    for i in range(n):
        insult = pick.random() < 0.3
        threat = insult and pick.random() < 0.5
        words = pick.choices(plain, k=pick.randint(5, 40)) + ["mudhead"] * insult + ["willfind"] * threat
        pick.shuffle(words)
        docs.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, int(insult), int(threat)))
    return docs, labels


def label_table(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, insult int, threat int")


def test_unlabelled_rows_are_told_apart(spark):
    docs, labels = rows()
    chain = tx.learn(documents(spark, docs), label_table(spark, labels[:250]), ["insult", "threat"])
    assert [len(w) for w in chain.weights] == [(1 << tx.FEATURE_BITS) + 1, (1 << tx.FEATURE_BITS) + 2]
    found = {r.doc_id: r for r in tx.score(documents(spark, docs), chain).collect()}
    rest = labels[250:]
    assert sum(found[i]._is_insult == bool(a) for i, a, _ in rest) >= 0.95 * len(rest)
    assert sum(found[i]._is_threat == bool(b) for i, _, b in rest) >= 0.95 * len(rest)


def test_later_models_use_earlier_probabilities(spark):
    docs, labels = rows(2)
    # The second category is the first, so all it needs is there already.
    chain = tx.learn(documents(spark, docs), label_table(spark, [(i, a, a) for i, a, _ in labels]), ["insult", "threat"])
    assert chain.weights[1][-2] > 0.5


def test_fit_is_the_minimum():
    random_ = np.random.default_rng(0)
    features = np.concatenate([random_.choice(50, 5, replace=False) for _ in range(200)])
    some = tx.Rows(features, np.full(1000, tx.LENGTH / 5**0.5), np.arange(0, 1001, 5), np.zeros((200, 0)))
    labels = (some.margins(np.append(random_.standard_normal(1 << tx.FEATURE_BITS), 0.0)) + random_.standard_normal(200) > 0).astype(float)
    weights = tx.fit(some, labels)

    def loss(w):
        p = tx._logistic(some.margins(w))
        return -np.mean(labels * np.log(p + 1e-12) + (1 - labels) * np.log(1 - p + 1e-12)) + tx.PENALTY / 2 * (w[:-1] ** 2).sum()

    assert loss(weights) < 0.6 * loss(np.zeros_like(weights))
    assert np.linalg.norm(some.gradient(tx._logistic(some.margins(weights)) - labels)) < 0.02


def test_threshold_is_the_best_of_all():
    random_ = np.random.default_rng(1)
    p = np.round(random_.random(300), 2)
    y = (random_.random(300) < p).astype(float)

    def f1(t):
        called = p >= t
        return 2 * (called * y).sum() / (called.sum() + y.sum())

    assert f1(tx.best_threshold(p, y)) == pytest.approx(max(f1(t) for t in np.unique(p)))
    assert tx.best_threshold(p, np.zeros(300)) > 1


def test_prefixes():
    a, b = prefix_hashes("MUDHEADS", (5,)), prefix_hashes("mudhe... and mudhex!", (5,))
    assert set(a[1:]) <= set(b)
    assert len(prefix_hashes(None, (5, 7))) == len(prefix_hashes(" ,;\n", (5, 7))) == 0


def test_long_texts_in_pieces(monkeypatch):
    text = "some words of a text " * 40
    whole = sorted(prefix_hashes(text, (5,)))
    monkeypatch.setattr("skyledger.llm.shingles.PIECE_BYTES", 50)
    assert sorted(prefix_hashes(text, (5,))) == whole


def test_odd_rows(spark):
    docs, labels = rows(3, 120)
    odd_labels = [(None, 1, 1), (901, 1, None), (902, 1, 1), (903, 0, 0), (905, 1, 0), (905, 0, 0), (7777, 1, 1)]
    table = documents(spark, docs + ODD_ROWS, id="clash", key=1, features=2, p=0.5, fold="x")
    chain = tx.learn(table, label_table(spark, labels + odd_labels), ["insult", "threat"])
    found = tx.score(documents(spark, ODD_ROWS, _p_insult="clash"), chain).collect()
    assert len(found) == len(ODD_ROWS)
    assert all(r._p_insult == 0 and not r._is_insult for r in found if not (r.text or "").strip())
    assert tx.score(documents(spark, []), chain).collect() == []
    unlearned = tx.learn(table, label_table(spark, []), ["insult", "threat"])
    assert not any(r._is_insult for r in tx.score(table, unlearned).collect())
