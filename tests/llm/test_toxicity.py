from __future__ import annotations

import random

import numpy as np
from made_texts import sentence

from quayside.llm.toxicity import (
    FOLDS,
    PENALTY,
    Sparse,
    _sigmoid,
    chain_of,
    features,
    fit_chain,
    fit_logistic,
    labelled_sample,
    scored,
    without_toxic,
)


def corpus(seed: int, count: int):
    """Documents of which the toxic ones hold bad words, in English or by an invented beginning."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        words = sentence(rng, rng.randrange(20, 60)).split()
        toxic = int(rng.random() < 0.3)
        for _ in range(rng.randrange(1, 4) * toxic):
            bad = rng.choice(["idiot", "moron", "scum", "trash", "grumbl" + rng.choice("abcdef")])
            words.insert(rng.randrange(len(words)), bad)
        rows.append((i, " ".join(words), toxic))
    return rows


def test_held_out_documents_are_told_apart(spark):
    rows = corpus(1, 500)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], 1 - r[2], r[2]) for r in rows[:300]], "doc_id long, quality int, toxic int")
    chain = chain_of(docs, labels)
    truth = {r[0]: r[2] for r in rows}
    found = scored(docs, chain).collect()
    assert [list(r.asDict()) for r in found[:1]] == [["doc_id", "quality", "toxic"]]
    held_out = [r for r in found if r["doc_id"] >= 300]
    wrong = sum((r["toxic"] >= 0.5) != bool(truth[r["doc_id"]]) for r in held_out)
    assert wrong <= 4
    kept = {r["doc_id"] for r in without_toxic(docs, chain).collect()}
    assert kept == {r["doc_id"] for r in found if r["toxic"] < 0.5}


def test_awkward_documents_and_labels(spark, awkward, empty):
    labels = [(i, i % 5 == 0, None) for i in range(30)] + [(None, True, ""), (3, None, ""), (0, False, ""), (999, True, "")]
    labels = [(*row, None if row[0] == 7 else 1) for row in labels]
    labels = spark.createDataFrame(labels, "doc_id long, toxic boolean, text string, quality int")
    chain = chain_of(awkward, labels)
    rows = scored(awkward, chain).collect()
    assert len(rows) == awkward.count() and all(0 <= r["toxic"] <= 1 for r in rows)
    kept = without_toxic(awkward, chain, 2.0)
    assert kept.columns == awkward.columns and kept.exceptAll(awkward).isEmpty() and kept.count() == len(rows)
    assert scored(empty, chain).count() == 0 and without_toxic(empty, chain).count() == 0


def test_no_labels_at_all(spark, awkward):
    chain = chain_of(awkward, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert all(r["toxic"] < 0.5 for r in scored(awkward, chain).collect())


def test_the_sample_is_bounded_and_the_same_each_time(spark):
    rows = corpus(2, 60)
    docs = spark.createDataFrame([r[:2] for r in rows] * 2, "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    first, second = (sorted(map(tuple, labelled_sample(docs, labels, ["toxic"], max_rows=17).collect())) for _ in range(2))
    assert len(first) == 17 and first == second


def test_logistic_regression_has_no_slope_left():
    rng = np.random.default_rng(3)
    hits = [np.flatnonzero(rng.random(12) < 0.3) for _ in range(400)]
    dense = rng.random((400, 2))
    y = np.array([float(0 in h or d[0] > 0.9) if rng.random() < 0.9 else 1.0 for h, d in zip(hits, dense, strict=True)])
    x = Sparse(hits, 12, dense)
    weights = fit_logistic(x, y, 0.5)
    ridge = np.full(15, 0.5)
    ridge[-1] = 0
    assert np.abs(x.back(_sigmoid(x.dot(weights)) - y) + ridge * weights).max() < 4e-4


def test_later_categories_use_earlier_ones_out_of_fold():
    rng = np.random.default_rng(4)
    hits = [np.flatnonzero(rng.random(6) < 0.5) for _ in range(300)]
    first = np.array([float(0 in h) for h in hits])
    weights = fit_chain(hits, np.column_stack([first, first]), np.arange(300) % 4, 6)
    assert len(weights) == 2 and len(weights[0]) == 7 and len(weights[1]) == 8
    assert weights[1][6] > 0.5  # the earlier probability speaks for the later category


def newton(x, y, penalty):
    """Dense Newton steps, the plainest way to the same weights."""
    weights = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 0
    for _ in range(60):
        p = 1 / (1 + np.exp(-(x @ weights)))
        bent = x.T @ (x * (p * (1 - p))[:, None]) + np.diag(ridge) + 1e-12 * np.eye(x.shape[1])
        weights = weights - np.linalg.solve(bent, x.T @ (p - y) + ridge * weights)
    return weights


def test_the_whole_chain_equals_dense_newton_steps(spark):
    rows = corpus(5, 240)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    rng = random.Random(6)
    given = [(number, int("idiot" in text or rng.random() < 0.05), toxic) for number, text, toxic in rows]
    labels = spark.createDataFrame(given, "doc_id long, insult int, toxic int")
    chain = chain_of(docs, labels, ["insult", "toxic"])
    fold = {r["doc_id"]: r["fold"] for r in docs.selectExpr("doc_id", f"pmod(xxhash64(doc_id, 'fold'), {FOLDS}) AS fold").collect()}
    names = sorted(chain.vocabulary, key=chain.vocabulary.get)
    x = np.array([[float(f in features(text)) for f in names] for _, text, _ in rows])
    insult, toxic = (np.array([g[i] for g in given], float) for i in (1, 2))
    ones, folds = np.ones((len(rows), 1)), np.array([fold[r[0]] for r in rows])
    first = newton(np.hstack([x, ones]), insult, PENALTY)
    unseen = np.zeros(len(rows))
    for f in range(FOLDS):
        weights = newton(np.hstack([x, ones])[folds != f], insult[folds != f], PENALTY)
        unseen[folds == f] = _sigmoid(np.hstack([x, ones])[folds == f] @ weights)
    second = newton(np.hstack([x, unseen[:, None], ones]), toxic, PENALTY)
    assert np.abs(chain.weights[0] - first).max() < 1e-3 and np.abs(chain.weights[1] - second).max() < 1e-3
    earlier = _sigmoid(np.hstack([x, ones]) @ first)
    wanted = _sigmoid(np.hstack([x, earlier[:, None], ones]) @ second)
    got = {r["doc_id"]: (r["insult"], r["toxic"]) for r in scored(docs, chain).collect()}
    for i, (number, _, _) in enumerate(rows):
        assert abs(got[number][0] - earlier[i]) < 1e-4 and abs(got[number][1] - wanted[i]) < 1e-4


def test_features():
    assert features("Bad, BADNESS 1x") == {"bad", "badness", "badn-", "badne-", "x"}
