from __future__ import annotations

import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quayside.llm.mixing import mixed, taken, tilts


def brute_targets(sizes, weights, budget):
    """Targets by dealing in rounds: what is above a limit goes to the others by weight."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target = {s: 0.0 for s in names}
    left, open_ = budget * sum(sizes.values()), set(names)
    while open_ and left > 1e-9:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / total
        left = sum(max(0.0, target[s] - 2 * sizes[s]) for s in open_)
        full = {s for s in open_ if target[s] >= 2 * sizes[s]}
        for s in full:
            target[s] = 2.0 * sizes[s]
        open_ -= full
    return target


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(rows, found, budget=1.5, weights=(3, 1, 2)):
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += size_of(text)
    targets = brute_targets(sizes, weights, budget)
    source_of = {number: source for number, _, source in rows}
    got = defaultdict(int)
    for r in found:
        source = source_of[r["id"]]
        assert 0 <= r["copies"] <= 2
        assert abs(r["target"] - targets[source]) < 1e-6 * max(1, targets[source])
        assert r["source_size"] == sizes[source]
        got[source] += r["copies"] * r["size"]
    return {s: (got[s], targets[s]) for s in targets}


def corpus(seed, count):
    rng = random.Random(seed)
    return [
        (i, " ".join("w" for _ in range(int(rng.lognormvariate(3, 1)))), rng.choice(["a", "b", "ä", None, "C", "c" * 3]))
        for i in range(count)
    ] + [(count, "w " * 5000, "a"), (count + 1, "w " * 20, "tiny")]


def test_targets_are_met(spark):
    rows = corpus(1, 900)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    first = mixed(docs, [3, 1, 2], 1.5).collect()
    for got, target in check(rows, first).values():
        assert abs(got - target) <= 5
    assert sorted(first) == sorted(mixed(docs.repartition(5), [3, 1, 2], 1.5).collect())


def test_rates_fall_or_rise_with_size(spark):
    rows = [(i, "w " * (5 + i % 40), "many" if i % 10 else "few") for i in range(2000)]
    found = mixed(spark.createDataFrame(rows, "doc_id long, text string, source string"), [1], 1.0).collect()
    mean = defaultdict(list)
    for r in found:
        if r["source_size"] > 20_000:
            mean[r["size"] > 25].append(r["copies"])
    # 'many' gives words up: the tilt takes them from the long documents
    assert sum(mean[True]) / len(mean[True]) < sum(mean[False]) / len(mean[False])


def test_a_hot_class_is_ranked_in_buckets(spark, monkeypatch):
    monkeypatch.setattr("quayside.llm.mixing.RANKED_TOGETHER", 50)
    rows = [(i, "one two three", "hot") for i in range(1500)] + [(5000 + i, "a b", "cold") for i in range(90)]
    found = mixed(spark.createDataFrame(rows, "doc_id long, text string, source string"), [1, 5], 1.0).collect()
    for got, target in check(rows, found, 1.0, (1, 5)).values():
        assert abs(got - target) <= 3


def test_awkward_documents(awkward, empty):
    plan = mixed(awkward, [3, 1, 2], 1.5).collect()
    rows = [tuple(r) for r in awkward.select("doc_id", "text", "source").collect()]
    check(rows, plan)
    assert len(plan) == len(rows)
    assert mixed(empty, [3, 1, 2], 1.5).count() == 0


def test_taken_rows(awkward):
    plan = mixed(awkward, [3, 1, 2], 1.5)
    wanted = {r["id"]: r["n"] for r in plan.groupBy("id").agg(F.sum("copies").alias("n")).collect()}
    rows = taken(awkward, plan)
    assert rows.columns == awkward.columns
    got = {r["doc_id"]: r["n"] for r in rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {k: n for k, n in wanted.items() if n}


def test_rows_alike_in_id_and_text_are_told_apart_by_their_source(spark):
    rows = [(1, "a b c d", "A"), (1, "a b c d", "B"), (1, "a b c d", None), (2, "x y", "A"), (2, "x y", "A")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for weights in ([1, 3, 2], [3, 1, 2], [2, 1, 5]):
        plan = mixed(docs, weights, 1.5)
        words, targets = defaultdict(int), {}
        for r in plan.collect():
            words[r["key"]] += r["copies"] * r["size"]
            targets[r["key"]] = r["target"]
        got = defaultdict(int)
        for r in taken(docs, plan).collect():
            got["none" if r["source"] is None else "s" + r["source"]] += size_of(r["text"])
        assert got == {k: n for k, n in words.items() if n}
        assert all(abs(words[k] - targets[k]) <= 4 for k in targets)


def test_rates_solve_the_dual(spark):
    """Tilts against those that plain bisection of the whole gradient finds, document by document."""
    rng = random.Random(8)
    classes = [("s", size, rng.randrange(1, 9)) for size in range(1, 60)] + [("t", size, 3) for size in (1, 500, 9000)]
    sizes = {key: sum(s * n for k, s, n in classes if k == key) for key in "st"}
    for share in (0.02, 0.6, 1.0, 1.4, 1.97):
        targets = [(key, float(sizes[key]), share * sizes[key]) for key in "st"]
        found = tilts(
            spark.createDataFrame(classes, "key string, size long, n long"),
            spark.createDataFrame(targets, "key string, source_size double, target double"),
        )
        for r in found.collect():
            own = [(s / r["mean"], s, n) for k, s, n in classes if k == r["key"]]
            low, high = -1e6, 1e6
            for _ in range(200):
                middle = (low + high) / 2
                words = sum(n * s * min(2.0, math.exp(min(middle * x, 50))) for x, s, n in own)
                low, high = (middle, high) if words < share * sizes[r["key"]] else (low, middle)
            taken_words = sum(n * s * min(2.0, math.exp(min(r["tilt"] * x, 50))) for x, s, n in own)
            assert abs(taken_words - share * sizes[r["key"]]) <= 2e-7 * share * sizes[r["key"]]
            assert r["tilt"] == pytest.approx(low, rel=1e-4, abs=1e-6)


def test_nothing_but_empty_texts(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", None), (None, " ", "b")], "doc_id long, text string, source string")
    assert [(r["size"], r["target"], r["copies"]) for r in mixed(docs, [1], 1.5).collect()] == [(0, 0.0, 0)] * 3
