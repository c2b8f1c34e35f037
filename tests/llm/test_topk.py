from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from quayside.llm.topk import top_k


def brute(rows, k, asks):
    usable = []
    for number, vector in rows:
        if number is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        usable.append((number, [math.floor(256 * x) for x in vector]))
    out = []
    for at, (query, q) in enumerate(usable):
        if asks(query):
            scored = [(-sum(a * b for a, b in zip(q, v, strict=True)), number) for i, (number, v) in enumerate(usable)
                      if i != at and len(v) == len(q)]
            out += [(query, rank + 1, number, str(-score)) for rank, (score, number) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def compare(spark, rows, k, **kwargs):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = top_k(frame, F.col("vec_id") % 5 == 0, k, **kwargs).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score_text"]) for r in found) == brute(rows, k, lambda n: n % 5 == 0)
    for r in found:
        exact = int(r["score_text"])
        assert r["score"] == (exact if -(2**63) <= exact < 2**63 else None)


def test_random_vectors_over_several_blocks(spark):
    rng = random.Random(6)
    rows = [(i, [rng.gauss(0, 1) for _ in range(12)]) for i in range(300)]
    compare(spark, rows, 5, block_rows=70)


def test_ties_nulls_and_other_lengths(spark):
    rng = random.Random(7)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(3)]) for i in range(150)]
    rows += [(200, None), (205, [1.0, None, 2.0]), (210, [1.0, math.nan, 2.0]), (215, [math.inf, 0.0, 0.0])]
    rows += [(220, [0.0, 0.0, 0.0]), (225, [1.0, 2.0]), (226, [3.0, 1.0]), (230, []), (None, [1.0, 1.0, 1.0]), rows[0]]
    rows += [(235, [1.0, 1.0, 1.0]), (235, [0.5, 1.0, 1.0])]
    compare(spark, rows, 4, block_rows=40)


def test_a_repeated_id_is_a_candidate_with_each_of_its_rows(spark):
    rows = [(1, [1.0, 0.0]), (1, [5.0, 0.0]), (5, [1.0, 1.0]), (5, [2.0, 0.0]), (7, [0.5, 0.5])]
    compare(spark, rows, 3)
    compare(spark, rows * 2, 6, block_rows=3)


def test_numbers_of_any_size_are_exact(spark):
    rng = random.Random(9)
    rows = [(0, [1.0, 2.0]), (1, [1e30, 0.0]), (2, [0.0, 1.0]), (3, [-1e30, 1e300]), (5, [1e300, -1e300]), (6, [2.0**70, 1.0])]
    rows += [(10 + i, [rng.choice([1.0, 3e15, -1e17, 2.0**53 + 2, 0.3]) * rng.random() for _ in range(2)]) for i in range(60)]
    compare(spark, rows, 5, block_rows=11)


def test_fewer_candidates_than_asked_for(spark):
    compare(spark, [(0, [1.0]), (1, [-2.0]), (5, [0.25])], 5)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_k(frame, F.col("vec_id") % 5 == 0, 3).count() == 0
