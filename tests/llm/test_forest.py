from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from quayside.llm import forest
from quayside.llm.forest import fitted, leaves_of, margin, near_vectors, unit

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, threshold=0.9):
    """Sorted (id, n_links, component_id) of every row by comparing all pairs."""
    usable = [
        i for i, (number, v) in enumerate(rows)
        if number is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)
    ]
    links = Counter()
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for size in {len(rows[i][1]) for i in usable}:
        same = [i for i in usable if len(rows[i][1]) == size]
        vectors = unit(np.array([rows[i][1] for i in same], dtype=float))
        for a, near in enumerate(vectors @ vectors.T >= threshold):
            for b in np.flatnonzero(near):
                if a != b:
                    links[same[a]] += 1
                    parent[root(same[a])] = root(same[b])
    least: dict = {}
    for i in usable:
        least[root(i)] = min(least.get(root(i), rows[i][0]), rows[i][0])
    return sorted(((n, links[i], least.get(root(i), n)) for i, (n, _) in enumerate(rows)), key=repr)


def found(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(map(tuple, near_vectors(frame, **options).collect()), key=repr)


def families(seed, many, copies, noise, dims=24):
    """Random vectors with near copies of each, more and less turned."""
    rng = np.random.default_rng(seed)
    made = []
    for _ in range(many):
        middle = rng.standard_normal(dims)
        for _ in range(rng.integers(1, copies + 1)):
            made.append((middle + noise * rng.random() * rng.standard_normal(dims)) * rng.uniform(0.1, 9))
    order = rng.permutation(len(made))
    return [(int(i), made[k].tolist()) for i, k in enumerate(order)]


def test_one_leaf_is_exact(spark):
    rows = families(1, 60, 6, 0.5)
    assert found(spark, rows) == brute(rows)


def test_many_leaves_find_the_same_links(spark):
    rows = families(2, 400, 4, 0.4)
    got = found(spark, rows, leaf_rows=64)
    wanted = brute(rows)
    hit, all_links = sum(r[1] for r in got), sum(r[1] for r in wanted)
    assert 0.99 * all_links <= hit <= all_links
    assert all(a[1] <= b[1] for a, b in zip(got, wanted))


def test_pairs_right_at_the_threshold_are_mostly_found(spark):
    rng = np.random.default_rng(3)
    a = unit(rng.standard_normal((1500, 64)))
    aside = rng.standard_normal(a.shape)
    aside = unit(aside - (aside * a).sum(axis=1, keepdims=True) * a)
    b = 0.9001 * a + math.sqrt(1 - 0.9001**2) * aside
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([a, b]))]
    got = {r[0]: r[1] for r in found(spark, rows, leaf_rows=64)}
    assert sum(got[i] for i in range(1500)) / 1500 > 0.97


def test_no_link_below_the_threshold(spark):
    rng = np.random.default_rng(5)
    a = unit(rng.standard_normal((300, 16)))
    aside = rng.standard_normal(a.shape)
    aside = unit(aside - (aside * a).sum(axis=1, keepdims=True) * a)
    b = 0.9999 * a + math.sqrt(1 - 0.9999**2) * aside
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([a, b]))]
    assert not any(r[1] for r in found(spark, rows, threshold=0.99991, leaf_rows=50))


def crowd(seed, n, dims=16):
    """A tight group that no direction splits, a loose one around it, and others."""
    rng = np.random.default_rng(seed)
    middle = rng.standard_normal(dims) * 2
    rows = [middle + 0.1 * rng.standard_normal(dims) for _ in range(n)]
    rows += [middle + 0.6 * rng.standard_normal(dims) for _ in range(n // 2)]
    rows += [rng.standard_normal(dims) for _ in range(n)]
    return [(i, v.tolist()) for i, v in enumerate(rows)]


def test_crowded_leaves_are_exact_and_cores_are_not_compared(spark, monkeypatch):
    rows = crowd(4, 300)
    assert found(spark, rows, leaf_rows=1000, block_rows=60) == brute(rows)
    frame = spark.createDataFrame(rows, SCHEMA).select(F.col("vec_id").alias("node"), F.lit(1).cast("long").alias("copies"),
                                                       F.col("embedding").alias("vector"))

    def copies_sent(rows_of, blocks):
        routed = forest._routed(rows_of, {16: [np.zeros(0)]}, 0.9)
        dealt, cores = forest._dealt(routed, blocks, 0.9)
        return dealt.count(), cores.count()

    sent, in_cores = copies_sent(frame.where("node < 300"), 30)
    assert in_cores > 250
    # rows outside the core meet all blocks, rows of the core only blocks outside
    outside = 300 - in_cores
    assert sent <= outside * 20 + in_cores * 10


def test_trees_of_a_crowd_agree(spark):
    rows = crowd(6, 250)
    got, wanted = found(spark, rows, leaf_rows=40, block_rows=60), brute(rows)
    assert 0.99 * sum(r[1] for r in wanted) <= sum(r[1] for r in got) <= sum(r[1] for r in wanted)
    assert all(a[1] <= b[1] for a, b in zip(got, wanted))


def test_copies_count_as_links(spark):
    rows = families(7, 20, 3, 0.3)
    rows += [(1000 + i, rows[0][1]) for i in range(500)] + [rows[1], rows[1]]
    rows += [(3000, [2 * c for c in rows[0][1]])]
    assert found(spark, rows) == brute(rows)


def test_odd_vectors(spark):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [math.nan, 1.0]), (6, [math.inf, 1.0])]
    rows += [(7, [1e300, 1e300]), (8, [1e-320, 1e-320]), (9, [1.0, 1.0, 1.0]), (10, [2.0, 2.0, 2.0]), (None, [1.0, 1.0])]
    rows += [(11, [-0.0, 1.0]), (12, [0.0, 1.0]), (7, [-1.0, -1.0]), (None, None), (13, [5.0])]
    assert found(spark, rows) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    assert near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(i, [1.0, float(i)], "x", 1, "y") for i in range(5)]
    frame = spark.createDataFrame(rows, SCHEMA + ", node string, size int, id string")
    assert sorted(map(tuple, near_vectors(frame).collect())) == brute([r[:2] for r in rows])


def test_every_vector_comes_to_a_leaf_of_every_tree():
    vectors = unit(np.random.default_rng(8).standard_normal((500, 12)))
    apart = margin(12, 0.9)
    cuts = [fitted(vectors, tree, 5, 20, apart) for tree in range(3)]
    rows, leaves = leaves_of(vectors, cuts, apart)
    for tree in range(3):
        mine = leaves >> forest._NODE_BITS == tree
        assert set(rows[mine]) == set(range(500))
    assert len(set(zip(rows.tolist(), leaves.tolist()))) == len(rows)
