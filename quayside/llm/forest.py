"""Near-duplicate embeddings by a forest of random-projection trees with spill overlap.

A tree splits recursively: at each level its vectors are projected on one random direction, and a node's vectors go left
or right of their median. Those close to the median, by a margin made of the distance that two vectors at the threshold
can have, go both ways. The medians come from a bounded sample; every vector is then sent through all trees in one
pass. Vectors that share a leaf are compared exactly. A pair that shares several leaves counts in the first of them
alone, so links are summed up without listing pairs. What each leaf ties together goes to the component search as stars.

A leaf that cannot be split, because its vectors are nearly the same, can hold a large part of the table. The vectors
within half the threshold's angle of one of them, its pivot, are all linked to each other: such a core is counted, not
compared. What is left of a large leaf is compared in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import column, stored
from quayside.llm.components import components
from quayside.llm.topk import usable

TREES = 8
# the spill margin in parts of how far the ends of a pair at the threshold lie apart along a random direction
SPILL = 0.4
LEAF_ROWS = 2_048
BLOCK_ROWS = 4_096
MOST_LEVELS = 16
# the fit looks at this many vectors for each leaf it aims at, and at no more than MOST_SAMPLED
SAMPLED_PER_LEAF = 128
MOST_SAMPLED = 1 << 18
# a direction that would send more than this part of a node both ways does not split it
OVERLAP = 0.5
SEED = 11
ROUNDING = 1e-9
_PAIRS = 1 << 16
_NODE_BITS = MOST_LEVELS + 2


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, by way of their largest entry, so that no square leaves the range of doubles."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def matrix(lists: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    flat = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return flat.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(lists), -1)


def directions(size: int, tree: int, levels: int) -> np.ndarray:
    """The unit directions of a tree, one row for each level."""
    drawn = np.random.default_rng([SEED, size, tree]).standard_normal((levels, size))
    return drawn / np.linalg.norm(drawn, axis=1, keepdims=True)


def margin(size: int, threshold: float) -> float:
    return SPILL * math.sqrt(max(0.0, 2 - 2 * threshold) / size)


def levels_for(vectors: int, leaf_rows: int) -> int:
    """Levels until leaves are small enough; overlap makes a child more than half of its parent."""
    return 0 if vectors <= leaf_rows else min(MOST_LEVELS, math.ceil(1.3 * math.log2(vectors / leaf_rows)) + 1)


def fitted(sample: np.ndarray, tree: int, levels: int, target: float, apart: float) -> np.ndarray:
    """The thresholds of a tree's nodes, children of k at 2 k + 1 and 2 k + 2; NaN where the tree ends.

    A node that a direction cannot split passes everything on to its left child, which tries the next direction.
    """
    thresholds = np.full((1 << levels) - 1, np.nan)
    projected = sample @ directions(sample.shape[1], tree, levels).T
    waiting = [(0, 0, np.arange(len(sample)))]
    while waiting:
        node, level, rows = waiting.pop()
        if level == levels or len(rows) <= target:
            continue
        along = projected[rows, level]
        middle = np.median(along)
        if (np.abs(along - middle) <= apart).mean() > OVERLAP:
            thresholds[node] = np.inf
            waiting.append((2 * node + 1, level + 1, rows))
        else:
            thresholds[node] = middle
            waiting.append((2 * node + 1, level + 1, rows[along < middle + apart]))
            waiting.append((2 * node + 2, level + 1, rows[along >= middle - apart]))
    return thresholds


def leaves_of(vectors: np.ndarray, thresholds: list[np.ndarray], apart: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of every leaf that each unit vector comes to, in all trees; sorted by row and leaf."""
    found_rows, found_leaves = [], []
    for tree, cuts in enumerate(thresholds):
        levels = (len(cuts) + 1).bit_length() - 1
        projected = vectors @ directions(vectors.shape[1], tree, levels).T
        rows, nodes = np.arange(len(vectors)), np.zeros(len(vectors), dtype=np.int64)
        for level in range(levels + 1):
            cut = cuts[nodes] if level < levels else np.full(len(nodes), np.nan)
            ends = np.isnan(cut)
            found_rows.append(rows[ends])
            found_leaves.append((tree << _NODE_BITS) + nodes[ends])
            rows, nodes, cut = rows[~ends], nodes[~ends], cut[~ends]
            if not len(rows):
                break
            along = projected[rows, level]
            left, right = along < cut + apart, along >= cut - apart
            rows, nodes = (
                np.concatenate([rows[left], rows[right]]),
                np.concatenate([2 * nodes[left] + 1, 2 * nodes[right] + 2]),
            )
    rows, leaves = np.concatenate(found_rows), np.concatenate(found_leaves)
    order = np.lexsort((leaves, rows))
    return rows[order], leaves[order]


def _forest(vectors: DataFrame, size: int, count: int, threshold: float, leaf_rows: int, trees: int) -> list[np.ndarray]:
    """Thresholds of all trees over vectors of one length: at most 2^MOST_LEVELS numbers for each, whatever the table."""
    levels = levels_for(count, leaf_rows)
    if not levels:
        return [np.zeros(0)]
    wanted = min(MOST_SAMPLED, math.ceil(SAMPLED_PER_LEAF * count / leaf_rows))
    part = min(1.0, wanted / count)
    drawn = F.pmod(F.xxhash64("node", F.lit(SEED)), F.lit(1 << 30)) < F.lit(int(part * (1 << 30)))
    sample = vectors.where((F.size("vector") == size) & drawn).select("vector").limit(2 * wanted)
    target, apart = max(2.0, leaf_rows * part), margin(size, threshold)

    def fit(key: tuple, table: pa.Table) -> pa.Table:
        tree = key[0].as_py()
        cuts = fitted(unit(matrix(table.column("vector"))), tree, levels, target, apart)
        return pa.table({"tree": pa.array([tree], pa.int32()), "cuts": pa.array([cuts.tolist()], pa.list_(pa.float64()))})

    every_tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")
    fits = sample.select("vector", every_tree).groupBy("tree").applyInArrow(fit, "tree int, cuts array<double>")
    cuts = {r["tree"]: np.array(r["cuts"]) for r in fits.collect()}
    nothing = np.full((1 << levels) - 1, np.nan)
    return [cuts.get(tree, nothing) for tree in range(trees)]


def _routed(vectors: DataFrame, forests: dict[int, list[np.ndarray]], threshold: float) -> DataFrame:
    """(node, copies, vector, size, leaves): every vector with its leaves, in one pass without a shuffle."""
    element = vectors.schema["vector"].dataType.simpleString()
    schema = f"node long, copies long, vector {element}, size int, leaves array<int>"

    def route(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            lengths = np.array([len(v) for v in part.column(2)])
            for size in sorted(set(lengths.tolist())):
                some = part.take(pa.array(np.flatnonzero(lengths == size)))
                rows, leaves = leaves_of(unit(matrix(some.column(2))), forests[size], margin(size, threshold))
                ends = np.searchsorted(rows, np.arange(len(some) + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(leaves, pa.int32()))
                sizes = pa.array(np.full(len(some), size, np.int32))
                yield pa.RecordBatch.from_arrays([*some.columns, sizes, lists], ["node", "copies", "vector", "size", "leaves"])

    return vectors.select("node", "copies", "vector").mapInArrow(route, schema)


def _earlier_leaf(left: np.ndarray, right: np.ndarray, leaf: int) -> np.ndarray:
    """Whether the vectors of each pair, given by rows of their leaves, share a leaf before this one."""
    shared = np.zeros(len(left), dtype=bool)
    for at in range(left.shape[1]):
        mine = left[:, at, None]
        shared |= ((mine == right) & (mine < leaf)).any(axis=1)
    return shared


def _padded(lists: list[list[int]]) -> np.ndarray:
    """Leaves as rows of one length; what is filled in is larger than any leaf."""
    width = max(map(len, lists), default=0)
    return np.array([row + [2**31 - 1] * (width - len(row)) for row in lists], dtype=np.int64).reshape(len(lists), width)


def leaf_links(table: pa.Table, leaf: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The links that count in this leaf: how many each row has, copies included, and a row that it hangs together with.

    Rows of the table stand on the left or on the right side, or, where a block meets itself, on both.
    """
    sides = [np.flatnonzero(table.column(s).to_numpy(zero_copy_only=False).astype(bool)) for s in ("left", "right")]
    vectors, copies = unit(matrix(table.column("vector"))), table.column("copies").to_numpy()
    leaves = _padded(table.column("leaves").to_pylist())
    core = table.column("core").fill_null(-1).to_numpy()
    counts, labels = np.zeros(len(table), dtype=np.int64), np.arange(len(table))
    left, right = sides
    step = max(1, (1 << 22) // max(1, len(right)))
    for begin in range(0, len(left), step):
        some = left[begin : begin + step]
        near = vectors[some] @ vectors[right].T >= threshold
        a, b = np.nonzero(near)
        a, b = some[a], right[b]
        # within a block each pair comes twice; a core is counted elsewhere
        fresh = ((core[a] < 0) | (core[a] != core[b])) & ((a < b) | ~np.isin(a, right) | ~np.isin(b, left))
        a, b = a[fresh], b[fresh]
        for at in range(0, len(a), _PAIRS):
            x, y = a[at : at + _PAIRS], b[at : at + _PAIRS]
            first = ~_earlier_leaf(leaves[x], leaves[y], leaf)
            x, y = x[first], y[first]
            np.add.at(counts, x, copies[y])
            np.add.at(counts, y, copies[x])
            _tie(labels, x, y)
    while (labels[labels] != labels).any():
        labels = labels[labels]
    return counts, labels


def _tie(labels: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Give both ends of every pair, and what hangs on them, the smallest label among them."""
    while True:
        while (labels[labels] != labels).any():
            labels[:] = labels[labels]
        mine, other = labels[x], labels[y]
        apart = mine != other
        if not apart.any():
            return
        low, high = np.minimum(mine, other)[apart], np.maximum(mine, other)[apart]
        np.minimum.at(labels, high, low)


def _compared(dealt: DataFrame, threshold: float) -> DataFrame:
    """(node, links, other): of each leaf, or pair of blocks of a leaf, the links that count there."""

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        counts, labels = leaf_links(table, key[1].as_py(), threshold)
        nodes = table.column("node").to_numpy()
        linked = counts > 0
        columns = [nodes[linked], counts[linked], nodes[labels[linked]]]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["node", "links", "other"])

    return dealt.groupBy("size", "leaf", "first", "second").applyInArrow(compare, "node long, links long, other long")


def _cores(crowded: DataFrame, threshold: float) -> DataFrame:
    """(node, core): vectors within half the threshold's angle of the pivot of a crowded leaf, the first such leaf each.

    Any two vectors of one core are linked, by the triangle inequality of angles.
    """
    pivots = crowded.groupBy("size", "leaf").agg(F.min_by("vector", F.xxhash64("node")).alias("pivot"))
    beside = crowded.select("node", "size", "leaf", "vector").join(pivots, ["size", "leaf"])
    half = math.sqrt((1 + threshold) / 2) + ROUNDING

    def near(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            lengths = part.column(1).to_numpy()
            for size in np.unique(lengths):
                some = part.take(pa.array(np.flatnonzero(lengths == size)))
                cosines = (unit(matrix(some.column(3))) * unit(matrix(some.column(4)))).sum(axis=1)
                inside = pa.array(cosines >= half)
                yield pa.RecordBatch.from_arrays([some.column(0).filter(inside), some.column(2).filter(inside)], ["node", "leaf"])

    inside = beside.select("node", "size", "leaf", "vector", "pivot").mapInArrow(near, "node long, leaf int")
    return inside.groupBy("node").agg(F.min("leaf").alias("core"))


def _dealt(routed: DataFrame, block_rows: int, threshold: float) -> tuple[DataFrame, DataFrame | None]:
    """Rows by leaf, and those of crowded leaves by pairs of blocks; and the cores, where a leaf is crowded."""
    leaf = F.explode("leaves").alias("leaf")
    counts = routed.select("size", leaf).groupBy("size", "leaf").agg(F.count(F.lit(1)).alias("rows"))
    crowds = stored(counts.where(F.col("rows") > block_rows), "crowded_leaves")
    zero, yes = F.lit(0).cast("long"), F.lit(True)
    whole = [zero.alias("first"), zero.alias("second"), yes.alias("left"), yes.alias("right")]
    fields = ["size", "leaf", "node", "copies", "vector", "leaves", "core"]
    if crowds.isEmpty():
        return routed.withColumn("core", F.lit(None).cast("int")).select("*", leaf).select(*fields, *whole), None
    cores = stored(_cores(routed.select("*", leaf).join(crowds, ["size", "leaf"]), threshold), "cores")
    members = routed.join(cores, "node", "left").select("*", leaf)
    small = members.join(crowds, ["size", "leaf"], "left_anti").select(*fields, *whole)
    crowded = members.join(crowds, ["size", "leaf"])
    part = F.pmod(F.xxhash64("node"), F.ceil(F.col("rows") / block_rows))
    crowded = stored(crowded.withColumn("block", F.xxhash64("core", part)).select(*fields, "block"), "crowded")
    # what is joined with itself are blocks, and a core never meets itself
    blocks = crowded.select("size", "leaf", "block", "core").distinct()
    others = blocks.select("size", "leaf", F.col("block").alias("second"), F.col("core").alias("second_core"))
    differ = F.col("core").isNull() | F.col("second_core").isNull() | (F.col("core") != F.col("second_core"))
    pairs = blocks.withColumnRenamed("block", "first").join(others, ["size", "leaf"])
    pairs = stored(pairs.where((F.col("first") <= F.col("second")) & differ).select("size", "leaf", "first", "second"), "block_pairs")
    same = F.col("first") == F.col("second")
    as_first = crowded.join(pairs.withColumn("block", F.col("first")), ["size", "leaf", "block"])
    as_second = crowded.join(pairs.where(~same).withColumn("block", F.col("second")), ["size", "leaf", "block"])
    first = as_first.select(*fields, "first", "second", yes.alias("left"), same.alias("right"))
    second = as_second.select(*fields, "first", "second", F.lit(False).alias("left"), yes.alias("right"))
    return small.unionByName(first).unionByName(second), cores


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.9,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    trees: int = TREES,
    leaf_rows: int = LEAF_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(id, n_links, component_id) of every row: rows linked to it, itself not counted, and the smallest id it reaches.

    Two vectors of one length are linked when their cosine, in doubles, is at least `threshold`. No link below it is
    made; one above it is missed where the two share a leaf in no tree. Up to `leaf_rows` vectors are one leaf, and the
    result is exact. Equal vectors are one node of the search, so copies cost nothing and all count as links. Vectors
    that are null, empty or zero or hold null or non-finite entries link with nothing, nor does a row without an id,
    whose component_id is null. Ids are whole numbers; an id that repeats stands for each of its rows.
    """
    given = vectors.select(column(id_col).cast("long").alias("id"), column(vector_col).alias("vector"))
    kind = given.schema["vector"].dataType.elementType.simpleString()
    # adding nothing makes a zero of one sign
    plain = F.transform("vector", lambda x: x + F.lit(0).cast(kind))
    takes_part = F.col("id").isNotNull() & usable(F.col("vector")) & F.exists("vector", lambda x: x != 0)
    keyed = given.select("id", F.when(F.coalesce(takes_part, F.lit(False)), plain).alias("vector"))
    digests = [F.when(F.col("vector").isNotNull(), F.xxhash64(F.lit(i), "vector")).alias(f"digest{i}") for i in (0, 1)]
    keyed = keyed.select("id", "vector", *digests)
    nodes = (
        keyed.where(F.col("vector").isNotNull())
        .groupBy("digest0", "digest1", "vector")
        .agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    nodes = stored(nodes, "vectors")
    # one number for each length that vectors have
    sizes = nodes.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n")).collect()
    forests = {r["size"]: _forest(nodes, r["size"], r["n"], threshold, leaf_rows, trees) for r in sizes}
    routed = stored(_routed(nodes, forests, threshold), "routed")
    dealt, cores = _dealt(routed, block_rows, threshold)
    links = stored(_compared(dealt, threshold), "links")
    counted = links.groupBy("node").agg(F.sum("links").alias("links"))
    edges = links.select("node", "other")
    if cores is not None:
        held = cores.join(nodes.select("node", "copies"), "node")
        sums = held.groupBy("core").agg(F.sum("copies").alias("held"), F.min("node").alias("other"))
        in_core = held.join(sums, "core").select("node", (F.col("held") - F.col("copies")).alias("links"), "other")
        counted = counted.unionByName(in_core.select("node", "links")).groupBy("node").agg(F.sum("links").alias("links"))
        edges = edges.unionByName(in_core.select("node", "other"))
    found = components(edges)
    owners = (
        nodes.drop("vector")
        .join(counted, "node", "left")
        .join(found, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .withColumn("links", F.coalesce("links", F.lit(0)) + F.col("copies") - 1)
    )
    owners = stored(owners, "owners")
    least = owners.groupBy("component").agg(F.min("least").alias("component_id"))
    owners = owners.join(least, "component").select("digest0", "digest1", "links", "component_id")
    return keyed.drop("vector").join(owners, ["digest0", "digest1"], "left").select(
        "id",
        F.coalesce("links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
