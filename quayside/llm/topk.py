"""Exact top-k search by the threshold algorithm over sorted lists, one list for each dimension.

The vectors are dealt into blocks. A block sorts its vectors once by every dimension. A query walks the lists of its
non-zero dimensions side by side, from the large end where its component is positive and from the small end where it is
negative, and scores every vector it meets for the first time. What has not been met scores at most the sum of the
query's components times the values at the walked depth, so the walk ends as soon as the k-th best score is above that
bound; a bound equal to it goes on, as a smaller id may still tie.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import column, stored

BLOCK_ROWS = 16_384
QUERY_ROWS = 65_536
# integer arithmetic of 64 bits holds every score while no partial sum can pass this
EXACT = 1 << 62
FIRST_DEPTH = 32


class SortedLists:
    """A block of integer vectors with their order in each dimension. Integers are 64 bits wide or Python's own."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.places, self.ids, self.vectors = order, ids[order], vectors[order]
        largest = max((abs(int(x)) for x in (vectors.min(initial=0), vectors.max(initial=0))), default=0)
        self.reach = largest * max(1, vectors.shape[1])
        self.order = np.argsort(self.vectors, axis=0, kind="stable").T.copy()
        self.values = np.sort(self.vectors, axis=0).T.copy()

    def top(self, query: np.ndarray, k: int, left_out: int | None) -> list[tuple[int, int]]:
        """(score, id) of the k best, best first, smaller ids first among equals; the row `left_out` takes no part."""
        n = len(self.ids)
        if self.reach * max(abs(int(x)) for x in (query.min(initial=0), query.max(initial=0))) >= EXACT:
            query = query.astype(object)  # products and sums become Python's integers
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        seen = np.zeros(n, dtype=bool)
        rows = np.zeros(0, dtype=np.int64)
        scores = np.zeros(0, dtype=query.dtype)
        walked, depth = 0, min(FIRST_DEPTH, n)
        while True:
            if len(up) + len(down) == 0:
                depth = n  # all scores are zero: no list tells anything
                met = np.arange(n)
            else:
                large = self.order[up, n - depth : n - walked]
                small = self.order[down, walked:depth]
                fresh = np.zeros(n, dtype=bool)
                fresh[large.ravel()] = True
                fresh[small.ravel()] = True
                fresh &= ~seen
                met = np.flatnonzero(fresh)
            seen[met] = True
            met = met[self.places[met] != left_out] if left_out is not None else met
            rows = np.append(rows, met)
            scores = np.append(scores, self.vectors[met] @ query)
            if len(rows) > k:
                best = self._ranked(rows, scores)[:k]
                rows, scores = rows[best], scores[best]
            if depth == n:
                break
            bound = self.values[up, n - depth] @ query[up] + self.values[down, depth - 1] @ query[down]
            if len(rows) == k and scores.min() > bound:
                break
            walked, depth = depth, min(2 * depth, n)
        return [(int(scores[i]), int(self.ids[rows[i]])) for i in self._ranked(rows, scores)]

    def _ranked(self, rows: np.ndarray, scores: np.ndarray) -> np.ndarray:
        if scores.dtype != object:
            return np.lexsort((self.ids[rows], -scores))
        return np.array(sorted(range(len(rows)), key=lambda i: (-scores[i], self.ids[rows[i]])), dtype=np.int64)


def usable(vector: Column) -> Column:
    """Whether a vector has values only: no null, no NaN, no infinity."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < math.inf)
    )
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    scale: float = 256.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The k highest inner products of every query with all other rows, of vectors turned into floor(scale * x).

    Returns query_id, rank (from 1), vec_id, score and score_text; ties go to the smaller id, and with fewer candidates
    all are returned. Every row is a candidate of every query but itself, rows that share its id included; an id that
    repeats asks once for each of its rows. Vectors that are null or hold nulls or non-finite components take no part,
    nor do rows without an id, and a query meets vectors of its own length only. Scores are exact integers of any size:
    `score` is null where a long cannot hold one, `score_text` has its digits.
    """
    # the whole part of a double is a double
    exact = F.transform(column(vector_col), lambda x: _floor(x.cast("double") * scale))
    rows = vectors.where(column(id_col).isNotNull() & usable(column(vector_col))).select(
        column(id_col).cast("long").alias("id"), is_query.alias("asks"), exact.alias("vector")
    )
    rows = stored(rows.withColumns({"size": F.size("vector"), "row": F.monotonically_increasing_id()}), "vectors")
    total, queries = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    blocks, parts = max(1, math.ceil(total / block_rows)), max(1, math.ceil(queries / QUERY_ROWS))
    # every part of the queries meets every block; a block sorts its lists for each part
    block, part = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"), F.pmod(F.hash("row"), F.lit(parts))
    every_block, every_part = (F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (blocks, parts))
    candidates = rows.select("size", block.alias("block"), every_part.alias("part"), "row", "id", "vector")
    asked = rows.where("asks").select("size", every_block.alias("block"), part.alias("part"), "row", "id", "vector")
    keys = ["size", "block", "part"]
    partial = stored(
        candidates.groupBy(keys)
        .cogroup(asked.groupBy(keys))
        .applyInArrow(
            lambda block_rows, query_rows: _answers(block_rows, query_rows, k),
            f"row long, {_ANSWER}",
        ),
        "answers",
    )
    answers = partial.where("score IS NOT NULL")
    large = partial.where("score IS NULL").select("row").distinct()
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    if not large.isEmpty():
        # scores beyond a long are compared by Python; few queries have any
        answers = partial.join(large, "row", "left_anti")
        merged = partial.join(large, "row").groupBy("row").applyInArrow(lambda t: _merged(t, k), f"{_ANSWER}, rank int")
    ranked = answers.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k).drop("row")
    ranked = ranked if large.isEmpty() else ranked.unionByName(merged)
    return ranked.select("query_id", "rank", "vec_id", "score", "score_text")


_ANSWER = "query_id long, vec_id long, score long, score_text string"


def _floor(value: Column) -> Column:
    """The largest whole number, as a double, that is no larger than a double: from 2^52 on, that is the double itself."""
    return F.when(F.abs(value) < float(1 << 52), F.floor(value).cast("double")).otherwise(value)


def _matrix(table: pa.Table) -> np.ndarray:
    """Vectors as rows of whole numbers: of 64 bits, or Python's own where these could not hold them."""
    flat = table.column("vector").combine_chunks()
    values = flat.flatten() if isinstance(flat, pa.Array) else pa.concat_arrays([c.flatten() for c in flat.chunks])
    numbers = values.to_numpy(zero_copy_only=False)
    if not (np.abs(numbers) < float(EXACT)).all():
        numbers = np.array([int(x) for x in numbers.tolist()], dtype=object)
        return numbers.reshape(len(table), -1)
    return numbers.astype(np.int64).reshape(len(table), -1)


def _answers(block: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    answers: list[tuple] = []
    if len(block) and len(queries):
        lists = SortedLists(block.column("id").to_numpy(), _matrix(block))
        own = {row: place for place, row in enumerate(block.column("row").to_pylist())}
        asked = zip(queries.column("row").to_pylist(), queries.column("id").to_pylist(), _matrix(queries), strict=True)
        for row, query_id, query in asked:
            found = lists.top(query, k, own.get(row))
            answers += [(row, query_id, vec_id, score if -_LONG <= score < _LONG else None, str(score)) for score, vec_id in found]
    columns = [list(c) for c in zip(*answers, strict=True)] or [[]] * 5
    types = [pa.int64()] * 4 + [pa.string()]
    names = ["row", "query_id", "vec_id", "score", "score_text"]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


_LONG = 1 << 63


def _merged(table: pa.Table, k: int) -> pa.Table:
    """The k best answers of a query, some of whose scores are beyond a long, out of those of all blocks."""
    rows = sorted(table.drop_columns(["row"]).to_pylist(), key=lambda r: (-int(r["score_text"]), r["vec_id"]))[:k]
    names = ["query_id", "vec_id", "score", "score_text"]
    types = [pa.int64()] * 3 + [pa.string()]
    columns = [pa.array([r[n] for r in rows], t) for n, t in zip(names, types, strict=True)]
    return pa.table([*columns, pa.array(range(1, len(rows) + 1), pa.int32())], names=[*names, "rank"])
