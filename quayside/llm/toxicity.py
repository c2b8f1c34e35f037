"""Toxicity by a classifier chain: categories are predicted one after the other by linear models.

Each model sees words and word beginnings of a text, and the probabilities of the categories before it. For training,
those probabilities come from models that have not seen the row (out-of-fold); otherwise later models would trust the
earlier ones more than they deserve on new texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import column, let_go, per_document, stored

WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5)
FOLDS = 4
MAX_TRAINING_ROWS = 20_000
FEATURES_PER_CATEGORY = 400
LEAST_DOCUMENTS = 4
PENALTY = 0.2
COUNTS_HELD = 100_000
CATEGORIES = ("quality", "toxic")

# where a fit ends: the slope that is left, in parts of the rows, and of a Newton step's linear system
SLOPE_LEFT = 1e-6
RESIDUAL_LEFT = 1e-6


def features(text: str) -> set[str]:
    """Distinct lower-cased words, and their beginnings of PREFIXES letters marked by a hyphen."""
    words = set(WORD.findall(text.lower()))
    found = set(words)
    for length in PREFIXES:
        found.update({w[:length] + "-" for w in words if len(w) > length})
    return found


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[str] = CATEGORIES,
    max_rows: int = MAX_TRAINING_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, text, and a 0/1 column for each category) of at most `max_rows` labelled documents, the first in the order
    of a hash of their id.

    The bound makes the sample small enough to fit models on and to send its ids to all tasks. Rows without an id, or
    without a label of some category, are left out; an id that is labelled twice counts as 1 if any of its labels is.
    """
    known = column(id_col).isNotNull()
    for c in categories:
        known = known & column(c).isNotNull()
    chosen = (
        labels.where(known)
        .groupBy(column(id_col).alias("id"))
        .agg(*[F.max(column(c).cast("int")).alias(c) for c in categories])
        .orderBy(F.xxhash64("id"), "id")
        .limit(max_rows)
    )
    texts = docs.select(column(id_col).alias("id"), F.coalesce(column(text_col), F.lit("")).alias("text"))
    # an id that repeats is one document, its text the smallest
    found = texts.join(F.broadcast(chosen), "id").groupBy("id", *categories).agg(F.min("text").alias("text"))
    return stored(found.select("id", "text", *categories), "labelled")


@dataclass
class Chain:
    """A fitted chain: feature numbers, and for each category the weights of features and earlier probabilities."""

    categories: list[str]
    vocabulary: dict[str, int]
    weights: list[np.ndarray]

    def probabilities(self, text: str) -> list[float]:
        hits = [self.vocabulary[f] for f in features(text) & self.vocabulary.keys()]
        known: list[float] = []
        for weights in self.weights:
            n = len(self.vocabulary)
            score = weights[-1] + weights[hits].sum() + weights[n : n + len(known)] @ np.array(known)
            known.append(float(_sigmoid(score)))
        return known


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Sparse:
    """Rows of 0/1 features beside a few dense columns, and a constant. Features are kept in the order of rows and in
    that of columns, so that products with either are sums of neighbouring numbers."""

    def __init__(self, hits: list[np.ndarray], width: int, dense: np.ndarray):
        sizes = np.array([len(h) for h in hits], dtype=np.int64)
        self.cols = np.concatenate(hits).astype(np.int64) if hits else np.zeros(0, dtype=np.int64)
        rows = np.repeat(np.arange(len(hits)), sizes)
        self.rows = rows[np.argsort(self.cols, kind="stable")]
        self.n, self.width, self.dense = len(hits), width, dense
        self.by_row = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.by_col = np.concatenate([[0], np.cumsum(np.bincount(self.cols, minlength=width))]).astype(np.int64)

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return _sums(weights[self.cols], self.by_row) + self.dense @ weights[self.width : -1] + weights[-1]

    def back(self, values: np.ndarray) -> np.ndarray:
        return np.concatenate([_sums(values[self.rows], self.by_col), self.dense.T @ values, [values.sum()]])


def _sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums of the values between neighbouring edges, 0 where there are none."""
    out = np.zeros(len(edges) - 1)
    filled = edges[1:] > edges[:-1]
    if filled.any():
        out[filled] = np.add.reduceat(values, edges[:-1][filled])
    return out


def fit_logistic(x: Sparse, y: np.ndarray, penalty: float = PENALTY, start: np.ndarray | None = None) -> np.ndarray:
    """Weights of a logistic regression with a squared penalty on all but the constant, by damped Newton steps whose
    linear systems are solved by conjugate gradients. It ends where no slope is left, or where a step no longer lowers
    the loss, which the convex loss reaches. Without both classes the constant tells their share.

    `start` are the weights to begin with; they change the way, not the end.
    """
    weights = np.zeros(x.width + x.dense.shape[1] + 1)
    share = y.mean() if len(y) else 0.0
    weights[-1] = np.log((share + 1e-9) / (1 - share + 1e-9))
    if share in (0.0, 1.0):
        return weights
    if start is not None:
        weights = start.copy()
    ridge = np.full(len(weights), penalty)
    ridge[-1] = 0.0

    def loss(at: np.ndarray, scores: np.ndarray) -> float:
        return float((np.logaddexp(0, scores) - y * scores).sum() + (ridge * at * at).sum() / 2)

    scores = x.dot(weights)
    now = loss(weights, scores)
    while True:
        p = 1 / (1 + np.exp(-np.clip(scores, -500, 500)))
        gradient = x.back(p - y) + ridge * weights
        if np.abs(gradient).max() <= SLOPE_LEFT * len(y):
            return weights
        curve = p * (1 - p)
        scale = x.back(curve) + ridge  # the diagonal of the curvature: features are 0 or 1
        scale[x.width : -1] = (x.dense * x.dense).T @ curve + ridge[x.width : -1]
        scale = np.maximum(scale, 1e-12)
        step, residual = np.zeros(len(weights)), -gradient
        direction = residual / scale
        size = residual @ direction
        goal = RESIDUAL_LEFT**2 * size
        for _ in range(len(weights)):
            bent = x.back(curve * x.dot(direction)) + ridge * direction
            along = size / max(direction @ bent, 1e-300)
            step += along * direction
            residual -= along * bent
            scaled = residual / scale
            smaller = residual @ scaled
            if smaller <= goal:
                break
            direction = scaled + smaller / size * direction
            size = smaller
        # a step that leads too far is halved until the loss falls as the gradient promises
        slope, length = gradient @ step, 1.0
        while True:
            moved = weights + length * step
            scores = x.dot(moved)
            then = loss(moved, scores)
            if then <= now + 1e-4 * length * slope or length < 1e-10:
                break
            length /= 2
        if not then < now:
            return weights
        weights, now = moved, then


def fit_chain(hits: list[np.ndarray], labels: np.ndarray, folds: np.ndarray, width: int) -> list[np.ndarray]:
    """Weights of each category of a chain; `labels` has a column for each, `folds` tells who is left out together."""
    n, count = labels.shape
    earlier = np.zeros((n, 0))
    fitted = []
    for category in range(count):
        y = labels[:, category].astype(float)
        fitted.append(whole := fit_logistic(Sparse(hits, width, earlier), y))
        if category + 1 == count:
            break
        unseen = np.zeros(n)
        for fold in np.unique(folds):
            out = folds == fold
            kept, left = np.flatnonzero(~out), np.flatnonzero(out)
            weights = fit_logistic(Sparse([hits[i] for i in kept], width, earlier[kept]), y[kept], start=whole)
            unseen[left] = _sigmoid(Sparse([hits[i] for i in left], width, earlier[left]).dot(weights))
        earlier = np.column_stack([earlier, unseen])
    return fitted


def train(
    sample: DataFrame,
    categories: list[str],
    features_per_category: int = FEATURES_PER_CATEGORY,
    least_documents: int = LEAST_DOCUMENTS,
) -> Chain:
    """A chain over `categories`, in this order, from a bounded sample with `id`, `text` and a 0/1 column for each.

    Of each category those features enter that speak for it most: by documents times log odds, `features_per_category`
    of them, from `least_documents` documents on. Both bound the model that travels to all tasks, not the texts it is
    used on. Only counts, and the numbers of these features in each row, come to the driver.
    """
    width = len(categories)
    wanted = sample.select("text", *categories)

    def counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Counter] = [Counter() for _ in range(width + 1)]

        def out() -> pa.RecordBatch:
            names = list(held[0])
            columns = [pa.array(names, pa.string())]
            columns += [pa.array([c[f] for f in names], pa.int64()) for c in held]
            for c in held:
                c.clear()
            return pa.RecordBatch.from_arrays(columns, names=["feature", "n", *[f"c{i}" for i in range(width)]])

        let_go()
        for part in parts:
            marks = [part.column(i + 1).to_pylist() for i in range(width)]
            for at, text in enumerate(part.column(0).to_pylist()):
                found = features(text)
                held[0].update(found)
                for i in range(width):
                    if marks[i][at]:
                        held[i + 1].update(found)
                if len(held[0]) >= COUNTS_HELD:
                    yield out()
        yield out()

    sums = ["n", *[f"c{i}" for i in range(width)]]
    schema = "feature string, " + ", ".join(f"{c} long" for c in sums)
    counts = wanted.mapInArrow(counted, schema).groupBy("feature").agg(*[F.sum(c).alias(c) for c in sums])
    counts = stored(counts.where(F.col("n") >= least_documents), "features")
    total, *positive = wanted.agg(
        F.count(F.lit(1)), *[F.coalesce(F.sum(column(c)), F.lit(0)) for c in categories]
    ).first()
    chosen: set[str] = set()
    for i, own in enumerate(positive):
        inside = (F.col(f"c{i}") + 0.5) / (own + 1.0)
        outside = (F.col("n") - F.col(f"c{i}") + 0.5) / (total - own + 1.0)
        ranked = counts.withColumn("weight", F.col(f"c{i}") * F.log(inside / outside)).where("weight > 0")
        top = ranked.orderBy(F.desc("weight"), "feature").limit(features_per_category)
        chosen.update(r["feature"] for r in top.select("feature").collect())
    vocabulary = {f: i for i, f in enumerate(sorted(chosen))}

    def numbered(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = part.column(0).to_pylist()
            found = [sorted(vocabulary[f] for f in features(t) & vocabulary.keys()) for t in texts]
            columns = [pa.array(found, pa.list_(pa.int32())), *[part.column(i) for i in range(1, part.num_columns)]]
            yield pa.RecordBatch.from_arrays(columns, names=["hits", "fold", "id", *categories])

    folded = sample.select("text", F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(FOLDS)).alias("fold"), "id", *categories)
    types = ", ".join(f"`{c}` int" for c in categories)
    id_type = sample.schema["id"].dataType.simpleString()
    rows = folded.mapInArrow(numbered, f"hits array<int>, fold long, id {id_type}, {types}").collect()
    rows.sort(key=lambda r: (r["id"], r["hits"]))  # sums come out alike whatever the tasks' order
    hits = [np.array(r["hits"], dtype=np.int64) for r in rows]
    labels = np.array([[r[c] for c in categories] for r in rows], dtype=float).reshape(len(rows), width)
    weights = fit_chain(hits, labels, np.array([r["fold"] for r in rows], dtype=np.int64), len(vocabulary))
    return Chain(list(categories), vocabulary, weights)


def chain_of(docs: DataFrame, labels: DataFrame, categories: Sequence[str] = CATEGORIES) -> Chain:
    """The chain over the given label columns, in this order, trained on labelled documents. The last one is the verdict;
    without any label it is never given."""
    return train(labelled_sample(docs, labels, categories), list(categories))


def scored(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The probability of each category for every whole text. A null text is read as empty: no feature speaks. Rows that
    repeat are answered each time."""
    fields = ", ".join(f"`{c}` double" for c in chain.categories)
    return per_document(docs, lambda text: tuple(chain.probabilities(text)), fields, id_col, text_col)


def without_toxic(docs: DataFrame, chain: Chain, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns as they are, whose last category's probability is below the threshold.

    A null text is read as empty. Only texts travel to Python, and a verdict on each comes back.
    """

    @F.arrow_udf("boolean")
    def kept(texts: pa.Array) -> pa.Array:
        let_go()
        return pa.array([chain.probabilities(t.as_py() or "")[-1] < threshold for t in texts], pa.bool_())

    return docs.where(kept(column(text_col)))
