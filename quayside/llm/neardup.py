"""Near-duplicate documents by MinHash with tensored banding, every link verified on whole sets.

A table key is usually made of several minhashes, and many tables need many of them. Here two small collections of
half keys are computed, and a table's key joins one half of each: 10 and 10 halves serve 100 tables with a fifth of the
minhashes. Only halves that two different sets share can make a shared key, so all others go before keys are formed.

What shares a key is only a candidate. Keys tie documents into groups by stars, one for each key, which takes as many
rows as the key has documents; the groups are then checked in blocks of documents on their full shingle sets, and a
block returns no more links than hold its documents together. Exact copies are one node from the start.

A group that does not fit into a block and whose documents are not near one of them, as those made from one template,
is divided first: two linked documents share one of the rarest fifth of their shingles, so only documents that share
such a shingle stay together. Documents whose own part is larger than the threshold allows share none and are done.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quayside.llm.common import BATCH_BYTES, column, let_go, small_parts, stored
from quayside.llm.components import components

SHINGLE = 5
HALVES = 10
MINHASHES_PER_HALF = 2
BLOCK_DOCS = 1_000
BLOCK_SHINGLES = 2_000_000
DIVIDED_TIMES = 2
WORDS_KEPT = 100_000
COLUMNS_AT_ONCE = 8_192

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


class WordHashes(dict):
    """64-bit hashes of words, remembered while the table is small."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _MIX
    return values ^ (values >> np.uint64(29))


def shingle_set(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct five-word shingles of a text; fewer words make one shingle, none none."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    each = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(SHINGLE, len(words))
    count = len(words) - width + 1
    joined = np.full(count, width, dtype=np.uint64)
    for step in range(width):
        joined = _mixed(joined * _ODD + each[step : step + count])
    return np.unique(joined)


def half_keys(shingles: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """2 x HALVES keys of MINHASHES_PER_HALF minhashes each."""
    least = np.full(len(seeds), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), COLUMNS_AT_ONCE):
        hashed = (shingles[None, at : at + COLUMNS_AT_ONCE] ^ seeds[:, None]) * _ODD
        hashed ^= hashed >> np.uint64(31)
        hashed *= _MIX
        least = np.minimum(least, hashed.min(axis=1))
    parts = least.reshape(2 * HALVES, MINHASHES_PER_HALF)
    joined = np.zeros(2 * HALVES, dtype=np.uint64)
    for part in parts.T:
        joined = _mixed(joined * _ODD + part)
    return joined.view(np.int64)


def _seeds() -> np.ndarray:
    count = 2 * HALVES * MINHASHES_PER_HALF
    return _mixed(np.arange(1, count + 1, dtype=np.uint64) * _ODD)


def _signatures(parts: Iterator[pa.RecordBatch], target: pa.Schema) -> Iterator[pa.RecordBatch]:
    let_go()
    hashes, seeds = WordHashes(), _seeds()
    for part in small_parts(parts, 1):
        sizes, digests, keys = [], [], []
        for text in part.column(1).to_pylist():
            shingles = shingle_set(text, hashes)
            sizes.append(len(shingles))
            if len(shingles):
                digests.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                keys.append(half_keys(shingles, seeds))
            else:
                digests.append(None)
                keys.append(None)
        columns = [part.column(0), pa.array(sizes), part.column(2), pa.array(digests), pa.array(keys)]
        arrays = [c.cast(f.type) for c, f in zip(columns, target, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, schema=target)
    hashes.clear()
    let_go()


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, n_shingles, version, digest, halves) of every row; digest and halves are null without words."""
    source = docs.select(
        column(id_col).cast("long").alias("id"),
        column(text_col).alias("text"),
        F.xxhash64(column(text_col)).alias("version"),
    )
    fields = "id long, n_shingles long, version long, digest binary, halves array<long>"
    schema = StructType.fromDDL(fields)

    def made(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _signatures(parts, to_arrow_schema(schema))

    return stored(source.mapInArrow(made, schema), "signatures")


def candidate_groups(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, component) of all nodes that share a table key with a smaller node, directly or over others.

    Besides, the `weight` of each node with shared halves: how many nodes have its halves, counted for each of them.
    """
    halves = classes.select("node", F.posexplode("halves").alias("slot", "half"))
    shared = halves.groupBy("slot", "half").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    alive = (
        halves.join(shared, ["slot", "half"])
        .groupBy("node")
        .agg(F.collect_set(F.struct("slot", "half")).alias("halves"), F.sum("n").alias("weight"))
        .select(
            "node",
            "weight",
            F.filter("halves", lambda h: h["slot"] < HALVES).alias("left"),
            F.filter("halves", lambda h: h["slot"] >= HALVES).alias("right"),
        )
    )
    alive = stored(alive.where((F.size("left") > 0) & (F.size("right") > 0)), "halves")
    keys = (
        alive.select("node", F.explode("left").alias("a"), "right")
        .select("node", "a", F.explode("right").alias("b"))
        .select("node", F.xxhash64("a.slot", "a.half", "b.slot", "b.half").alias("key"))
    )
    # a star for each key: every node with the smallest one
    centres = keys.groupBy("key").agg(F.min("node").alias("other"), F.count(F.lit(1)).alias("n"))
    stars = keys.join(centres.where("n > 1").drop("n"), "key").where(F.col("node") != F.col("other"))
    return components(stars.select("node", "other")), alive.select("node", "weight")


def block_links(sets: list[np.ndarray], nodes: list[int], sides: list[tuple[bool, bool]], percent: int):
    """Links (a, b) that connect what is linked among the documents of two blocks, and no more of them than needed.

    `sides` tells for each document whether it is in the first and in the second block; only pairs across count.
    Documents are sorted by size, so a document meets only those whose size allows the similarity.
    """
    order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), nodes[i]))
    sizes = np.array([len(sets[i]) for i in order])
    flat = np.concatenate([sets[i] for i in order])
    _, shingle = np.unique(flat, return_inverse=True)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    first = np.array([sides[i][0] for i in order])
    second = np.array([sides[i][1] for i in order])
    names = np.array([nodes[i] for i in order])
    group = np.arange(len(order))  # which documents are connected so far
    marked = np.zeros(len(flat), dtype=bool)
    links = []
    if len(set(nodes)) < len(nodes):
        group = np.unique(names, return_inverse=True)[1]  # rows of one node are connected as they are
    for at in range(len(order)):
        stop = np.searchsorted(sizes * percent, sizes[at] * 100, side="right")
        others = slice(at + 1, stop)
        across = (first[at] & second[others]) | (second[at] & first[others])
        apart = across & (group[others] != group[at])
        if not apart.any():
            continue
        own = shingle[offsets[at] : offsets[at + 1]]
        marked[own] = True
        span = marked[shingle[offsets[at + 1] : offsets[stop]]]
        common = np.add.reduceat(span, offsets[at + 1 : stop] - offsets[at + 1], dtype=np.int64)
        marked[own] = False
        linked = apart & (100 * common >= percent * (sizes[at] + sizes[others] - common))
        for other in np.flatnonzero(linked) + at + 1:
            if group[other] != group[at]:
                links.append((int(names[at]), int(names[other])))
                group[group == group[other]] = group[at]
    return links


def _checked(placed: DataFrame, percent: int) -> DataFrame:
    """True links within each (component, first, second): between rows that are `left` and rows that are `right`."""

    def check(table: pa.Table) -> pa.Table:
        hashes = WordHashes()
        sets = [shingle_set(text, hashes) for text in table.column("text").to_pylist()]
        sides = list(zip(table.column("left").to_pylist(), table.column("right").to_pylist(), strict=True))
        links = block_links(sets, table.column("node").to_pylist(), sides, percent)
        pairs = [list(c) for c in zip(*links, strict=True)] or [[], []]
        if table.nbytes > BATCH_BYTES:
            let_go()
        return pa.table([pa.array(p, pa.int64()) for p in pairs], names=["node", "other"])

    return placed.groupBy("component", "first", "second").applyInArrow(check, "node long, other long")


def _in_blocks(rows: DataFrame) -> DataFrame:
    """`rows` with the number of `blocks` that their component needs, and the block each belongs to.

    A block has some BLOCK_DOCS documents and BLOCK_SHINGLES shingles at the most, or one document that has more.
    """
    by_docs, by_shingles = F.count(F.lit(1)) / BLOCK_DOCS, F.sum("n_shingles") / BLOCK_SHINGLES
    counts = rows.groupBy("component").agg(F.ceil(F.greatest(by_docs, by_shingles)).cast("int").alias("blocks"))
    dealt = rows.join(counts, "component")
    return dealt.withColumn("block", F.pmod(F.xxhash64("node", "version"), "blocks").cast("int"))


def _each(count: str):
    return F.explode(F.sequence(F.lit(0), F.col(count) - 1))


def _shingle_sets(texts: DataFrame) -> DataFrame:
    """(component, node, version, n_shingles, shingles) of texts with these columns."""
    schema = StructType.fromDDL("component long, node long, version long, n_shingles long, shingles array<long>")
    source = texts.select("component", "node", "version", "text")

    def made(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, target = WordHashes(), to_arrow_schema(schema)
        for part in small_parts(parts, 3):
            sets = [shingle_set(text, hashes).view(np.int64) for text in part.column(3).to_pylist()]
            columns = [*part.columns[:3], pa.array([len(s) for s in sets]), pa.array(sets)]
            arrays = [c.cast(f.type) for c, f in zip(columns, target, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return source.mapInArrow(made, schema)


def rare_shingles(texts: DataFrame, percent: int) -> DataFrame:
    """(component, shingle, node, n_shingles, reach): of each text the shingles one of which all its links share.

    With the shingles of a component in one order, rarest first, two linked documents share one of the first
    `n - percent / 100 * n + 1` shingles of each. Shingles of a single document come first, they link it with nothing
    and are not returned. `reach` is the size of the largest document that can be linked with the shingles that are
    not its own. Counts are merged before their shuffle and stored, so adaptive execution can split a frequent shingle.
    """
    sets = stored(_shingle_sets(texts), "shingles")
    spread = sets.select("component", "node", "version", "n_shingles", F.explode("shingles").alias("shingle"))
    counts = spread.groupBy("component", "shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = (
        spread.join(stored(counts, "shared_shingles"), ["component", "shingle"])
        .groupBy("component", "node", "version", "n_shingles")
        .agg(F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("shared"))
        .withColumn("rare", F.expr(f"size(shared) - (n_shingles * {percent} + 99) div 100 + 1").cast("int"))
        .withColumn("reach", F.expr(f"size(shared) * {100 + percent}L div {percent} - n_shingles"))
    )
    rare = F.explode(F.slice("shared", F.lit(1), F.col("rare")))
    found = shared.where("rare > 0").select("component", "node", "n_shingles", "reach", rare.alias("one"))
    return found.select("component", "one.shingle", "node", "n_shingles", "reach")


def divided(texts: DataFrame, percent: int) -> DataFrame:
    """(node, component): the groups of `texts` divided so that no link between two of their documents is lost.

    What shares a rare shingle stays together, where sizes allow a link. A document that none of those with its
    shingle can be linked with, by the shares that are its own or theirs, leaves that shingle.
    """
    rare = stored(rare_shingles(texts, percent), "rare_shingles")
    one = ["component", "shingle"]
    bounds = (
        rare.groupBy(*one)
        .agg(F.count(F.lit(1)).alias("n"), F.min("n_shingles").alias("least"), F.max("reach").alias("farthest"))
        .where("n > 1")
    )
    possible = rare.join(stored(bounds, "bounds"), one).where("least <= reach AND n_shingles <= farthest")
    possible = stored(possible.select(*one, "node"), "possible")
    centres = possible.groupBy(*one).agg(F.min("node").alias("other"))
    stars = possible.join(stored(centres, "centres"), one).where(F.col("node") != F.col("other"))
    return components(stars.select("node", "other"))


def verified_links(
    sizes: DataFrame, texts: DataFrame, groups: DataFrame, weights: DataFrame, percent: int, divide: int = DIVIDED_TIMES
) -> DataFrame:
    """(node, other): true links that connect the nodes of each group just as all its true links would.

    `sizes` has (node, version, n_shingles) and `texts` (node, version, text) of all of them. A group of one block is
    checked at once. In a larger one all documents are first compared with one of them, the pivot, a block at a time.
    Those linked to it are connected; only the others are compared with all of the group. Where they are more than a
    block, the group is divided by rare shingles and its parts are checked like groups. What still has more after
    `divide` times is compared in blocks, each block of the others with each block of the group.

    So the work is linear in documents that are near the pivot or have enough text of their own. It grows with the
    square of those that have neither, in one group: many texts a little less alike than `percent`.
    """
    roots = groups.select("component", F.col("component").alias("node")).distinct()
    members = groups.select("component", "node").unionByName(roots)
    # blocks are dealt out before texts come along, which are never dealt by component alone
    dealt = _in_blocks(members.join(sizes.select("node", "version", "n_shingles"), "node"))
    placed = stored(dealt.join(texts, ["node", "version"]).dropDuplicates(["node", "version"]), "group_texts")
    yes, no, zero = F.lit(True), F.lit(False), F.lit(0)
    both = [yes.alias("left"), yes.alias("right")]
    small = placed.where("blocks = 1")
    small = small.select("component", zero.alias("first"), zero.alias("second"), *both, "node", "text")
    links = _checked(small, percent)
    large = placed.where("blocks > 1")
    if large.isEmpty():
        return links

    # the document whose half keys most others share stands in the middle of its group
    most = F.struct("weight", -F.col("node"), "version")
    chosen = (
        large.join(weights, "node")
        .groupBy("component", "blocks")
        .agg(F.max_by(F.struct("node", "text"), most).alias("pivot"))
    )
    left, right = [yes.alias("left"), no.alias("right")], [no.alias("left"), yes.alias("right")]
    pivots = chosen.select("component", _each("blocks").alias("first"), zero.alias("second"), *left, "pivot.*")
    compared = large.select("component", F.col("block").alias("first"), zero.alias("second"), *right, "node", "text")
    to_pivot = stored(_checked(pivots.unionByName(compared), percent), "pivot_links")
    links = links.unionByName(to_pivot)
    connected = to_pivot.select("node").unionByName(to_pivot.select(F.col("other").alias("node"))).distinct()
    keys = large.select("component", "node", "version", "n_shingles", "block", F.col("blocks").alias("all_blocks"))
    apart = _in_blocks(keys.drop("block").join(connected, "node", "left_anti"))
    apart = stored(apart.withColumnsRenamed({"blocks": "parts", "block": "part"}), "apart")
    if divide:
        crowded = apart.where("parts > 1").select("component").distinct()
        if not crowded.isEmpty():
            rows = large.join(crowded, "component", "left_semi")
            own = rows.select("node", "version", "text")
            parts_of = divided(rows, percent)
            links = links.unionByName(verified_links(rows, own, parts_of, weights, percent, divide - 1))
            apart = apart.where("parts = 1")
    parts = apart.select("component", "parts").distinct()
    one = large.select("node", "version", "text")
    asking = apart.join(one, ["node", "version"]).select(
        "component", F.col("part").alias("first"), _each("all_blocks").alias("second"), *left, "node", "text"
    )
    asked = keys.join(parts, "component").join(one, ["node", "version"]).select(
        "component", _each("parts").alias("first"), F.col("block").alias("second"), *right, "node", "text"
    )
    return links.unionByName(_checked(asking.unionByName(asked), percent))


def near_duplicates(
    docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_shingles, component_id) of every row of `docs`.

    Two documents are linked when 100 times the shingles they share are at least `percent` times those of either. A
    component is what links connect; its id is the smallest document id in it. A text without words, or null, has no
    shingles and is a component of its own, and so is a row without an id, whose component_id is null. Repeated rows
    are exact copies. Ids are whole numbers.
    """
    signed = signatures(docs, id_col, text_col)
    classes = (
        signed.where(F.col("digest").isNotNull() & F.col("id").isNotNull())
        .groupBy("digest")
        .agg(F.min(F.struct("id", "version", "n_shingles", "halves")).alias("one"))
        .select("digest", F.col("one.id").alias("node"), "one.version", "one.n_shingles", "one.halves")
    )
    classes = stored(classes, "classes")
    groups, weights = candidate_groups(classes)
    source = docs.select(
        column(id_col).cast("long").alias("node"),
        F.xxhash64(column(text_col)).alias("version"),
        column(text_col).alias("text"),
    )
    found = components(verified_links(classes, source, groups, weights, percent))
    owners = classes.select("digest", "node").join(found, "node", "left")
    owners = owners.select("digest", F.coalesce("component", "node").alias("component"))
    return signed.join(owners, "digest", "left").select(
        "id", "n_shingles", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id")
    )


def without_near_duplicates(
    docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of each component, that of its smallest document id, with all columns as they are.

    Of rows that share this id the one with the smallest hash of its text stays. Rows without an id stay.
    """
    kept = (
        near_duplicates(docs, percent, id_col, text_col)
        .where(F.col("id") == F.col("component_id"))
        .select(F.col("id").alias("kept_id"))
        .distinct()
    )
    rows = docs.select(
        F.struct(*[column(c) for c in docs.columns]).alias("row"), column(id_col).cast("long").alias("id")
    )
    known = rows.where(F.col("id").isNotNull()).join(kept, F.col("id") == F.col("kept_id"), "left_semi")
    version = F.xxhash64(F.col("row")[text_col])
    one = known.groupBy("id").agg(F.min_by("row", version).alias("row"))
    return one.select("row.*").unionByName(rows.where(F.col("id").isNull()).select("row.*"))
