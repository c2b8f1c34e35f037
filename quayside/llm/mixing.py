"""Mixing sources to target token counts by entropy balancing. DataFrame operations only.

Every document gets a rate, how often the mix takes it on average: the rates closest to 1 in relative entropy that
give each source its target of tokens. These are exponentially tilted by the document's size, at most MAX_COPIES. The
tilt of each source is the root of the gradient of a convex dual; Newton iterations find it, each an aggregation over
the counts of (source, size), which hold all that rates depend on. Rates are then rounded to copies.
"""

from __future__ import annotations

import math
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import column, discard, stored

MAX_COPIES = 2
TOLERANCE = 1e-7
NEWTON_STEPS = 50
# a bracket this narrow, in parts of its ends, holds one number
NARROW = 1e-15
RANKED_TOGETHER = 1_000
WORD = r"[^\\x20\\x09-\\x0D]+"


def text_size(text: Column) -> Column:
    """Number of words in a text, runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.expr(f"'{WORD}'")), F.lit(0)).cast("long")


def _exact_sum(value: Column) -> Column:
    """A sum that comes out alike in whatever order its rows arrive."""
    return F.coalesce(F.sum(value.cast("decimal(38,9)")), F.lit(0)).cast("double")


def shares(sources: DataFrame, weights: list[float], budget: float) -> DataFrame:
    """`sources` (key, source, source_size) with a `target` each: `budget` times all sizes, dealt by weights.

    Weights repeat over the sources in the order of their code points, null last. No target is above MAX_COPIES times
    its source's size; what would be goes to the others by weight. There is one row for each source, so the windows over
    all of them are short.
    """
    order = Window.orderBy(F.asc_nulls_last("source"))
    everything = Window.partitionBy()
    numbered = sources.withColumn("number", F.row_number().over(order)).withColumn(
        "weight",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("number") - 1) % len(weights) + 1)),
    )
    limit = MAX_COPIES * F.col("source_size").cast("double")
    rising = Window.orderBy(limit / F.col("weight"), "number")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    # if the sources before this one are at their limits, the rest is dealt at this level of tokens for each weight
    rest = budget * F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(rising.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    levelled = numbered.withColumn("level", rest / weight_left).withColumn("limit", limit)
    holds = F.col("level") * F.col("weight") <= F.col("limit")
    first = F.min(F.when(holds, F.struct(F.col("limit") / F.col("weight"), "number", "level"))).over(everything)
    level = F.coalesce(first["level"], F.lit(math.inf))
    return levelled.withColumn("target", F.least("limit", F.col("weight") * level)).select(
        "key", "source", "source_size", "target"
    )


def _rate(tilt: Column) -> Column:
    return F.least(F.lit(float(MAX_COPIES)), F.exp(tilt * F.col("x")))


def tilts(classes: DataFrame, targets: DataFrame) -> DataFrame:
    """(key, tilt) of each source: its taken tokens at rates min(MAX_COPIES, exp(tilt * x)) reach its target.

    `classes` has (key, size, n); x is the size over the source's mean. Newton steps on the dual's gradient, halving a
    bracket of the root where a step leaves it, and from NEWTON_STEPS steps on in any case. A target at its limit takes all documents MAX_COPIES times, one of 0
    takes none; both need no iteration.
    """
    tokens = F.col("n") * F.col("size")
    spread = classes.where("size > 0").groupBy("key").agg(F.sum("n").alias("docs"), F.min("size").alias("least"))
    state = targets.join(spread, "key").withColumn("mean", F.col("source_size") / F.col("docs"))
    share = F.col("target") / F.col("source_size")
    least_x = F.col("least") / F.col("mean")
    state = state.where("target > 0").select(
        "key",
        "target",
        "mean",
        (F.log(share / 4) / least_x).alias("low"),
        (F.lit(math.log(MAX_COPIES)) / least_x).alias("high"),
        F.when(share >= MAX_COPIES * (1 - 1e-12), F.lit(math.log(MAX_COPIES)) / least_x)
        .otherwise(F.lit(0.0))
        .alias("tilt"),
        (share >= MAX_COPIES * (1 - 1e-12)).alias("done"),
    )
    state = stored(state, "tilts")
    for iteration in count():
        if state.where(~F.col("done")).isEmpty():
            break
        joined = classes.where("size > 0").join(state.where(~F.col("done")), "key")
        joined = joined.withColumn("x", F.col("size") / F.col("mean")).withColumn("rate", _rate(F.col("tilt")))
        taken = tokens * F.col("rate")
        slope = F.when(F.col("rate") < MAX_COPIES, taken * F.col("x")).otherwise(F.lit(0.0))
        step = joined.groupBy("key").agg(_exact_sum(taken).alias("taken"), _exact_sum(slope).alias("slope"))
        moved = state.join(step, "key", "left")
        short = F.col("taken") < F.col("target")
        low, high = F.when(short, F.col("tilt")).otherwise(F.col("low")), F.when(short, F.col("high")).otherwise(
            F.col("tilt")
        )
        newton = F.col("tilt") - F.try_divide(F.col("taken") - F.col("target"), F.col("slope"))
        # from here on the bracket is halved, which ends whatever the dual looks like
        inside = (newton > low) & (newton < high) & F.lit(iteration < NEWTON_STEPS)
        reached = F.abs(F.col("taken") - F.col("target")) <= TOLERANCE * F.col("target")
        narrow = (high - low) <= NARROW * F.greatest(F.abs(low), F.abs(high))
        stay = F.col("done") | reached | narrow
        before, state = state, stored(
            moved.select(
                "key",
                "target",
                "mean",
                F.when(stay, F.col("low")).otherwise(low).alias("low"),
                F.when(stay, F.col("high")).otherwise(high).alias("high"),
                F.when(stay, F.col("tilt")).when(inside, newton).otherwise((low + high) / 2).alias("tilt"),
                stay.alias("done"),
            ),
            "tilts",
        )
        discard(before)
    return state.select("key", "tilt", "mean")


def class_copies(classes: DataFrame, targets: DataFrame, solved: DataFrame) -> DataFrame:
    """(key, size, n, copies): how many copies the documents of a source and size get together.

    Copies follow the running sum of the expected ones over rising sizes, so each class has its rates rounded up or
    down. The tokens by which a source then misses its target are made up by single copies, of the largest sizes first.
    The array for this holds one entry for each distinct size of a source, not one for each document.
    """
    rated = classes.join(targets, "key").join(solved, "key", "left")
    x = F.col("size") / F.col("mean")
    rate = F.when(F.col("tilt").isNull(), F.lit(0.0)).otherwise(
        F.least(F.lit(float(MAX_COPIES)), F.exp(F.col("tilt") * x))
    )
    rising = Window.partitionBy("key").orderBy("size")
    until = F.sum(F.col("n") * F.col("rate")).over(rising.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summed = rated.withColumn("rate", F.when(F.col("size") == 0, F.lit(0.0)).otherwise(rate)).withColumn("until", until)
    rounded = F.round(F.col("until"), 6)  # the same place wherever the last digits of a sum fall
    reach = F.floor(rounded + 0.5)
    copies = reach - F.coalesce(F.lag(reach).over(rising), F.lit(0))
    summed = summed.withColumn("copies", F.least(F.greatest(copies, F.lit(0)), MAX_COPIES * F.col("n")))
    summed = stored(summed.select("key", "size", "n", "target", "copies"), "copies")
    missing = summed.groupBy("key").agg(
        F.sum(F.col("size") * F.col("copies")).alias("taken"),
        F.max("target").alias("target"),
        F.sort_array(
            F.collect_list(F.when(F.col("size") > 0, F.struct("size", "n", "copies"))), asc=False
        ).alias("sizes"),
    )

    def fill(done: Column, c: Column) -> Column:
        """From the largest size down, as many copies more or less as bring the tokens closest to the target."""
        fewer, more = -F.least(c["n"], c["copies"]), F.least(c["n"], MAX_COPIES * c["n"] - c["copies"])
        moved = F.least(F.greatest(F.round(done["left"] / c["size"]).cast("long"), fewer), more)
        entry = F.array(F.struct(c["size"].alias("size"), moved.alias("moved")))
        return F.struct(
            (done["left"] - moved * c["size"]).alias("left"),
            F.when(moved != 0, F.concat(done["moves"], entry)).otherwise(done["moves"]).alias("moves"),
        )

    nothing = F.struct(
        (F.col("target") - F.col("taken")).cast("double").alias("left"),
        F.array().cast("array<struct<size: bigint, moved: bigint>>").alias("moves"),
    )
    moves = (
        missing.withColumn("filled", F.aggregate("sizes", nothing, fill))
        .select("key", F.explode("filled.moves").alias("move"))
        .select("key", "move.size", "move.moved")
    )
    final = F.col("copies") + F.coalesce("moved", F.lit(0))
    return summed.join(moves, ["key", "size"], "left").select("key", "size", "n", final.alias("copies"))


def _source_key(source_col: str) -> Column:
    return F.coalesce(F.concat(F.lit("s"), column(source_col).cast("string")), F.lit("none"))


def mixed(
    docs: DataFrame,
    weights: list[float],
    budget: float,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """(id, version, key, size, source_size, target, copies) of every row of `docs`.

    Sources share `budget` times all words by `weights`, see `shares`; a null source is one like others. A document is
    taken 0 to MAX_COPIES times, each source's words come within the smallest sizes of its target, and the same input
    gives the same copies. Which documents of one size and source get the one copy more is decided by a hash of id and
    text. Texts without words and null texts have size 0 and no copies. `version` is a hash of the text, `key` stands for the source.
    """
    source = column(source_col).cast("string")
    sized = stored(
        docs.select(
            column(id_col).alias("id"),
            F.xxhash64(column(text_col)).alias("version"),
            source.alias("source"),
            _source_key(source_col).alias("key"),
            text_size(column(text_col)).alias("size"),
        ),
        "sizes",
    )
    classes = stored(sized.groupBy("key", "size").agg(F.count(F.lit(1)).alias("n")), "classes")
    totals = classes.groupBy("key").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    names = F.when(F.col("key") == "none", F.lit(None)).otherwise(F.substring("key", 2, 2**31 - 1))
    targets = stored(shares(totals.withColumn("source", names), weights, budget), "targets").drop("source")
    copies = class_copies(classes, targets.select("key", "target"), tilts(classes, targets))
    # q copies for all documents of a class and one more for the first r of them
    ruled = copies.select(
        "key",
        "size",
        F.floor(F.col("copies") / F.col("n")).alias("each"),
        (F.col("copies") % F.col("n")).alias("more"),
        F.ceil(F.col("n") / RANKED_TOGETHER).alias("buckets"),
    ).join(targets, "key")
    place = F.pmod(F.xxhash64("id", "version"), F.lit(2**31))
    # stored on both sides, the join stands alone and adaptive execution can split a class of very many documents
    placed = stored(
        sized.drop("source")
        .join(stored(ruled, "ruled"), ["key", "size"])
        .withColumn("place", place)
        .withColumn("bucket", F.floor(F.col("place") * F.col("buckets") / F.lit(2**31))),
        "placed",
    )
    # a class of many documents is ranked in buckets of places, which follow each other
    bucket_sizes = placed.where("buckets > 1").groupBy("key", "size", "bucket").agg(F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy("key", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = bucket_sizes.select("key", "size", "bucket", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("offset"))
    # dealt by the bucket too, so that not all of a class meet in one task
    placed = placed.repartition("key", "size", "bucket")
    within = Window.partitionBy("key", "size", "bucket").orderBy("place", "id", "version")
    ranked = placed.withColumn("rank", F.row_number().over(within)).join(offsets, ["key", "size", "bucket"], "left")
    one_more = (F.col("rank") + F.coalesce("offset", F.lit(0)) <= F.col("more")).cast("long")
    return ranked.select(
        "id", "version", "key", "size", "source_size", "target", (F.col("each") + one_more).alias("copies")
    )


def taken(
    docs: DataFrame, plan: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """The rows of `docs`, all columns as they are, as often as `plan`, the result of `mixed` on them, takes each.

    Rows alike in id, text and source share their copies, the first of them the most.
    """

    def key(number: Column, version: Column, source: Column) -> Column:
        return F.concat_ws(":", F.coalesce(number.cast("string"), F.lit("none")), version.cast("string"), source)

    planned = plan.groupBy(key(F.col("id"), F.col("version"), F.col("key")).alias("row_key")).agg(
        F.sort_array(F.collect_list("copies"), asc=False).alias("copies")
    )
    rows = docs.select(
        F.struct(*[column(c) for c in docs.columns]).alias("row"),
        key(column(id_col), F.xxhash64(column(text_col)), _source_key(source_col)).alias("row_key"),
    )
    again = Window.partitionBy("row_key").orderBy("row_key")
    counted = rows.join(planned, "row_key").withColumn("copies", F.element_at("copies", F.row_number().over(again)))
    return counted.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")
