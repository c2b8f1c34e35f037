"""Reading by position: dense offsets and pages, and batches of keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.names import quoted, unused
from quayside.functions.ranges import check_page_size, range_size
from quayside.sources.storage import scratch_path

# monotonically_increasing_id(): the partition number is above bit 33, the row's place in the partition below.
_PARTITION_BITS = 33

PAGE_COLUMNS = ("off", "rng", "page")

def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b).cast("bigint"))


def _check_new(df: DataFrame, names: tuple[str, ...]) -> None:
    taken = {c.lower() for c in df.columns} & {n.lower() for n in names}
    if taken:
        raise ValueError(f"the records already have columns named {', '.join(sorted(taken))}")


def with_position(df: DataFrame, key_col: str, position_col: str = "off") -> tuple[DataFrame, int]:
    """Number all records 0, 1, 2, … in key order, and return them with their count.

    The range partitioner sorts in parallel; a record's place is its place in its partition plus the sizes of the
    partitions before. Range boundaries are chosen anew whenever a plan runs, so the sorted records are written to the
    shared folder and both steps read that copy. The tie breaker lets records of one frequent key spread over several
    partitions.
    """
    _check_new(df, (position_col,))
    spark = df.sparkSession
    path = scratch_path(spark, "positions")
    tie, slot = unused("_tie", df.columns), unused("_slot", df.columns)
    ordered = (
        df.withColumn(tie, F.monotonically_increasing_id())
        .repartitionByRange(quoted(key_col), tie)
        .sortWithinPartitions(quoted(key_col), tie)
        .drop(tie)
        .withColumn(slot, F.monotonically_increasing_id())
    )
    ordered.write.mode("overwrite").parquet(path)
    stored = spark.read.schema(ordered.schema).parquet(path)
    part, n, before = (unused(name, df.columns) for name in ("_part", "_n", "_before"))
    parted = stored.withColumn(part, F.shiftright(slot, _PARTITION_BITS))
    # one row for each partition
    sizes = parted.groupBy(part).agg(F.count(F.lit(1)).alias(n))
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(part, F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(before))
    place = F.col(slot).bitwiseAND(F.lit((1 << _PARTITION_BITS) - 1))
    placed = parted.join(offsets, part)
    return placed.select(
        *[F.col(quoted(c)) for c in df.columns], (F.col(before) + place).alias(position_col)
    ), stored.count()


def offset_pages(
    df: DataFrame,
    key_col: str,
    ranges: int,
    page_size: int,
    names: tuple[str, str, str] = PAGE_COLUMNS,
) -> DataFrame:
    """Records with their offset (`off`), offset range (`rng`) and page within the range (`page`)."""
    check_page_size(page_size)
    _check_new(df, names)
    off, rng, page = names
    positioned, total = with_position(df, key_col, off)
    size = range_size(total, ranges)
    in_range = F.col(off) - F.col(rng).cast("bigint") * F.lit(size).cast("bigint")
    return positioned.withColumn(rng, _div(F.col(off), size).cast("int")).withColumn(
        page, _div(in_range, page_size).cast("int")
    )


def id_batches(ids: DataFrame, id_col: str, ids_per_batch: int, tasks: int) -> DataFrame:
    """Keys (`id`, text) with the request `batch` they belong to, as `fetch_ids` asks for them.

    Keys are spread over `tasks` partitions by hash, and those of a partition are cut into batches in the order they
    come: no sort, and no key is in two batches. The number holds the partition above bit 33, as Spark's own do.
    """
    if ids_per_batch < 1:
        raise ValueError("a batch holds at least one key")
    spread = ids.select(F.col(quoted(id_col)).cast("string").alias("id")).repartition(tasks, "id")
    numbered = spread.withColumn("place", F.monotonically_increasing_id())
    part = F.shiftright("place", _PARTITION_BITS)
    within = _div(F.col("place").bitwiseAND(F.lit((1 << _PARTITION_BITS) - 1)), ids_per_batch)
    return numbered.select("id", (F.shiftleft(part, _PARTITION_BITS) + within).alias("batch"))
