"""What the operators share: intermediate tables in the shared folder, Arrow passes over documents, ASCII folding."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quayside.sources.storage import delete_directory, scratch_path


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The rows of `frame`, written once to the cluster's shared folder; what reads them starts from these files."""
    path = scratch_path(frame.sparkSession, purpose)
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Remove the files of tables that `stored` wrote, as soon as nothing reads them any more."""
    for frame in frames:
        for path in {file.rpartition("/")[0] for file in frame.inputFiles()}:
            delete_directory(frame.sparkSession, path)


_kept: dict = {}


def kept_in_worker(key: object, make: Callable[[], object]) -> object:
    """What `make` builds, kept for the next tasks of a Python worker in place of whatever was kept there before."""
    if key not in _kept:
        let_go()
        _kept[key] = make()
    return _kept[key]


def let_go() -> None:
    """Free what a Python worker kept for tasks of another operator, and hand freed memory back to the system.

    Workers outlive stages and wait for the next task, so what they hold would be missing to the executor meanwhile.
    """
    _kept.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim:
        trim(0)


BATCH_BYTES = 4 << 20


def small_parts(parts: Iterator[pa.RecordBatch], text_at: int) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in slices with some megabytes of text each, one row at the least.

    Spark cuts batches by rows. What Python makes of a slice is gone before the next, so a task holds one batch and the
    objects of a few texts, whatever their number and length.
    """
    for part in parts:
        sizes = pc.fill_null(pc.binary_length(part.column(text_at)), 0).to_numpy(zero_copy_only=False)
        until, begin = np.cumsum(sizes), 0
        while begin < len(part):
            read = until[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(until, read + BATCH_BYTES, side="right")))
            yield part.slice(begin, end - begin)
            begin = end
        if not len(part):
            yield part


def column(name: str):
    """A column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def per_document(
    docs: DataFrame,
    row: Callable[[str], tuple],
    fields: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    setup: Callable[[], Callable[[str], tuple]] | None = None,
) -> DataFrame:
    """The id of every document with the fields that `row` makes of its whole text, in one pass without a shuffle.

    A null text is read as empty. `setup` builds `row` once for each task, from what `kept_in_worker` has. Only id and text leave the scan, so extra
    columns never clash; rows that repeat are answered each time.
    """
    schema = StructType.fromDDL(fields)
    source = docs.select(column(id_col).alias(id_col), column(text_col).alias("text"))
    schema = StructType([source.schema[id_col], *schema.fields])
    names = schema.fieldNames()

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not setup:
            let_go()
        made = setup() if setup else row
        target = to_arrow_schema(schema)
        for part in small_parts(parts, 1):
            rows = [made(text or "") for text in part.column(1).to_pylist()]
            columns = list(zip(*rows, strict=True)) if rows else [()] * (len(names) - 1)
            arrays = [part.column(0).cast(target.field(0).type)]
            arrays += [pa.array(values, type=target.field(i + 1).type) for i, values in enumerate(columns)]
            yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return source.mapInArrow(batches, schema)
