"""Extraction from a table: the change-time window, its chunks, the field list and lists of keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.moments import (
    Moment,
    as_datetime,
    bound_literal,
    chunk_of,
    column_type,
    epoch_micros,
    first_moment,
    from_micros,
    to_micros,
)
from quayside.functions.names import quoted


def cleaned_filter(base_filter: str | None) -> str | None:
    """A base filter; blank and the word `null` mean that there is none."""
    if base_filter is None or base_filter.strip().lower() in ("", "null"):
        return None
    return base_filter


def window_predicate(df: DataFrame, updated_col: str, start: Moment | None, end: Moment | None) -> Column:
    """`start <= updated <= end`; a missing bound does not restrict."""
    updated, data_type = F.col(quoted(updated_col)), column_type(df, quoted(updated_col))
    predicate = F.lit(True)
    if start is not None:
        predicate = predicate & (updated >= bound_literal(first_moment(start, data_type), data_type))
    if end is not None:
        predicate = predicate & (updated <= bound_literal(end, data_type))
    return predicate


def extract_window(
    df: DataFrame,
    updated_col: str,
    start: Moment | None = None,
    end: Moment | None = None,
    base_filter: str | None = None,
    fields: Sequence[str] = (),
) -> DataFrame:
    """The records of a window that satisfy the base filter, reduced to the requested fields (none named: all).

    Filter and projection are plain predicates and column names, so both end up in the scan.
    """
    base_filter = cleaned_filter(base_filter)
    rows = df.where(window_predicate(df, updated_col, start, end))
    if base_filter:
        rows = rows.where(F.expr(base_filter))
    return rows.select(*[F.col(quoted(f)) for f in fields]) if fields else rows


def probe(df: DataFrame, updated_col: str) -> tuple[tuple[Moment, Moment] | None, int]:
    """First and last change time of a table, None when it has none, and the number of records, in one scan."""
    updated, data_type = F.col(quoted(updated_col)), column_type(df, quoted(updated_col))
    if isinstance(data_type, T.StringType):
        # Text that is no moment must not become a bound.
        updated, data_type = updated.try_cast("timestamp_ntz"), T.TimestampNTZType()
    found = df.agg(F.min(updated).alias("low"), F.max(updated).alias("high"), F.count(F.lit(1)).alias("n"))
    low, high, count = found.select(*[epoch_micros(F.col(end), data_type) for end in ("low", "high")], "n").first()
    return (None if low is None else (from_micros(low), from_micros(high))), count


def observed_window(df: DataFrame, updated_col: str) -> tuple[Moment, Moment] | None:
    """First and last change time of a table, or None when it is empty."""
    return probe(df, updated_col)[0]


def chunk_number(df: DataFrame, updated_col: str, start: Moment, end: Moment, chunks: int) -> Column:
    """The number of the equal-width window chunk a record's change time falls into."""
    micros = epoch_micros(F.col(quoted(updated_col)), column_type(df, quoted(updated_col)))
    return chunk_of(micros, to_micros(start), to_micros(end), chunks)


def with_chunk(
    df: DataFrame, updated_col: str, start: Moment, end: Moment, chunks: int, chunk_col: str = "chunk"
) -> DataFrame:
    """Tag every record with the number of the equal-width window chunk its change time falls into."""
    return df.withColumn(chunk_col, chunk_number(df, updated_col, start, end, chunks))


def chunk_report(chunked: DataFrame, updated_col: str, chunk_col: str = "chunk") -> DataFrame:
    """Records per chunk, with its first and last change time."""
    updated = F.col(quoted(updated_col))
    return chunked.groupBy(chunk_col).agg(
        F.count(F.lit(1)).alias("n"), F.min(updated).alias("first_updated"), F.max(updated).alias("last_updated")
    )


def chunk_plan(
    df: DataFrame, updated_col: str, chunks: int, start: Moment | None = None, end: Moment | None = None
) -> DataFrame:
    """Split a window (given, or the observed one) into chunks and report what each of them holds."""
    if start is None or end is None:
        seen = observed_window(df, updated_col) or (as_datetime("1970-01-01"),) * 2
        start, end = start or seen[0], end or seen[1]
    return chunk_report(with_chunk(df, updated_col, start, end, chunks), updated_col)


def expected_count(df: DataFrame) -> int:
    """How many records an extraction should deliver."""
    return df.count()


def extract_ids(df: DataFrame, ids: DataFrame, key_col: str, id_col: str = "id") -> DataFrame:
    """The records whose key is in the list.

    Spark broadcasts the list where its size is within `spark.sql.autoBroadcastJoinThreshold`, and the large side is
    then not shuffled. A longer list joins by sort-merge, where adaptive execution splits a partition that a frequent
    key has made large.
    """
    key_type = column_type(df, quoted(key_col))
    keys = ids.select(F.col(quoted(id_col)).try_cast(key_type).alias("_wanted")).where("_wanted IS NOT NULL")
    return df.join(keys, df[quoted(key_col)] == keys["_wanted"], "left_semi")
