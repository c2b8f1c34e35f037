"""Change times: window bounds, micros since the epoch and equal-width window chunks.

A change time may be stored as text, as a timestamp with or without zone, or as a date. Text and zone-less values are
read as UTC, whatever the session zone is.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPOCH = datetime(1970, 1, 1)
_MICRO = timedelta(microseconds=1)
_LONG_MAX = 2**63 - 1

Moment = datetime | date | str


def as_datetime(moment: Moment) -> datetime:
    """Text (`yyyy-MM-dd`, optionally with a time), date or datetime as a zone-less UTC datetime."""
    if isinstance(moment, str):
        moment = datetime.fromisoformat(moment.strip())
    elif not isinstance(moment, datetime):
        moment = datetime(moment.year, moment.month, moment.day)
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return moment


def as_text(moment: datetime) -> str:
    """The text form records use: `yyyy-MM-dd HH:mm:ss`, with a fraction only where there is one."""
    return moment.isoformat(sep=" ")


def to_micros(moment: Moment) -> int:
    return (as_datetime(moment) - _EPOCH) // _MICRO


def from_micros(micros: int) -> datetime:
    return _EPOCH + micros * _MICRO


def column_type(df: DataFrame, name: str) -> T.DataType:
    return df.select(F.col(name)).schema[0].dataType


def bound_literal(moment: Moment, data_type: T.DataType) -> Column:
    """A window bound in the stored type of the column, so that the comparison can be pushed into the scan."""
    text = as_text(as_datetime(moment))
    if isinstance(data_type, T.StringType):
        return F.lit(text)
    if isinstance(data_type, T.TimestampNTZType):
        return F.expr(f"TIMESTAMP_NTZ '{text}'")
    if isinstance(data_type, T.TimestampType):
        return F.expr(f"TIMESTAMP '{text}Z'")
    if isinstance(data_type, T.DateType):
        return F.expr(f"DATE '{text[:10]}'")
    raise TypeError(f"a change time cannot be of type {data_type.simpleString()}")


def first_moment(start: Moment, data_type: T.DataType) -> datetime:
    """The first moment from `start` on that a column of this type can hold: a day begins at midnight."""
    moment = as_datetime(start)
    midnight = moment.replace(hour=0, minute=0, second=0, microsecond=0)
    if isinstance(data_type, T.DateType) and moment > midnight:
        return midnight + timedelta(days=1)
    return moment


def epoch_micros(column: Column, data_type: T.DataType) -> Column:
    """Micros since the epoch, without a detour through the session zone."""
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(data_type, T.DateType):
        return F.unix_date(column).cast("bigint") * F.lit(86_400_000_000)
    if isinstance(data_type, T.StringType):
        column = column.try_cast("timestamp_ntz")
    elif not isinstance(data_type, T.TimestampNTZType):
        raise TypeError(f"a change time cannot be of type {data_type.simpleString()}")
    since = column - F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    return (since.cast("interval second").cast("decimal(18,6)") * 1_000_000).cast("bigint")


def chunk_of(micros: Column, low: int, high: int, chunks: int) -> Column:
    """Number (0-based) of the equal-width chunk of `[low, high]` a moment falls into; `high` is in the last one."""
    if high <= low:
        return F.when(micros.isNotNull(), 0)
    span = high - low
    steps = (micros - F.lit(low)).cast("bigint")
    if span * chunks > _LONG_MAX:
        steps = steps.cast("decimal(20,0)")
    position = F.call_function("div", steps * F.lit(chunks), F.lit(span))
    return F.when(micros.isNotNull(), F.least(position, F.lit(chunks - 1))).cast("int")


def chunk_bounds(start: Moment, end: Moment, chunks: int) -> list[tuple[datetime, datetime]]:
    """The chunks of a window as moments. Each excludes its end, but for the last one; agrees with `chunk_of`."""
    low, high = to_micros(start), to_micros(end)
    if high < low:
        raise ValueError(f"the window ends ({end}) before it starts ({start})")
    if chunks < 1:
        raise ValueError("a window is split into at least one chunk")
    if high == low:
        return [(from_micros(low), from_micros(high))]
    edges = [low + -((low - high) * i // chunks) for i in range(chunks)] + [high]
    return [(from_micros(a), from_micros(b)) for a, b in zip(edges, edges[1:])]
