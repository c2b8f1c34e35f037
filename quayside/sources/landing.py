"""Raw landing: one JSON record per line, in one directory per table and run date.

Landed files are the only copy later steps read, so a source is never asked twice and a lost executor costs a re-read
of its files, not a new extraction.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.grammar import BASE64
from quayside.functions.names import FIELD_END, quoted

# The text forms of times within nested columns.
_JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "dateFormat": "yyyy-MM-dd",
    "timeZone": "UTC",
}


def landing_dir(output_dir: str, table: str, run_date: date) -> str:
    return f"{output_dir.rstrip('/')}/json/{table}_{run_date:%Y%m%d}"


def _as_text(name: str, data_type: T.DataType) -> Column:
    """The text form of a column, which the cast grammar turns back into the same value.

    Numbers are text, so that no parser rewrites them; times are UTC and keep the fraction that they have.
    """
    column = F.col(quoted(name))
    if isinstance(data_type, T.TimestampType):
        since = column - F.expr("TIMESTAMP '1970-01-01 00:00:00Z'")
        return (F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + since).cast("string")
    if isinstance(data_type, T.BinaryType):
        return F.concat(F.lit(BASE64), F.base64(column))
    if isinstance(data_type, (T.StructType, T.ArrayType, T.MapType)):
        return column
    return column.cast("string")


def record_print(texts: Sequence[Column]) -> Column:
    """The checksum of a record's texts as a number; see `fingerprint` in `paged.py`."""
    return F.crc32(F.concat_ws(FIELD_END, *texts))


def print_sum(value: Column) -> Column:
    """The fingerprint of many records, as text: the sum of their checksums, so their order does not count.

    High and low bits are summed apart, which no number of records makes overflow.
    """
    high, low = F.sum(F.shiftright(value, 16)), F.sum(value.bitwiseAND(F.lit(65535)))
    whole = F.coalesce(high, F.lit(0)).cast("decimal(20,0)") * 65536 + F.coalesce(low, F.lit(0))
    return whole.cast("decimal(38,0)").cast("string")


def extracted_print(records: DataFrame, fields: Sequence[str], names: Sequence[str]) -> Column:
    """The print of each record as it is extracted: the texts of the contract's fields `names`, blank for null."""
    types = {f.name: f.dataType for f in records.schema}
    folded = {name.lower(): name for name in types}
    given: dict[str, list[str]] = {}
    for f in fields:
        given.setdefault(f.lower(), []).append(f)
    texts = []
    for own in names:
        spelled = sorted(given.get(own.lower(), ()), key=lambda n: (n != own, n))
        found = []
        for name in spelled:
            data_type = types[name if name in types else folded[name.lower()]]
            text = _as_text(name, data_type)
            nested = isinstance(data_type, (T.StructType, T.ArrayType, T.MapType))
            found.append(F.to_json(text, _JSON_OPTIONS) if nested else text)
        texts.append(F.coalesce(*found, F.lit("")))
    return record_print(texts)


def as_lines(records: DataFrame, fields: Sequence[str] | None = None, **beside: Column) -> DataFrame:
    """Records, or some of their fields, as JSON text in the column `value`; a null field is left out of its record.

    `beside` are further columns, made of the records, that go along for counting and are not landed.
    """
    types = {f.name: f.dataType for f in records.schema}
    folded = {name.lower(): name for name in types}
    names = list(types) if fields is None else list(fields)
    texts = [_as_text(n, types[n if n in types else folded[n.lower()]]).alias(n) for n in names]
    line = F.to_json(F.struct(*texts), _JSON_OPTIONS).alias("value")
    return records.select(line, *[column.alias(name) for name, column in beside.items()])


def land(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write lines to a landing directory, replacing what a run of the same day left there, or adding to it."""
    lines.select("value").write.mode(mode).text(path)
