"""Quoting of names and text that go into generated SQL expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T


# Fixed value: what stands between the texts of a record when its checksum is taken.
FIELD_END = "\x1f"


def unused(name: str, taken: Iterable[str]) -> str:
    """The name, with underscores in front until no taken name equals it in any case."""
    folded = {t.lower() for t in taken}
    while name.lower() in folded:
        name = "_" + name
    return name


def name_list(spec: str | Iterable[str]) -> list[str]:
    """Names from a list or from comma-separated text; blanks are dropped."""
    names = spec.split(",") if isinstance(spec, str) else spec
    return [n.strip() for n in names if n.strip()]


def quoted(name: str) -> str:
    """A column or field name as one back-ticked SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def text_literal(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ddl(data_type: T.DataType) -> str:
    """The SQL spelling of a type, with every nested field name quoted."""
    if isinstance(data_type, T.StructType):
        inner = ", ".join(f"{quoted(f.name)}: {ddl(f.dataType)}" for f in data_type.fields)
        return f"struct<{inner}>"
    if isinstance(data_type, T.ArrayType):
        return f"array<{ddl(data_type.elementType)}>"
    if isinstance(data_type, T.MapType):
        return f"map<{ddl(data_type.keyType)}, {ddl(data_type.valueType)}>"
    return data_type.simpleString()
