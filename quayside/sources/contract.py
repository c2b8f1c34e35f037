"""Contracts: the ordered fields a table must have, read from an Avro record schema."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    """One contract field. `kind` names its rule in the cast grammar, `size` is the length of a fixed field, `symbols`
    are the values of an enum, the one first that stands for a blank."""

    name: str
    kind: str
    type: T.DataType
    nullable: bool = False
    size: int | None = None
    symbols: tuple[str, ...] = ()


@dataclass(frozen=True)
class Contract:
    """The fields of a table, and the Avro schema they come from, where there is one, as JSON text."""

    name: str
    namespace: str | None
    fields: tuple[Field, ...]
    avro: str | None = None

    def __post_init__(self):
        seen: set[str] = set()
        for field in self.fields:
            if field.name.lower() in seen:
                raise ValueError(f"contract {self.name} has the field {field.name} twice")
            seen.add(field.name.lower())
        if not self.fields:
            raise ValueError(f"contract {self.name} has no fields")

    def with_symbols(self) -> Contract:
        """The contract with enums that take their own symbols alone, as Avro files do; as text they take any."""
        strict = (replace(f, kind="symbol") if f.kind == "enum" and f.symbols else f for f in self.fields)
        return replace(self, fields=tuple(strict))

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.type, f.nullable) for f in self.fields])

    @property
    def text_schema(self) -> T.StructType:
        """The all-text twin: the shape of quarantined rows."""
        return T.StructType([T.StructField(f.name, T.StringType(), True) for f in self.fields])


# Avro type names and logical types with their contract kinds and Spark types.
_PRIMITIVES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "bytes": T.BinaryType(),
}
_LOGICAL = {
    ("int", "date"): ("date", T.DateType()),
    ("long", "timestamp-millis"): ("timestamp", T.TimestampType()),
    ("long", "timestamp-micros"): ("timestamp", T.TimestampType()),
    ("long", "local-timestamp-millis"): ("timestamp_ntz", T.TimestampNTZType()),
    ("long", "local-timestamp-micros"): ("timestamp_ntz", T.TimestampNTZType()),
}
_WIDENING = {frozenset({"int", "long"}): "long", frozenset({"float", "double"}): "double"}


@dataclass(frozen=True)
class _Resolved:
    kind: str
    type: T.DataType
    nullable: bool = False
    size: int | None = None
    symbols: tuple[str, ...] = ()


def _union(branches: list, named: dict) -> _Resolved:
    present = [b for b in branches if b != "null"]
    if len(present) == 1:
        inner = _resolve(present[0], named)
    elif all(isinstance(b, str) for b in present) and frozenset(present) in _WIDENING:
        inner = _resolve(_WIDENING[frozenset(present)], named)
    else:
        raise ValueError(f"a union of {present} has no single type")
    return _Resolved(inner.kind, inner.type, inner.nullable or "null" in branches, inner.size, inner.symbols)


def _record(schema: dict, named: dict) -> T.StructType:
    fields = []
    for f in schema["fields"]:
        inner = _resolve(f["type"], named)
        fields.append(T.StructField(f["name"], inner.type, inner.nullable))
    return T.StructType(fields)


def _resolve(schema, named: dict) -> _Resolved:
    if isinstance(schema, list):
        return _union(schema, named)
    if isinstance(schema, str):
        if schema in _PRIMITIVES:
            return _Resolved(schema, _PRIMITIVES[schema])
        if schema in named:
            return named[schema]
        raise ValueError(f"unknown contract type {schema!r}")

    base, logical = schema["type"], schema.get("logicalType")
    if logical == "decimal" and base in ("bytes", "fixed"):
        resolved = _Resolved("decimal", T.DecimalType(schema["precision"], schema.get("scale", 0)))
    elif isinstance(base, str) and (base, logical) in _LOGICAL:
        resolved = _Resolved(*_LOGICAL[base, logical])
    elif base == "record":
        resolved = _Resolved("record", _record(schema, named))
    elif base == "enum":
        # a schema may name the symbol that stands for all others
        first = [s for s in schema["symbols"] if s == schema.get("default")]
        resolved = _Resolved("enum", T.StringType(), symbols=tuple(first or schema["symbols"][:1]) + tuple(schema["symbols"]))
    elif base == "fixed":
        resolved = _Resolved("fixed", T.BinaryType(), size=int(schema["size"]))
    elif base == "array":
        items = _resolve(schema["items"], named)
        resolved = _Resolved("array", T.ArrayType(items.type, items.nullable))
    elif base == "map":
        values = _resolve(schema["values"], named)
        resolved = _Resolved("map", T.MapType(T.StringType(), values.type, values.nullable))
    else:
        resolved = _resolve(base, named)
    if base in ("record", "enum", "fixed") and "name" in schema:
        named[schema["name"]] = resolved
        if schema.get("namespace"):
            named[f"{schema['namespace']}.{schema['name']}"] = resolved
    return resolved


def _writable(schema):
    """The schema with unions that Spark reads as one wider type written as that type; all else stays."""
    if isinstance(schema, list):
        present = [b for b in schema if b != "null"]
        if len(present) > 1 and all(isinstance(b, str) for b in present) and frozenset(present) in _WIDENING:
            wide = _WIDENING[frozenset(present)]
            return [b for b in ("null", wide) if b == wide or b in schema] if "null" in schema else wide
        return [_writable(b) for b in schema]
    if not isinstance(schema, dict):
        return schema
    made = {k: _writable(v) if k in ("type", "items", "values") else v for k, v in schema.items()}
    if "fields" in made:
        made["fields"] = [{**f, "type": _writable(f["type"])} for f in made["fields"]]
    return made


def _inlined(schema, gone: dict):
    """The schema with the first use of every type that `gone` has by its name replaced by the definition."""
    if isinstance(schema, str):
        return gone.pop(schema, schema)
    if isinstance(schema, list):
        return [_inlined(b, gone) for b in schema]
    made = {k: _inlined(v, gone) if k in ("type", "items", "values") and v != schema.get("name") else v for k, v in schema.items()}
    if "fields" in made:
        made["fields"] = [{**f, "type": _inlined(f["type"], gone)} for f in made["fields"]]
    return made


def _definitions(schema, found: dict) -> dict:
    """Every named type that is defined within a schema."""
    if isinstance(schema, list):
        for branch in schema:
            _definitions(branch, found)
    elif isinstance(schema, dict):
        if schema.get("type") in ("record", "enum", "fixed"):
            found[schema["name"]] = schema
        for inner in [*(schema.get(k) for k in ("type", "items", "values")), *(f["type"] for f in schema.get("fields", ()))]:
            _definitions(inner, found)
    return found


def writer_schema(contract: Contract, left_out: Iterable[str] = ()) -> str | None:
    """The Avro schema to write files of this contract with: its own, without the fields that go into directory names.

    A type that a left-out field defines and another one uses is defined where it is used first.
    """
    if contract.avro is None:
        return None
    schema = json.loads(contract.avro)
    apart = {n.lower() for n in left_out}
    gone: dict = {}
    for field in schema["fields"]:
        if field["name"].lower() in apart:
            _definitions(field["type"], gone)
    kept = [f for f in schema["fields"] if f["name"].lower() not in apart]
    schema["fields"] = [{**f, "type": _inlined(f["type"], gone)} for f in kept]
    return json.dumps(schema)


def parse_contract(text: str) -> Contract:
    """A contract from the JSON text of an Avro record schema. Field defaults, docs and aliases do not count."""
    schema = json.loads(text)
    if not isinstance(schema, dict) or schema.get("type") != "record":
        raise ValueError("a contract is an Avro record schema")
    named: dict = {}
    fields = []
    for f in schema["fields"]:
        r = _resolve(f["type"], named)
        fields.append(Field(f["name"], r.kind, r.type, r.nullable, r.size, r.symbols))
    return Contract(schema["name"], schema.get("namespace"), tuple(fields), json.dumps(_writable(schema)))


def read_contract(spark: SparkSession, contract_dir: str, table: str) -> Contract:
    """The contract of a table, kept as `<contract_dir>/<table>.avsc`."""
    path = f"{contract_dir.rstrip('/')}/{table}.avsc"
    return parse_contract(spark.read.text(path, wholetext=True).first()[0])
