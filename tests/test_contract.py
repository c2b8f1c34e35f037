from __future__ import annotations

import json

import pytest
from pyspark.sql import types as T

from quayside import parse_contract, read_contract


def record(*fields) -> str:
    return json.dumps({"type": "record", "name": "r", "namespace": "n", "fields": list(fields)})


def only(field_type):
    return parse_contract(record({"name": "f", "type": field_type})).fields[0]


@pytest.mark.parametrize(
    "avro, kind, spark_type, nullable",
    [
        ("string", "string", T.StringType(), False),
        ("int", "int", T.IntegerType(), False),
        ("long", "long", T.LongType(), False),
        ("float", "float", T.FloatType(), False),
        ("double", "double", T.DoubleType(), False),
        ("boolean", "boolean", T.BooleanType(), False),
        ("bytes", "bytes", T.BinaryType(), False),
        (["null", "long"], "long", T.LongType(), True),
        (["long", "null"], "long", T.LongType(), True),
        (["int"], "int", T.IntegerType(), False),
        (["null", "int", "long"], "long", T.LongType(), True),
        (["float", "double"], "double", T.DoubleType(), False),
        ({"type": "int", "logicalType": "date"}, "date", T.DateType(), False),
        ({"type": "long", "logicalType": "timestamp-millis"}, "timestamp", T.TimestampType(), False),
        (["null", {"type": "long", "logicalType": "timestamp-micros"}], "timestamp", T.TimestampType(), True),
        ({"type": "long", "logicalType": "local-timestamp-millis"}, "timestamp_ntz", T.TimestampNTZType(), False),
        ({"type": "long", "logicalType": "time-micros"}, "long", T.LongType(), False),
        (
            {"type": "bytes", "logicalType": "decimal", "precision": 10, "scale": 2},
            "decimal",
            T.DecimalType(10, 2),
            False,
        ),
        ({"type": "enum", "name": "e", "symbols": ["A"]}, "enum", T.StringType(), False),
        ({"type": "fixed", "name": "x", "size": 4}, "fixed", T.BinaryType(), False),
        ({"type": "array", "items": "int"}, "array", T.ArrayType(T.IntegerType(), False), False),
        (
            {"type": "map", "values": ["null", "string"]},
            "map",
            T.MapType(T.StringType(), T.StringType(), True),
            False,
        ),
        ({"type": {"type": "string"}}, "string", T.StringType(), False),
    ],
)
def test_types(avro, kind, spark_type, nullable):
    field = only(avro)
    assert (field.kind, field.type, field.nullable) == (kind, spark_type, nullable)


def test_records_and_named_types():
    inner = {"type": "record", "name": "p", "fields": [{"name": "x", "type": ["null", "int"]}]}
    contract = parse_contract(record({"name": "a", "type": inner}, {"name": "b", "type": ["null", "p"]}))
    point = T.StructType([T.StructField("x", T.IntegerType(), True)])
    assert [f.type for f in contract.fields] == [point, point]
    assert [f.nullable for f in contract.fields] == [False, True]


def test_order_name_and_twin():
    contract = parse_contract(record({"name": "b", "type": "int", "default": 7}, {"name": "a", "type": "string"}))
    assert contract.names == ["b", "a"]
    assert (contract.name, contract.namespace) == ("r", "n")
    assert contract.text_schema == T.StructType([T.StructField(n, T.StringType()) for n in ("b", "a")])
    assert contract.schema["b"].nullable is False


@pytest.mark.parametrize(
    "text",
    [
        '"string"',
        record(),
        record({"name": "f", "type": "unheard"}),
        record({"name": "f", "type": ["int", "string"]}),
        record({"name": "f", "type": "int"}, {"name": "F", "type": "int"}),
    ],
)
def test_refused(text):
    with pytest.raises(ValueError):
        parse_contract(text)


def test_read_contract(spark, tmp_path):
    (tmp_path / "thing.avsc").write_text(record({"name": "f", "type": "int"}))
    assert read_contract(spark, str(tmp_path), "thing").names == ["f"]
