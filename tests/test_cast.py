from __future__ import annotations

import json
import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quayside.operators import align, cast
from quayside.sources.contract import Contract, Field, parse_contract

REJECTED = object()


def contract_of(**types) -> Contract:
    fields = [{"name": n, "type": t} for n, t in types.items()]
    return parse_contract(json.dumps({"type": "record", "name": "r", "fields": fields}))


def aligned(spark, contract, rows):
    schema = ", ".join(f"`{n}` string" for n in [*contract.names, "_bad_line"])
    return spark.createDataFrame([(*r, None) for r in rows], schema)


def cast_one(spark, avro, text):
    contract = contract_of(f=avro)
    rows = cast.cast_rows(aligned(spark, contract, [(text,)]), contract)
    row = cast.error_lists(rows).first()
    return row["typed"]["f"], [e["type"] for e in row["errors"]]


DATE = {"type": "int", "logicalType": "date"}
MOMENT = {"type": "long", "logicalType": "timestamp-millis"}
LOCAL = {"type": "long", "logicalType": "local-timestamp-millis"}
MONEY = {"type": "bytes", "logicalType": "decimal", "precision": 6, "scale": 2}
EPOCH = datetime(1970, 1, 1)


@pytest.mark.parametrize(
    "avro, default, cases",
    [
        (
            "int",
            0,
            {
                "7": 7, "+7": 7, "-7": -7, "007": 7, "2147483647": 2147483647, "2147483648": REJECTED, " 12": REJECTED,
                "12 ": REJECTED, "12\n": REJECTED, "12.5": REJECTED, "1e3": REJECTED, "x": REJECTED, "+": REJECTED,
                "١٢": REJECTED,
            },
        ),
        ("long", 0, {"2147483648": 2147483648, "9223372036854775808": REJECTED, "1.0": REJECTED}),
        (
            "double",
            0.0,
            {
                "1e3": 1000.0, "2.5": 2.5, "-0.5E-1": -0.05, "nan": REJECTED, "1d": REJECTED, ".5": REJECTED,
                "5.": REJECTED, "Infinity": float("inf"), "-Infinity": float("-inf"), "+Infinity": REJECTED, "0x1p3": REJECTED, " 1": REJECTED,
            },
        ),
        ("float", 0.0, {"0.5": 0.5, "1f": REJECTED}),
        ("boolean", False, {"TRUE": True, "false": False, "yes": REJECTED, "1": REJECTED, "t": REJECTED, " true": REJECTED}),
        (
            DATE,
            date(1970, 1, 1),
            {
                "2024-02-29": date(2024, 2, 29), "2024-02-30": REJECTED, "2024-2-3": REJECTED,
                "2024-02-03 00:00:00": REJECTED, "2024-02": REJECTED,
            },
        ),
        (
            LOCAL,
            EPOCH,
            {
                "2024-01-02 03:04:05": datetime(2024, 1, 2, 3, 4, 5), "2024-01-02": REJECTED,
                "2024-02-30 00:00:00": REJECTED, "2024-01-02 03:04:05.1234567": REJECTED, "2024-1-2 3:4:5": REJECTED, "2024-01-02T03:04:05": REJECTED,
                "2024-01-02 24:00:00": REJECTED,
            },
        ),
        (MONEY, Decimal("0.00"), {"12.34": Decimal("12.34"), "1e1": REJECTED, "12345.0": REJECTED, "9999.99": Decimal("9999.99")}),
        ("string", "", {"anything ": "anything "}),
        ({"type": "enum", "name": "e", "symbols": ["A"]}, "", {"B": "B"}),
        ("bytes", b"", {"é": "é".encode(), "data:;base64,AQL/": b"\x01\x02\xff", "data:;base64,*": REJECTED}),
        ({"type": "fixed", "name": "x", "size": 2}, b"\0\0", {"ab": b"ab", "abc": REJECTED}),
        ({"type": "array", "items": "int"}, [], {"[1,2]": [1, 2], "{}": REJECTED, "x": REJECTED}),
        ({"type": "map", "values": "string"}, {}, {'{"a":"b"}': {"a": "b"}, "[1]": REJECTED}),
    ],
)
def test_grammar(spark, avro, default, cases):
    contract = contract_of(f=avro, g=["null", avro] if not isinstance(avro, dict) or "name" not in avro else "string")
    rows = [(t, t) for t in cases] + [("", "")]
    result = cast.error_lists(cast.cast_rows(aligned(spark, contract, rows), contract, cast.FIELD)).collect()
    plain = lambda v: bytes(v) if isinstance(v, bytearray) else v
    for row, (text, expected) in zip(result, [*cases.items(), ("", default)]):
        rejected = {e["field"] for e in row["errors"]}
        assert plain(row["typed"]["f"]) == (default if expected is REJECTED else expected), text
        assert ("f" in rejected) == (expected is REJECTED), text
        if contract.fields[1].nullable:
            wanted = None if expected is REJECTED or text == "" else expected
            assert plain(row["typed"]["g"]) == wanted, text


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_timestamps_are_utc_whatever_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        contract = contract_of(f=MOMENT)
        rows = [("2024-03-10 02:30:00",), ("",), ("2024-02-30 00:00:00",), ("2024-01-02",)]
        frame = cast.typed_rows(cast.cast_rows(aligned(spark, contract, rows), contract))
        assert [r[0] for r in frame.select(F.unix_seconds("f")).collect()] == [1710037800, 0, 0, 0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


MIXED = dict(k="string", a="int", b="int", c="boolean", d="string", e=["null", "string"], f=["null", "int"])


def test_sticky_and_field_modes(spark):
    contract = contract_of(**MIXED)
    rows = [
        ("1", "5", "x", "true", "d", "e", "9"),
        ("2", "x", "6", "maybe", "d", "e", "9"),
        ("3", "5", "6", "true", "d", "", ""),
    ]
    frame = aligned(spark, contract, rows)
    sticky = cast.cast_rows(frame, contract, cast.ROW_STICKY)
    field = cast.cast_rows(frame, contract, cast.FIELD)
    assert [tuple(r) for r in cast.typed_rows(sticky).collect()] == [
        ("1", 5, 0, False, "", None, None),
        ("2", 0, 0, False, "", None, None),
        ("3", 5, 6, True, "d", None, None),
    ]
    assert [tuple(r) for r in cast.typed_rows(field).collect()] == [
        ("1", 5, 0, True, "d", "e", 9),
        ("2", 0, 6, False, "d", "e", 9),
        ("3", 5, 6, True, "d", None, None),
    ]
    for mode in (sticky, field):
        errors = [[(e["field"], e["type"], e["raw"]) for e in r["errors"]] for r in cast.error_lists(mode).collect()]
        assert errors == [[("b", "int", "x")], [("a", "int", "x"), ("c", "boolean", "maybe")], []]
        assert [r["k"] for r in cast.quarantine_rows(mode).collect()] == ["1", "2"]
        summary = {(r["field"], r["type"]): r["n"] for r in cast.error_summary(mode).collect()}
        assert summary == {("a", "int"): 1, ("b", "int"): 1, ("c", "boolean"): 1}


def test_sticky_equals_a_loop_over_the_fields(spark):
    """The first-rejected position gives what going through the fields one by one gives."""
    names = [f"f{i}" for i in range(7)]
    contract = contract_of(**{n: "string" if i in (0, 4) else "int" for i, n in enumerate(names)})
    rows = [tuple("x" if (mask >> i) & 1 else str(i) for i in range(7)) for mask in range(128)]
    result = [tuple(r) for r in cast.typed_rows(cast.cast_rows(aligned(spark, contract, rows), contract)).collect()]
    expected = []
    for row in rows:
        caught, out = False, []
        for i, text in enumerate(row):
            is_text = i in (0, 4)
            caught = caught or (not is_text and text == "x")
            out.append(("" if is_text else 0) if caught else (text if is_text else int(text)))
        expected.append(tuple(out))
    assert result == expected


def test_invariants_of_the_modes(spark):
    """On random rows: a field defaults alone iff blank or rejected, and rows without errors are equal in both modes."""
    rng = random.Random(7)
    contract = contract_of(k="string", a="int", b="double", c="boolean", d="string", e="long")
    texts = ["", "1", "x", "2.5", "true", "99999999999", "-7", "1e2"]
    rows = [(str(i), *[rng.choice(texts) for _ in range(5)]) for i in range(500)]
    frame = aligned(spark, contract, rows)
    field = cast.error_lists(cast.cast_rows(frame, contract, cast.FIELD)).collect()
    sticky = cast.error_lists(cast.cast_rows(frame, contract, cast.ROW_STICKY)).collect()
    defaults = {"k": "", "a": 0, "b": 0.0, "c": False, "d": "", "e": 0}
    order = contract.names
    for one, other, row in zip(field, sticky, rows):
        assert one["raw"] == other["raw"] and tuple(one["raw"]) == row
        assert one["errors"] == other["errors"]
        rejected = {e["field"]: e["raw"] for e in one["errors"]}
        assert all(one["raw"][f] == raw != "" for f, raw in rejected.items())
        first = min((order.index(f) for f in rejected), default=len(order))
        for i, name in enumerate(order):
            if one["raw"][name] == "" or name in rejected:
                assert one["typed"][name] == defaults[name]
            assert other["typed"][name] == (defaults[name] if i >= first else one["typed"][name])


def test_records_keep_their_structure(spark):
    inner = {"type": "record", "name": "p", "fields": [{"name": "x y", "type": ["null", "int"]}, {"name": "z", "type": "string"}]}
    contract = contract_of(f=inner, g=["null", "p"])
    rows = [('{"x y":1,"z":"q"}', "[1]"), ("", "")]
    result = cast.error_lists(cast.cast_rows(aligned(spark, contract, rows), contract, cast.FIELD)).collect()
    assert [tuple(r["typed"]["f"]) for r in result] == [(1, "q"), (None, None)]
    assert [r["typed"]["g"] for r in result] == [None, None]
    assert [[(e["field"], e["type"]) for e in r["errors"]] for r in result] == [[("g", "record")], []]


def test_required_fields_are_never_null(spark):
    contract = contract_of(**MIXED)
    schema = cast.typed_rows(cast.cast_rows(aligned(spark, contract, [("",) * 7]), contract)).schema
    assert [f.nullable for f in schema] == [f.nullable for f in contract.fields]


def test_odd_names(spark):
    names = ["order", "a`b", "first_bad", "r0", "t1", "c1", "bad_line", "a.b", "it's", "failed", "e1"]
    contract = Contract("r", None, tuple(Field(n, "int", contract_of(f="int").fields[0].type) for n in names))
    lines = spark.createDataFrame([(json.dumps({n: i for i, n in enumerate(names)}),)], "value string")
    spellings = align.discover_spellings(lines, contract)
    rows = cast.cast_rows(align.align_lines(lines, contract, spellings), contract)
    assert cast.typed_rows(rows).first().asDict() == {n: i for i, n in enumerate(names)}
    assert cast.error_lists(rows).first()["raw"]["a`b"] == "1"


def test_wide_contract(spark):
    """400 fields plan and run; the position of the first rejected field is found among all of them."""
    contract = contract_of(**{f"f{i}": "int" for i in range(400)})
    rows = [tuple("x" if i == bad else "1" for i in range(400)) for bad in (0, 399, 400)]
    frame = cast.typed_rows(cast.cast_rows(aligned(spark, contract, rows), contract))
    assert [sum(r) for r in frame.collect()] == [0, 399, 400]


def test_text_only_contract(spark):
    contract = contract_of(a="string", b=["null", "string"])
    rows = cast.cast_rows(aligned(spark, contract, [("", ""), ("x", "y")]), contract)
    assert [tuple(r) for r in cast.typed_rows(rows).collect()] == [("", None), ("x", "y")]
    assert cast.quarantine_rows(rows).count() == 0
    assert cast.error_summary(rows).count() == 0


def test_quarantine_holds_the_rows_without_a_null(spark):
    """Selecting by error gives what dropping rows with nulls gives when the text of good rows is nulled."""
    contract = contract_of(k="string", a="int", b=["null", "double"])
    rows = [(str(i), "x" if i % 3 else "1", "" if i % 2 else "y") for i in range(12)]
    result = cast.cast_rows(aligned(spark, contract, rows), contract)
    nulled = result.frame.select(*[F.when(F.col("failed"), c).alias(n) for c, n in zip(result.text_columns(), contract.names)])
    assert sorted(nulled.na.drop().collect()) == sorted(cast.quarantine_rows(result).collect())


def test_no_python_in_the_plan(spark):
    contract = contract_of(**MIXED)
    rows = cast.cast_rows(aligned(spark, contract, [("",) * 7]), contract)
    plan = rows.frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_unknown_mode(spark):
    contract = contract_of(a="string")
    with pytest.raises(ValueError):
        cast.cast_rows(aligned(spark, contract, []), contract, "lenient")


EDGES = {
    "float": {
        "3.4028235e38": 3.4028234663852886e38, "3.5e38": REJECTED, "-1E+39": REJECTED, "1e-45": 1.401298464324817e-45,
        "1e-50": REJECTED, "-0e99": 0.0, "9" * 60: REJECTED, "0." + "0" * 60 + "1": REJECTED, "0" * 60 + "5": 5.0,
        "-Infinity": float("-inf"),
    },
    "double": {
        "1.7976931348623157e308": 1.7976931348623157e308, "1e400": REJECTED, "-1e400": REJECTED, "4.9e-324": 5e-324,
        "1e-400": REJECTED, "0e999": 0.0, "9" * 400: REJECTED, "0.5" + "0" * 400: 0.5, "Infinity": float("inf"),
    },
    "decimal": {
        "1.239": REJECTED, "1.23": Decimal("1.23"), "1.2300": Decimal("1.23"), "-1.2": Decimal("-1.20"), "1.": REJECTED,
        "9999.99": Decimal("9999.99"), "10000.00": REJECTED, "0.001": REJECTED, "7": Decimal("7.00"),
    },
}


@pytest.mark.parametrize("avro", EDGES)
def test_no_number_changes_in_silence(spark, avro):
    schema = MONEY if avro == "decimal" else avro
    zero = Decimal("0.00") if avro == "decimal" else 0.0
    contract = contract_of(f=schema)
    rows = cast.error_lists(cast.cast_rows(aligned(spark, contract, [(t,) for t in EDGES[avro]]), contract))
    found = {r["raw"]["f"]: (r["typed"]["f"], len(r["errors"])) for r in rows.collect()}
    for text, value in EDGES[avro].items():
        assert found[text] == ((zero, 1) if value is REJECTED else (value, 0)), text


def test_reasons(spark):
    contract = contract_of(a="int", b=MONEY, c="double", d=DATE, e="boolean")
    given = [
        ("x", "1.239", "1e400", "2024-02-30", "maybe"),
        ("2147483648", "10000.00", "x", "2024", ""),
        ("1", "a", "", "", "true"),
    ]
    rows = cast.error_lists(cast.cast_rows(aligned(spark, contract, given), contract, cast.FIELD)).select("raw.a", "errors")
    found = {r["a"]: [(e["field"], e["reason"]) for e in r["errors"]] for r in rows.collect()}
    assert found == {
        "x": [("a", "form"), ("b", "scale"), ("c", "range"), ("d", "range"), ("e", "form")],
        "2147483648": [("a", "range"), ("b", "range"), ("c", "form"), ("d", "form")],
        "1": [("b", "form")],
    }


def test_excess_digits_are_rounded_on_request(spark):
    contract = contract_of(f=MONEY)
    given = [("1.239",), ("-1.235",), ("9999.999",), ("1.23",)]
    rows = cast.cast_rows(aligned(spark, contract, given), contract, excess_digits="round")
    found = {r["raw"]["f"]: (r["typed"]["f"], [e["reason"] for e in r["errors"]]) for r in cast.error_lists(rows).collect()}
    assert found == {
        "1.239": (Decimal("1.24"), []), "-1.235": (Decimal("-1.24"), []), "9999.999": (Decimal("0.00"), ["range"]),
        "1.23": (Decimal("1.23"), []),
    }
    with pytest.raises(ValueError, match="excess_digits"):
        cast.cast_rows(aligned(spark, contract, given), contract, excess_digits="ignore")


def test_symbols(spark):
    contract = contract_of(f={"type": "enum", "name": "e", "symbols": ["A", "B"], "default": "B"}).with_symbols()
    rows = cast.typed_rows(cast.cast_rows(aligned(spark, contract, [("A",), ("C",), ("",)]), contract))
    assert [r["f"] for r in rows.collect()] == ["A", "B", "B"]
