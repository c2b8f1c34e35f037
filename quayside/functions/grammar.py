"""The cast grammar: which text each contract kind accepts, how it converts, and what replaces it when it does not.

This is the only place that knows about conversion. A rule is three SQL templates over `{v}` (the blank-filled text),
`{type}` (the target type) and `{size}` (bytes of a fixed field):

accept   what the text must look like before it is converted; None when any text is fine
convert  the typed value, null when the text has the right look but no value (overflow, 30 February)
default  the value of a required field that is blank or was rejected; nullable fields become null

The guards decide, not the engine's casts: those trim spaces, take `1d` for a double or `yes` for a boolean, turn a
number that is too large into infinity, one that is too small into zero, and round digits away. They also keep rejected
text away from `try_cast`, whose failures cost an exception per value.

A rejected text has one of three reasons: its `form`; its `range`, where the form is right but the type has no such
value; its `scale`, where a decimal has more digits behind the point than the type keeps, zeros at the end not counted.
With excess_digits="round" such decimals are rounded instead.
"""

from __future__ import annotations

from dataclasses import dataclass

from quayside.functions.names import ddl, text_literal
from quayside.sources.contract import Field


@dataclass(frozen=True)
class Rule:
    accept: str | None
    convert: str
    default: str


# The accepted text forms.
INTEGER = r"r'^[+-]?[0-9]+\z'"
DECIMAL = r"r'^[+-]?[0-9]+([.][0-9]+)?\z'"
FLOATING = r"r'^([+-]?[0-9]+([.][0-9]+)?([eE][+-]?[0-9]+)?|-?Infinity|NaN)\z'"
DAY = r"r'^[0-9]{4}-[0-9]{2}-[0-9]{2}\z'"
MOMENT = r"r'^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?\z'"
# A decimal whose digits beyond the scale are zeros.
SCALED = r"r'^[+-]?[0-9]+([.](?=[0-9])[0-9]{0,{scale}}0*)?\z'"
NONZERO = r"r'^[+-]?[0.]*[1-9]'"
BASE64 = "data:;base64,"

FORM, RANGE, SCALE = "form", "range", "scale"
REJECT, ROUND = "reject", "round"
EXCESS_DIGITS = (REJECT, ROUND)

_CAST = "try_cast({v} AS {type})"
_ZERO = "CAST(0 AS {type})"
# Without an exponent, a text this short is far from either end of a float's range. All others are looked at again.
_SURELY_IN_RANGE = "octet_length({v}) <= 37 AND NOT contains(lower({v}), 'e')"
_NO_VALUE = (
    f"(abs({_CAST}) = CAST('Infinity' AS {{type}}) AND NOT endswith({{v}}, 'Infinity'))"
    f" OR ({_CAST} = 0 AND regexp_like({{v}}, {NONZERO}))"
)
_REAL = f"CASE WHEN {_SURELY_IN_RANGE} THEN {_CAST} WHEN NOT ({_NO_VALUE}) THEN {_CAST} END"
_OBJECT = "json_object_keys({v}) IS NOT NULL"
_PARSED = "from_json({v}, {type_text})"
# Text is its own bytes; binary columns of a table are landed as base64 behind a mark.
_ENCODED = f"substr({{v}}, {len(BASE64) + 1})"
_MARKED = f"startswith({{v}}, '{BASE64}')"
_BINARY_OK = f"{{v}} <> '' AND (NOT {_MARKED} OR try_to_binary({_ENCODED}, 'base64') IS NOT NULL)"
_BINARY = f"CASE WHEN {_MARKED} THEN try_to_binary({_ENCODED}, 'base64') ELSE encode({{v}}, 'UTF-8') END"

RULES: dict[str, Rule] = {
    "string": Rule(None, "{v}", "''"),
    "enum": Rule(None, "{v}", "''"),
    "symbol": Rule("{v} IN ({symbols})", "{v}", "{symbol}"),
    "int": Rule(f"regexp_like({{v}}, {INTEGER})", _CAST, _ZERO),
    "long": Rule(f"regexp_like({{v}}, {INTEGER})", _CAST, _ZERO),
    "float": Rule(f"regexp_like({{v}}, {FLOATING})", _REAL, _ZERO),
    "double": Rule(f"regexp_like({{v}}, {FLOATING})", _REAL, _ZERO),
    "decimal": Rule(f"regexp_like({{v}}, {SCALED})", _CAST, _ZERO),
    "boolean": Rule("lower({v}) IN ('true', 'false')", "lower({v}) = 'true'", "false"),
    "date": Rule(f"regexp_like({{v}}, {DAY})", _CAST, "DATE '1970-01-01'"),
    "timestamp": Rule(
        f"regexp_like({{v}}, {MOMENT})", "try_cast(concat({v}, 'Z') AS TIMESTAMP)", "timestamp_seconds(0)"
    ),
    "timestamp_ntz": Rule(f"regexp_like({{v}}, {MOMENT})", _CAST, "TIMESTAMP_NTZ '1970-01-01 00:00:00'"),
    "bytes": Rule(_BINARY_OK, _BINARY, "X''"),
    "fixed": Rule(f"{_BINARY_OK} AND octet_length({_BINARY}) = {{size}}", _BINARY, "unhex(repeat('00', {size}))"),
    "record": Rule(_OBJECT, _PARSED, "from_json('{}', {type_text})"),
    "map": Rule(_OBJECT, _PARSED, "from_json('{}', {type_text})"),
    "array": Rule("json_array_length({v}) IS NOT NULL", _PARSED, "from_json('[]', {type_text})"),
}


# Where excess digits are rounded, a decimal may have as many as it likes.
_ROUNDED = {"decimal": Rule(f"regexp_like({{v}}, {DECIMAL})", _CAST, _ZERO)}


def _rule(field: Field, excess_digits: str) -> Rule:
    if excess_digits == ROUND:
        return _ROUNDED.get(field.kind, RULES[field.kind])
    return RULES[field.kind]


def _fill(template: str, field: Field, v: str = "") -> str:
    spelled = ddl(field.type)
    filled = template.replace("{v}", v).replace("{size}", str(field.size))
    symbols = [text_literal(s) for s in field.symbols] or ["''"]
    filled = filled.replace("{symbols}", ", ".join(symbols)).replace("{symbol}", symbols[0])
    filled = filled.replace("{scale}", str(getattr(field.type, "scale", 0)))
    return filled.replace("{type}", spelled).replace("{type_text}", text_literal(spelled))


def is_fallible(field: Field) -> bool:
    """Whether a non-blank text can be rejected."""
    return RULES[field.kind].accept is not None


def converted(field: Field, v: str, excess_digits: str = REJECT) -> str:
    """SQL for the typed value of text `v`; null when the text is rejected or, but for required text, blank."""
    rule = _rule(field, excess_digits)
    accept = _fill(rule.accept, field, v) if rule.accept else f"{v} <> ''"
    value = _fill(rule.convert, field, v)
    if rule.accept is None and not field.nullable:
        return value
    return f"CASE WHEN {accept} THEN {value} END"


def reason(field: Field, v: str, excess_digits: str = REJECT) -> str:
    """SQL for why the rejected text `v` was rejected."""
    accept = _fill(_rule(field, excess_digits).accept, field, v)
    if field.kind != "decimal":
        return f"CASE WHEN {accept} THEN '{RANGE}' ELSE '{FORM}' END"
    number = _fill(_ROUNDED["decimal"].accept, field, v)
    return f"CASE WHEN {accept} THEN '{RANGE}' WHEN {number} THEN '{SCALE}' ELSE '{FORM}' END"


def default(field: Field) -> str:
    """SQL for the value a blank or rejected field takes."""
    if field.nullable:
        return f"CAST(NULL AS {ddl(field.type)})"
    return _fill(RULES[field.kind].default, field)
