"""Typed casting of aligned rows, with the original of every failed row kept beside its typed form.

All expressions are generated as SQL text and stay in the JVM. Each field is converted once, in one projection; the next
ones look only at which conversions came out empty. Columns are numbered until the last projection, so no field name can
clash with a scratch column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import grammar
from quayside.functions.names import text_literal
from quayside.sources.contract import Contract

ROW_STICKY = "row_sticky"
FIELD = "field"
ERROR_MODES = (ROW_STICKY, FIELD)

ERROR_TYPE = "array<struct<field: string, type: string, raw: string, reason: string>>"
BAD_LINE_KIND = "json"


@dataclass(frozen=True)
class CastRows:
    """Cast rows. `frame` has, per contract field, its text `r<i>` and its typed value `t<i>`, and besides

    - `first_bad`, the 1-based position of the first rejected field, one past the last field when there is none
    - `bad_line`, the line itself where it was malformed
    - `failed`, whether the row has either
    - `e<i>`, for fields that can be rejected, whether it was
    """

    frame: DataFrame
    contract: Contract
    excess_digits: str = grammar.REJECT

    def index(self, name: str) -> int:
        return [n.lower() for n in self.contract.names].index(name.lower())

    def typed_columns(self) -> list:
        return [F.col(f"t{i}").alias(n) for i, n in enumerate(self.contract.names)]

    def text_columns(self) -> list:
        return [F.col(f"r{i}").alias(n) for i, n in enumerate(self.contract.names)]

    def fallible(self) -> list:
        return [(i, f) for i, f in enumerate(self.contract.fields) if grammar.is_fallible(f)]


def cast_rows(
    aligned: DataFrame, contract: Contract, error_mode: str = ROW_STICKY, excess_digits: str = grammar.REJECT
) -> CastRows:
    """Cast every field to its contract type.

    `aligned` holds the contract's fields as blank-filled text, in order, and then the malformed line. A blank field
    takes its default and is no error. A rejected field takes its default; in mode `row_sticky` so do all fields after
    the first rejected one in contract order, in mode `field` only the rejected ones. A malformed line counts as failed
    and is all defaults. A decimal with more digits than its type keeps is rejected, or rounded by
    `excess_digits="round"`; no other value is ever changed by its cast, but for the nearest float or double of a number.
    """
    if error_mode not in ERROR_MODES:
        raise ValueError(f"error_mode is one of {', '.join(ERROR_MODES)}, not {error_mode!r}")
    if excess_digits not in grammar.EXCESS_DIGITS:
        raise ValueError(f"excess_digits is one of {', '.join(grammar.EXCESS_DIGITS)}, not {excess_digits!r}")
    fields = list(enumerate(contract.fields))
    fallible = [i for i, f in fields if grammar.is_fallible(f)]
    texts = [f"r{i}" for i, _ in fields]

    converted = aligned.toDF(*texts, "bad_line").selectExpr(
        *texts, "bad_line", *[f"{grammar.converted(contract.fields[i], f'r{i}', excess_digits)} AS c{i}" for i in fallible]
    )
    # The arms stop at the first hit. An array of flags would be built for every row.
    rejected = {i: f"(r{i} <> '' AND c{i} IS NULL)" for i in fallible}
    arms = " ".join(f"WHEN {rejected[i]} THEN {i + 1}" for i in fallible)
    beyond = len(fields) + 1
    located = converted.selectExpr("*", f"{f'CASE {arms} ELSE {beyond} END' if arms else beyond} AS first_bad")

    typed = []
    for i, f in fields:
        value = f"c{i}" if i in rejected else grammar.converted(f, f"r{i}")
        if error_mode == ROW_STICKY and fallible and i >= fallible[0]:
            value = f"CASE WHEN first_bad > {i + 1} THEN {value} END"
        if not f.nullable:
            value = f"coalesce({value}, {grammar.default(f)})"
        typed.append(f"{value} AS t{i}")
    frame = located.selectExpr(
        *texts,
        *typed,
        "first_bad",
        "bad_line",
        f"(first_bad < {beyond} OR bad_line IS NOT NULL) AS failed",
        *[f"{rejected[i]} AS e{i}" for i in fallible],
    )
    return CastRows(frame, contract, excess_digits)


def typed_rows(cast: CastRows) -> DataFrame:
    """The typed form of all rows, failed ones included."""
    return cast.frame.select(*cast.typed_columns())


def quarantine_rows(cast: CastRows, bad_line_col: str | None = None) -> DataFrame:
    """The original text of the failed rows; on request with one more column for lines that could not be parsed."""
    extra = [F.col("bad_line").alias(bad_line_col)] if bad_line_col else []
    return cast.frame.where("failed").select(*cast.text_columns(), *extra)


def error_lists(cast: CastRows) -> DataFrame:
    """`typed`, `raw` and `errors` of every row; `errors` lists the rejected fields with type, text and reason."""
    found = [
        f"CASE WHEN e{i} THEN named_struct('field', {text_literal(f.name)}, 'type', {text_literal(f.kind)}, "
        f"'raw', r{i}, 'reason', {grammar.reason(f, f'r{i}', cast.excess_digits)}) END"
        for i, f in cast.fallible()
    ]
    found.append(
        "CASE WHEN bad_line IS NOT NULL THEN "
        f"named_struct('field', '', 'type', {text_literal(BAD_LINE_KIND)}, 'raw', bad_line, "
        f"'reason', '{grammar.FORM}') END"
    )
    errors = f"CASE WHEN failed THEN array_compact(array({', '.join(found)})) ELSE array() END"
    return cast.frame.select(
        F.struct(*cast.typed_columns()).alias("typed"),
        F.struct(*cast.text_columns()).alias("raw"),
        F.expr(f"CAST({errors} AS {ERROR_TYPE})").alias("errors"),
    )


def error_summary(cast: CastRows) -> DataFrame:
    """Rejected values per field (`field`, `type`, `n`), counted in one pass and without a shuffle of rows.

    Counts every rejected field of a row, in either error mode. Malformed lines count under an empty field name.
    """
    counters = [("", BAD_LINE_KIND, F.col("bad_line").isNotNull())]
    counters += [(f.name, f.kind, F.col(f"e{i}")) for i, f in cast.fallible()]
    entries = [
        F.struct(F.lit(name).alias("field"), F.lit(kind).alias("type"), F.count_if(flag).alias("n"))
        for name, kind, flag in counters
    ]
    counted = cast.frame.agg(F.array(*entries).alias("found"))
    return counted.select(F.inline("found")).where("n > 0")
