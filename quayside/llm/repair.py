"""Conversation repair: weighted interval parsing of the rows of a conversation by a repair grammar.

A conversation should read `(s?(ua)+)?` in the initials of its roles. The order has four points: nothing yet (0), behind
the system row (1), behind a user row (2), behind an assistant row (3); it may end at 0 and 3. The grammar is in Chomsky
normal form. A nonterminal [p q] derives a part of a conversation that leads from point p to point q:

    [p q] -> [p r] [r q]          two neighbouring parts
    [p q] -> row                  one row, kept, given another role or deleted, with insertions before and behind it

The insertions are the closure of the rules that derive nothing: the shortest run of new rows from p to q. A cell holds,
for a span of rows and each nonterminal, the least (cost, audit). The audit has one letter for each edit in order, and
of equal costs the least in ASCII counts. No audit of a cell is the beginning of another one of the same cost, since what
would follow are insertions, which cost something: so the least parts make the least whole.

Cells are combined bottom-up by the length of their spans. The nonterminals of a part do not depend on how it is
divided, every way to cut a span gives the same cell, and one cut is enough: a conversation of n rows takes n - 1
combinations, not n³. A very long conversation is cut into blocks of rows that different tasks parse; their spans are
combined in rounds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quayside.llm.common import column, stored

# The points of the order, what leads from one to the next, and what each edit costs.
STEPS = {"s": ((0, 1),), "u": ((0, 2), (1, 2), (3, 2)), "a": ((2, 3),)}
ENDS = (0, 3)
RENAME, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")

FINE, CUT, GONE = "fine", "truncated", "deleted"
_WORD = r"[^\x20\x09-\x0D]"
_UNENDED = r"[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*\z"

BLOCK_BITS = 12  # a block has at most 4,096 rows
SPANS_TOGETHER = 16
_REMEMBERED = 8

Cell = tuple[int, str]
Cells = dict[tuple[int, int], Cell]


def combined(left: Cells, right: Cells) -> Cells:
    """The cells of two neighbouring spans taken together: [p q] -> [p r] [r q]."""
    best: Cells = {}
    for (p, r), (cost, audit) in left.items():
        for q in range(len(STEPS) + 1):
            other = right.get((r, q))
            if other is None:
                continue
            total, now = cost + other[0], best.get((p, q))
            if now is None or total < now[0]:
                best[p, q] = total, audit + other[1]
            elif total == now[0]:
                best[p, q] = total, min(now[1], audit + other[1])
    return best


def _closure() -> Cells:
    """What derives nothing: no edit at all, or the fewest insertions from one point to another."""
    cells: Cells = {(p, p): (0, "") for p in range(len(STEPS) + 1)}
    steps = {pair: (INSERT, "I") for initial in ROLES for pair in STEPS[initial]}
    while (grown := {**combined(cells, steps), **cells}).keys() != cells.keys():
        cells = grown
    return cells


@lru_cache(maxsize=None)
def leaf(initial: str, state: str) -> Cells:
    """The cells of one row: its edits, with insertions before and behind it."""
    edits: Cells = {(p, p): (DELETE, "D") for p in range(len(STEPS) + 1)}
    if state != GONE:
        extra = TRUNCATED if state == CUT else 0
        edits |= {pair: (RENAME + extra, "R") for renamed in ROLES for pair in STEPS[renamed]}
        edits |= {pair: (extra, "K") for pair in STEPS.get(initial, ())}
    return combined(combined(_closure(), edits), _closure())


@lru_cache(maxsize=1 << 14)
def _short(rows: tuple[tuple[str, str], ...]) -> Cells:
    return parsed(rows)


def parsed(rows: tuple[tuple[str, str], ...]) -> Cells:
    """The cells of a span of (initial, state) rows, bottom-up: spans of one row, of two, of four and so on."""
    if len(rows) > _REMEMBERED:
        spans = [_short(rows[i : i + _REMEMBERED]) for i in range(0, len(rows), _REMEMBERED)]
    else:
        spans = [leaf(*row) for row in rows]
    while len(spans) > 1:
        spans = [combined(*spans[i : i + 2]) if i + 1 < len(spans) else spans[i] for i in range(0, len(spans), 2)]
    return spans[0] if spans else _closure()


def cheapest(cells: Cells) -> Cell:
    """The best parse of a whole conversation."""
    return min(cells[0, q] for q in ENDS if (0, q) in cells)


# A span on its way: its cells as parallel lists, and what is counted in it.
_CELLS = "points array<int>, costs array<long>, audits array<string>"
_COUNTS = (
    "blank long, duplicate long, truncated long, illegal long, first_initial string, last_initial string, "
    "low decimal(20,0), high decimal(20,0), turns long"
)


@dataclass
class _Span:
    """Cells and counts of neighbouring rows of one conversation, which come in order."""

    cells: Cells
    blank: int
    duplicate: int
    truncated: int
    illegal: int
    first_initial: str
    last_initial: str
    low: int | None
    high: int | None
    turns: int

    def __add__(self, after: _Span) -> _Span:
        meets = self.last_initial + after.first_initial not in LEGAL
        return _Span(
            combined(self.cells, after.cells),
            self.blank + after.blank,
            self.duplicate + after.duplicate,
            self.truncated + after.truncated,
            self.illegal + after.illegal + meets,
            self.first_initial,
            after.last_initial,
            after.low if self.low is None else self.low,
            self.high if after.high is None else after.high,
            # rows are in the order of turns: only the two at the seam can be the same
            self.turns + after.turns - (self.high is not None and self.high == after.low),
        )

    def row(self) -> tuple:
        points, cells = zip(*self.cells.items(), strict=True)
        costs, audits = zip(*cells, strict=True)
        counts = [getattr(self, name.split()[0]) for name in _COUNTS.split(", ")]
        return ([4 * p + q for p, q in points], list(costs), list(audits), *counts)

    @staticmethod
    def of_row(row: dict) -> _Span:
        cells = {divmod(at, 4): (cost, audit) for at, cost, audit in zip(row["points"], row["costs"], row["audits"])}
        counts = {k: row[k] for k in (name.split()[0] for name in _COUNTS.split(", "))}
        low, high = (None if counts[k] is None else int(counts[k]) for k in ("low", "high"))
        return _Span(cells, **(counts | {"low": low, "high": high}))

    @staticmethod
    def of_rows(rows: list[tuple]) -> _Span:
        """The span of (initial, blank, duplicate, cut, turn) rows."""
        states = tuple((r[0] if r[0] in STEPS else "", GONE if r[1] or r[2] else CUT if r[3] else FINE) for r in rows)
        known = [r[4] for r in rows if r[4] is not None]
        return _Span(
            parsed(states),
            sum(r[1] for r in rows),
            sum(r[2] for r in rows),
            sum(state == CUT for _, state in states),
            sum(a[0] + b[0] not in LEGAL for a, b in zip(rows, rows[1:])),
            rows[0][0],
            rows[-1][0],
            known[0] if known else None,
            known[-1] if known else None,
            len(set(known)),
        )


def in_order(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """The rows numbered (`slot`) in the order of conversations and turns, with what their text shows, stored.

    Rows are dealt by ranges of everything that orders them, so a conversation of any length spreads over partitions.
    """
    role, text = (F.coalesce(column(c), F.lit(" ")) for c in (role_col, text_col))
    taken = rows.select(
        column(conv_col).alias("conv"), column(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text")
    )
    order = ["conv", "turn", "role", "text", "tie"]
    marked = taken.withColumn("tie", F.monotonically_increasing_id())
    ordered = marked.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    same = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    shown = ordered.select(
        *ordered.columns,
        (~F.col("text").rlike(_WORD)).alias("blank"),
        F.col("text").rlike(_UNENDED).alias("cut"),
        F.unhex(same).alias("same"),
        F.monotonically_increasing_id().alias("slot"),
    )
    return stored(shown, "ordered_turns")


def _judged(ordered: DataFrame) -> DataFrame:
    """(conv, slot, turn, initial, blank, duplicate, cut): a duplicate's role and text come earlier in its conversation."""
    repeated = (
        ordered.where(~F.col("blank"))
        .groupBy(F.col("conv").alias("in_conv"), F.col("same").alias("what"))
        .agg(F.min("slot").alias("first_slot"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    alike = F.col("conv").eqNullSafe(F.col("in_conv")) & (F.col("same") == F.col("what")) & ~F.col("blank")
    return ordered.join(repeated, alike, "left").select(
        "conv",
        "slot",
        "turn",
        F.substring("role", 1, 1).alias("initial"),
        "blank",
        F.coalesce(F.col("slot") > F.col("first_slot"), F.lit(False)).alias("duplicate"),
        "cut",
    )


def _block_spans(judged: DataFrame) -> DataFrame:
    """(conv, first_slot, cells and counts) of what each block has of each conversation."""
    conv_type = judged.schema["conv"].dataType
    dealt = (
        judged.withColumn("block", F.shiftright("slot", BLOCK_BITS)).repartition("block").sortWithinPartitions("slot")
    )
    schema = StructType.fromDDL(f"conv {conv_type.simpleString()}, first_slot long, {_CELLS}, {_COUNTS}")

    def spans(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for part in parts:
            found = []
            columns = [part.column(n).to_pylist() for n in ("conv", "slot", "block", "initial", "blank", "duplicate", "cut", "turn")]
            for conv, slot, block, *row in zip(*columns, strict=True):
                if held and held[0][:2] != (conv, block):
                    found.append(held)
                    held = []
                held.append((conv, block, slot, tuple(row)))
            yield _span_batch([_spanned(run) for run in found], target)
        if held:
            yield _span_batch([_spanned(held)], target)

    target = to_arrow_schema(schema)
    return dealt.mapInArrow(spans, schema)


def _spanned(run: list[tuple]) -> tuple:
    return (run[0][0], run[0][2], *_Span.of_rows([r[3] for r in run]).row())


def _span_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _whole_spans(spans: DataFrame) -> DataFrame:
    """One span for each conversation: spans of one conversation are combined by the dozen, round after round."""
    schema, target = spans.schema, to_arrow_schema(spans.schema)

    def combine(table: pa.Table) -> pa.Table:
        rows = sorted(table.drop_columns(["bundle"]).to_pylist(), key=lambda r: r["first_slot"])
        whole = reduce(_Span.__add__, map(_Span.of_row, rows))
        return pa.Table.from_batches([_span_batch([(rows[0]["conv"], rows[0]["first_slot"], *whole.row())], target)])

    done = None
    while True:
        spans = stored(spans, "spans")
        order = Window.partitionBy("conv").orderBy("first_slot")
        # numbers alone go through the window; cells stay in their files
        numbered = spans.select("conv", "first_slot").withColumn("at", F.row_number().over(order))
        counts = numbered.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        several = stored(
            numbered.join(counts.select(F.col("conv").alias("long_conv")), F.col("conv").eqNullSafe(F.col("long_conv")))
            .select(F.col("first_slot").alias("of_slot"), F.floor((F.col("at") - 1) / SPANS_TOGETHER).alias("bundle")),
            "numbered_spans",
        )
        single = spans.join(several, F.col("first_slot") == F.col("of_slot"), "left_anti")
        done = single if done is None else done.unionByName(single)
        if several.isEmpty():
            return done
        open_spans = spans.join(several, F.col("first_slot") == F.col("of_slot")).drop("of_slot")
        spans = open_spans.groupBy("conv", "bundle").applyInArrow(combine, schema)


@dataclass(frozen=True)
class Repair:
    """`conversations` has a row for each conversation: its id `conv`, `gaps`, `blank`, `duplicate`, `truncated`,
    `illegal`, `cost` and `audit`. `turns` has the repaired rows (`conv`, `place` from 0, `role`, `text`); within a
    partition they come sorted, and a conversation is in one partition."""

    conversations: DataFrame
    turns: DataFrame


def repaired(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> Repair:
    """Repair conversations at the least cost, by the grammar above.

    Rows are taken by turn, nulls first; rows of one turn by role and text. A row is blank when its text has nothing but
    white space, a duplicate when its role and text came earlier in the conversation, truncated when its text does not
    end in `.`, `!` or `?`; the first that holds counts. Blank and duplicate rows must go; a truncated one that stays
    costs 1 more. `gaps` is the number of turns missing between the first and the last, null where that is beyond a
    long. Null roles and texts count as one space; rows without a conversation id form a conversation of their own.
    """
    ordered = in_order(rows, conv_col, turn_col, role_col, text_col)
    spans = _whole_spans(_block_spans(_judged(ordered)))
    # the ends an order may have, from point 0: the least (cost, audit) of those that can be reached
    cells = F.arrays_zip("points", "costs", "audits")
    ends = F.filter(cells, lambda c: c["points"].isin(*ENDS))
    best = F.array_min(F.transform(ends, lambda c: F.struct(c["costs"].alias("cost"), c["audits"].alias("audit"))))
    missing = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).try_cast("long")
    conversations = spans.withColumn("best", best).select(
        "conv",
        missing.alias("gaps"),
        *["blank", "duplicate", "truncated", "illegal"],
        F.col("best.cost").alias("cost"),
        F.col("best.audit").alias("audit"),
    )
    conversations = stored(conversations, "repairs")
    # an audit goes ahead of the rows of its conversation, which then stream past it
    none = F.lit(None).cast("string")
    ahead = conversations.select("conv", F.lit(-1).cast("long").alias("slot"), none.alias("role"), none.alias("text"), "audit")
    behind = ordered.select("conv", "slot", "role", "text", none.alias("audit"))
    streamed = ahead.unionByName(behind).repartition("conv").sortWithinPartitions("conv", "slot")
    conv_type = ordered.schema["conv"].dataType.simpleString()
    turns = streamed.mapInArrow(_edit, f"conv {conv_type}, place long, role string, text string")
    return Repair(conversations, turns)


def _edit(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repaired rows of conversations that come in order, each behind its audit."""
    audit, at, place, point = "", 0, 0, 0
    for part in parts:
        conv_type = part.schema.field("conv").type
        found: list[tuple] = []

        def inserted(conv):
            nonlocal at, place, point
            while at < len(audit) and audit[at] == "I":
                (role, text), point = _put("I", "", "", point)
                found.append((conv, place, role, text))
                at, place = at + 1, place + 1

        columns = [part.column(n).to_pylist() for n in ("conv", "role", "text", "audit")]
        for conv, role, text, header in zip(*columns, strict=True):
            if header is not None:
                audit, at, place, point = header, 0, 0, 0
            else:
                edit, at = audit[at], at + 1
                if edit != "D":
                    (role, text), point = _put(edit, role, text, point)
                    found.append((conv, place, role, text))
                    place += 1
            inserted(conv)
        columns = list(zip(*found, strict=True)) or [()] * 4
        types = (conv_type, pa.int64(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=["conv", "place", "role", "text"]
        )


def _put(edit: str, role: str, text: str, point: int) -> tuple[tuple[str, str], int]:
    """The row that an edit leaves at a point of the order, and the point behind it."""
    if edit != "K":
        role = ROLES["a" if point == 2 else "u"]
    return (role, text), next(q for p, q in STEPS[role[:1]] if p == point)


def digests(turns: DataFrame) -> DataFrame:
    """(conv, repaired_sha256) of every conversation with repaired rows: of `role:text`, joined by line ends.

    Streams the rows in the order that `Repair.turns` has them; a digest is carried along, a conversation is never held.
    """
    conv_type = turns.schema["conv"].dataType.simpleString()

    def digest(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running, owner, kind = None, None, None
        for part in parts:
            kind, done = part.schema.field("conv").type, []
            for conv, place, role, text in zip(*(part.column(i).to_pylist() for i in range(4)), strict=True):
                if place == 0:
                    if running is not None:
                        done.append((owner, running.hexdigest()))
                    running, owner = hashlib.sha256(), conv
                else:
                    running.update(b"\n")
                running.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
            yield _digest_batch(done, kind)
        if running is not None:
            yield _digest_batch([(owner, running.hexdigest())], kind)

    return turns.mapInArrow(digest, f"conv {conv_type}, repaired_sha256 string")


def _digest_batch(rows: list[tuple], conv_type: pa.DataType) -> pa.RecordBatch:
    owners, texts = zip(*rows, strict=True) if rows else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(owners, conv_type), pa.array(texts, pa.string())], ["conv", "repaired_sha256"])
