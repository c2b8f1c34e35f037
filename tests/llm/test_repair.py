from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

import quayside.llm.repair as repair_module
from quayside.llm import oracles
from quayside.llm.queries import damaged, op12_conversation_repair
from quayside.llm.repair import cheapest, digests, parsed, repaired

ORDER = re.compile(r"(s?(ua)+)?\Z")
SCHEMA = "conv_id long, turn long, role string, text string"


def all_audits(rows, most):
    """Every (cost, audit) up to a cost that makes the rows read in order, by trying all edits."""

    def tried(i, initials, cost, audit):
        if cost > most:
            return
        if i == len(rows) and ORDER.match(initials):
            yield cost, audit
        for inserted in "ua":
            if not audit.endswith("III"):
                yield from tried(i, initials + inserted, cost + 2, audit + "I")
        if i < len(rows):
            initial, state = rows[i]
            yield from tried(i + 1, initials, cost + 3, audit + "D")
            if state != "deleted":
                extra = int(state == "truncated")
                yield from tried(i + 1, initials + (initial or "?"), cost + extra, audit + "K")
                for renamed in "ua":
                    yield from tried(i + 1, initials + renamed, cost + 2 + extra, audit + "R")

    return tried(0, "", 0, "")


def all_splits(rows):
    """The cells of a span by every way to cut it, as a table of all spans."""
    spans = {(i, i + 1): repair_module.leaf(*row) for i, row in enumerate(rows)}
    for length in range(2, len(rows) + 1):
        for i in range(len(rows) - length + 1):
            cells: dict = {}
            for cut in range(i + 1, i + length):
                for key, cell in repair_module.combined(spans[i, cut], spans[cut, i + length]).items():
                    cells[key] = min(cells.get(key, cell), cell)
            spans[i, i + length] = cells
    return spans[0, len(rows)]


KINDS = list(itertools.product(("s", "u", "a", ""), ("fine", "truncated", "deleted")))


def test_short_conversations_against_all_edits():
    rng = random.Random(1)
    cases = [()] + [(kind,) for kind in KINDS] + [tuple(rng.choice(KINDS) for _ in range(rng.randrange(2, 4))) for _ in range(60)]
    for rows in cases:
        best = cheapest(parsed(rows))
        assert best == min(all_audits(rows, best[0])), rows


def test_one_cut_gives_the_cells_of_all_cuts():
    rng = random.Random(2)
    for _ in range(40):
        rows = tuple(rng.choice(KINDS) for _ in range(rng.randrange(1, 24)))
        assert parsed(rows) == all_splits(rows)


def by_sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    if rows:
        con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    return sorted(con.execute(oracles.CONVERSATION_REPAIR).fetchall(), key=repr)


def by_query(spark, rows, tmp_path):
    path = str(tmp_path / "in")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/conversations.parquet")
    return sorted(map(tuple, op12_conversation_repair(spark, path).collect()), key=repr)


def made(seed, conversations, longest):
    rng = random.Random(seed)
    texts = ["Hello there.", "What?", "no end", " \t", "", "Fine! ", "a\x0bb.", "same text.", None, "漢字。", "x" * 500]
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randrange(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"])
            rows.append((conv, turn + rng.choice([0, 0, 0, 5]), role, rng.choice(texts) if rng.random() < 0.6 else f"t {turn}."))
    return rows


def test_equals_the_sql_on_awkward_rows(spark, tmp_path):
    rows = made(3, 80, 9)
    rows += [(None, 1, "user", "a."), (None, 2, "assistant", "b."), (None, None, None, None), (7, None, "user", "c.")]
    rows += [(500, None, "user", "one."), (500, None, "assistant", "two."), (501, -(2**40), "user", "far."), (501, 2**40, "user", "f.")]
    rows += [rows[0], rows[0], rows[1]]
    assert by_query(spark, rows, tmp_path) == by_sql(rows)


def test_long_conversations_over_blocks_and_rounds(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(repair_module, "BLOCK_BITS", 2)
    monkeypatch.setattr(repair_module, "SPANS_TOGETHER", 3)
    rows = made(4, 3, 150) + made(5, 20, 5)
    assert by_query(spark, rows, tmp_path) == by_sql(rows)


def test_rows_that_all_go(spark, tmp_path):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(dropped, 0, "user", "gone.")]
    empty = hashlib.sha256(b"").hexdigest()
    assert by_query(spark, rows, tmp_path) == [(dropped, 0, 0, 0, 0, 0, 0, "", empty)] == by_sql(rows)


def test_empty_table(spark, tmp_path):
    assert by_query(spark, [], tmp_path) == []


def test_a_very_long_text_and_clashing_columns(spark):
    long = "word " * 400_000 + " " * 1_000_000
    rows = [(1, 0, "user", long, 1, "x", "y"), (1, 1, "assistant", "Yes.", 2, "x", "y")]
    frame = spark.createDataFrame(rows, SCHEMA + ", slot int, conv string, audit string")
    repair = repaired(frame)
    assert [(r["cost"], r["audit"]) for r in repair.conversations.collect()] == [(1, "KK")]
    found = [(r["place"], r["role"], r["text"]) for r in repair.turns.collect()]
    assert found == [(0, "user", long), (1, "assistant", "Yes.")]
    digest = hashlib.sha256(f"user:{long}\nassistant:Yes.".encode()).hexdigest()
    assert [r["repaired_sha256"] for r in digests(repair.turns).collect()] == [digest]


def test_repaired_rows_read_in_order(spark):
    frame = spark.createDataFrame(made(6, 60, 12), SCHEMA)
    by_conv: dict = {}
    for r in repaired(damaged(frame)).turns.orderBy("conv", "place").collect():
        by_conv.setdefault(r["conv"], []).append(r)
    for rows in by_conv.values():
        assert [r["place"] for r in rows] == list(range(len(rows)))
        assert ORDER.match("".join(r["role"][:1] for r in rows))


@pytest.mark.parametrize("text, cut", [("a.", 0), ("a", 1), ("a. \n\x0b", 0), ("a\x85", 1), (".b ", 1), ("a. ", 1)])
def test_what_counts_as_truncated(spark, text, cut):
    frame = spark.createDataFrame([(1, 0, "user", text)], SCHEMA)
    assert [r["truncated"] for r in repaired(frame).conversations.collect()] == [cut]
