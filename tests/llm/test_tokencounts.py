from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest

from quayside.llm.tokencounts import RULES, attributed, encoder_of, token_attribution

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoder():
    with open(RANKS, "rb") as file:
        return encoder_of(file.read())


def test_spans_hold_the_tokens(encoder):
    text = "naïve 漢字 🙂 words\n\n  and more's 12345"
    ids, starts, ends = encoder.spans(text)
    assert encoder.encoding.decode(ids.tolist()) == text
    data = text.encode()
    at = 0
    for token, start, end in zip(ids.tolist(), starts, ends, strict=True):
        raw = encoder.encoding.decode_single_token_bytes(token)
        first = len(data[:at].decode(errors="ignore"))
        assert start == first and end == len((data[: at + len(raw)] + b"").decode(errors="ignore")) + (
            not _whole(data[: at + len(raw)])
        )
        at += len(raw)


def _whole(data: bytes) -> bool:
    try:
        data.decode()
        return True
    except UnicodeDecodeError:
        return False


def brute(starts, ends, bounds, stops, rule):
    counts = np.zeros(len(bounds))
    for s, e in zip(starts, ends, strict=True):
        overlap = [max(0, min(e, q) - max(s, b)) for b, q in zip(bounds, stops, strict=True)]
        if rule == "share":
            counts += np.array(overlap) / (e - s)
        elif rule == "most":
            if any(overlap):
                counts[int(np.argmax(overlap))] += 1
        else:
            place = s if rule == "first" else e - 1
            for i, (b, q) in enumerate(zip(bounds, stops, strict=True)):
                counts[i] += b <= place < q
    return counts


@pytest.mark.parametrize("rule", RULES)
def test_attribution_equals_brute_force(rule):
    rng = np.random.default_rng(5)
    for _ in range(200):
        ends = np.cumsum(rng.integers(1, 6, 12))
        starts = np.append(0, ends[:-1])
        cuts = np.unique(rng.integers(0, ends[-1] + 3, 8))
        bounds, stops = cuts[:-1], cuts[1:].copy()
        if len(stops) and rng.random() < 0.5:
            stops = np.maximum(stops - rng.integers(0, 2, len(stops)), bounds + 1)
        counts, _, outside = attributed(starts, ends, bounds, stops, rule)
        assert np.allclose(counts, brute(starts, ends, bounds, stops, rule))
        if rule in ("first", "last", "most"):
            assert counts.sum() + outside == len(starts)


def test_paragraphs_of_documents(awkward, encoder):
    texts = {r["doc_id"]: r["text"] or "" for r in awkward.select("doc_id", "text").collect()}
    rows = token_attribution(awkward, RANKS).collect()
    assert len(rows) == awkward.count()
    for row in rows:
        text = texts[row["doc_id"]]
        assert row["n_tokens"] == len(encoder.encoding.encode_ordinary(text))
        assert sum(s["n_tokens"] for s in row["sections"]) == row["n_tokens"] and row["n_outside"] == 0
        assert len(row["sections"]) == text.count("\n") + 1
        assert "".join(text[s["start"] : s["end"]] for s in row["sections"]) == text


def test_given_sections(spark):
    text = "Title\n\n\nBody text here"
    sections = [{"name": "title", "start": 0, "end": 6}, None, {"name": "body", "start": 8, "end": 100},
                {"name": "none", "start": None, "end": 3}, {"name": "empty", "start": 7, "end": 7}]
    schema = "doc_id int, text string, fields array<struct<name: string, start: long, end: long>>"
    docs = spark.createDataFrame([(1, text, sections), (2, text, None), (3, None, sections)], schema)
    rows = {r["doc_id"]: r for r in token_attribution(docs, RANKS, "fields", "first").collect()}
    assert [s["name"] for s in rows[1]["sections"]] == ["title", "empty", "body"]
    assert rows[1]["n_crossing"] == 1 and rows[2]["n_outside"] == rows[2]["n_tokens"]
    assert rows[3]["n_tokens"] == 0
    shared = token_attribution(docs, RANKS, "fields", "share").where("doc_id = 1").first()
    assert 0 < shared["sections"][0]["n_tokens"] % 1 < 1


def test_overlapping_sections_are_told(spark):
    schema = "doc_id int, text string, fields array<struct<name: string, start: long, end: long>>"
    docs = spark.createDataFrame([(1, "some more text", [("a", 0, 5), ("b", 3, 9), ("c", 5, 14)]), (2, "x", None)], schema)
    rows = {r["doc_id"]: r for r in token_attribution(docs, RANKS, "fields").collect()}
    assert (rows[1]["n_overlapping"], rows[2]["n_overlapping"]) == (1, 0)
    assert [(s["name"], s["n_tokens"] > 0) for s in rows[1]["sections"]] == [("a", True), ("b", False), ("c", True)]
    assert rows[1]["n_outside"] == 0


def test_long_runs_of_white_space_give_the_ids_of_the_library(encoder):
    rng = np.random.default_rng(9)
    marks = ["a", "Bc", "1", "'s", "!", " ", " ", "  ", "\n", "\t", "\u00a0", "\x1c", "\u2028", "é", "🙂"]
    for _ in range(500):
        text = "".join(rng.choice(marks, rng.integers(0, 30)))
        for long_run in (1, 2, 5):
            assert encoder.ids(text, long_run).tolist() == encoder.encoding.encode_ordinary(text)


def test_two_million_blanks(spark, encoder):
    text = "x" + " " * 2_000_000 + "y" + "\n" * 50_000
    docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
    row = token_attribution(docs, RANKS).first()
    assert row["n_tokens"] == len(encoder.ids(text)) and sum(s["n_tokens"] for s in row["sections"]) == row["n_tokens"]


def test_empty_table(empty):
    assert token_attribution(empty, RANKS).count() == 0
