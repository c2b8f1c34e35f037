from __future__ import annotations

import random

import regex

from quayside.llm.licenses import NOTICES, PHRASES, Notice, NoticeFinder, folded_words, license_scan


def edited(rng: random.Random, text: str, edits: int) -> str:
    for _ in range(edits):
        at = rng.randrange(1, len(text) - 1)
        kind = rng.randrange(3)
        text = text[:at] + ("" if kind == 0 else rng.choice("xyz")) + text[at + (kind != 1) :]
    return text


def test_every_notice_within_its_edits_is_found():
    rng = random.Random(2)
    finder = NoticeFinder(NOTICES)
    for number, notice in enumerate(NOTICES):
        for _ in range(30):
            edits = rng.randrange(notice.edits + 1)
            text = f" before it {edited(rng, notice.words, edits)} and behind "
            places = [p for p in finder.find(text) if p[0] == number]
            assert places and min(p[3] for p in places) <= edits


def test_finds_what_a_search_of_the_whole_text_finds():
    rng = random.Random(3)
    notice = Notice("abcab cabba bacca", "x", 2)
    finder = NoticeFinder([notice])
    pattern = regex.compile(rf"(?b)(?:{notice.words}){{e<=2}}")
    for _ in range(400):
        parts = [edited(rng, notice.words, rng.randrange(6)) if rng.random() < 0.3 else "".join(
            rng.choice("abc ") for _ in range(20)) for _ in range(3)]
        text = f" {' '.join(parts)} "
        assert bool(finder.find(text)) == bool(pattern.search(text)), text


def test_phrases_by_brute_force(spark):
    rng = random.Random(4)
    vocabulary = "mit license apache general public the mitt licenses".split()
    rows = [(i, rng.choice(["", "\n", "--"]).join(rng.choice(vocabulary).title() + rng.choice(" ./-\n") for _ in range(
        rng.randrange(30)))) for i in range(60)] + [(100, None), (101, "MIT—License"), (102, "mit\x00license")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    for row in license_scan(docs, PHRASES).collect():
        words = [w.decode() for w in folded_words(dict(rows)[row["doc_id"]] or "")]
        expected = sorted(
            (i, p.label)
            for p in PHRASES
            for i in range(len(words))
            if words[i : i + len(p.words.split())] == p.words.split()
        )
        assert sorted((p["word"], p["label"]) for p in row["places"]) == expected
        assert row["n_words"] == len(words)


def test_spans_and_edits(spark):
    text = "Some words. Permision is hereby granted, free of charge, to any person obtaining a copi of it."
    row = license_scan(spark.createDataFrame([(1, text)], "doc_id int, text string")).first()
    place = next(p for p in row["places"] if p["notice"].startswith("permission"))
    joined = b" ".join(folded_words(text)).decode()
    assert joined[place["start"] : place["end"]].startswith("permision is hereby") and place["edits"] == 2
    assert place["word"] == 2 and place["label"] == "mit"


def test_awkward_and_empty(awkward, empty):
    rows = license_scan(awkward).collect()
    assert len(rows) == awkward.count() and not any(r["places"] for r in rows)
    assert license_scan(empty).count() == 0
