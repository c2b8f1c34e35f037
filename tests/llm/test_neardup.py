from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from made_texts import sentence

from quayside.llm.components import components
from quayside.llm.neardup import (
    BLOCK_DOCS,
    WordHashes,
    _checked,
    block_links,
    near_duplicates,
    shingle_set,
    without_near_duplicates,
)
from quayside.sources.storage import list_directories, shared_dir


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows, percent):
    """{(id, n_shingles, component)} of (id, text) rows with unique ids."""
    sets = {number: shingles(text) for number, text in rows}
    holders: dict = {}
    for number, found in sets.items():
        for shingle in found:
            holders.setdefault(shingle, []).append(number)
    parent = {number: number for number in sets}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for number, found in sets.items():
        for other, common in Counter(o for s in found for o in holders[s] if o < number).items():
            if 100 * common >= percent * (len(found) + len(sets[other]) - common):
                a, b = root(number), root(other)
                parent[max(a, b)] = min(a, b)
    return {(number, len(found), root(number)) for number, found in sets.items()}


def near_copies(seed, families, copies):
    """Documents with many copies of each, more and less changed, and copies of copies."""
    rng = random.Random(seed)
    made = []
    for _ in range(families):
        words = sentence(rng, rng.randrange(40, 150)).split()
        family = [words]
        for _ in range(rng.randrange(1, copies)):
            copy = list(rng.choice(family))
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = "new" + str(rng.randrange(1000))
            family.append(copy)
        made += [" ".join(w) for w in family]
    rng.shuffle(made)
    return list(enumerate(made))


@pytest.mark.parametrize("percent", [80, 85])
def test_equals_brute_force(spark, percent):
    rows = near_copies(percent, 30, 12)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in near_duplicates(docs, percent).collect()} == brute(rows, percent)


@pytest.mark.parametrize("families, copies", [(2, 160), (1, 240), (5, 60)])
def test_large_groups_in_several_blocks(spark, monkeypatch, families, copies):
    monkeypatch.setattr("quayside.llm.neardup.BLOCK_DOCS", 25)
    rows = near_copies(copies, families, copies)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in near_duplicates(docs, 85).collect()} == brute(rows, 85)


def of_templates(seed, templates, each, shared, own):
    """Documents that are a template's words and some of their own, every tenth with a near copy."""
    rng = random.Random(seed)
    made = []
    for number in range(templates):
        common = [f"t{number}w{at}" for at in range(shared)]
        for _ in range(each):
            words = common + ["w" + str(rng.randrange(10**9)) for _ in range(own)]
            made.append(words)
            if rng.random() < 0.1:
                made.append([*words[:-1], "copy"])
    rng.shuffle(made)
    return [(number, " ".join(words)) for number, words in enumerate(made)]


def checked_rows(monkeypatch):
    """How many texts are sent to be compared, as a list that grows with each comparison."""
    sent = []

    def counted(placed, percent):
        sent.append(placed.count())
        return _checked(placed, percent)

    monkeypatch.setattr("quayside.llm.neardup._checked", counted)
    return sent


@pytest.mark.parametrize("shared, own", [(50, 55), (70, 25), (80, 12)])
def test_documents_of_one_template(spark, monkeypatch, shared, own):
    """Similar to all others, but linked with their copies alone: as many comparisons as documents."""
    monkeypatch.setattr("quayside.llm.neardup.BLOCK_DOCS", 20)
    sent = checked_rows(monkeypatch)
    grown = []
    for each in (150, 300):
        rows = of_templates(each, 1, each, shared, own)
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        sent.clear()
        assert {tuple(r) for r in near_duplicates(docs, 85).collect()} == brute(rows, 85)
        grown.append(sum(sent) / len(rows))
    assert grown[1] < 1.3 * grown[0]
    assert grown[1] < 4


def test_templates_too_much_alike_to_divide(spark, monkeypatch):
    """A little less alike than the threshold and of many sizes: what cannot be divided meets in blocks."""
    monkeypatch.setattr("quayside.llm.neardup.BLOCK_DOCS", 15)
    rng = random.Random(6)
    common = [f"w{at}" for at in range(120)]
    texts = [[*common[: rng.randrange(90, 120)], *(f"x{rng.randrange(10**9)}" for _ in range(9))] for _ in range(120)]
    rows = [(number, " ".join(words)) for number, words in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in near_duplicates(docs, 85).collect()} == brute(rows, 85)


def test_blocks_by_size(spark, monkeypatch):
    """Long texts make blocks of few documents; one longer than a block is one of its own."""
    monkeypatch.setattr("quayside.llm.neardup.BLOCK_SHINGLES", 3_000)
    rng = random.Random(12)
    long = sentence(rng, 4_000).split()
    made = [long, [*long[:-9], "x"], *(long[:2_000] + sentence(rng, n).split() for n in range(100, 1_500, 100))]
    rows = [(number, " ".join(words)) for number, words in enumerate(made)] + near_copies(3, 4, 9)[20:]
    rows = [(number, text) for number, (_, text) in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in near_duplicates(docs, 85).collect()} == brute(rows, 85)


def test_awkward_documents(awkward):
    rows = awkward.select("doc_id", "text").distinct().collect()
    found = near_duplicates(awkward, 80).collect()
    assert len(found) == awkward.count()
    assert {tuple(r) for r in found} == brute([tuple(r) for r in rows], 80)


def test_one_of_each_group_stays_with_its_columns(spark, awkward):
    kept = without_near_duplicates(awkward, 80)
    assert kept.columns == awkward.columns
    rows = [tuple(r) for r in awkward.select("doc_id", "text").distinct().collect()]
    expected = sorted(c for c in {c for _, _, c in brute(rows, 80)})
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == expected
    assert kept.exceptAll(awkward).isEmpty()


def test_rows_without_id(spark):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (2, "a b c d e f"), (1, "A B c d e f"), (3, "a b c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((tuple(r) for r in near_duplicates(docs, 80).collect()), key=repr)
    assert found == sorted([(None, 2, None), (None, 2, None), (1, 2, 1), (2, 2, 1), (3, 1, 3)], key=repr)
    assert without_near_duplicates(docs, 80).count() == 4


def test_empty_table(empty):
    assert near_duplicates(empty).count() == 0
    assert without_near_duplicates(empty).count() == 0


def test_components(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)]
    parent = {n: n for edge in edges for n in edge}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    found = {tuple(r) for r in components(spark.createDataFrame(edges, "node long, other long")).collect()}
    assert found == {(n, root(n)) for n in parent if root(n) != n}


def test_rounds_leave_one_table(spark):
    folder = shared_dir(spark)
    before = set(list_directories(spark, folder))
    edges = spark.range(300).selectExpr("id AS node", "id + 1 AS other")
    found = components(edges)
    left = set(list_directories(spark, folder)) - before
    assert len(left) == 1
    assert {tuple(r) for r in found.collect()} == {(n, 0) for n in range(1, 301)}


def test_block_links_span_what_is_linked():
    hashes = WordHashes()
    rows = near_copies(9, 6, 14)
    sets = [shingle_set(text, hashes) for _, text in rows]
    nodes = [number for number, _ in rows]
    links = block_links(sets, nodes, [(True, True)] * len(rows), 85)
    expected = {c for _, _, c in brute(rows, 85)}
    assert len(links) == len(rows) - len(expected)  # a forest
    true = {(a, b) for a, b in links if _similar(sets[a], sets[b], 85)}
    assert len(true) == len(links)
    sides = [(n % 2 == 0, n % 2 == 1) for n in nodes]
    assert all((a + b) % 2 for a, b in block_links(sets, nodes, sides, 85))
    assert BLOCK_DOCS > 1


def _similar(a, b, percent):
    common = len(np.intersect1d(a, b))
    return 100 * common >= percent * (len(a) + len(b) - common)
