from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from made_texts import texts
from pyspark.sql import functions as F

from quayside.llm.ppm import asked, adaptive_score, adaptive_scores, folded, ppm_scores
from quayside.llm.ppm_trie import DISCOUNT, END, SYMBOLS, GramTable, code_lengths, grams, levels_of


def trie(learned: list[bytes], order: int):
    """context -> symbol -> count; shorter contexts count each longer one's symbols once."""
    counts: dict = defaultdict(Counter)
    for data in learned:
        symbols = [END] * order + list(data) + [END]
        for at in range(order, len(symbols)):
            counts[tuple(symbols[at - order : at])][symbols[at]] += 1
    for length in range(order - 1, -1, -1):
        for context in [c for c in counts if len(c) == length + 1]:
            for symbol in counts[context]:
                counts[context[1:]][symbol] += 1
    return counts


def brute(data: bytes, counts, order: int) -> float:
    symbols = [END] * order + list(data) + [END]
    total = 0.0
    for at in range(order, len(symbols)):
        excluded: set = set()
        for length in range(order, -1, -1):
            seen = counts.get(tuple(symbols[at - length : at]), {})
            left = {s: c for s, c in seen.items() if s not in excluded}
            weight = sum(left.values())
            if symbols[at] in left:
                total += math.log10((left[symbols[at]] - DISCOUNT) / weight)
                break
            if weight:
                total += math.log10(DISCOUNT * len(left) / weight)
                excluded = set(seen)
        else:
            total -= math.log10(SYMBOLS - len(counts.get((), {})))
    return total


@pytest.mark.parametrize("order", [2, 3, 5])
def test_code_lengths_equal_a_walk_through_the_trie(order):
    rng = random.Random(order)
    learned = ["".join(rng.choice("abc ") for _ in range(rng.randrange(40))).encode() for _ in range(12)]
    counts = trie(learned, order)
    keys, n = np.unique(np.concatenate([grams(d, order) for d in learned]), return_counts=True)
    levels = levels_of(keys, n, order)
    for data in [b"", b"abc", b"cab cab xyz", b"\xff\x00", *learned[:4]]:
        wanted = grams(data, order)
        assert np.isclose(code_lengths(wanted, levels).sum(), brute(data, counts, order))


def test_probabilities_of_all_symbols_sum_to_one():
    learned = [b"abracadabra", b"abba", b"cad"]
    keys, n = np.unique(np.concatenate([grams(d, 3) for d in learned]), return_counts=True)
    levels = levels_of(keys, n, 3)
    for context in (b"abr", b"xab", b"zzz", b"", b"dab"):
        symbols = np.arange(SYMBOLS)
        base = grams(context, 3)[-1] >> 9 << 9
        assert math.isclose((10 ** code_lengths(base | symbols, levels)).sum(), 1, rel_tol=1e-9)


def test_gram_table():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 54, 5000))
    values = rng.random(len(keys))
    wanted = rng.choice(len(keys), 20000)
    assert np.array_equal(GramTable(keys, values).of(keys[wanted]), values[wanted])


def expected(rows, learns, order):
    words = {number: folded(text).split(b" ") if folded(text) else [] for number, text in rows}
    learned = [(n, t) for n, t in rows if learns(n)]
    counts = Counter(w for n, _ in learned for w in [*words[n], b""])
    total, known = sum(counts.values()), len(counts)
    model = trie([folded(t) for _, t in learned], order)
    out = {}
    for number, text in rows:
        own = [*words[number], b""]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (known + 1))) for w in own)
        out[number] = (len(own), sum(counts[w] > 0 for w in own), total, base, brute(folded(text), model, order))
    return out


def is_learned(number):
    return number is not None and zlib.crc32(str(number).encode()) % 10 != 0


def test_scores_equal_brute_force(spark, monkeypatch):
    rows = list(enumerate(texts(5, 25)))
    rows = [(n, t if t is None or len(t) < 5000 else t[:900]) for n, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    learns = F.crc32(F.col("doc_id").cast("string")) % 10 != 0
    found = {r["id"]: r for r in ppm_scores(docs, learns, 4).collect()}
    wanted = expected(rows, is_learned, 4)
    assert found.keys() == wanted.keys()
    for number, (n_tokens, n_known, total, base, score) in wanted.items():
        row = found[number]
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (n_tokens, n_known, total)
        assert math.isclose(row["base_score"], base, rel_tol=1e-9)
        assert math.isclose(row["score"], score, rel_tol=1e-5)
        assert row["learned"] == is_learned(number)


def test_many_blocks_are_merged_in_rounds(spark, monkeypatch):
    monkeypatch.setattr("quayside.llm.ppm.BLOCK_BYTES", 60)
    monkeypatch.setattr("quayside.llm.ppm.MERGED_TOGETHER", 3)
    monkeypatch.setattr("quayside.llm.ppm.LEAST_SHARDS", 2)
    rows = [(i, f"the cat {i % 7} sat on the mat") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = {r["id"]: r for r in ppm_scores(docs, F.col("doc_id") % 3 != 0, 2).collect()}
    for number, (n_tokens, n_known, total, base, score) in expected(rows, lambda n: n % 3 != 0, 2).items():
        row = found[number]
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (n_tokens, n_known, total)
        assert math.isclose(row["base_score"], base, rel_tol=1e-9)
        assert math.isclose(row["score"], score, rel_tol=1e-5)


def test_awkward_documents(awkward, empty):
    rows = ppm_scores(awkward, F.lit(True), 3).collect()
    assert len(rows) == awkward.count() and all(r["score"] < 0 and r["n_known"] == r["n_tokens"] for r in rows)
    assert ppm_scores(empty, F.lit(True)).count() == 0


def test_nothing_to_learn_from(awkward):
    rows = ppm_scores(awkward, F.lit(None).cast("boolean"), 3).collect()
    for row in rows:
        assert row["n_known"] == 0 and row["train_tokens"] == 0 and math.isfinite(row["base_score"])


def test_adaptive_scores(spark):
    rng = random.Random(1)
    repeated, random_ = "abcabcabc" * 20, "".join(rng.choice("abcdefgh") for _ in range(180))
    docs = spark.createDataFrame([(1, repeated), (2, random_), (3, None)], "doc_id int, text string")
    found = {r["doc_id"]: r["score"] for r in adaptive_scores(docs).collect()}
    assert found[1] > found[2] / 4 and math.isclose(found[3], -math.log10(SYMBOLS))
    assert math.isclose(adaptive_score(b"aa", 2), _adaptive_aa())


def _adaptive_aa():
    # a: unseen; a again: order 0 has a once, order 1 context a is new; end: order 1 knows a, order 0 has nothing else
    return -math.log10(SYMBOLS) + math.log10(1 - DISCOUNT) + math.log10(DISCOUNT) - math.log10(SYMBOLS - 1)


def test_a_shard_of_the_model_is_sent_once_whatever_the_blocks(spark):
    """Rows on their way to Python: as many as there are pieces and shards, not their product."""
    model = spark.range(6).selectExpr(
        "CAST(id % 2 AS int) AS kind", "CAST(id AS int) AS shard", "X'01' AS model_keys", "X'02' AS numbers"
    )
    for blocks in (1, 7, 50):
        pieces = spark.range(6 * blocks).selectExpr(
            "id % 6 % 2 AS kind", "CAST(id % 6 AS int) AS shard", "id div 6 AS block", "X'03' AS keys", "X'04' AS counts"
        )
        rows = asked(pieces, model)
        assert rows.count() == 6 + 6 * blocks and "Join" not in rows._jdf.queryExecution().toString()
        order = rows.select("shard", "model_keys", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
        first = {}
        for r in sorted(order.collect(), key=lambda r: r["at"]):
            first.setdefault(r["shard"], r["model_keys"])
        assert all(keys is not None for keys in first.values())
