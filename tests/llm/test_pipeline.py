from __future__ import annotations

import hashlib
import random
import struct
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from test_linededup import brute as brute_lines
from test_mixing import brute_targets, size_of
from test_neardup import brute as brute_near
from test_toxicity import corpus

import corpus_pipeline as pipeline
from __spark_entry__ import oracle_sql, queries
from quayside.llm.toxicity import chain_of


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables as the pipeline reads them, with toxic documents, shared lines, copies, nulls and repeated rows."""
    path = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(20)
    rows, labels = [], []
    for number, text, toxic in corpus(21, 150):
        lines = [text] + (["A line that is in many documents."] if number % 3 == 0 else [])
        rows.append([number, "\n".join(lines), "en", f"src{number % 5}"])
        labels.append((number, 1, toxic))
    for number in range(0, 60, 4):
        words = rows[number][1].split(" ")
        words[rng.randrange(len(words))] = "else"
        rows.append([1000 + number, " ".join(words), "en", "src0"])
    rows += [[2000, None, None, None], [2001, "", "en", "src1"], [2002, " \n ", "en", None], rows[4], rows[4]]
    rows = [(*r, None if r[1] is None else len(r[1])) for r in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_the_whole_pipeline_by_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    chain = chain_of(docs, labels)
    rows = [r for r in docs.collect() if chain.probabilities(r["text"] or "")[-1] < 0.5]
    lines = brute_lines([(r["doc_id"], r["text"]) for r in rows], 10, False)
    kept = {number: text for number, _, _, text in lines}
    source = {r["doc_id"]: r["source"] for r in rows}
    alive = sorted({c for _, _, c in brute_near(list(kept.items()), 80)})
    sizes = defaultdict(int)
    for number in alive:
        sizes[source[number]] += size_of(kept[number])
    targets = brute_targets(sizes, [3, 1, 2], 1.5)
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    taken = defaultdict(int)
    copies = Counter()
    for row in pipeline.run(spark, folder).collect():
        number = row["doc_id"]
        ids = library.encode(kept[number], add_bos=True, add_eos=True)
        assert bytes(row["ids"]) == struct.pack(f"<{len(ids)}I", *ids) and row["n_tokens"] == len(ids)
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
        taken[source[number]] += size_of(kept[number])
        copies[number] += 1
    assert set(copies) <= set(alive) and max(copies.values()) <= 2
    for name, target in targets.items():
        assert abs(taken[name] - target) <= max(size_of(kept[n]) for n in alive if source[n] == name)


def test_stages_keep_the_columns_of_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).schema.simpleString() == docs.schema.simpleString()


def test_clean_documents_stay(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{folder}/labels.parquet").where("toxic = 1").collect()}
    kept = Counter(r["doc_id"] for r in pipeline.toxicity(spark, docs, folder).collect())
    lost = {r["doc_id"] for r in docs.collect()} - set(kept)
    assert len(lost - toxic) <= 15  # the changed copies of toxic documents have no label
    assert len(toxic & set(kept)) <= 2


def test_stages_of_an_empty_table(spark, folder):
    nothing = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, nothing, folder).count() == 0


def test_registered():
    names = list(queries())
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14)) and "pipeline" in names
    assert "pipeline" not in oracle_sql() and pipeline.ORACLE_SQL is None
