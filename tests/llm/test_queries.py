from __future__ import annotations

import pytest
from check_oracles import compare

from quayside.llm import queries as llm

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(llm.ORACLES))
def test_query_equals_its_sql(spark, name):
    same, rows, _ = compare(spark, SMALL, name)
    assert same and rows


@pytest.mark.parametrize("name", [n for n in llm.QUERIES if n not in llm.ORACLES and "embedding" not in n])
def test_query_answers_every_document(spark, name):
    frame = llm.QUERIES[name](spark, SMALL)
    rows = [r["doc_id"] for r in frame.select("doc_id").collect()]
    assert sorted(rows) == [r["doc_id"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()]
