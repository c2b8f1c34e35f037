from __future__ import annotations

import pytest
from made_texts import CLASHING, texts


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with every kind of trouble, and extra columns whose names operators use themselves."""
    rows = [(i, text, "en", f"src{i % 4}" if i % 7 else None) for i, text in enumerate(texts(3, 40))]
    rows += [rows[0], rows[0], rows[5]]
    clashing = ", ".join(f"`{name}` string" for name in CLASHING)
    rows = [(*row, None if row[1] is None else len(row[1]), *CLASHING) for row in rows]
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {clashing}"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
