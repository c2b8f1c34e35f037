"""A corpus from raw documents: stages that each take what their predecessor kept, by way of Parquet.

Toxic documents go, then lines found in many documents, then near copies; the rest is mixed to source weights and
encoded. All stages but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import stored
from quayside.llm.linededup import line_bitmaps, without_lines
from quayside.llm.mixing import mixed, taken
from quayside.llm.neardup import without_near_duplicates
from quayside.llm.pieces import encoded
from quayside.llm.toxicity import chain_of, without_toxic

TOXIC_FROM = 0.5
MIN_LINE_DOCS = 10
NEAR_PERCENT = 80
SOURCE_WEIGHTS = [3, 1, 2]
MIX_BUDGET = 1.5


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not call toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return without_toxic(docs, chain_of(docs, labels), TOXIC_FROM)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many of them hold; the number of characters follows the text."""
    lines = without_lines(docs, line_bitmaps(docs, MIN_LINE_DOCS))
    changed = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast("long")}
    fields = []
    for name in docs.columns:
        value = F.col("row")[name]
        if name in changed:
            value = F.when(F.col("n_dropped") > 0, changed[name]).otherwise(value)
        fields.append(value.alias(name))
    return lines.select(*fields)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id."""
    return without_near_duplicates(docs, NEAR_PERCENT)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return taken(docs, mixed(docs, SOURCE_WEIGHTS, MIX_BUDGET))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document that the mix takes, and a digest of the text they decode to."""
    pieces = encoded(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return pieces.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("sentencepiece", sentencepiece),
]

# The classifier, the Newton iterations and the encoding cannot be written in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each one's rows written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
