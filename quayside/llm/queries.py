"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import oracles
from quayside.llm.common import documents
from quayside.llm.forest import near_vectors
from quayside.llm.licenses import PHRASES, license_scan
from quayside.llm.linededup import line_bitmaps, without_lines
from quayside.llm.linequality import line_quality
from quayside.llm.mixing import mixed
from quayside.llm.neardup import near_duplicates
from quayside.llm.pieces import encoded
from quayside.llm.ppm import ppm_scores
from quayside.llm.repair import digests, repaired
from quayside.llm.tokencounts import token_attribution
from quayside.llm.topk import top_k
from quayside.llm.toxicity import chain_of, scored
from quayside.llm.whitening import whitened

MIN_LINE_DOCS = 10
MIN_WORDS = 50
TOXIC_FROM = 0.5
SOURCE_WEIGHTS = [3, 1, 2]
MIX_BUDGET = 1.5
NEAR_PERCENT = 85
COMPONENTS = 16
NEAR_COSINE = 0.9


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    chain = chain_of(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    probabilities = [F.col(c).alias(f"p_{c}") for c in chain.categories]
    return scored(docs, chain).select("doc_id", *probabilities, (F.col("toxic") >= TOXIC_FROM).alias("toxic"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    kept = without_lines(docs, line_bitmaps(docs, MIN_LINE_DOCS))
    return kept.select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256")
    )


def op3_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixed(documents(spark, sf_dir), SOURCE_WEIGHTS, MIX_BUDGET)
    return plan.select(
        F.col("id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "copies",
    )


def op4_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    learns = F.crc32(F.col("doc_id").cast("string")) % 10 != 0
    scores = ppm_scores(documents(spark, sf_dir), learns)
    return scores.select(
        F.col("id").alias("doc_id"),
        (~F.col("learned")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = encoded(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
    return pieces.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op6_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return line_quality(documents(spark, sf_dir)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & F.col("accepted")).alias("kept"),
        "n_lost_words",
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = license_scan(documents(spark, sf_dir))
    phrases = [F.lit(p.words) for p in PHRASES]
    base = F.filter("places", lambda p: p["notice"].isin(*phrases))
    starts = F.transform(base, lambda p: p["word"])
    similarity = F.transform("places", lambda p: 1 - p["edits"] / F.char_length(p["notice"]))

    def labels(places):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")

    return scanned.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(similarity), F.lit(0.0)).alias("score"),
    )


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir), NEAR_PERCENT)
    return found.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document and of its paragraphs; a token that crosses belongs to the one with its first character."""
    counted = token_attribution(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return counted.select(
        "doc_id",
        "n_tokens",
        "n_crossing",
        F.size("sections").cast("long").alias("n_sections"),
        F.transform("sections", lambda s: s["n_tokens"].cast("long")).alias("section_tokens"),
    )


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, F.col("vec_id") % 50 == 0, 5).drop("score_text")


def op11_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), NEAR_COSINE)
    return found.select(
        F.col("id").alias("vec_id"),
        "n_links",
        "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with the faults that op12 repairs, put in by a hash of conversation and turn."""
    conv, turn, role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text"))
    damage = F.crc32(F.concat_ws(":", conv, turn)) % 20
    copies = F.when(damage == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return conversations.where(damage != 0).select(
        "conv_id",
        "turn",
        F.when(damage == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(damage == 1, F.lit("")).when(damage == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(copies).alias("copy"),
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    repair = repaired(damaged(conversations))
    found = repair.conversations.withColumnRenamed("conv", "found_conv")
    digested = digests(repair.turns).withColumnRenamed("conv", "digest_conv")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return (
        conversations.select("conv_id")
        .distinct()
        .join(found, F.col("conv_id").eqNullSafe(F.col("found_conv")), "left")
        .join(digested, F.col("conv_id").eqNullSafe(F.col("digest_conv")), "left")
        .select(
            "conv_id",
            *counts,
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
    )


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), COMPONENTS)
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_line_dedup,
        op3_entropy_mix,
        op4_ppm_scores,
        op5_sentencepiece,
        op6_line_quality,
        op7_license_scan,
        op8_near_duplicates,
        op9_token_counts,
        op10_exact_top_k,
        op11_embedding_near_duplicates,
        op12_conversation_repair,
        op13_embedding_whitening,
    )
}

# The other operators are not expressible in SQL; the tests hold them against brute force.
ORACLES = {
    "op2_line_dedup": oracles.LINE_DEDUP,
    "op6_line_quality": oracles.LINE_QUALITY,
    "op8_near_duplicates": oracles.NEAR_DUPLICATES,
    "op10_exact_top_k": oracles.TOP_K,
    "op11_embedding_near_duplicates": oracles.NEAR_VECTORS,
    "op12_conversation_repair": oracles.CONVERSATION_REPAIR,
}
