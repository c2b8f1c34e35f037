"""Counts about a run, blank values and distinct keys, and the audit table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.names import quoted
from quayside.sources.contract import Contract

TEXT_KINDS = ("string", "enum", "symbol", "bytes")


def blank_profile(aligned: DataFrame, names: Sequence[str]) -> DataFrame:
    """Blank (null, absent or empty) values per field, in one pass without a shuffle of rows."""
    entries = [
        F.struct(F.lit(n).alias("field"), F.count_if(F.col(quoted(n)) == "").alias("blanks")) for n in names
    ]
    return aligned.agg(F.array(*entries).alias("found")).select(F.inline("found"))


def default_ambiguous(contract: Contract) -> list[str]:
    """Required fields whose default can be mistaken for data; their blanks are worth counting."""
    return [f.name for f in contract.fields if not f.nullable and f.kind not in TEXT_KINDS]


def unique_keys(typed: DataFrame, key_col: str) -> int:
    """Exact number of distinct keys. Equal keys are merged before the shuffle, so a frequent key costs nothing."""
    return typed.agg(F.count_distinct(F.col(quoted(key_col)))).first()[0]


AUDIT_SCHEMA = """
    table_name string, run_partition string, extract_mode string, started_at timestamp, elapsed_ms bigint,
    expected bigint, landed bigint, processed bigint, unique_keys bigint, error_rows bigint, malformed bigint,
    missing_fields array<string>, blanks map<string, bigint>,
    ranges array<struct<range_id: int, low: string, high: string, records: bigint, requests: bigint, fingerprint: string>>,
    fingerprint string
"""


def audit_dir(output_dir: str) -> str:
    return f"{output_dir.rstrip('/')}/logs/runs"


def append_audit(report: DataFrame, output_dir: str, run_date: date, run_id: str) -> None:
    """Add a run report to the audit table: a folder for the day, below it one for the run.

    Runs that end at the same time write to folders of their own and cannot disturb each other.
    """
    path = f"{audit_dir(output_dir)}/run_date={run_date:%Y%m%d}/run_id={run_id}"
    report.coalesce(1).write.mode("errorifexists").parquet(path)


def read_audit(spark: SparkSession, output_dir: str) -> DataFrame:
    return spark.read.schema(f"{AUDIT_SCHEMA}, run_date string, run_id string").parquet(audit_dir(output_dir))
