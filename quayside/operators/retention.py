"""Retention of raw landings."""

from __future__ import annotations

import re
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.sources.storage import delete_directory, list_directories

EXACT = "exact"
SWEEP = "sweep"
RETENTION_MODES = (EXACT, SWEEP)

DROP_EXACT = "drop_exact"
DROP_SWEEP_ONLY = "drop_sweep_only"
OVERWRITE = "overwrite"
KEEP = "keep"


def retention_plan(days: DataFrame, run_date: date, days_to_keep: int, day_col: str = "dt") -> DataFrame:
    """What happens to the landing of each day (`dt` as yyyyMMdd, `action`).

    The landing dated exactly `days_to_keep` days before the run is dropped; older ones only by a sweep. The landing of
    the run date itself is overwritten.
    """
    age = F.datediff(F.lit(run_date), F.col(day_col))
    action = (
        F.when(age == days_to_keep, DROP_EXACT)
        .when(age > days_to_keep, DROP_SWEEP_ONLY)
        .when(age == 0, OVERWRITE)
        .otherwise(KEEP)
    )
    return days.select(F.date_format(day_col, "yyyyMMdd").alias("dt"), action.alias("action"))


def landed_days(spark: SparkSession, output_dir: str, table: str) -> list[date]:
    """Run dates a table has landings of."""
    form = re.compile(re.escape(table) + r"_(\d{8})")
    names = (form.fullmatch(n) for n in list_directories(spark, f"{output_dir.rstrip('/')}/json"))
    return [datetime.strptime(m[1], "%Y%m%d").date() for m in names if m]


def apply_retention(
    spark: SparkSession, output_dir: str, table: str, run_date: date, days_to_keep: int, mode: str = EXACT
) -> list[str]:
    """Delete expired landings of a table and return their dates."""
    if mode not in RETENTION_MODES:
        raise ValueError(f"retention is one of {', '.join(RETENTION_MODES)}, not {mode!r}")
    days = landed_days(spark, output_dir, table)
    if not days:
        return []
    wanted = [DROP_EXACT] if mode == EXACT else [DROP_EXACT, DROP_SWEEP_ONLY]
    frame = spark.createDataFrame([(d,) for d in days], "dt date")
    plan = retention_plan(frame, run_date, days_to_keep).where(F.col("action").isin(wanted))
    expired = sorted(r["dt"] for r in plan.collect())
    return [d for d in expired if delete_directory(spark, f"{output_dir.rstrip('/')}/json/{table}_{d}")]
