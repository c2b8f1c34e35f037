"""ID files: text lines of keys separated by commas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_id_file(spark: SparkSession, path: str, column: str = "id") -> DataFrame:
    """Every distinct key of every line; blanks around a key and empty entries do not count.

    The file is read with a comma as its line end, and entries are cut at real line ends: a list that is one long line
    spreads over as many tasks as a list of many lines.
    """
    entries = spark.read.option("lineSep", ",").text(path)
    entries = entries.select(F.explode(F.split("value", r"\r\n|\r|\n")).alias("entry"))
    keys = entries.select(F.trim("entry").alias(column))
    return keys.where(F.col(column) != "").distinct()
