"""Run every query next to its SQL: `python tests/check_oracles.py [sf_dir] [query ...]`."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import oracle_sql, queries  # noqa: E402

TABLES = "events orders documents embeddings pages benchmark labels conversations"


def duckdb_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for name in TABLES.split():
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return normalised(names, result.fetchall())


def normalised(names: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark, sf_dir: str, name: str) -> tuple[bool, int, float]:
    began = time.monotonic()
    df = queries()[name](spark, sf_dir)
    spark_rows = normalised(df.columns, [tuple(r) for r in df.collect()])
    took = time.monotonic() - began
    return spark_rows == duckdb_rows(sf_dir, oracle_sql()[name]), len(spark_rows[1]), took


if __name__ == "__main__":
    from conftest import session

    spark = session()
    directory = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    for query in sys.argv[2:] or queries():
        same, rows, seconds = compare(spark, directory, query)
        print(f"{'ok  ' if same else 'DIFF'} {query:20s} {rows:8d} rows {seconds:6.2f} s", flush=True)
