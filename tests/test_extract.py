from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quayside.functions.moments import chunk_bounds, from_micros, to_micros
from quayside.operators import extract
from quayside.sources.idfile import read_id_file

TIMES = ["2024-01-01 00:00:00", "2024-01-01 12:00:00", "2024-01-02 00:00:00", "2024-01-02 00:00:00.000001", None]


@pytest.fixture(params=["string", "timestamp_ntz", "timestamp", "date"])
def timed(request, spark):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(TIMES)], "id int, at string")
    return frame.withColumn("at", F.col("at").cast(request.param)), request.param


def ids(frame):
    return sorted(r["id"] for r in frame.collect())


def test_window_includes_both_ends(timed):
    frame, kind = timed
    found = ids(extract.extract_window(frame, "at", "2024-01-01 00:00:00", "2024-01-02 00:00:00"))
    assert found == ([0, 1, 2, 3] if kind == "date" else [0, 1, 2])
    assert ids(extract.extract_window(frame, "at", start="2024-01-02")) == [2, 3]
    assert ids(extract.extract_window(frame, "at")) == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("base, expected", [("id > 0", [1, 2]), (None, [0, 1, 2]), ("  ", [0, 1, 2]), ("null", [0, 1, 2]), ("id = 9", [])])
def test_base_filter(spark, base, expected):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(TIMES)], "id int, at string")
    assert ids(extract.extract_window(frame, "at", TIMES[0], TIMES[2], base)) == expected


def test_fields_and_pushdown(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT 1 AS id, TIMESTAMP_NTZ '2024-01-01 00:00:00' AS at, 'x' AS unused").write.parquet(path)
    frame = extract.extract_window(spark.read.parquet(path), "at", "2024-01-01", "2024-01-02", "id = 1", ["id"])
    assert frame.columns == ["id"]
    plan = frame._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "GreaterThanOrEqual(at," in plan and "LessThanOrEqual(at," in plan and "EqualTo(id,1)" in plan
    assert "ReadSchema: struct<id:int,at:timestamp_ntz>" in plan


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("chunks", [1, 2, 3, 7, 1000])
def test_chunks_agree_with_their_bounds(spark, zone, chunks):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        start, end = datetime(2024, 3, 9, 1, 2, 3, 4), datetime(2024, 3, 11, 23, 59, 59, 999999)
        bounds = chunk_bounds(start, end, chunks)
        edges = {to_micros(m) + d for b in bounds for m in b for d in (-1, 0, 1)}
        inside = sorted(e for e in edges if to_micros(start) <= e <= to_micros(end))
        frame = spark.createDataFrame([(from_micros(e),) for e in inside], "at timestamp_ntz")
        tagged = extract.with_chunk(frame, "at", start, end, chunks).collect()
        for at, chunk in tagged:
            low, high = bounds[chunk]
            assert low <= at and (at < high or (chunk == chunks - 1 and at == high))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_chunk_bounds():
    bounds = chunk_bounds("2024-01-01", "2024-01-02", 4)
    assert [b[0].hour for b in bounds] == [0, 6, 12, 18]
    assert all(a[1] == b[0] for a, b in zip(bounds, bounds[1:]))
    assert chunk_bounds("2024-01-01", "2024-01-01", 4) == [(datetime(2024, 1, 1),) * 2]
    for bad in (("2024-01-02", "2024-01-01", 1), ("2024-01-01", "2024-01-02", 0)):
        with pytest.raises(ValueError):
            chunk_bounds(*bad)


def test_chunk_arithmetic_of_a_long_window_does_not_overflow(spark):
    frame = spark.sql("SELECT TIMESTAMP_NTZ '9999-12-31 23:59:59' AS at UNION ALL SELECT TIMESTAMP_NTZ '0001-01-01 00:00:00'")
    tagged = extract.with_chunk(frame, "at", "0001-01-01", "9999-12-31 23:59:59", 100_000)
    assert sorted(r["chunk"] for r in tagged.collect()) == [0, 99_999]


def test_chunk_plan(spark):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(TIMES)], "id int, at string")
    plan = extract.chunk_plan(frame, "at", 2)
    assert sorted((r["chunk"] is None, r["chunk"], r["n"]) for r in plan.collect()) == [(False, 0, 2), (False, 1, 2), (True, None, 1)]
    assert extract.chunk_plan(frame.where("false"), "at", 2).collect() == []
    same = frame.where("id = 0")
    assert [(r["chunk"], r["n"]) for r in extract.chunk_plan(same, "at", 3).collect()] == [(0, 1)]


def test_id_file(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("a,b\nc,,a\n d , \n")
    found = read_id_file(spark, str(tmp_path / "ids.txt"))
    assert sorted(r["id"] for r in found.collect()) == ["a", "b", "c", "d"]


def test_a_list_in_one_line_uses_several_tasks(spark, tmp_path):
    (tmp_path / "ids.txt").write_text(",".join(f"key{i:07d}" for i in range(200_000)) + "\r\nlast")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300k")
    try:
        entries = spark.read.option("lineSep", ",").text(str(tmp_path / "ids.txt"))
        assert entries.rdd.getNumPartitions() > 4
        assert read_id_file(spark, str(tmp_path / "ids.txt")).count() == 200_001
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_extract_ids(spark, threshold):
    """Both ways to join: a list that is broadcast and one that is not."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        frame = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z"), (3, "w")], "id bigint, v string")
        keys = spark.createDataFrame([("2",), ("3",), ("9",), ("nonsense",)], "id string")
        assert sorted(r["v"] for r in extract.extract_ids(frame, keys, "id").collect()) == ["w", "y", "z"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_day_begins_at_midnight(spark):
    frame = spark.sql("SELECT explode(sequence(DATE '2024-01-04', DATE '2024-01-07')) AS day")
    found = extract.extract_window(frame, "day", "2024-01-05 12:00:00", "2024-01-06 12:00:00").collect()
    assert [str(r["day"]) for r in found] == ["2024-01-06"]
    found = extract.extract_window(frame, "day", "2024-01-05 00:00:00", "2024-01-06").collect()
    assert [str(r["day"]) for r in found] == ["2024-01-05", "2024-01-06"]


def test_a_frequent_key_is_split_where_the_list_is_long(spark):
    """A third of the records share one key: adaptive execution splits its partition of the shuffle join."""
    settings = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        records = spark.range(0, 300_000, 1, 24).selectExpr("if(id % 3 = 0, 7, id) AS id", "sha2(string(id), 512) AS v")
        keys = spark.range(0, 300_000, 7).selectExpr("string(id) AS id")
        longest = extract.extract_ids(records, keys, "id").selectExpr("count(1) AS n", "max(v) AS v")
        wanted = 100_000 + sum(1 for i in range(0, 300_000, 7) if i % 3 and i != 7)
        assert longest.collect()[0]["n"] == wanted + 1
        assert "skew=true" in longest._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
