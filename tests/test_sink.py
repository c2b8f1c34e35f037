from __future__ import annotations

import json
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from quayside.functions.names import name_list
from quayside.operators import retention, sink
from quayside.sources.contract import parse_contract
from quayside.sources.landing import as_lines, land, landing_dir
from quayside.sources.storage import list_directories, scratch_path, shared_dir

CONTRACT = parse_contract(
    json.dumps(
        {
            "type": "record",
            "name": "thing",
            "namespace": "some.space",
            "fields": [
                {"name": "id", "type": "long"},
                {"name": "code", "type": "string"},
                {"name": "at", "type": ["null", {"type": "long", "logicalType": "timestamp-millis"}]},
            ],
        }
    )
)
ROWS = "SELECT id, CAST(id % 3 AS string) AS code, timestamp_seconds(id) AS at FROM range({n})"


@pytest.mark.parametrize("fmt", ["parquet", "avro"])
@pytest.mark.parametrize("partition_by", [[], ["code"]])
def test_round_trip_and_rerun(spark, tmp_path, fmt, partition_by):
    path = sink.table_dir(str(tmp_path), "thing", "20240101")
    other = sink.table_dir(str(tmp_path), "thing", "20240102")
    sink.write_partition(spark.sql(ROWS.format(n=5)), other, partition_by, fmt, CONTRACT)
    for n in (20, 10, 10):
        rows = spark.sql(ROWS.format(n=n))
        sink.write_partition(sink.clustered(rows, partition_by) if partition_by else rows, path, partition_by, fmt, CONTRACT)
        written = sink.read_partition(spark, path, CONTRACT, fmt)
        assert written.schema.simpleString() == "struct<id:bigint,code:string,at:timestamp>"
        assert sorted(written.collect()) == sorted(rows.collect())
    assert sink.read_partition(spark, other, CONTRACT, fmt).count() == 5
    assert list_directories(spark, path) == [f"code={i}" for i in range(3) if partition_by]


def test_avro_takes_the_contract_name(spark, tmp_path):
    path = str(tmp_path / "t")
    sink.write_partition(spark.sql(ROWS.format(n=1)).coalesce(1), path, [], "avro", CONTRACT)
    header = next((tmp_path / "t").glob("part-*")).read_bytes()[:600]
    assert b'"name":"thing"' in header and b'"namespace":"some.space"' in header


def test_an_unknown_sub_partition_is_refused(spark, tmp_path):
    with pytest.raises(Exception, match="nothere"):
        sink.write_partition(spark.sql(ROWS.format(n=1)), str(tmp_path / "t"), ["nothere"])


def test_blank_sub_partition_reads_back_as_null(spark, tmp_path):
    rows = spark.sql("SELECT 1L AS id, '' AS code, CAST(NULL AS timestamp) AS at")
    sink.write_partition(rows, str(tmp_path / "t"), ["code"])
    assert sink.read_partition(spark, str(tmp_path / "t"), CONTRACT).first()["code"] is None


@pytest.mark.parametrize("spec, expected", [("", []), ("a", ["a"]), ("a,,b, ", ["a", "b"]), (["a", ""], ["a"])])
def test_name_list(spec, expected):
    assert name_list(spec) == expected


def test_clustering_makes_few_files_and_splits_a_hot_value(spark, tmp_path):
    rows = spark.range(0, 300_000, 1, 50).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 7).otherwise(99).cast("string").alias("code"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        rows.write.partitionBy("code").parquet(str(tmp_path / "plain"))
        sink.write_partition(sink.clustered(rows, ["code"]), str(tmp_path / "clustered"), ["code"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = lambda name, code="*": len(list((tmp_path / name).glob(f"code={code}/part-*")))
    assert files("plain") == 8 * 50
    assert 4 * files("clustered") < files("plain")
    assert files("clustered", "99") > 1
    assert spark.read.parquet(str(tmp_path / "clustered")).count() == 300_000


def test_landing_round_trip(spark, tmp_path):
    records = spark.sql(
        """SELECT 1 AS `a b`, 'line\\nbreak "q"' AS t, CAST(NULL AS string) AS gone, DATE '2024-01-02' AS d,
        TIMESTAMP_NTZ '2024-01-02 03:04:05.1234' AS l, TIMESTAMP '2024-01-02 03:04:05.000001Z' AS z, 1.50D AS x,
        CAST(1.50 AS decimal(9,4)) AS y, X'0102FF' AS b, double('-Infinity') AS i, named_struct('n', 1.50D) AS s"""
    )
    path = landing_dir(str(tmp_path), "thing", date(2024, 1, 2))
    assert path.endswith("/json/thing_20240102")
    for _ in range(2):
        land(as_lines(records), path)
    assert [json.loads(r["value"]) for r in spark.read.text(path).collect()] == [
        {
            "a b": "1", "t": 'line\nbreak "q"', "d": "2024-01-02", "l": "2024-01-02 03:04:05.1234",
            "z": "2024-01-02 03:04:05.000001", "x": "1.5", "y": "1.5000", "b": "data:;base64,AQL/", "i": "-Infinity",
            "s": {"n": 1.5},
        }
    ]


RUN = date(2024, 3, 10)


@pytest.fixture
def landings(tmp_path):
    for age in (0, 1, 2, 3, 4, 10):
        (tmp_path / "json" / f"thing_{RUN - timedelta(days=age):%Y%m%d}").mkdir(parents=True)
    for other in ("thing_else_20240307", "things_20240307", "thing_2024", "other_20240307"):
        (tmp_path / "json" / other).mkdir()
    return str(tmp_path)


@pytest.mark.parametrize("mode, gone", [("exact", ["20240307"]), ("sweep", ["20240229", "20240306", "20240307"])])
def test_retention(spark, landings, mode, gone):
    assert retention.apply_retention(spark, landings, "thing", RUN, 3, mode) == gone
    left = list_directories(spark, f"{landings}/json")
    assert len(left) == 10 - len(gone) and not {f"thing_{d}" for d in gone} & set(left)
    assert retention.apply_retention(spark, landings, "thing", RUN, 3, mode) == []


def test_retention_plan(spark):
    days = spark.createDataFrame([(RUN - timedelta(days=a),) for a in (-1, 0, 2, 3, 4)], "dt date")
    plan = [r["action"] for r in retention.retention_plan(days, RUN, 3).orderBy("dt").collect()]
    assert plan == ["drop_sweep_only", "drop_exact", "keep", "overwrite", "keep"]


def test_retention_of_nothing(spark, tmp_path):
    assert retention.apply_retention(spark, str(tmp_path / "nowhere"), "t", RUN, 3) == []
    with pytest.raises(ValueError):
        retention.apply_retention(spark, str(tmp_path), "t", RUN, 3, "never")


def test_scratch_is_in_the_folder_the_session_names(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark) + "/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
