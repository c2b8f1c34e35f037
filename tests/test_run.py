from __future__ import annotations

import json
from dataclasses import replace
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_paged import list_service

from quayside import IngestParams, LandedLines, parse_contract, run
from quayside.operators import audit, sink
from quayside.plans import ingest
from quayside.sources.storage import list_directories

CONTRACT = parse_contract(
    json.dumps(
        {
            "type": "record",
            "name": "thing",
            "fields": [
                {"name": "key", "type": "string"},
                {"name": "v", "type": "int"},
                {"name": "kind", "type": "string"},
                {"name": "missing", "type": ["null", "string"]},
            ],
        }
    )
)


def source_rows(n):
    return [
        {
            "key": f"{i:05d}",
            "at": f"2024-01-0{1 + i % 3} 0{i % 10}:00:00",
            "v": "bad" if i % 10 == 3 else "" if i % 10 == 4 else str(i),
            "kind": "ab"[i % 2],
        }
        for i in range(n)
    ]


def expected_rows(rows):
    out = []
    for r in rows:
        bad = r["v"] == "bad"
        out.append((r["key"], 0 if bad or not r["v"] else int(r["v"]), "" if bad else r["kind"], None))
    return sorted(out)


@pytest.fixture
def params(tmp_path):
    return IngestParams(
        table="thing",
        run_partition="20240103",
        output_dir=str(tmp_path / "out"),
        key_col="key",
        updated_col="at",
        window_start="2024-01-01",
        window_end="2024-01-03 09:00:00",
        num_chunks=3,
        page_size=10,
        run_date=date(2024, 1, 4),
    )


@pytest.fixture(params=["table", "service"])
def make_source(request, spark):
    def make(rows):
        if request.param == "service":
            return list_service(rows)
        return spark.createDataFrame([tuple(r.values()) for r in rows], "key string, at string, v string, kind string")

    return make


def typed(spark, result, fmt="parquet"):
    return sorted(tuple(r) for r in sink.read_partition(spark, result.typed_path, CONTRACT, fmt).collect())


def test_run(spark, make_source, params):
    rows = source_rows(100)
    params = replace(params, partition_by="kind")
    result = run(spark, make_source(rows), CONTRACT, params)
    assert result.audit_error is None
    report = result.report
    counts = {k: report[k] for k in ("expected", "landed", "processed", "unique_keys", "error_rows", "malformed")}
    assert counts == {
        "expected": 100, "landed": 100, "processed": 100, "unique_keys": 100, "error_rows": 10, "malformed": 0,
    }
    assert report["missing_fields"] == ["missing"]
    assert report["blanks"] == {"v": 10}
    assert [r[:4] for r in report["ranges"]] == [
        (0, "2024-01-01 00:00:00", "2024-01-01 19:00:00", 34),
        (1, "2024-01-01 19:00:00", "2024-01-02 14:00:00", 33),
        (2, "2024-01-02 14:00:00", "2024-01-03 09:00:00", 33),
    ]

    partial = [(k, v, kind or None, m) for k, v, kind, m in expected_rows(rows)]
    assert typed(spark, result) == partial
    assert list_directories(spark, result.typed_path) == ["kind=__HIVE_DEFAULT_PARTITION__", "kind=a", "kind=b"]
    quarantined = spark.read.parquet(result.quarantine_path)
    assert quarantined.count() == 10
    assert quarantined.where("v = 'bad' AND kind IN ('a', 'b') AND missing = '' AND _raw IS NULL").count() == 10
    assert spark.read.text(result.raw_path).count() == 100

    row = audit.read_audit(spark, params.output_dir).first()
    assert (row["table_name"], row["processed"], row["run_date"]) == ("thing", 100, "20240104")
    assert row["blanks"] == {"v": 10} and len(row["ranges"]) == 3 and row["elapsed_ms"] > 0


def test_rerun_gives_the_same_and_leaves_other_partitions(spark, make_source, params):
    rows = source_rows(40)
    other = run(spark, make_source(rows[:7]), CONTRACT, replace(params, run_partition="20240102"))
    first = run(spark, make_source(rows), CONTRACT, params)
    before = typed(spark, first), spark.read.parquet(first.quarantine_path).count()
    second = run(spark, make_source(rows), CONTRACT, params)
    assert (typed(spark, second), spark.read.parquet(second.quarantine_path).count()) == before
    assert len(typed(spark, other)) == 7
    assert audit.read_audit(spark, params.output_dir).count() == 3


def test_a_good_rerun_empties_the_quarantine(spark, make_source, params):
    run(spark, make_source(source_rows(20)), CONTRACT, params)
    good = [r | {"v": "1"} for r in source_rows(20)]
    result = run(spark, make_source(good), CONTRACT, params)
    assert result.report["error_rows"] == 0
    assert spark.read.schema(CONTRACT.text_schema).parquet(result.quarantine_path).count() == 0


def test_few_failed_rows_make_few_files(spark, params, tmp_path):
    frame = spark.range(0, 4000, 1, 40).selectExpr(
        "lpad(string(id), 5, '0') AS key", "'2024-01-01 00:00:00' AS at", "if(id % 100 = 0, 'bad', '1') AS v", "'a' AS kind"
    )
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        result = run(spark, frame, CONTRACT, params)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    files = lambda path: len([f for f in Path(path.removeprefix("file:")).glob("part-*")])
    assert files(result.typed_path) >= 8
    assert result.report["error_rows"] == 40 and files(result.quarantine_path) == 1


@pytest.mark.parametrize("partition_by", ["", "kind"])
def test_no_records(spark, make_source, params, partition_by):
    window = replace(params, window_start="2030-01-01", window_end="2030-01-02", partition_by=partition_by)
    result = run(spark, make_source(source_rows(5)), CONTRACT, window)
    assert (result.report["expected"], result.report["processed"], result.report["unique_keys"]) == (0, 0, 0)
    assert typed(spark, result) == []


def test_window_filter_and_fields(spark, params):
    rows = source_rows(60)
    frame = spark.createDataFrame([tuple(r.values()) for r in rows], "key string, at string, v string, kind string")
    some = replace(params, window_end="2024-01-01 23:59:59", base_filter="kind = 'a'", fields="key,kind")
    result = run(spark, frame, CONTRACT, some)
    wanted = [r for r in rows if r["at"] < "2024-01-02" and r["kind"] == "a"]
    assert typed(spark, result) == [(r["key"], 0, "a", None) for r in wanted]
    assert result.report["missing_fields"] == ["v", "missing"]


def test_spellings_of_a_service(spark, params):
    """A service that spells a field in two ways: both are read."""
    rows = source_rows(30)
    for i, r in enumerate(rows):
        if i % 3 == 0:
            r["KIND"] = r.pop("kind")
    result = run(spark, list_service(rows), CONTRACT, params)
    assert typed(spark, result) == expected_rows(source_rows(30))
    assert result.report["missing_fields"] == ["missing"]


def test_open_window(spark, params):
    frame = spark.createDataFrame([tuple(r.values()) for r in source_rows(30)], "key string, at string, v string, kind string")
    frame = frame.union(spark.sql("SELECT 'z', CAST(NULL AS string), '1', 'a'"))
    result = run(spark, frame, CONTRACT, replace(params, window_start=None, window_end=None))
    assert result.report["expected"] == result.report["processed"] == 31


def test_offsets(spark, make_source, params):
    rows = source_rows(95)
    result = run(spark, make_source(rows), CONTRACT, replace(params, extract_mode="offsets", num_chunks=4))
    assert typed(spark, result) == expected_rows(rows)
    assert result.report["expected"] == 95
    assert [r[:2] for r in result.report["ranges"]] == [(0, "0"), (1, "24"), (2, "48"), (3, "72")]
    assert sum(r[3] for r in result.report["ranges"]) == 95


def test_a_shortfall_leaves_the_old_partition(spark, params):
    """A service that counts more than it gives: the run fails before anything is replaced."""
    frame_rows = source_rows(20)
    first = run(spark, list_service(frame_rows), CONTRACT, params)
    before = typed(spark, first)
    plain = list_service(source_rows(10))
    lying = type(plain)(plain.fetch, lambda request: plain.count(request) + 1 if request.limit else 0)
    with pytest.raises(RuntimeError, match="landed"):
        run(spark, lying, CONTRACT, replace(params, num_chunks=1))
    assert typed(spark, first) == before
    assert run(spark, lying, CONTRACT, replace(params, num_chunks=1, on_mismatch="report")).report["landed"] == 10


def test_a_failed_write_leaves_the_old_partition(spark, make_source, params, monkeypatch):
    first = run(spark, make_source(source_rows(20)), CONTRACT, params)
    before = typed(spark, first)

    def refuse(*_):
        raise OSError("no space")

    monkeypatch.setattr(ingest, "_write_quarantine", refuse)
    with pytest.raises(OSError, match="no space"):
        run(spark, make_source(source_rows(5)), CONTRACT, params)
    assert typed(spark, first) == before
    assert list_directories(spark, f"{params.output_dir}/thing") == ["dt=" + params.run_partition]


@pytest.mark.parametrize("fails_at", [1, 2, 3, 4])
@pytest.mark.parametrize("lost_driver", [False, True])
def test_a_failure_within_the_commit_leaves_both_old_tables(spark, make_source, params, monkeypatch, fails_at, lost_driver):
    first = run(spark, make_source(source_rows(20)), CONTRACT, params)
    journal = sink.journal_path(params.output_dir, params.table, params.run_partition)
    plain, calls = sink._rename, []

    def tables():
        paths = [sink.resolved(spark, path, journal) for path in (first.typed_path, first.quarantine_path)]
        return [spark.read.parquet(path).count() for path in paths]

    before = tables()

    def rename(session, source, target):
        calls.append(target)
        if len(calls) == fails_at:
            assert tables() == before  # what a reader sees meanwhile
            raise OSError("gone")
        plain(session, source, target)

    with monkeypatch.context() as patched:
        patched.setattr(sink, "_rename", rename)
        if lost_driver:  # nobody is left to undo anything
            patched.setattr(sink, "recover", lambda *_: None)
        with pytest.raises(OSError, match="gone"):
            run(spark, make_source(source_rows(33)), CONTRACT, params)
        assert tables() == before
    sink.recover(spark, journal)
    assert typed(spark, first) == expected_rows(source_rows(20)) and tables() == before
    assert list_directories(spark, f"{params.output_dir}/thing") == ["dt=" + params.run_partition]
    again = run(spark, make_source(source_rows(33)), CONTRACT, params)
    assert len(typed(spark, again)) == 33 and tables() == [33, 3]


def test_a_first_commit_that_fails_leaves_nothing(spark, make_source, params, monkeypatch):
    plain, calls = sink._rename, []

    def rename(session, source, target):
        calls.append(target)
        if len(calls) == 2:
            raise OSError("gone")
        plain(session, source, target)

    with monkeypatch.context() as patched:
        patched.setattr(sink, "_rename", rename)
        with pytest.raises(OSError, match="gone"):
            run(spark, make_source(source_rows(5)), CONTRACT, params)
    journal = sink.journal_path(params.output_dir, params.table, params.run_partition)
    assert sink.resolved(spark, sink.table_dir(params.output_dir, "thing", params.run_partition), journal) is None
    assert list_directories(spark, f"{params.output_dir}/thing") == []


def test_a_journal_that_was_cut_off_moved_nothing(spark, make_source, params):
    first = run(spark, make_source(source_rows(5)), CONTRACT, params)
    journal = Path(sink.journal_path(params.output_dir, params.table, params.run_partition))
    journal.write_text('{"moves": [{"path": "')
    assert sink.resolved(spark, first.typed_path, str(journal)) == first.typed_path
    assert len(typed(spark, run(spark, make_source(source_rows(6)), CONTRACT, params))) == 6
    assert not journal.exists()


def test_the_landing_is_parsed_once(spark, make_source, params, monkeypatch):
    """Both tables and all counts come from what one parse of the landing staged."""
    parsed, written = [], []
    read, typed_write, quarantine_write = ingest.align.read_aligned, ingest._write_typed, ingest._write_quarantine
    monkeypatch.setattr(ingest.align, "read_aligned", lambda *a, **k: parsed.append(a[1]) or read(*a, **k))
    monkeypatch.setattr(ingest, "_write_typed", lambda rows, *a: written.append(rows.inputFiles()) or typed_write(rows, *a))
    monkeypatch.setattr(ingest, "_write_quarantine", lambda rows, *a: written.append(rows.inputFiles()) or quarantine_write(rows, *a))
    result = run(spark, make_source(source_rows(50)), CONTRACT, params)
    assert result.report["error_rows"] == 5
    assert parsed == [result.raw_path] and len(written) == 2
    assert all(f.endswith(".parquet") for files in written for f in files)


@pytest.mark.parametrize("bounds", [("2024-01-01", "2024-01-03 09:00:00"), (None, "2024-01-04"), (None, None)])
def test_a_service_without_a_count_is_divided_while_it_is_read(spark, params, bounds):
    rows = source_rows(400)
    service = list_service(rows, count=False, rows_per_task=30)
    start, end = bounds
    result = run(spark, service, CONTRACT, replace(params, window_start=start, window_end=end, num_chunks=1))
    assert typed(spark, result) == expected_rows(rows) and result.report["expected"] is None
    ranges = result.report["ranges"]
    assert len(ranges) >= 400 / 40 and max(r[3] for r in ranges) < 30 + params.page_size
    assert sum(r[3] for r in ranges) == 400


def noted_service(rows, log, fails_on=(), **options):
    """A service that notes the first request of every range, and refuses ranges whose number is in `fails_on`."""
    plain = list_service(rows, **options)

    def fetch(request):
        if request.after is None:
            name = str(request.lo).replace(":", "")
            (log / name).touch()
            if name in fails_on:
                raise OSError("unreachable")
        return plain.fetch(request)

    return type(plain)(fetch, plain.count, plain.rows_per_task)


def test_a_run_goes_on_where_it_stopped(spark, params, tmp_path):
    rows, log = source_rows(100), tmp_path / "asked"
    log.mkdir()
    params = replace(params, num_chunks=10, ranges_per_commit=1, count_probe=False)

    def asked():
        names = sorted(p.name for p in log.iterdir())
        for p in log.iterdir():
            p.unlink()
        return names

    run(spark, noted_service(rows, log), CONTRACT, replace(params, output_dir=str(tmp_path / "other")))
    every = asked()
    assert len(every) == 10
    with pytest.raises(Exception, match="unreachable"):
        run(spark, noted_service(rows, log, fails_on=every[6:7]), CONTRACT, params)
    assert asked() == every[:7]
    landing = Path(params.output_dir) / "json" / "thing_20240104"
    (landing / "part-of-a-commit-that-did-not-end").write_text('{"key":"zzz"}\n')
    result = run(spark, noted_service(rows, log), CONTRACT, params)
    assert asked() == every[6:]
    assert typed(spark, result) == expected_rows(rows)
    assert sorted(r[0] for r in result.report["ranges"]) == list(range(10))
    # a run that ended is not taken up again, nor is one with other parameters
    run(spark, noted_service(rows, log), CONTRACT, params)
    assert asked() == every


def test_another_window_is_another_extraction(spark, params, tmp_path):
    rows, log = source_rows(60), tmp_path / "asked"
    log.mkdir()
    params = replace(params, num_chunks=4, ranges_per_commit=1, count_probe=False)
    with pytest.raises(Exception, match="unreachable"):
        run(spark, noted_service(rows, log, fails_on=["2024-01-02 120000"]), CONTRACT, replace(params, window_end="2024-01-04"))
    with pytest.raises(Exception, match="unreachable"):
        run(spark, noted_service(rows, log, fails_on=[sorted(p.name for p in log.iterdir())[0]]), CONTRACT, params)
    assert len(typed(spark, run(spark, noted_service(rows, log), CONTRACT, params))) == 60


@pytest.mark.parametrize("damage", [("00007", "00008"), ('"b"', '"c"')])
def test_one_changed_character_is_told(spark, make_source, params, monkeypatch, damage):
    rows = source_rows(30)
    report = run(spark, make_source(rows), CONTRACT, params).report
    assert int(report["fingerprint"]) == sum(int(r[5]) for r in report["ranges"])
    plain = ingest.land

    def land(lines, path, *mode):
        changed = F.when(F.col("value").contains("00007"), F.replace("value", F.lit(damage[0]), F.lit(damage[1])))
        plain(lines.withColumn("value", F.coalesce(changed, "value")), path, *mode)

    monkeypatch.setattr(ingest, "land", land)
    with pytest.raises(RuntimeError, match="not those that were processed"):
        run(spark, make_source(rows), CONTRACT, params)


def test_fingerprints_of_typed_columns_and_nested_values(spark, params):
    fields = [{"name": n, "type": "string"} for n in ("key", "n", "d", "t", "s", "b", "none", "Deep")]
    contract = parse_contract(json.dumps({"type": "record", "name": "t", "fields": fields}))
    frame = spark.sql(
        "SELECT CAST(id AS string) AS key, id AS n, id / 3 AS d, timestamp_micros(id) AS t, named_struct('x', id / 7, 'y', 'é\"') AS s,"
        " CAST('q' AS binary) AS b, CAST(NULL AS int) AS none, array(1.50, id) AS deep, '2024-01-01 00:00:00' AS at FROM range(20)"
    )
    result = run(spark, frame, contract, params)
    assert result.report["processed"] == 20 and int(result.report["fingerprint"]) > 0


def test_avro_files_have_the_schema_of_the_contract(spark, params, tmp_path):
    fields = [
        {"name": "key", "type": "string"},
        {"name": "day", "type": {"type": "int", "logicalType": "date"}},
        {"name": "at", "type": {"type": "long", "logicalType": "timestamp-millis"}},
        {"name": "local", "type": ["null", {"type": "long", "logicalType": "local-timestamp-micros"}], "default": None},
        {"name": "kind", "type": {"type": "enum", "name": "Kind", "symbols": ["a", "b"]}},
        {"name": "other", "type": ["null", "Kind"]},
        {"name": "code", "type": {"type": "fixed", "name": "Four", "size": 4}},
        {"name": "price", "type": {"type": "bytes", "logicalType": "decimal", "precision": 9, "scale": 2}},
        {"name": "wide", "type": ["int", "null", "long"]},
        {"name": "inner", "type": {"type": "record", "name": "Inner", "fields": [{"name": "x", "type": ["null", "int"]}]}},
    ]
    schema = {"type": "record", "name": "things", "namespace": "some.space", "fields": fields}
    contract = parse_contract(json.dumps(schema))
    rows = [
        ("1", "2024-01-02", "2024-01-02 03:04:05.678", "2024-01-02 03:04:05.678901", "a", "b", "four", "1.20", "7", '{"x":1}'),
        ("2", "", "bad", "", "b", "", "", "", "", ""),
    ]
    names = [f["name"] for f in fields]
    frame = spark.createDataFrame([(*r, "2024-01-02 00:00:00") for r in rows], ", ".join(f"{n} string" for n in [*names, "changed"]))
    for partition_by in ("", "kind"):
        again = replace(params, updated_col="changed", sink_format="avro", error_mode="field", partition_by=partition_by)
        result = run(spark, frame, contract, again)
        file = next(Path(result.typed_path).rglob("part-*.avro"))
        written = avro_schema(file.read_bytes())
        found = {f["name"]: f["type"] for f in written["fields"]}
        assert (written["name"], written["namespace"]) == ("things", "some.space")
        wanted = {f["name"]: f["type"] for f in fields if f["name"] != partition_by}
        wanted["wide"] = ["null", "long"]
        if partition_by:
            wanted["other"] = ["null", fields[4]["type"]]
        assert found == wanted
        typed = sink.read_partition(spark, result.typed_path, contract, "avro").orderBy("key").collect()
        assert [(r["key"], r["kind"], bytes(r["code"]), str(r["price"]), r["wide"]) for r in typed] == [
            ("1", "a", b"four", "1.20", 7), ("2", "b", bytes(4), "0.00", None)
        ]


def avro_schema(data: bytes) -> dict:
    """The schema in the header of an Avro file."""
    text = data[data.index(b"avro.schema") + len(b"avro.schema") :].decode("utf-8", "ignore")
    return json.JSONDecoder().raw_decode(text[text.index("{") :])[0]


def test_a_field_named_like_a_page_column(spark, params):
    contract = parse_contract(
        json.dumps({"type": "record", "name": "t", "fields": [{"name": n, "type": "long"} for n in ("key", "page", "off")]})
    )
    frame = spark.range(50).selectExpr("id AS key", "id * 2 AS page", "id * 3 AS off", "'2024-01-01 00:00:00' AS at")
    result = run(spark, frame, contract, replace(params, extract_mode="offsets", num_chunks=1))
    rows = sink.read_partition(spark, result.typed_path, contract).collect()
    assert sorted(tuple(r) for r in rows) == [(i, 2 * i, 3 * i) for i in range(50)]


def test_ids(spark, make_source, params, tmp_path):
    (tmp_path / "ids").write_text("00001,00002\n00093 ,,00002,99999\n")
    rows = source_rows(95)
    listed = replace(params, extract_mode="ids", id_file=str(tmp_path / "ids"), window_end="2024-01-01", ids_per_batch=2)
    result = run(spark, make_source(rows), CONTRACT, listed)
    assert typed(spark, result) == expected_rows([rows[1], rows[2], rows[93]])
    assert result.report["expected"] is None


def test_without_the_count_probe(spark, make_source, params):
    result = run(spark, make_source(source_rows(20)), CONTRACT, replace(params, count_probe=False))
    assert result.report["expected"] is None and result.report["processed"] == 20


def test_landed_lines(spark, params, tmp_path):
    (tmp_path / "kept").mkdir()
    lines = [json.dumps(r) for r in source_rows(5)] + ["not json", '[{"key":"x"},{"key":"y"}]']
    (tmp_path / "kept" / "part").write_text("\n".join(lines) + "\n")
    result = run(spark, LandedLines(str(tmp_path / "kept")), CONTRACT, params)
    assert (result.report["processed"], result.report["malformed"], result.report["error_rows"]) == (7, 2, 3)
    bad = spark.read.parquet(result.quarantine_path).where("_raw IS NOT NULL")
    assert sorted(r["_raw"] for r in bad.collect()) == sorted(lines[-2:])
    assert list_directories(spark, params.output_dir) == ["logs", "thing", "thing_err"]


def test_avro_and_field_mode(spark, make_source, params):
    rows = source_rows(20)
    result = run(spark, make_source(rows), CONTRACT, replace(params, sink_format="avro", error_mode="field"))
    assert [r[2] for r in typed(spark, result, "avro")] == [r["kind"] for r in rows]


def test_the_service_is_asked_once(spark, params, tmp_path):
    """Landed files serve all later steps."""
    rows, log = source_rows(25), tmp_path / "asked"
    log.mkdir()
    plain = list_service(rows)

    def fetch(request):
        with open(log / f"{request.lo}_{request.after}".replace("/", "-"), "a") as f:
            f.write("x")
        return plain.fetch(request)

    run(spark, type(plain)(fetch, plain.count), CONTRACT, params)
    assert {p.read_text() for p in log.iterdir()} == {"x"}


def test_retention_in_a_run(spark, make_source, params):
    for day in (1, 2, 3, 4):
        run(spark, make_source(source_rows(3)), CONTRACT, replace(params, run_date=date(2024, 1, day)))
    kept = list_directories(spark, f"{params.output_dir}/json")
    assert kept == ["thing_20240102", "thing_20240103", "thing_20240104"]


def test_a_failed_landing_fails_the_run(spark, params):
    def fetch(request):
        raise OSError("unreachable")

    with pytest.raises(Exception, match="unreachable"):
        run(spark, type(list_service([]))(fetch), CONTRACT, params)
    assert list_directories(spark, f"{params.output_dir}/thing") == []


def test_a_failed_audit_is_reported(spark, make_source, params, monkeypatch):
    def refuse(*_):
        raise OSError("no space")

    monkeypatch.setattr(audit, "append_audit", refuse)
    result = run(spark, make_source(source_rows(3)), CONTRACT, params)
    assert "no space" in str(result.audit_error) and len(typed(spark, result)) == 3


@pytest.mark.parametrize(
    "change",
    [
        dict(extract_mode="guess"),
        dict(error_mode="none"),
        dict(retention="none"),
        dict(page_size=1),
        dict(on_mismatch="ignore"),
        dict(extract_mode="offsets", count_probe=False),
        dict(extract_mode="ids"),
        dict(key_col="unknown"),
        dict(partition_by="unknown"),
        dict(blank_fields=["unknown"]),
    ],
)
def test_refused_parameters(spark, params, change):
    with pytest.raises(ValueError):
        run(spark, spark.range(1), CONTRACT, replace(params, **change))


def test_contract_from_its_directory_and_settings_are_restored(spark, make_source, params, tmp_path):
    fields = [{"name": f.name, "type": ["null", f.kind] if f.nullable else f.kind} for f in CONTRACT.fields]
    (tmp_path / "thing.avsc").write_text(json.dumps({"type": "record", "name": "thing", "fields": fields}))
    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    result = run(spark, make_source(source_rows(12)), None, replace(params, contract_dir=str(tmp_path)))
    assert typed(spark, result) == expected_rows(source_rows(12))
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == before
