"""The queries: each operator on the driver's tables, with the SQL that must give the same rows.

The ingestion queries work on service records made from `events`: all text, with values no contract accepts and with
blanks put in at known places.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators import align, audit, cast, extract, paging, retention, sink
from quayside.plans.ingest import IngestParams, LandedLines, RunResult, run
from quayside.sources.contract import Contract, parse_contract, read_contract
from quayside.sources.idfile import read_id_file
from quayside.sources.landing import as_lines, land
from quayside.sources.storage import scratch_path

CONTRACT = """
{"type": "record", "name": "event_row", "namespace": "fixture", "fields": [
  {"name": "sys_id", "type": "string"},
  {"name": "user_id", "type": "int"},
  {"name": "amount", "type": "double"},
  {"name": "active", "type": "boolean"},
  {"name": "category", "type": "string"},
  {"name": "note", "type": ["null", "string"], "default": null}]}
"""

ORDERS_CONTRACT = """
{"type": "record", "name": "orders", "fields": [
  {"name": "id", "type": "int"},
  {"name": "big", "type": ["null", "long"]},
  {"name": "price", "type": {"type": "bytes", "logicalType": "decimal", "precision": 15, "scale": 2}},
  {"name": "day", "type": {"type": "int", "logicalType": "date"}},
  {"name": "at", "type": ["null", {"type": "long", "logicalType": "local-timestamp-micros"}]},
  {"name": "ratio", "type": "float"},
  {"name": "total", "type": "double"},
  {"name": "code", "type": {"type": "fixed", "name": "four", "size": 4}},
  {"name": "raw", "type": "bytes"}]}
"""

WINDOW = ("2024-01-05 00:00:00", "2024-01-12 00:00:00")


def contract() -> Contract:
    return parse_contract(CONTRACT)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def service_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as records of a service."""
    return table(spark, sf_dir, "events").selectExpr(
        "lpad(CAST(event_id AS string), 10, '0') AS sys_id",
        "CAST(ts AS string) AS sys_updated_on",
        "event_type AS category",
        "CASE WHEN event_id % 17 = 0 THEN 'bad' WHEN event_id % 19 = 0 THEN '' ELSE CAST(user_id AS string) END"
        " AS user_id",
        "CASE WHEN event_id % 23 = 0 THEN 'n/a' ELSE CAST(value AS string) END AS amount",
        "CASE WHEN event_id % 29 = 0 THEN 'maybe' WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END AS active",
    )


def landed_events(spark: SparkSession, sf_dir: str) -> str:
    """Service records as JSON lines in a new directory."""
    path = scratch_path(spark, "landing")
    land(as_lines(service_rows(spark, sf_dir)), path)
    return path


def cast_events(spark: SparkSession, sf_dir: str, error_mode: str) -> cast.CastRows:
    """Service records landed, read back aligned to the contract, and cast."""
    spellings = align.matched_spellings(service_rows(spark, sf_dir).columns, contract())
    aligned = align.read_aligned(spark, landed_events(spark, sf_dir), contract(), spellings)
    return cast.cast_rows(aligned, contract(), error_mode)


def extract_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_window(
        service_rows(spark, sf_dir),
        "sys_updated_on",
        *WINDOW,
        base_filter="category = 'click'",
        fields=["sys_id", "sys_updated_on", "category"],
    )


def extract_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window filter on a stored timestamp, where it reaches the scan."""
    return extract.extract_window(
        table(spark, sf_dir, "events"),
        "ts",
        *WINDOW,
        base_filter="event_type = 'click'",
        fields=["event_id", "event_type", "value"],
    )


def chunk_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = extract.chunk_plan(table(spark, sf_dir, "events").select("ts"), "ts", 4)
    return plan.select("chunk", "n", F.col("first_updated").alias("first_ts"), F.col("last_updated").alias("last_ts"))


def offset_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id")
    return paging.offset_pages(events, "event_id", ranges=4, page_size=1000)


def offset_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each page of each range holds."""
    pages = paging.offset_pages(service_rows(spark, sf_dir).select("sys_id"), "sys_id", ranges=3, page_size=250)
    return pages.groupBy("rng", "page").agg(
        F.count(F.lit(1)).alias("n"), F.min("sys_id").alias("first_id"), F.max("sys_id").alias("last_id")
    )


def _urgent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select("o_orderkey")


def _id_file(spark: SparkSession, ids: DataFrame) -> str:
    """An ID file with every key twice, some of them padded, and an empty entry."""
    path = scratch_path(spark, "idfile")
    line = F.concat_ws(",", F.col(ids.columns[0]), F.lit(" "), F.concat(F.lit(" "), F.col(ids.columns[0])))
    ids.select(line.alias("value")).write.mode("overwrite").text(path)
    return path


def id_list_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = read_id_file(spark, _id_file(spark, _urgent(spark, sf_dir)))
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return extract.extract_ids(events, ids, "event_id")


def id_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_id_file(spark, _id_file(spark, table(spark, sf_dir, "orders").select("o_orderkey")))


def id_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys in requests as a run makes them: every key once, and how many requests hold more than they may."""
    batches = paging.id_batches(_urgent(spark, sf_dir), "o_orderkey", ids_per_batch=100, tasks=8)
    sizes = batches.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    kept = batches.join(sizes, "batch").withColumn("oversized", F.col("n") > 100)
    return kept.select("id", "oversized")


def schema_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [{"name": n, "type": "string"} for n in ("k", "unit", "note")]
    wanted = parse_contract(json.dumps({"type": "record", "name": "props", "fields": fields}))
    return align.schema_diff(align.observed_keys(table(spark, sf_dir, "events"), "props"), wanted)


def blank_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blanks in landed lines whose keys are not known beforehand."""
    path = landed_events(spark, sf_dir)
    spellings = align.discover_spellings(spark.read.text(path), contract())
    aligned = align.read_aligned(spark, path, contract(), spellings)
    return audit.blank_profile(aligned, ["user_id", "amount"])


def typed_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast.typed_rows(cast_events(spark, sf_dir, cast.ROW_STICKY))


def typed_cast_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast.typed_rows(cast_events(spark, sf_dir, cast.FIELD))


def typed_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored times through the landing and the cast, with and without zone, to the microsecond."""
    logical = {"at": "local-timestamp-micros", "instant": "timestamp-micros"}
    fields = [{"name": n, "type": {"type": "long", "logicalType": kind}} for n, kind in logical.items()]
    fields.insert(0, {"name": "event_id", "type": "long"})
    wanted = parse_contract(json.dumps({"type": "record", "name": "times", "fields": fields}))
    since = F.col("ts") - F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    instant = F.expr("TIMESTAMP '1970-01-01 00:00:00Z'") + since
    records = table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("at"), instant.alias("instant"))
    path = scratch_path(spark, "landing")
    land(as_lines(records), path)
    aligned = align.read_aligned(spark, path, wanted, align.matched_spellings(records.columns, wanted))
    typed = cast.typed_rows(cast.cast_rows(aligned, wanted))
    return typed.select("event_id", "at", F.unix_micros("instant").alias("instant_micros"))


def _orders_contract(spark: SparkSession) -> Contract:
    """A contract as it is kept: a file in a folder."""
    folder = scratch_path(spark, "contracts")
    spark.createDataFrame([(ORDERS_CONTRACT,)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{folder}/orders.avsc"
    )
    return read_contract(spark, folder, "orders")


def _cast_orders(spark: SparkSession, sf_dir: str, error_mode: str) -> DataFrame:
    """Orders with every kind of trouble, cast."""
    typed = cast.typed_rows(_cast_order_rows(spark, sf_dir, error_mode))
    return typed.withColumns({"code": F.hex("code"), "raw": F.hex("raw")})


def _cast_order_rows(spark: SparkSession, sf_dir: str, error_mode: str) -> cast.CastRows:
    """Orders as text with overflows, underflows, excess digits, a 30 February, exponents, blanks and marked binaries."""
    key = "o_orderkey"
    price = "CAST(o_totalprice AS string)"
    records = table(spark, sf_dir, "orders").selectExpr(
        f"CAST({key} AS string) AS id",
        f"CASE WHEN {key} % 13 = 0 THEN '92233720368547758080' ELSE CAST({key} AS string) END AS big",
        f"CASE WHEN {key} % 17 = 0 THEN '1e3' WHEN {key} % 19 = 0 THEN '' WHEN {key} % 47 = 0 THEN '1.239'"
        f" WHEN {key} % 59 = 0 THEN '12345678901234.00' WHEN {key} % 61 = 0 THEN '1.2300' ELSE {price} END AS price",
        f"CASE WHEN {key} % 23 = 0 THEN '2023-02-30' ELSE CAST(CAST(o_orderdate AS date) AS string) END AS day",
        f"CASE WHEN {key} % 29 = 0 THEN '2023-02-30 00:00:00' ELSE concat(CAST(CAST(o_orderdate AS date) AS string),"
        f" ' 12:34:56.', lpad(CAST({key} % 1000000 AS string), 6, '0')) END AS at",
        f"CASE WHEN {key} % 31 = 0 THEN '1.5E3' WHEN {key} % 37 = 0 THEN '.5'"
        f" WHEN {key} % 43 = 0 THEN '1e39' WHEN {key} % 67 = 0 THEN '-1e-50' ELSE '0.25' END AS ratio",
        f"CASE WHEN {key} % 53 = 0 THEN '1e400' WHEN {key} % 71 = 0 THEN concat('-', repeat('9', 400))"
        f" WHEN {key} % 73 = 0 THEN '-Infinity' WHEN {key} % 79 = 0 THEN '0e999' ELSE {price} END AS total",
        f"CASE WHEN {key} % 41 = 0 THEN 'x' ELSE 'four' END AS code",
        f"unhex(lpad(hex({key}), 16, '0')) AS raw",
    )
    wanted = _orders_contract(spark)
    path = scratch_path(spark, "landing")
    land(as_lines(records), path)
    aligned = align.read_aligned(spark, path, wanted, align.matched_spellings(records.columns, wanted))
    return cast.cast_rows(aligned, wanted, error_mode)


def error_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each field was rejected, and why."""
    listed = cast.error_lists(_cast_order_rows(spark, sf_dir, cast.FIELD)).select(F.inline("errors"))
    return listed.groupBy("field", "type", "reason").agg(F.count(F.lit(1)).alias("n"), F.min("raw").alias("least"))


def typed_cast_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cast_orders(spark, sf_dir, cast.ROW_STICKY)


def typed_cast_orders_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cast_orders(spark, sf_dir, cast.FIELD)


def replay_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over a table, then its landing replayed: as it is, and by another writer, who spells a field in two ways,
    puts numbers without quotes and an object where there was its text."""
    fields = [
        {"name": "id", "type": "long"},
        {"name": "amount", "type": {"type": "bytes", "logicalType": "decimal", "precision": 24, "scale": 4}},
        {"name": "label", "type": "string"},
        {"name": "note", "type": "string"},
    ]
    wanted = parse_contract(json.dumps({"type": "record", "name": "replay", "fields": fields}))
    records = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id",
        "CAST(o_totalprice AS decimal(24,4)) + CAST('12345678901234567.8901' AS decimal(24,4)) AS amount",
        "concat(CAST(o_orderkey AS string), '.50') AS label",
        "concat('{\"x\" : 1.50,\"y\":12345678901234567.8901,\"k\":', o_orderkey, '}') AS note",
        "o_orderdate AS changed",
    )
    folder = scratch_path(spark, "replay")
    params = IngestParams("replay", "20240101", folder, "id", "changed", num_chunks=4)
    first = run(spark, records, wanted, params)
    respelled = f"{folder}/respelled"
    bare = F.regexp_replace("value", r'"(amount|label)":"([0-9.]+)"', '"$1":$2')
    bare = F.regexp_replace(F.replace(bare, F.lit('\\"'), F.lit('"')), r'"note":"(\{[^}]*\})"', '"note":$1')
    second = F.when(F.col("value").rlike('"id":"[0-9]*7"'), F.regexp_replace(bare, '"amount"', '"Amount"'))
    spark.read.text(first.raw_path).select(F.coalesce(second, bare).alias("value")).write.text(respelled)
    passes = [first.typed_path]
    for number, path in enumerate((first.raw_path, respelled), start=2):
        again = IngestParams("replay", f"2024010{number}", folder, "id", "changed")
        passes.append(run(spark, LandedLines(path), wanted, again).typed_path)
    found = [sink.read_partition(spark, path, wanted).withColumn("pass", F.lit(i)) for i, path in enumerate(passes)]
    return found[0].unionByName(found[1]).unionByName(found[2])


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast.quarantine_rows(cast_events(spark, sf_dir, cast.ROW_STICKY))


def error_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast.error_summary(cast_events(spark, sf_dir, cast.ROW_STICKY))


def error_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rejected value with the key of its record."""
    listed = cast.error_lists(cast_events(spark, sf_dir, cast.ROW_STICKY))
    return listed.select(F.col("raw.sys_id").alias("sys_id"), F.inline("errors")).drop("reason")


def ingest_events(
    spark: SparkSession, sf_dir: str, output_dir: str | None = None, **options
) -> tuple[RunResult, str]:
    """A whole run over the service records."""
    params = IngestParams(
        table="event_row",
        run_partition="20240130",
        output_dir=output_dir or scratch_path(spark, "ingest"),
        key_col="sys_id",
        updated_col="sys_updated_on",
        num_chunks=8,
        **options,
    )
    result = run(spark, service_rows(spark, sf_dir), contract(), params)
    if result.audit_error:
        raise result.audit_error
    return result, params.output_dir


def ingest_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run writes to the typed table, in Avro."""
    result, _ = ingest_events(spark, sf_dir, sink_format=sink.AVRO)
    return sink.read_partition(spark, result.typed_path, contract(), sink.AVRO)


def ingest_avro_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields that stand in the header of a written Avro file, and how many rows the file's table has."""
    result, _ = ingest_events(spark, sf_dir, sink_format=sink.AVRO)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.avro").load(result.typed_path)
    header = F.regexp_extract(F.decode(F.substring("content", 1, 4000), "ISO-8859-1"), r'(\{"type":"record".*\}\]\})', 1)
    fields = F.from_json(header, "fields array<struct<name string, type string>>")["fields"]
    listed = files.select(F.posexplode(fields).alias("place", "field")).distinct()
    return listed.select("place", "field.name", "field.type", F.lit(result.report["processed"]).cast("long").alias("n_rows"))


def ingest_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run and then one of the same partition over fewer records: only the second one's rows are there."""
    _, folder = ingest_events(spark, sf_dir)
    again, _ = ingest_events(spark, sf_dir, folder, base_filter="category = 'click'")
    typed = sink.read_partition(spark, again.typed_path, contract()).withColumn("part", F.lit("typed"))
    originals = sink.read_partition(spark, again.quarantine_path, contract(), as_text=True)
    return typed.select("sys_id", "part").unionByName(originals.select("sys_id", F.lit("quarantine").alias("part")))


def ingest_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a run whose window holds no record, and what it writes."""
    result, folder = ingest_events(spark, sf_dir, window_start="2031-01-01", window_end="2031-01-02")
    written = sink.read_partition(spark, result.typed_path, contract()).count()
    return audit.read_audit(spark, folder).select(
        *["expected", "landed", "processed", "unique_keys", "error_rows"],
        F.size("ranges").cast("long").alias("chunks"),
        F.lit(written).cast("long").alias("typed_rows"),
    )


def ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run writes to the quarantine, with sub-partitions."""
    result, _ = ingest_events(spark, sf_dir, partition_by="category")
    return sink.read_partition(spark, result.quarantine_path, contract(), as_text=True)


def ingest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the audit table says of a run."""
    _, output_dir = ingest_events(spark, sf_dir, partition_by="category")
    return audit.read_audit(spark, output_dir).select(
        *["table_name", "run_partition", "extract_mode", "expected", "landed", "processed", "unique_keys"],
        *["error_rows", "malformed"],
        F.array_join("missing_fields", ",").alias("missing_fields"),
        *[F.col("blanks")[name].alias(f"blank_{name}") for name in ("user_id", "amount", "active")],
        F.array_join(F.transform("ranges", _range_text), ";").alias("ranges"),
        "fingerprint",
        F.array_join(F.transform("ranges", lambda r: r["fingerprint"]), ";").alias("range_fingerprints"),
    )


def _range_text(r):
    return F.concat_ws("|", r["range_id"].cast("string"), r["low"], r["high"], r["records"].cast("string"))


def partition_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed rows written with sub-partitions and read back."""
    fields = [{"name": "event_id", "type": "long"}, {"name": "category", "type": "string"}]
    layout = parse_contract(json.dumps({"type": "record", "name": "event", "fields": fields}))
    rows = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("category"))
    path = sink.table_dir(scratch_path(spark, "sink"), "event", "20240130")
    sink.write_partition(sink.clustered(rows, ["category"]), path, ["category"], contract=layout)
    written = sink.read_partition(spark, path, layout)
    return written.groupBy("category").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("min_id"), F.max("event_id").alias("max_id")
    )


def retention_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("dt")).distinct()
    run_date: date = table(spark, sf_dir, "events").agg(F.max(F.col("ts").cast("date"))).first()[0]
    return retention.retention_plan(days, run_date, days_to_keep=3)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        extract_window,
        extract_events,
        chunk_plan,
        offset_pages,
        offset_layout,
        id_list_extract,
        id_file_scan,
        id_batches,
        schema_diff,
        blank_profile,
        typed_cast,
        typed_cast_field,
        typed_times,
        typed_cast_orders,
        typed_cast_orders_field,
        error_reasons,
        replay_typed,
        quarantine,
        error_summary,
        error_details,
        ingest_typed,
        ingest_avro_schema,
        ingest_rerun,
        ingest_nothing,
        ingest_quarantine,
        ingest_report,
        partition_profile,
        retention_plan,
    )
}

_API = """api AS (
  SELECT event_id, lpad(CAST(event_id AS VARCHAR(20)), 10, '0') AS sys_id,
    CAST(ts AS VARCHAR) AS sys_updated_on, event_type AS category,
    CASE WHEN event_id % 17 = 0 THEN 'bad' WHEN event_id % 19 = 0 THEN '' ELSE CAST(user_id AS VARCHAR(20)) END
      AS user_id,
    CASE WHEN event_id % 23 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR(40)) END AS amount,
    CASE WHEN event_id % 29 = 0 THEN 'maybe' WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END AS active
  FROM events)"""

_FLAGS = """flags AS (
  SELECT *, (user_id <> '' AND NOT regexp_matches(user_id, '^[+-]?[0-9]{1,9}$')) AS e1,
    (amount <> '' AND NOT regexp_matches(amount, '^[+-]?[0-9]+([.][0-9]+)?$')) AS e2,
    (active <> '' AND active NOT IN ('true', 'false')) AS e3
  FROM api)"""

_TYPED = f"""WITH {_API}, {_FLAGS}
SELECT sys_id, CASE WHEN e1 OR user_id = '' THEN 0 ELSE TRY_CAST(user_id AS INT) END AS user_id,
  CASE WHEN e1 OR e2 OR amount = '' THEN 0.0 ELSE TRY_CAST(amount AS DOUBLE) END AS amount,
  CASE WHEN e1 OR e2 OR e3 OR active = '' THEN FALSE ELSE active = 'true' END AS active,
  CASE WHEN e1 OR e2 OR e3 THEN '' ELSE category END AS category, CAST(NULL AS VARCHAR) AS note
FROM flags"""

_QUARANTINE = f"""WITH {_API}, {_FLAGS}
SELECT sys_id, user_id, amount, active, category, '' AS note FROM flags WHERE e1 OR e2 OR e3"""

# What is wrong with the orders, by their keys: (reason, condition on k, text) of each field.
_ORDER_FAULTS = {
    "big": [("range", "k % 13 = 0", "92233720368547758080")],
    "price": [
        ("form", "k % 17 = 0", "1e3"),
        ("scale", "k % 17 <> 0 AND k % 19 <> 0 AND k % 47 = 0", "1.239"),
        ("range", "k % 17 <> 0 AND k % 19 <> 0 AND k % 47 <> 0 AND k % 59 = 0", "12345678901234.00"),
    ],
    "day": [("range", "k % 23 = 0", "2023-02-30")],
    "at": [("range", "k % 29 = 0", "2023-02-30 00:00:00")],
    "ratio": [
        ("form", "k % 31 <> 0 AND k % 37 = 0", ".5"),
        ("range", "k % 31 <> 0 AND k % 37 <> 0 AND k % 43 = 0", "1e39"),
        ("range", "k % 31 <> 0 AND k % 37 <> 0 AND k % 43 <> 0 AND k % 67 = 0", "-1e-50"),
    ],
    "total": [
        ("range", "k % 53 = 0", "1e400"),
        ("range", "k % 53 <> 0 AND k % 71 = 0", "-" + "9" * 400),
    ],
    "code": [("form", "k % 41 = 0", "x")],
}
_ORDER_TYPES = {
    "big": "long", "price": "decimal", "day": "date", "at": "timestamp_ntz", "ratio": "float", "total": "double", "code": "fixed",
}


def _reasons_sql() -> str:
    planted = [
        f"SELECT '{name}' AS field, '{_ORDER_TYPES[name]}' AS type, '{why}' AS reason, '{text}' AS raw FROM o WHERE {wrong}"
        for name, faults in _ORDER_FAULTS.items()
        for why, wrong, text in faults
    ]
    return f"""WITH o AS (SELECT o_orderkey AS k FROM orders), planted AS ({" UNION ALL ".join(planted)})
SELECT field, type, reason, COUNT(*) AS n, MIN(raw) AS least FROM planted GROUP BY field, type, reason"""


def _orders_sql(sticky: bool) -> str:
    """What the orders become: a field is bad by its key; in sticky mode later fields are bad with it."""
    names = ["id", "big", "price", "day", "at", "ratio", "total", "code", "raw"]

    def fails(name: str) -> str:
        before = names[: names.index(name) + 1] if sticky else [name]
        wrong = [condition for n in before for _, condition, _ in _ORDER_FAULTS.get(n, ())]
        return " OR ".join(f"({w})" for w in wrong) or "FALSE"

    values = {
        "id": ("CAST(k AS INT)", "0"),
        "big": ("CAST(k AS BIGINT)", "NULL"),
        "price": ("CASE WHEN k % 19 = 0 THEN 0 WHEN k % 61 = 0 THEN 1.23 ELSE p END", "0"),
        "day": ("d", "DATE '1970-01-01'"),
        "at": ("CAST(d AS TIMESTAMP) + INTERVAL 45296 SECOND + to_microseconds(k % 1000000)", "NULL"),
        "ratio": ("CASE WHEN k % 31 = 0 THEN 1500 ELSE 0.25 END", "0"),
        "total": ("CASE WHEN k % 73 = 0 THEN -CAST('Infinity' AS DOUBLE) WHEN k % 79 = 0 THEN 0 ELSE t END", "0"),
        "code": ("'666F7572'", "'00000000'"),
        "raw": ("lpad(hex(k), 16, '0')", "''"),
    }
    types = {"price": "DECIMAL(15,2)", "ratio": "FLOAT", "total": "DOUBLE"}
    columns = []
    for name, (value, default) in values.items():
        column = f"CASE WHEN {fails(name)} THEN {default} ELSE {value} END"
        columns.append(f"CAST({column} AS {types[name]}) AS {name}" if name in types else f"{column} AS {name}")
    return f"""WITH o AS (
  SELECT o_orderkey AS k, CAST(o_totalprice AS DECIMAL(15,2)) AS p, o_totalprice AS t,
    CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT {", ".join(columns)} FROM o"""


ORACLES: dict[str, str] = {
    "extract_window": f"""WITH {_API}
SELECT sys_id, sys_updated_on, category FROM api
WHERE category = 'click' AND sys_updated_on >= '{WINDOW[0]}' AND sys_updated_on <= '{WINDOW[1]}'""",
    "extract_events": f"""SELECT event_id, event_type, value FROM events
WHERE event_type = 'click' AND ts >= TIMESTAMP '{WINDOW[0]}' AND ts <= TIMESTAMP '{WINDOW[1]}'""",
    "chunk_plan": """WITH b AS (SELECT epoch_us(MIN(ts)) AS lo, epoch_us(MAX(ts)) AS hi FROM events),
c AS (SELECT LEAST(CAST(FLOOR((epoch_us(ts) - lo) * 4.0 / (hi - lo)) AS INT), 3) AS chunk, ts FROM events CROSS JOIN b)
SELECT chunk, COUNT(*) AS n, MIN(ts) AS first_ts, MAX(ts) AS last_ts FROM c GROUP BY chunk""",
    "offset_pages": """WITH r AS (
  SELECT event_id, CAST(ROW_NUMBER() OVER (ORDER BY event_id) - 1 AS BIGINT) AS off, COUNT(*) OVER () AS cnt
  FROM events),
p AS (
  SELECT event_id, off, CAST(FLOOR(off / CEIL((cnt + 1) / 4.0)) AS INT) AS rng,
    CAST(FLOOR((off - FLOOR(off / CEIL((cnt + 1) / 4.0)) * CEIL((cnt + 1) / 4.0)) / 1000) AS INT) AS page
  FROM r)
SELECT event_id, off, rng, page FROM p""",
    "offset_layout": f"""WITH {_API},
r AS (SELECT sys_id, ROW_NUMBER() OVER (ORDER BY sys_id) - 1 AS off, COUNT(*) OVER () AS cnt FROM api),
s AS (SELECT sys_id, off, CAST(CEIL((cnt + 1) / 3.0) AS BIGINT) AS size FROM r)
SELECT CAST(off // size AS INT) AS rng, CAST((off % size) // 250 AS INT) AS page, COUNT(*) AS n,
  MIN(sys_id) AS first_id, MAX(sys_id) AS last_id
FROM s GROUP BY 1, 2""",
    "id_list_extract": """SELECT e.event_id, e.event_type FROM events e
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = e.event_id AND o.o_orderpriority = '1-URGENT')""",
    "id_file_scan": "SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS id FROM orders",
    "id_batches": """SELECT CAST(o_orderkey AS VARCHAR) AS id, FALSE AS oversized
FROM orders WHERE o_orderpriority = '1-URGENT'""",
    "schema_diff": """WITH seen AS (SELECT DISTINCT k FROM (SELECT unnest(json_keys(props)) AS k FROM events) t),
want AS (SELECT * FROM (VALUES ('k'), ('unit'), ('note')) v(k))
SELECT COALESCE(w.k, s.k) AS col_name,
  CASE WHEN s.k IS NULL THEN 'missing' WHEN w.k IS NULL THEN 'extra' ELSE 'present' END AS status
FROM want w FULL OUTER JOIN seen s ON lower(w.k) = lower(s.k)""",
    "blank_profile": f"""WITH {_API}
SELECT 'user_id' AS field, COUNT(*) FILTER (WHERE user_id = '') AS blanks FROM api
UNION ALL SELECT 'amount', COUNT(*) FILTER (WHERE amount = '') FROM api""",
    "typed_cast": _TYPED,
    "ingest_typed": _TYPED,
    "ingest_avro_schema": """SELECT CAST(place AS INT) AS place, name, type, (SELECT COUNT(*) FROM events) AS n_rows
FROM (VALUES (0, 'sys_id', 'string'), (1, 'user_id', 'int'), (2, 'amount', 'double'), (3, 'active', 'boolean'),
  (4, 'category', 'string'), (5, 'note', '["null","string"]')) f(place, name, type)""",
    "typed_cast_field": f"""WITH {_API}, {_FLAGS}
SELECT sys_id, CASE WHEN e1 OR user_id = '' THEN 0 ELSE TRY_CAST(user_id AS INT) END AS user_id,
  CASE WHEN e2 OR amount = '' THEN 0.0 ELSE TRY_CAST(amount AS DOUBLE) END AS amount,
  CASE WHEN e3 OR active = '' THEN FALSE ELSE active = 'true' END AS active, category, CAST(NULL AS VARCHAR) AS note
FROM flags""",
    "typed_times": "SELECT event_id, ts AS at, epoch_us(ts) AS instant_micros FROM events",
    "typed_cast_orders": _orders_sql(sticky=True),
    "typed_cast_orders_field": _orders_sql(sticky=False),
    "error_reasons": _reasons_sql(),
    "replay_typed": """WITH t AS (
  SELECT o_orderkey AS id, CAST(CAST(o_totalprice AS DECIMAL(24,4)) + 12345678901234567.8901 AS DECIMAL(24,4)) AS amount,
    CAST(o_orderkey AS VARCHAR) || '.50' AS label,
    '{"x" : 1.50,"y":12345678901234567.8901,"k":' || o_orderkey || '}' AS note FROM orders)
SELECT id, amount, label, note, CAST(p AS INT) AS pass FROM t, range(3) r(p)""",
    "quarantine": _QUARANTINE,
    "ingest_quarantine": _QUARANTINE,
    "error_summary": f"""WITH {_API}, {_FLAGS}
SELECT 'user_id' AS field, 'int' AS type, COUNT(*) AS n FROM flags WHERE e1
UNION ALL SELECT 'amount', 'double', COUNT(*) FROM flags WHERE e2
UNION ALL SELECT 'active', 'boolean', COUNT(*) FROM flags WHERE e3""",
    "error_details": f"""WITH {_API}, {_FLAGS}
SELECT sys_id, 'user_id' AS field, 'int' AS type, user_id AS raw FROM flags WHERE e1
UNION ALL SELECT sys_id, 'amount', 'double', amount FROM flags WHERE e2
UNION ALL SELECT sys_id, 'active', 'boolean', active FROM flags WHERE e3""",
    "ingest_report": f"""WITH {_API}, {_FLAGS},
w AS (SELECT epoch_us(MIN(ts)) AS lo, epoch_us(MAX(ts)) AS hi FROM events),
crc AS (
  SELECT list(list_reduce(list_concat([b], [0, 1, 2, 3, 4, 5, 6, 7]),
    lambda x, k: xor(x >> 1, (x & 1) * 3988292384)) ORDER BY b) AS step FROM range(256) r(b)),
f AS (
  SELECT event_id, xor(list_reduce(list_concat([4294967295], [CAST(ord(x) AS BIGINT) FOR x IN string_split(
    concat_ws(chr(31), sys_id, user_id, amount, active, category, ''), '')]),
    lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])), 4294967295) AS print FROM api, crc),
c AS (SELECT CAST(LEAST((epoch_us(ts) - lo) * 8 // (hi - lo), 7) AS INT) AS i, COUNT(*) AS n, SUM(print) AS print
  FROM events JOIN f USING (event_id), w GROUP BY 1),
e AS (SELECT CAST(i AS INT) AS i, lo + ((hi - lo) * i + 7) // 8 AS us FROM w, range(9) r(i)),
t AS (SELECT i, strftime(make_timestamp(us), '%Y-%m-%d %H:%M:%S.%f') AS at FROM e),
ranges AS (
  SELECT string_agg(a.i || '|' || a.at || '|' || b.at || '|' || COALESCE(c.n, 0), ';' ORDER BY a.i) AS ranges,
    string_agg(CAST(COALESCE(c.print, 0) AS VARCHAR), ';' ORDER BY a.i) AS prints
  FROM t a JOIN t b ON b.i = a.i + 1 LEFT JOIN c ON c.i = a.i)
SELECT 'event_row' AS table_name, '20240130' AS run_partition, 'chunks' AS extract_mode, COUNT(*) AS expected,
  COUNT(*) AS landed, COUNT(*) AS processed, COUNT(DISTINCT sys_id) AS unique_keys,
  COUNT(*) FILTER (WHERE e1 OR e2 OR e3) AS error_rows, CAST(0 AS BIGINT) AS malformed, 'note' AS missing_fields,
  COUNT(*) FILTER (WHERE user_id = '') AS blank_user_id, COUNT(*) FILTER (WHERE amount = '') AS blank_amount,
  COUNT(*) FILTER (WHERE active = '') AS blank_active, MAX(ranges) AS ranges,
  (SELECT CAST(SUM(print) AS VARCHAR) FROM f) AS fingerprint, MAX(prints) AS range_fingerprints
FROM flags, ranges""",
    "ingest_rerun": f"""WITH {_API}, {_FLAGS}
SELECT sys_id, part
FROM flags, (VALUES ('typed'), ('quarantine')) p(part)
WHERE category = 'click' AND (part = 'typed' OR e1 OR e2 OR e3)""",
    "ingest_nothing": """SELECT COUNT(*) AS expected, COUNT(*) AS landed, COUNT(*) AS processed, COUNT(*) AS unique_keys,
  COUNT(*) AS error_rows, CAST(8 AS BIGINT) AS chunks, COUNT(*) AS typed_rows
FROM events WHERE ts >= TIMESTAMP '2031-01-01 00:00:00'""",
    "partition_profile": """SELECT event_type AS category, COUNT(*) AS n, MIN(event_id) AS min_id,
  MAX(event_id) AS max_id
FROM events GROUP BY event_type""",
    "retention_plan": f"""WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS dt FROM events),
r AS (SELECT MAX(dt) AS run_dt FROM d)
SELECT strftime(dt, '%Y%m%d') AS dt,
  CASE WHEN date_diff('day', dt, run_dt) = 3 THEN '{retention.DROP_EXACT}'
    WHEN date_diff('day', dt, run_dt) > 3 THEN '{retention.DROP_SWEEP_ONLY}'
    WHEN dt = run_dt THEN '{retention.OVERWRITE}' ELSE '{retention.KEEP}' END AS action
FROM d CROSS JOIN r""",
}
