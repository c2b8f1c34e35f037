"""One ingestion run: extract, land, align, cast, write typed and quarantined rows, count, and record the run."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field, replace
from datetime import date, datetime, timezone
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quayside.functions.grammar import EXCESS_DIGITS, REJECT
from quayside.functions.moments import Moment, as_text, chunk_bounds
from quayside.functions.names import name_list, quoted, unused
from quayside.functions.ranges import check_page_size, offset_ranges
from quayside.operators import align, audit, cast, extract, retention, sink
from quayside.sources.contract import Contract, read_contract
from quayside.sources.idfile import read_id_file
from quayside.sources.landing import as_lines, extracted_print, land, landing_dir, print_sum, record_print
from quayside.sources.manifest import Manifest
from quayside.sources.paged import (
    CHUNKS,
    OFFSETS,
    PagedScan,
    PagedService,
    PlannedRange,
    check_scan,
    fetch_ids,
    planned_ranges,
    read_ranges,
)
from quayside.sources.storage import delete_directory

IDS = "ids"
EXTRACT_MODES = (CHUNKS, OFFSETS, IDS)
FAIL = "fail"
REPORT = "report"

# The quarantine's extra column, for lines that could not be parsed.
RAW_LINE = "_raw"

# The JVM does not compile methods beyond 8000 bytes. From some 30 fields on, the cast fused into one generated method
# is larger and would be interpreted; with this limit Spark runs it as separate projections, twice as fast.
SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


@dataclass(frozen=True)
class IngestParams:
    """Parameters of a run.

    `window_start` and `window_end` are inclusive. `num_chunks` is the number of window chunks, offset ranges or tasks
    that read keys; without it there are as many as the session runs tasks at once. `on_mismatch` says what happens when
    other numbers of records are expected, landed and processed: "fail", before any earlier output is replaced, or
    "report", for a service whose records change while they are read. `blank_fields` names the fields whose blanks are
    counted (default: those whose default value could be mistaken for data).

    The ranges of a service are landed `ranges_per_commit` at a time (default: four times as many as the session runs
    tasks at once), and a run that failed is taken up behind the last commit by the next one of the same day and
    parameters. `resume=False` starts over.
    """

    table: str
    run_partition: str
    output_dir: str
    key_col: str
    updated_col: str
    window_start: Moment | None = None
    window_end: Moment | None = None
    base_filter: str | None = None
    fields: str | Sequence[str] = ()
    extract_mode: str = CHUNKS
    num_chunks: int | None = None
    page_size: int = 1000
    on_mismatch: str = FAIL
    count_probe: bool = True
    id_file: str | None = None
    ids_per_batch: int = 100
    error_mode: str = cast.ROW_STICKY
    excess_digits: str = REJECT
    partition_by: str | Sequence[str] = ()
    sink_format: str = sink.PARQUET
    blank_fields: Sequence[str] | None = None
    contract_dir: str | None = None
    raw_days_to_keep: int = 3
    retention: str = retention.EXACT
    run_date: date | None = None
    resume: bool = True
    ranges_per_commit: int | None = None


@dataclass(frozen=True)
class LandedLines:
    """Source: JSON lines that lie in files already, such as a landing kept from an earlier run."""

    path: str


@dataclass(frozen=True)
class RunResult:
    report: dict[str, Any]
    raw_path: str
    typed_path: str
    quarantine_path: str
    audit_error: Exception | None = None


@dataclass
class _Extraction:
    """Lines to land and what is known about them beforehand, or the scan of a service that lands them range by range."""

    lines: DataFrame | None
    names: list[str] | None = None
    expected: int | None = None
    ranges: list[tuple] = field(default_factory=list)
    metrics: dict[str, Column] = field(default_factory=dict)
    bounds: list[tuple[str, str]] = field(default_factory=list)
    fingerprint: str | None = None


def _check(contract: Contract, params: IngestParams) -> None:
    if params.extract_mode not in EXTRACT_MODES:
        raise ValueError(f"extract_mode is one of {', '.join(EXTRACT_MODES)}, not {params.extract_mode!r}")
    if params.error_mode not in cast.ERROR_MODES:
        raise ValueError(f"error_mode is one of {', '.join(cast.ERROR_MODES)}, not {params.error_mode!r}")
    if params.excess_digits not in EXCESS_DIGITS:
        raise ValueError(f"excess_digits is one of {', '.join(EXCESS_DIGITS)}, not {params.excess_digits!r}")
    if params.retention not in retention.RETENTION_MODES:
        raise ValueError(f"retention is one of {', '.join(retention.RETENTION_MODES)}, not {params.retention!r}")
    if params.on_mismatch not in (FAIL, REPORT):
        raise ValueError(f"on_mismatch is {FAIL} or {REPORT}, not {params.on_mismatch!r}")
    check_page_size(params.page_size)
    if params.extract_mode == OFFSETS and not params.count_probe:
        raise ValueError("reading by offsets needs the count probe")
    if params.extract_mode == IDS and not params.id_file:
        raise ValueError("reading by ids needs an id_file")
    known = {n.lower() for n in contract.names}
    wanted = [params.key_col, *name_list(params.partition_by), *(params.blank_fields or ())]
    unknown = [n for n in wanted if n.lower() not in known]
    if unknown:
        raise ValueError(f"not in contract {contract.name}: {', '.join(unknown)}")


def _lines(rows: DataFrame, fields: Sequence[str], contract: Contract, **beside: Column) -> DataFrame:
    return as_lines(rows, fields, **beside, print=extracted_print(rows, fields, contract.names))


def _chunked(rows: DataFrame, fields: Sequence[str], contract: Contract, params: IngestParams) -> _Extraction:
    """The records of a table by window chunks.

    One scan of the change times alone gives the expected count and the ends of an open window; how many records each
    chunk has is counted while they are landed.
    """
    start, end = params.window_start, params.window_end
    expected = None
    if start is None or end is None:
        seen, expected = extract.probe(rows, params.updated_col)
        if seen is None:
            return _Extraction(_lines(rows, fields, contract), fields, expected if params.count_probe else None)
        start, end = start or seen[0], end or seen[1]
    elif params.count_probe:
        expected = extract.expected_count(rows)
    bounds = [(as_text(low), as_text(high)) for low, high in chunk_bounds(start, end, params.num_chunks)]
    chunk = extract.chunk_number(rows, params.updated_col, start, end, params.num_chunks)
    metrics = {f"chunk{i}": F.count_if(F.col("chunk") == i) for i in range(len(bounds))}
    # records without a readable change time, possible only where no window is given
    metrics["chunk_none"] = F.count_if(F.col("chunk").isNull())
    metrics |= {f"print{i}": print_sum(F.when(F.col("chunk") == i, F.col("print"))) for i in range(len(bounds))}
    metrics["print_none"] = print_sum(F.when(F.col("chunk").isNull(), F.col("print")))
    expected = expected if params.count_probe else None
    lines = _lines(rows, fields, contract, chunk=chunk)
    return _Extraction(lines, fields, expected, metrics=metrics, bounds=bounds)


def _chunk_report(bounds: list[tuple[str, str]], seen: dict[str, Any]) -> list[tuple]:
    report = [(i, low, high, seen[f"chunk{i}"], None, seen[f"print{i}"]) for i, (low, high) in enumerate(bounds)]
    rest = (-1, None, None, seen["chunk_none"], None, seen["print_none"])
    return report + ([rest] if seen["chunk_none"] else [])


def _offset_ranges(count: int, params: IngestParams) -> list[tuple]:
    return [
        (i, str(r.start), str(r.stop - 1), max(min(r.stop, count) - r.start, 0), None, None)
        for i, r in enumerate(offset_ranges(count, params.num_chunks))
    ]


def _from_table(df: DataFrame, contract: Contract, params: IngestParams) -> _Extraction:
    fields = name_list(params.fields) or df.columns
    if params.extract_mode == IDS:
        ids = read_id_file(df.sparkSession, params.id_file)
        return _Extraction(_lines(extract.extract_ids(df, ids, params.key_col), fields, contract), fields)

    rows = extract.extract_window(
        df, params.updated_col, params.window_start, params.window_end, params.base_filter
    )
    if params.extract_mode == CHUNKS:
        return _chunked(rows, fields, contract, params)
    expected = extract.expected_count(rows)
    return _Extraction(_lines(rows, fields, contract), fields, expected, ranges=_offset_ranges(expected, params))


def _ids_of_service(
    spark: SparkSession, service: PagedService, contract: Contract, params: IngestParams
) -> _Extraction:
    # The reader notes the spellings of contract fields as records pass, which saves a pass over the landed files. Few
    # tasks differ in them, so the set is small.
    ids = read_id_file(spark, params.id_file)
    layout = (params.ids_per_batch, params.num_chunks, tuple(contract.names), params.page_size)
    lines = fetch_ids(ids, service, params.table, tuple(name_list(params.fields)), *layout)
    lines = lines.withColumn("print", F.col("fingerprint").cast("long"))
    return _Extraction(lines, metrics={"names": F.collect_set("names")})


def _land_service(
    spark: SparkSession, service: PagedService, contract: Contract, params: IngestParams, path: str
) -> tuple[_Extraction, int]:
    """Land the window of a service range by range, some ranges at a time, behind a manifest.

    A range of a service without a count hands back what is more than a task reads; that is divided and read later.
    """
    scan = PagedScan(
        params.table,
        params.key_col,
        params.updated_col,
        params.extract_mode,
        params.window_start,
        params.window_end,
        params.num_chunks if None not in (params.window_start, params.window_end) else 1,
        params.page_size,
        tuple(name_list(params.fields)),
        extract.cleaned_filter(params.base_filter),
        report=True,
        wanted_names=tuple(contract.names),
    )
    expected = None
    if params.count_probe and service.count is not None:
        expected = service.count(scan.request())
    if params.extract_mode == OFFSETS:
        if expected is None:
            raise ValueError("reading by offsets needs a service that can count")
        scan = replace(scan, expected=expected, num_ranges=params.num_chunks)
    check_scan(service, scan)
    told = {k: str(v) for k, v in asdict(scan).items()} | {"rows_per_task": service.rows_per_task}
    manifest = Manifest(spark, path, json.dumps(told, sort_keys=True))
    if not (params.resume and manifest.resume()):
        manifest.begin([r.as_json() for r in planned_ranges(spark, service, scan)])
    together = params.ranges_per_commit or 4 * spark.sparkContext.defaultParallelism
    report = ["range_id", "low", "high", "records", "requests", "fingerprint", "rest_after", "rest_split"]
    done = F.when(F.col("value").isNull(), F.struct(*report))
    while pending := manifest.pending():
        batch = [PlannedRange.from_json(r) for r in pending[:together]]
        seen = Observation()
        counted = read_ranges(spark, service, scan, batch).observe(
            seen, F.collect_set("names").alias("names"), F.collect_list(done).alias("ranges")
        )
        land(counted.where("value IS NOT NULL"), path, "append")
        found = sorted(tuple(r) for r in seen.get["ranges"])
        by_id, more = {r.range_id: r for r in batch}, []
        for range_id, *_, after, split in found:
            for request in by_id[range_id].rest(after, split) if after is not None else ():
                more.append(PlannedRange(len(manifest.ranges) + len(more), request).as_json())
        names = sorted({name for names in seen.get["names"] for name in names})
        manifest.commit([r.range_id for r in batch], {"ranges": [r[:6] for r in found], "names": names}, more)
    if not manifest.ranges:
        land(spark.createDataFrame([], "value string"), path, "append")
    manifest.end()
    ranges = sorted(tuple(r) for commit in manifest.reports for r in commit["ranges"])
    names = sorted({name for commit in manifest.reports for name in commit["names"]})
    prints = str(sum(int(r[5]) for r in ranges))
    extraction = _Extraction(None, names, expected, ranges, fingerprint=prints)
    return extraction, sum(r[3] for r in ranges)


def _land(extraction: _Extraction, path: str) -> int:
    seen = Observation()
    metrics = extraction.metrics | {"print_all": print_sum(F.col("print"))}
    counted = extraction.lines.observe(
        seen, F.count("value").alias("landed"), *[m.alias(n) for n, m in metrics.items()]
    )
    land(counted.where("value IS NOT NULL"), path)
    if extraction.bounds:
        extraction.ranges = _chunk_report(extraction.bounds, seen.get)
    if "names" in metrics:
        extraction.names = sorted({name for names in seen.get["names"] for name in names})
    extraction.fingerprint = seen.get["print_all"]
    return seen.get["landed"]


def _reconcile(
    params: IngestParams, wanted: int | None, wanted_name: str, found: int, found_name: str, always: bool = False
) -> None:
    if wanted is not None and wanted != found and (always or params.on_mismatch == FAIL):
        raise RuntimeError(f"{wanted} records were {wanted_name} but {found} were {found_name}")


def _stage(rows: cast.CastRows, path: str, blanks: list[str]) -> tuple[DataFrame, dict]:
    """Parse and cast the landing once: typed values (`t<i>`) of all rows, and beside them, where a row failed, its
    original text and malformed line (`original`). Both tables are then read from these columns.

    The rows are counted on the way, in the stage that writes: a write task that succeeds counts once.
    """
    spark = rows.frame.sparkSession
    fields = range(len(rows.contract.fields))
    original = F.when(F.col("failed"), F.struct(*[f"r{i}" for i in fields], "bad_line"))
    texts = [f"r{i}" for i in fields]
    staged = rows.frame.select(*[f"t{i}" for i in fields], original.alias("original"), "failed", "bad_line", *texts)
    counts = Observation()
    counted = staged.observe(
        counts,
        F.count(F.lit(1)).alias("processed"),
        F.count_if("failed").alias("error_rows"),
        F.count_if(F.col("bad_line").isNotNull()).alias("malformed"),
        print_sum(record_print([F.col(t) for t in texts])).alias("print"),
        *[F.count_if(F.col(f"r{rows.index(b)}") == "").alias(f"b{j}") for j, b in enumerate(blanks)],
    ).select(*[f"t{i}" for i in fields], "original")
    counted.write.mode("overwrite").parquet(path)
    found = dict(counts.get)
    found["blanks"] = {b: found.pop(f"b{j}") for j, b in enumerate(blanks)}
    return spark.read.schema(counted.schema).parquet(path), found


def _write_typed(staged: DataFrame, contract: Contract, params: IngestParams, path: str) -> None:
    partition_by = name_list(params.partition_by)
    typed = staged.select(*[F.col(f"t{i}").alias(n) for i, n in enumerate(contract.names)])
    if partition_by:
        typed = sink.clustered(typed, [quoted(c) for c in partition_by])
    sink.write_partition(typed, path, partition_by, params.sink_format, contract)


def _write_quarantine(staged: DataFrame, contract: Contract, params: IngestParams, path: str) -> None:
    """Write the originals of failed rows. They are few and come from all tasks, so they are gathered first."""
    partition_by = name_list(params.partition_by)
    texts = [F.col(f"original.r{i}").alias(n) for i, n in enumerate(contract.names)]
    bad_line = F.col("original.bad_line").alias(unused(RAW_LINE, contract.names))
    originals = staged.where("original IS NOT NULL").select(*texts, bad_line)
    sink.write_partition(sink.clustered(originals, [quoted(c) for c in partition_by]), path, partition_by)


def _unique_keys(staged: DataFrame, contract: Contract, params: IngestParams) -> int:
    at = [n.lower() for n in contract.names].index(params.key_col.lower())
    return audit.unique_keys(staged.select(F.col(f"t{at}").alias(params.key_col)), params.key_col)


def _together(spark: SparkSession, *steps: Callable[[], Any]) -> list[Any]:
    """Run independent jobs at the same time; all have ended when this returns or raises."""
    with ThreadPoolExecutor(len(steps)) as pool:
        waiting = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [w.result() for w in waiting]


def run(
    spark: SparkSession,
    source: DataFrame | PagedService | LandedLines,
    contract: Contract | None,
    params: IngestParams,
) -> RunResult:
    """Ingest one window of a table. Replaces what an earlier run wrote for the same partition.

    Without a contract, the one kept for the table in `params.contract_dir` is used.
    """
    if contract is None:
        contract = read_contract(spark, params.contract_dir, params.table)
    _check(contract, params)
    if params.sink_format == sink.AVRO:
        contract = contract.with_symbols()
    if params.num_chunks is None:
        params = replace(params, num_chunks=spark.sparkContext.defaultParallelism)
    with _settings(spark, SETTINGS):
        return _run(spark, source, contract, params)


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _run(
    spark: SparkSession, source: DataFrame | PagedService | LandedLines, contract: Contract, params: IngestParams
) -> RunResult:
    clock, started = time.monotonic(), datetime.now(timezone.utc)
    run_date = params.run_date or started.date()
    journal = sink.journal_path(params.output_dir, params.table, params.run_partition)
    sink.recover(spark, journal)

    if isinstance(source, LandedLines):
        extraction, raw_path, landed = _Extraction(spark.read.text(source.path)), source.path, None
    else:
        raw_path = landing_dir(params.output_dir, params.table, run_date)
        if not isinstance(source, PagedService):
            extraction = _from_table(source, contract, params)
            landed = _land(extraction, raw_path)
        elif params.extract_mode == IDS:
            extraction = _ids_of_service(spark, source, contract, params)
            landed = _land(extraction, raw_path)
        else:
            extraction, landed = _land_service(spark, source, contract, params, raw_path)
        # only now that the new landing is there
        retention.apply_retention(
            spark, params.output_dir, params.table, run_date, params.raw_days_to_keep, params.retention
        )
        _reconcile(params, extraction.expected, "expected", landed, "landed")

    if extraction.names is None:
        spellings = align.discover_spellings(spark.read.text(raw_path), contract)
    else:
        spellings = align.matched_spellings(extraction.names, contract)
    aligned = align.read_aligned(spark, raw_path, contract, spellings, foreign=landed is None)
    rows = cast.cast_rows(aligned, contract, params.error_mode, params.excess_digits)

    typed_path = sink.table_dir(params.output_dir, params.table, params.run_partition)
    quarantine_path = sink.quarantine_dir(params.output_dir, params.table, params.run_partition)
    blanks = params.blank_fields
    blanks = audit.default_ambiguous(contract) if blanks is None else list(blanks)
    # everything is written beside the partitions, which change places, together, only when the counts agree
    new_rows, new_typed, new_quarantine = (
        sink.staging_dir(path) for path in (typed_path, typed_path, quarantine_path)
    )
    try:
        staged, counts = _stage(rows, new_rows, blanks)
        _reconcile(params, landed, "landed", counts["processed"], "processed", always=True)
        if extraction.fingerprint not in (None, counts["print"]):
            raise RuntimeError(
                f"the records that were extracted ({extraction.fingerprint}) are not those that were processed ({counts['print']})"
            )
        unique, *_ = _together(
            spark,
            lambda: _unique_keys(staged, contract, params),
            lambda: _write_typed(staged, contract, params, new_typed),
            lambda: _write_quarantine(staged, contract, params, new_quarantine),
        )
        sink.publish(spark, {typed_path: new_typed, quarantine_path: new_quarantine}, journal)
    finally:
        for leftover in (new_rows, new_typed, new_quarantine):
            delete_directory(spark, leftover)

    report = {
        "table_name": params.table,
        "run_partition": params.run_partition,
        "extract_mode": params.extract_mode,
        "started_at": started,
        "elapsed_ms": int((time.monotonic() - clock) * 1000),
        "expected": extraction.expected,
        "landed": counts["processed"] if landed is None else landed,
        "processed": counts["processed"],
        "unique_keys": unique,
        "error_rows": counts["error_rows"],
        "malformed": counts["malformed"],
        "missing_fields": align.missing_fields(spellings),
        "blanks": counts["blanks"],
        "ranges": extraction.ranges,
        "fingerprint": counts["print"],
    }
    failure = None
    try:
        frame = spark.createDataFrame([tuple(report.values())], audit.AUDIT_SCHEMA)
        audit.append_audit(frame, params.output_dir, run_date, uuid.uuid4().hex)
    except Exception as e:  # the data is written; a lost report must not undo that
        failure = e
    return RunResult(report, raw_path, typed_path, quarantine_path, failure)
