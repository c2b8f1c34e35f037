"""A Spark data source over any service that hands out records page by page.

The user supplies a fetch callable; it runs on the executors, makes one request per call, and finds its own credentials
there, so none travel in options or plans. The contract of `fetch(request)`:

- it returns the matching records (mappings), at most `request.limit` of them, ordered by the key;
- `lo`/`hi` bound the change time (`hi` itself belongs to the request only when `hi_closed`);
- `after` is an exclusive and `upto` an inclusive bound of the key, `offset` skips that many matching records;
- `ids` asks for the records of exactly these keys, and then only `offset` and `limit` apply.

`count(request)`, optional, tells how many records match.
"""

from __future__ import annotations

import base64
import json
import math
import sys
import zlib
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import asdict, dataclass, replace
from datetime import datetime, timedelta
from typing import Any

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    InputPartition,
)

from quayside.functions.grammar import BASE64
from quayside.functions.names import FIELD_END
from quayside.functions.moments import Moment, as_datetime, as_text, chunk_bounds, from_micros, to_micros
from quayside.functions.ranges import check_page_size, offset_ranges
from quayside.operators.paging import id_batches

CHUNKS = "chunks"
OFFSETS = "offsets"

SCHEMA = "range_id int, updated string, value string"
# With reports, each range ends in one row without a value. It tells what the range was, what reading it took, in which
# spellings the wanted names came up in its records, their fingerprint, and what the range left for another task: the
# records behind a key, and a moment to divide them at.
REPORT_SCHEMA = SCHEMA + (
    ", low string, high string, records bigint, requests bigint, names array<string>, fingerprint string"
    ", rest_after string, rest_split string"
)
_ARROW = pa.schema(
    [
        ("range_id", pa.int32()),
        ("updated", pa.string()),
        ("value", pa.string()),
        ("low", pa.string()),
        ("high", pa.string()),
        ("records", pa.int64()),
        ("requests", pa.int64()),
        ("names", pa.list_(pa.string())),
        ("fingerprint", pa.string()),
        ("rest_after", pa.string()),
        ("rest_split", pa.string()),
    ]
)
_FIRST_STEP = timedelta(days=1) // timedelta(microseconds=1)


@dataclass(frozen=True)
class PageRequest:
    table: str
    limit: int
    fields: tuple[str, ...] = ()
    base_filter: str | None = None
    lo: datetime | None = None
    hi: datetime | None = None
    hi_closed: bool = True
    after: str | None = None
    upto: str | None = None
    offset: int | None = None
    ids: tuple[str, ...] = ()


@dataclass(frozen=True)
class PagedService:
    """A fetch callable, and a count callable where the service can count.

    A window that holds more than `rows_per_task` records is halved until its parts do not, so a burst of changes does
    not become one long task. An open window is closed first, by counting what lies beyond ever later and earlier
    moments. Without a count, a run divides while it reads: a task hands back what is left after `rows_per_task` records.

    `short_pages` tells that an offset page may be cut short though more records follow: the next page then starts
    behind the last record. Without it, an offset page that is short is an error.
    """

    fetch: Callable[[PageRequest], Iterable[Mapping[str, Any]]]
    count: Callable[[PageRequest], int] | None = None
    rows_per_task: int = 1_000_000
    short_pages: bool = False


@dataclass(frozen=True)
class PagedScan:
    """What to read from a service."""

    table: str
    key_col: str
    updated_col: str
    mode: str = CHUNKS
    start: Moment | None = None
    end: Moment | None = None
    num_ranges: int = 1
    page_size: int = 1000
    fields: tuple[str, ...] = ()
    base_filter: str | None = None
    expected: int | None = None
    report: bool = False
    wanted_names: tuple[str, ...] = ()

    def request(self) -> PageRequest:
        """The request for everything in the window."""
        lo = None if self.start is None else as_datetime(self.start)
        hi = None if self.end is None else as_datetime(self.end)
        return PageRequest(self.table, self.page_size, tuple(self.fields), self.base_filter, lo, hi)


@dataclass
class PlannedRange(InputPartition):
    """One task: a keyset range of a window chunk, or a run of offsets."""

    range_id: int
    request: PageRequest
    offsets: range | None = None

    def as_json(self) -> dict:
        """The range as plain values, which `from_json` turns back."""
        request = {k: v for k, v in asdict(self.request).items() if v not in (None, ())}
        texts = {k: as_text(request[k]) for k in ("lo", "hi") if k in request}
        span = None if self.offsets is None else [self.offsets.start, self.offsets.stop]
        return {"range_id": self.range_id, "request": request | texts, "offsets": span}

    @staticmethod
    def from_json(given: dict) -> PlannedRange:
        request = dict(given["request"])
        request |= {k: as_datetime(request[k]) for k in ("lo", "hi") if k in request}
        request |= {k: tuple(request[k]) for k in ("fields", "ids") if k in request}
        span = given["offsets"]
        return PlannedRange(given["range_id"], PageRequest(**request), None if span is None else range(*span))

    def rest(self, after: str, split: str | None) -> list[PageRequest]:
        """What is left behind a key, on both sides of a moment where one is known."""
        left = replace(self.request, after=after)
        if split is None:
            return [left]
        moment = as_datetime(split)
        return [replace(left, hi=moment, hi_closed=False), replace(left, lo=moment)]

    def bounds(self) -> tuple[str | None, str | None]:
        if self.offsets is not None:
            return str(self.offsets.start), str(self.offsets.stop - 1)
        return tuple(None if m is None else as_text(m) for m in (self.request.lo, self.request.hi))


def _landed(value: Any) -> Any:
    """A value in the text form that tables are landed in; nested values stay as they are."""
    if value is None or isinstance(value, (str, Mapping, list, tuple)):
        return value
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float) and not math.isfinite(value):
        return "NaN" if math.isnan(value) else ("Infinity" if value > 0 else "-Infinity")
    if isinstance(value, (bytes, bytearray)):
        return BASE64 + base64.b64encode(value).decode()
    return str(value)


def _json(value: Any) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"), default=str)


def as_line(record: Mapping[str, Any]) -> str:
    return _json({name: _landed(value) for name, value in record.items()})


def _text_of(record: Mapping[str, Any], name: str) -> str | None:
    value = record.get(name)
    return None if value is None else str(value)


def fingerprint(texts: Iterable[str]) -> int:
    """The checksum of a record's texts; summed up over records, in whatever order, it tells two sets apart."""
    return zlib.crc32(FIELD_END.join(texts).encode("utf-8", "surrogatepass"))


class _Texts:
    """The texts that the parser will find for the wanted names in a record, in their order; blank where there is none."""

    def __init__(self, wanted: Iterable[str]):
        self.wanted = [(name, name.lower()) for name in wanted]
        self.folded = {low for _, low in self.wanted}

    def of(self, record: Mapping[str, Any]) -> list[str]:
        found: dict[str, list[str]] = {}
        for name in record:
            if name.lower() in self.folded:
                found.setdefault(name.lower(), []).append(name)
        texts = []
        for own, low in self.wanted:
            spelled = sorted(found.get(low, ()), key=lambda n: (n != own, n))
            values = (_landed(record[n]) for n in spelled)
            value = next((v for v in values if v is not None), "")
            texts.append(value if isinstance(value, str) else _json(value))
        return texts


class _Spellings:
    """The spellings in which wanted names come up in records."""

    def __init__(self, wanted: Iterable[str]):
        self.wanted = {name.lower() for name in wanted}
        self.seen: set[str] = set()

    def note(self, page: Iterable[Mapping[str, Any]]) -> None:
        for record in page:
            self.seen.update(k for k in record.keys() - self.seen if k.lower() in self.wanted)


def _whole_chunks(scan: PagedScan) -> list[PageRequest]:
    """The window's chunks as they were asked for; an open window is one."""
    whole = scan.request()
    if whole.lo is None or whole.hi is None:
        return [whole]
    if whole.lo > whole.hi:
        return []
    bounds = chunk_bounds(whole.lo, whole.hi, scan.num_ranges)
    return [replace(whole, lo=lo, hi=hi, hi_closed=hi == whole.hi) for lo, hi in bounds]


def halved(chunk: PageRequest, service: PagedService, key_col: str) -> Iterator[PageRequest]:
    """Parts of a chunk with at most `rows_per_task` records each, in the order of time; empty halves are left out.

    Parts are found by counting. Only where one instant holds more records than a task reads is it cut at keys, and
    the offsets this takes stay within that instant. A chunk with an open end is not cut.
    """
    found = service.count(chunk)
    if found <= service.rows_per_task or chunk.lo is None or chunk.hi is None:
        yield chunk
        return
    low, high = to_micros(chunk.lo), to_micros(chunk.hi)
    if high - low <= (0 if chunk.hi_closed else 1):
        yield from _cut_at_keys(chunk, found, service, key_col)
        return
    middle = from_micros((low + high + 1) // 2)
    for half in (replace(chunk, hi=middle, hi_closed=False), replace(chunk, lo=middle)):
        if service.count(half):
            yield from halved(half, service, key_col)


def closed(whole: PageRequest, service: PagedService, scan: PagedScan) -> Iterator[PageRequest]:
    """An open window as parts with at most `rows_per_task` records each.

    From one of its bounds, or from the change time of its first record, ends are sought that nothing lies beyond, by
    steps that double; what is between them is halved. What is beyond stays open, for records that come meanwhile. Where
    records have no change time, which no bound can find, the window is cut at keys.
    """
    found = service.count(whole)
    if found <= service.rows_per_task:
        yield whole
        return
    anchor = whole.lo or whole.hi or _first_moment(whole, service, scan.updated_col)
    if anchor is None:
        yield from _cut_at_keys(whole, found, service, scan.key_col)
        return
    low, high = whole.lo or anchor, whole.hi or anchor
    beyond = []
    if whole.lo is None:
        low = _end(anchor, -1, lambda at: service.count(replace(whole, hi=at, hi_closed=False)))
        beyond.append(replace(whole, hi=low, hi_closed=False))
    if whole.hi is None:
        high = _end(anchor, 1, lambda at: service.count(replace(whole, lo=at)))
        beyond.append(replace(whole, lo=high))
    between = replace(whole, lo=low, hi=high, hi_closed=whole.hi is not None and whole.hi_closed)
    if whole.lo is None and whole.hi is None and found > sum(service.count(part) for part in [between, *beyond]):
        yield from _cut_at_keys(whole, found, service, scan.key_col)
        return
    yield from halved(between, service, scan.key_col)
    yield from beyond


def _first_moment(whole: PageRequest, service: PagedService, updated_col: str) -> datetime | None:
    for record in service.fetch(replace(whole, limit=1)):
        return _moment(record.get(updated_col))
    return None


def _moment(value: Any) -> datetime | None:
    """A change time as a moment; None where it is none."""
    try:
        return None if value is None else as_datetime(value)
    except (TypeError, ValueError):
        return None


def _end(anchor: datetime, sign: int, count: Callable[[datetime], int]) -> datetime:
    """A moment beyond which nothing is counted, sought from the anchor in steps that double."""
    step = _FIRST_STEP
    last = datetime.max if sign > 0 else datetime.min
    while True:
        room = abs(to_micros(last) - to_micros(anchor))
        at = last if step >= room else from_micros(to_micros(anchor) + sign * step)
        if at == last or not count(at):
            return at
        step *= 2


def _cut_at_keys(instant: PageRequest, found: int, service: PagedService, key_col: str) -> Iterator[PageRequest]:
    step = service.rows_per_task
    edges: list[str] = []
    for offset in range(step - 1, found - 1, step):
        at = list(service.fetch(replace(instant, offset=offset, limit=1)))
        key = str(at[0][key_col]) if at else None
        if key is not None and key not in edges[-1:]:
            edges.append(key)
    for after, upto in zip([None, *edges], [*edges, None]):
        yield replace(instant, after=after, upto=upto)


class _Span:
    """First and last change time of the records that a task has read."""

    def __init__(self):
        self.first: datetime | None = None
        self.last: datetime | None = None

    def note(self, values: Iterable[Any]) -> None:
        moments = [m for m in map(_moment, values) if m is not None]
        if moments:
            self.first = min([*moments, *([self.first] if self.first else [])])
            self.last = max([*moments, *([self.last] if self.last else [])])

    def split(self, request: PageRequest) -> str | None:
        """The moment to divide the rest of a range at: amid what was read, or else amid the window; None at an instant.

        A window without any bound may hold records without a change time, so it is not divided by time.
        """
        if request.lo is None and request.hi is None:
            return None
        for low, high in ((self.first, self.last), (request.lo, request.hi)):
            if low is not None and high is not None and to_micros(high) > to_micros(low):
                return as_text(from_micros((to_micros(low) + to_micros(high) + 1) // 2))
        return None


class _Reader(DataSourceReader):
    def __init__(self, service: PagedService, scan: PagedScan, ranges: list[PlannedRange]):
        self.service = service
        self.scan = scan
        self.ranges = ranges

    def partitions(self) -> list[PlannedRange]:
        return self.ranges

    def read(self, partition: PlannedRange | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark passes when there are no ranges
            return
        pages = self._offset_pages(partition) if partition.offsets is not None else self._key_pages(partition)
        requests = records = prints = 0
        spellings, texts, span = _Spellings(self.scan.wanted_names), _Texts(self.scan.wanted_names), _Span()
        hands_back = self.scan.report and partition.offsets is None and self.service.count is None
        after = split = None
        for page in pages:
            requests += 1
            records += len(page)
            if self.scan.report:
                spellings.note(page)
                prints += sum(fingerprint(texts.of(r)) for r in page)
            if page:
                yield self._batch(partition.range_id, page)
            if hands_back and page:
                span.note(r.get(self.scan.updated_col) for r in page)
                if records >= self.service.rows_per_task:
                    after, split = str(page[-1][self.scan.key_col]), span.split(partition.request)
                    break
        if self.scan.report:
            low, high = partition.bounds()
            names = sorted(spellings.seen)
            told = [low, high, records, requests, names, str(prints), after, split]
            yield self._arrow([partition.range_id], [None], [None], *[[value] for value in told])

    def _key_pages(self, partition: PlannedRange) -> Iterator[list]:
        """Pages by exclusive key bound. Only an empty page ends the range: a service may well return short ones."""
        request = partition.request
        while True:
            page = list(self.service.fetch(request))
            yield page
            if not page:
                return
            last = str(page[-1][self.scan.key_col])
            if last == request.after:
                raise ValueError(f"the page after key {last} ends in that same key; pages must be ordered by key")
            request = replace(request, after=last)

    def _offset_pages(self, partition: PlannedRange) -> Iterator[list]:
        """Pages by offset, until all records that the range was planned for have come."""
        at, stop = partition.offsets.start, partition.offsets.stop
        while at < stop:
            limit = min(self.scan.page_size, stop - at)
            page = list(self.service.fetch(replace(partition.request, offset=at, limit=limit)))
            if not page or (len(page) < limit and not self.service.short_pages):
                raise ValueError(f"offsets {at} to {at + limit - 1} gave {len(page)} records of {limit}")
            yield page
            at += len(page)

    def _batch(self, range_id: int, page: list) -> pa.RecordBatch:
        values = [as_line(r) for r in page]
        updated = [_text_of(r, self.scan.updated_col) for r in page]
        return self._arrow([range_id] * len(page), updated, values, *[[None] * len(page)] * (len(_ARROW) - 3))

    def _arrow(self, *columns: list) -> pa.RecordBatch:
        names = _ARROW.names if self.scan.report else _ARROW.names[:3]
        arrays = [pa.array(values, _ARROW.field(name).type) for name, values in zip(names, columns)]
        return pa.RecordBatch.from_arrays(arrays, names=names)


def planned_ranges(spark: SparkSession, service: PagedService, scan: PagedScan) -> list[PlannedRange]:
    """The tasks of a scan. Chunks are counted and halved by a Spark job, so the driver asks the service for nothing
    that grows with the records; what comes back is a few fields for each task."""
    if scan.mode == OFFSETS:
        count = service.count(scan.request()) if scan.expected is None else scan.expected
        wanted = max(scan.num_ranges, -(-count // service.rows_per_task))
        clipped = [range(r.start, min(r.stop, count)) for r in offset_ranges(count, wanted)]
        return [PlannedRange(i, scan.request(), r) for i, r in enumerate(clipped)]
    chunks = _whole_chunks(scan)
    if service.count is None or not chunks:
        return [PlannedRange(i, chunk) for i, chunk in enumerate(chunks)]
    _ship_package()
    numbered = spark.createDataFrame([(i, cloudpickle.dumps(c)) for i, c in enumerate(chunks)], "chunk int, request binary")
    one_task_each = numbered.repartitionByRange(len(chunks), "chunk")

    def plan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for number, request in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                chunk = cloudpickle.loads(request)
                is_open = chunk.lo is None or chunk.hi is None
                parted = closed(chunk, service, scan) if is_open else halved(chunk, service, scan.key_col)
                pieces = [cloudpickle.dumps(piece) for piece in parted]
                rows = [[number] * len(pieces), list(range(len(pieces))), pieces]
                arrays = [pa.array(r, t) for r, t in zip(rows, (pa.int32(), pa.int32(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(arrays, names=["chunk", "piece", "request"])

    pieces = one_task_each.mapInArrow(plan, "chunk int, piece int, request binary").collect()
    ordered = sorted(pieces, key=lambda r: (r["chunk"], r["piece"]))
    return [PlannedRange(i, cloudpickle.loads(bytes(r["request"]))) for i, r in enumerate(ordered)]


def paged_source(service: PagedService, scan: PagedScan, ranges: list[PlannedRange]) -> type[DataSource]:
    """The data source class of one planned scan, ready for `spark.dataSource.register`."""

    class Paged(DataSource):
        @classmethod
        def name(cls) -> str:
            return f"paged_{scan.table}"

        def schema(self) -> str:
            return REPORT_SCHEMA if scan.report else SCHEMA

        def reader(self, schema) -> DataSourceReader:
            return _Reader(service, scan, ranges)

    return Paged


def check_scan(service: PagedService, scan: PagedScan) -> None:
    check_page_size(scan.page_size)
    if scan.mode not in (CHUNKS, OFFSETS):
        raise ValueError(f"a paged scan reads by {CHUNKS} or {OFFSETS}, not {scan.mode!r}")
    if scan.mode == OFFSETS and scan.expected is None and service.count is None:
        raise ValueError("reading by offsets needs a record count")
    if scan.mode == CHUNKS and scan.num_ranges > 1 and (scan.start is None or scan.end is None):
        raise ValueError("an open window cannot be cut into chunks; name its start and end")


def _ship_package() -> None:
    """Send this package's code along with the tasks, so that executors need not have it installed."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__.partition(".")[0]])


def read_ranges(spark: SparkSession, service: PagedService, scan: PagedScan, ranges: list[PlannedRange]) -> DataFrame:
    """Records of some ranges of a service as JSON lines (`range_id`, `updated`, `value`), one task per range."""
    _ship_package()
    source = paged_source(service, scan, ranges)
    spark.dataSource.register(source)
    return spark.read.format(source.name()).load()


def read_paged(spark: SparkSession, service: PagedService, scan: PagedScan) -> DataFrame:
    """Records of a service as JSON lines (`range_id`, `updated`, `value`), one task per range."""
    check_scan(service, scan)
    if scan.report and service.count is None and scan.mode == CHUNKS:
        raise ValueError("a service without a count divides its ranges while a run reads them")
    return read_ranges(spark, service, scan, planned_ranges(spark, service, scan))


def fetch_ids(
    ids: DataFrame,
    service: PagedService,
    table: str,
    fields: tuple[str, ...],
    ids_per_batch: int,
    tasks: int,
    wanted_names: tuple[str, ...] = (),
    page_size: int = 1000,
) -> DataFrame:
    """Records of the given (distinct) keys as JSON lines (`value`), at most `ids_per_batch` keys per request.

    Keys are spread over `tasks` tasks and never collected. A batch is paged until an empty page ends it: a key may have
    several records, and a page may be short. Every task ends in one row without a value that tells in which spellings
    the wanted names came up (`names`) and the fingerprint of its records.
    """
    _ship_package()
    fetch = service.fetch
    lines = pa.schema([("value", pa.string()), ("names", pa.list_(pa.string())), ("fingerprint", pa.string())])

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spellings, texts, prints = _Spellings(wanted_names), _Texts(wanted_names), 0

        def pages(keys: list[str]) -> Iterator[pa.RecordBatch]:
            nonlocal prints
            request = PageRequest(table, page_size, tuple(fields), offset=0, ids=tuple(keys))
            while found := list(fetch(request)):
                spellings.note(found)
                prints += sum(fingerprint(texts.of(r)) for r in found)
                values, none = [as_line(r) for r in found], [None] * len(found)
                yield pa.RecordBatch.from_pydict({"value": values, "names": none, "fingerprint": none}, lines)
                request = replace(request, offset=request.offset + len(found))

        waiting, number = [], None
        for part in parts:
            for key, batch in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if waiting and batch != number:
                    yield from pages(waiting)
                    waiting = []
                waiting.append(key)
                number = batch
        if waiting:
            yield from pages(waiting)
        told = {"value": [None], "names": [sorted(spellings.seen)], "fingerprint": [str(prints)]}
        yield pa.RecordBatch.from_pydict(told, lines)

    batches = id_batches(ids, ids.columns[0], ids_per_batch, tasks)
    return batches.mapInArrow(read, "value string, names array<string>, fingerprint string")
