"""Lines that repeat across documents: hashes dealt by range, streamed in order, answered by keep bitmaps.

Every line becomes a row (hash, document, position). Rows are range-partitioned by hash and document, so a line that
fills a third of a corpus spreads over as many partitions as its documents need, and sorted by hash, document and
position. One streaming pass meets the occurrences of a hash in order, the first one first, and knows how many documents
hold it. Only what a partition begins or ends with can go on in a neighbour; these pieces are summed up once more. What
comes back is a compressed bitmap for each document that loses lines, never text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quayside.llm.common import column, let_go, small_parts, stored

BLANKS = b" \t\n\x0b\x0c\r"
MASK = (1 << 63) - 1
OUTPUT_ROWS = 50_000

# states of a streamed row
DROPPED, OPEN, PIECE = 0, 1, 2


def line_keys(text: str) -> list[tuple[int, int, int]]:
    """(position, hash, hash) of each line whose key has a character: stripped of ASCII white space, A-Z lowered."""
    keys = []
    for position, line in enumerate(text.encode("utf-8", "surrogatepass").split(b"\n")):
        key = line.strip(BLANKS).lower()
        if key:
            digest = xxhash.xxh3_128_intdigest(key)
            keys.append((position, digest >> 64 & MASK, digest & MASK))
    return keys


def _hashed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    let_go()
    for part in small_parts(parts, 1):
        documents, texts, rows = part.column(0), part.column(1), part.column(2).to_pylist()
        owners, found, versions = [], [], []
        for at, text in enumerate(texts.to_pylist()):
            keys = line_keys(text) if text else []
            found += keys
            owners += [at] * len(keys)
            versions += [rows[at]] * len(keys)
        positions, high, low = zip(*found, strict=True) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(high, pa.int64()),
                pa.array(low, pa.int64()),
                documents.take(pa.array(owners, pa.int64())),
                pa.array(versions, pa.int64()),
                pa.array(positions, pa.int32()),
            ],
            names=["high", "low", "document", "version", "position"],
        )


def _occurrences(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows one by one; of rows that repeat, which come one behind the other, the first."""
    before = None
    for part in parts:
        for row in zip(*(part.column(i).to_pylist() for i in range(5)), strict=True):
            if row != before:
                yield row
            before = row


def _stream(parts: Iterator[pa.RecordBatch], min_docs: int, keep_first: bool) -> Iterator[tuple]:
    """(state, high, low, document, version, position, documents) of a partition's rows, which come sorted.

    A row is held while its hash has been met in fewer than `min_docs` documents, and dropped from there on. The first
    and the last run of equal hashes may go on in a neighbouring partition: what they still hold goes out as OPEN, and
    a PIECE tells their first row and number of documents. All other runs end here.
    """
    edge: list[tuple] = []
    for number, (_, rows) in enumerate(groupby(_occurrences(parts), key=itemgetter(0, 1))):
        if number == 1:
            yield from edge
        first = next(rows)
        held, documents, last = [first], 1, first[2]
        if min_docs <= 1 and not keep_first:
            yield (DROPPED, *first, None)
            held = []
        for row in rows:
            if row[2] != last:
                documents, last = documents + 1, row[2]
            if documents < min_docs:
                held.append(row)
                continue
            for early in held[1:] if keep_first else held:
                yield (DROPPED, *early, None)
            held = [first] if keep_first else []
            yield (DROPPED, *row, None)
        edge = [(OPEN, *row, None) for row in held] + [(PIECE, *first, documents)]
    yield from edge


def _streamed(parts: Iterator[pa.RecordBatch], min_docs: int, keep_first: bool, target: pa.Schema):
    rows: list[tuple] = []
    for row in _stream(parts, min_docs, keep_first):
        rows.append(row)
        if len(rows) == OUTPUT_ROWS:
            yield _batch(rows, target)
            rows = []
    yield _batch(rows, target)


def _batch(rows: list[tuple], target: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(target)
    arrays = [pa.array(values, field.type) for values, field in zip(columns, target, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=target)


def packed(positions: list[int]) -> bytes:
    """The keep bitmap of a document that loses the lines at `positions`: bit i of it, counted from the lowest bit of
    the first byte, is 1 where line i stays. Lines behind its end stay. Compressed by zlib."""
    bits = bytearray(b"\xff" * (max(positions) // 8 + 1))
    for position in positions:
        bits[position >> 3] &= ~(1 << (position & 7))
    return zlib.compress(bytes(bits))


def kept_lines(lines: list[str], bitmap: bytes) -> list[str]:
    bits = zlib.decompress(bitmap)
    covered = len(bits) * 8
    return [line for i, line in enumerate(lines) if i >= covered or bits[i >> 3] >> (i & 7) & 1]


def line_bitmaps(
    docs: DataFrame, min_docs: int, keep_first: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(document, version, n_dropped, bitmap) of every document that loses lines.

    Lines whose key is in at least `min_docs` documents go, all of them or, with `keep_first`, all but the first in the
    order of document and position. Keys are compared by 128 bits of hash; blank lines have none and stay. A document is
    an id: rows of one id count once, null is an id like others. Rows of one id with different texts differ in
    `version`, a hash of the text; rows alike in both share a bitmap. A null text has no lines to lose.
    """
    source = docs.select(
        column(id_col).alias("document"), column(text_col).alias("text"), F.xxhash64(column(text_col)).alias("version")
    )
    id_type = source.schema["document"].dataType.simpleString()
    place = f"document {id_type}, version long, position int"
    hashed = stored(source.mapInArrow(_hashed, f"high long, low long, {place}"), "lines")
    ordered = hashed.repartitionByRange("high", "low", "document").sortWithinPartitions(
        "high", "low", "document", "version", "position"
    )
    schema = StructType.fromDDL(f"state int, high long, low long, {place}, documents long")

    def stream(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _streamed(parts, min_docs, keep_first, to_arrow_schema(schema))

    streamed = stored(ordered.mapInArrow(stream, schema), "occurrences")
    one = F.struct("document", "version", "position")
    # two pieces for a partition at most
    whole = (
        streamed.where(F.col("state") == PIECE)
        .groupBy("high", "low")
        .agg(F.sum("documents").alias("total"), F.min(one).alias("first"))
        .where(F.col("total") >= min_docs)
    )
    still_open = streamed.where(F.col("state") == OPEN).drop("documents").join(whole, ["high", "low"])
    if keep_first:
        still_open = still_open.where(~one.eqNullSafe(F.col("first")))
    places = ["document", "version", "position"]
    dropped = streamed.where(F.col("state") == DROPPED).select(places).unionByName(still_open.select(places))
    # a row that repeats as a whole repeats its places
    gathered = dropped.groupBy("document", "version").agg(F.collect_set("position").alias("positions"))
    bitmap = F.udf(packed, "binary", useArrow=True)
    return gathered.select(
        "document", "version", F.size("positions").cast("long").alias("n_dropped"), bitmap("positions").alias("bitmap")
    )


def without_lines(
    docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(row, n_lines, n_dropped, kept) of every row of `docs`: the row itself as a struct, the number of its lines before
    dropping and of those dropped, and the text that stays. A null text is one empty line and stays null."""
    text = column(text_col)
    rows = docs.select(
        F.struct(*[column(c) for c in docs.columns]).alias("row"),
        column(id_col).alias("id"),
        F.xxhash64(text).alias("text_version"),
        text.alias("text"),
    )
    same = rows["id"].eqNullSafe(bitmaps["document"]) & (rows["text_version"] == bitmaps["version"])
    joined = rows.join(bitmaps, same, "left")

    @F.udf("string", useArrow=True)
    def kept(whole: str | None, bitmap: bytes | None) -> str | None:
        return None if bitmap is None else "\n".join(kept_lines(whole.split("\n"), bitmap))

    # only documents that lose lines are handed to Python
    reduced = kept(F.when(F.col("bitmap").isNotNull(), F.col("text")), "bitmap")
    return joined.select(
        "row",
        F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
        F.when(F.col("bitmap").isNull(), F.col("text")).otherwise(reduced).alias("kept"),
    )
