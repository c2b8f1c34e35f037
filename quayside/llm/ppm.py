"""Language model scoring by prediction by partial matching over a trie of byte contexts.

Documents are packed into blocks of text in the shared folder. A block counts its words and the grams of its bytes and
deals them to shards; shards sum up the counts of all blocks, which is the model, a table as large as the corpus makes
it. No task ever holds the model: each block asks the shards for the words and grams that it has, and scores its
documents with the answers. Keys and numbers travel as sorted, compressed arrays, a row for each block and shard.

A gram's shard is decided by the last two bytes of its context, so a shard has all longer contexts that end alike and
can follow escapes from the longest to the context of two bytes. Only the counts of single-byte contexts, 257 x 257 at
most, go to every shard.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quayside.llm.common import column, per_document, stored
from quayside.llm.ppm_trie import BITS, DISCOUNT, END, SYMBOLS, GramTable, Level, code_lengths, grams, levels_of, mask

ORDER = 5
BLOCK_BYTES = 16 << 20
PIECE_BYTES = 2 << 20
GRAMS_HELD = 2_000_000
LEAST_SHARDS, MOST_SHARDS = 64, 1024
MERGED_TOGETHER = 64
WORDS, GRAMS = 0, 1


def folded(text: str | None) -> bytes:
    """A text as it is modelled: its words, A-Z lower-cased, with a blank between them."""
    return b" ".join(text.encode("utf-8", "surrogatepass").lower().split()) if text else b""


def _squeezed(data) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(bytes(data))


def _unsqueezed(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _numbers(values: np.ndarray) -> bytes:
    return _squeezed(values.tobytes())


def _numbered(data: bytes, kind=np.int64) -> np.ndarray:
    return np.frombuffer(_unsqueezed(data), dtype=kind)


def _sorted_grams(keys: np.ndarray) -> bytes:
    return _numbers(np.diff(keys, prepend=0))


def _grams_of(data: bytes) -> np.ndarray:
    return np.cumsum(_numbered(data))


def _words_of(data: bytes) -> list[bytes]:
    return _unsqueezed(data).split(b" ")


def _packed(parts: Iterator[pa.RecordBatch], target: pa.Schema) -> Iterator[pa.RecordBatch]:
    first = TaskContext.get().partitionId() << 32
    count, size = 0, 0
    ids, learns, texts = [], [], []

    def out() -> pa.RecordBatch:
        columns = [[first + count], [ids], [learns], [_squeezed(b"\n".join(texts))]]
        arrays = [pa.array(c, f.type) for c, f in zip(columns, target, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=target)

    for part in parts:
        for row in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
            text = folded(row[2])
            if ids and size + len(text) > BLOCK_BYTES:
                yield out()
                count, size = count + 1, 0
                ids, learns, texts = [], [], []
            ids.append(row[0])
            learns.append(row[1])
            texts.append(text)
            size += len(text) + 1
    if ids:
        yield out()


def blocks(docs: DataFrame, learns: Column, id_col: str, text_col: str) -> DataFrame:
    """(block, ids, learns, texts): the documents in the order they are read, folded texts compressed together."""
    source = docs.select(
        column(id_col).alias("id"), F.coalesce(learns, F.lit(False)).alias("learns"), column(text_col).alias("text")
    )
    id_type = source.schema["id"].dataType.simpleString()
    schema = StructType.fromDDL(f"block long, ids array<{id_type}>, learns array<boolean>, texts binary")
    return stored(source.mapInArrow(lambda parts: _packed(parts, to_arrow_schema(schema)), schema), "blocks")


def _texts(data: bytes) -> list[bytes]:
    return _unsqueezed(data).split(b"\n")


def word_counts(texts: list[bytes], learns: list[bool]) -> dict[bytes, int]:
    """How often the learned texts have each word of all texts; the empty word is the end of a text."""
    learned: Counter[bytes] = Counter()
    others: set[bytes] = set()
    for text, learn in zip(texts, learns, strict=True):
        words = text.split(b" ") if text else []
        if learn:
            learned.update(words)
            learned[b""] += 1
        else:
            others.update(words)
            others.add(b"")
    for word in others - learned.keys():
        learned[word] = 0
    return learned


def gram_counts(texts: list[bytes], learns: list[bool], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted grams of all texts, and how often the learned texts have each."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    held: dict[bool, list[np.ndarray]] = {True: [], False: []}
    size = {True: 0, False: 0}

    def flush(learn: bool) -> None:
        if held[learn]:
            keys, counts = np.unique(np.concatenate(held[learn]), return_counts=True)
            found.append((keys, counts if learn else np.zeros_like(counts)))
            held[learn], size[learn] = [], 0
            if sum(len(k) for k, _ in found) >= GRAMS_HELD:
                found[:] = [_summed(found)]

    for text, learn in zip(texts, learns, strict=True):
        held[learn].append(grams(text, order))
        size[learn] += len(text)
        if size[learn] >= PIECE_BYTES:
            flush(learn)
    flush(True)
    flush(False)
    return _summed(found)


def _summed(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([k for k, _ in found])
    counts = np.concatenate([c for _, c in found])
    level = Level(keys, counts)
    return level.keys, level.counts


def gram_shards(keys: np.ndarray, shards: int) -> np.ndarray:
    context = (keys >> BITS) & mask(1)
    return ((context * 2654435761 & 0xFFFFFFFF) >> 7) % shards


def _pieces(parts: Iterator[pa.RecordBatch], shards: int, order: int, target: pa.Schema) -> Iterator[pa.RecordBatch]:
    for part in parts:
        for at in range(len(part)):
            block, learns = part.column(0)[at].as_py(), part.column(1)[at].as_py()
            texts = _texts(part.column(2)[at].as_py())
            rows = []
            counted = word_counts(texts, learns)
            dealt: list[list[bytes]] = [[] for _ in range(shards)]
            for word in counted:
                dealt[zlib.crc32(word) % shards].append(word)
            for shard, words in enumerate(dealt):
                if words:
                    words.sort()
                    counts = np.fromiter(map(counted.__getitem__, words), np.int64, len(words))
                    rows.append((WORDS, shard, block, _squeezed(b" ".join(words)), _numbers(counts)))
            del counted, dealt
            keys, counts = gram_counts(texts, learns, order)
            owner = gram_shards(keys, shards)
            for shard in np.unique(owner).tolist():
                mine = owner == shard
                rows.append((GRAMS, shard, block, _sorted_grams(keys[mine]), _numbers(counts[mine])))
            arrays = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), target, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=target)


def _merge(key: tuple, table: pa.Table) -> pa.Table:
    kind, shard = key[0].as_py(), key[1].as_py()
    rows = zip(table.column("keys").to_pylist(), table.column("counts").to_pylist(), strict=True)
    low = None
    if kind == WORDS:
        total: dict[bytes, int] = {}
        for words, counts in rows:
            for word, count in zip(_words_of(words), _numbered(counts).tolist(), strict=True):
                total[word] = total.get(word, 0) + count
        names = sorted(total)
        keys = _squeezed(b" ".join(names))
        sums = np.fromiter(map(total.__getitem__, names), np.int64, len(names))
    else:
        grams_, sums = _summed([(_grams_of(k), _numbered(c)) for k, c in rows])
        keys = _sorted_grams(grams_)
        triples = np.unique(grams_[sums > 0] & mask(2))
        short = Level(triples & mask(1), np.ones_like(triples))
        low = _numbers(np.stack([short.keys, short.counts]))
    row = (kind, shard, 0, keys, _numbers(sums), int(sums.sum()), int((sums > 0).sum()), low)
    return pa.table(
        [pa.array([v], t) for v, t in zip(row, _MERGED_TYPES, strict=True)],
        names=["kind", "shard", "block", "keys", "counts", "total", "known", "low"],
    )


_PIECE = "kind int, shard int, block long, keys binary, counts binary"
_MERGED = _PIECE + ", total long, known long, low binary"
_MERGED_TYPES = [
    pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.binary()
]


def merged(pieces: DataFrame, block_count: int) -> DataFrame:
    """The counts of each shard over all blocks, summed up in rounds of about MERGED_TOGETHER pieces at a time."""
    left = block_count
    while True:
        left = -(-left // MERGED_TOGETHER)
        bundle = F.pmod(F.xxhash64("block"), F.lit(left))
        summed = pieces.groupBy("kind", "shard", bundle.alias("bundle")).applyInArrow(_merge, _MERGED)
        if left <= 1:
            return stored(summed, "model")
        # the next round's bundles are made of this round's, numbered by their place
        pieces = stored(summed.withColumn("block", F.monotonically_increasing_id()).drop("total", "known", "low"), "part")


def _unfolded(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        for low in part.column(0).to_pylist():
            keys, counts = _numbered(low).reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["gram", "n"])


def _priced(parts: Iterator[pa.RecordBatch], order: int, low: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The log10 probability of every gram of a shard."""
    lowest = levels_of(low[0], low[1], 1)
    for part in parts:
        out = []
        for at in range(len(part)):
            keys, counts = _grams_of(part.column(1)[at].as_py()), _numbered(part.column(2)[at].as_py())
            levels = lowest + levels_of(keys, counts, order, 2)
            out.append(_numbers(code_lengths(keys, levels).astype(np.float32)))
        yield pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1), pa.array(out, pa.binary())], names=["shard", "keys", "numbers"]
        )


def asked(pieces: DataFrame, model: DataFrame) -> DataFrame:
    """Every model row and every piece of a block, once: a shard of the model right before the pieces that ask it."""
    none = F.lit(None).cast("binary")
    # no block has the number -1, so the shard itself sorts first
    shards = model.select("kind", "shard", F.lit(-1).cast("long").alias("block"), none.alias("keys"), "model_keys", "numbers")
    asking = pieces.select("kind", "shard", "block", "keys", none.alias("model_keys"), none.alias("numbers"))
    return shards.unionByName(asking).repartition("kind", "shard").sortWithinPartitions("kind", "shard", "block")


def _answers(parts: Iterator[pa.RecordBatch], target: pa.Schema) -> Iterator[pa.RecordBatch]:
    """For each piece of a block, the shard's numbers at its keys. A shard comes before its pieces and is read once."""
    decoded = None
    for part in parts:
        for at in range(len(part)):
            kind, _, block, keys, model_keys, numbers = (part.column(i)[at].as_py() for i in range(6))
            if model_keys is not None:
                if kind == WORDS:
                    decoded = dict(zip(_words_of(model_keys), _numbered(numbers).tolist(), strict=True))
                else:
                    decoded = (_grams_of(model_keys), _numbered(numbers, np.float32))
                continue
            if kind == WORDS:
                wanted = _words_of(keys)
                found = _numbers(np.fromiter(map(decoded.__getitem__, wanted), np.int64, len(wanted)))
            else:
                found = _numbers(decoded[1][np.searchsorted(decoded[0], _grams_of(keys))])
            columns = zip(((block,), (kind,), (keys,), (found,)), target, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in columns], schema=target)


def _block_scores(block: pa.Table, answers: pa.Table, order: int, id_type: pa.DataType) -> pa.Table:
    logs: dict[bytes, float] = {}
    unknown: set[bytes] = set()
    keys, values = [], []
    for kind, wanted, numbers in zip(
        *(answers.column(c).to_pylist() for c in ("kind", "keys", "numbers")), strict=True
    ):
        if kind == WORDS:
            words, totals = _words_of(wanted), _numbered(numbers)
            logs.update(zip(words, np.log10(totals + 0.1).tolist(), strict=True))
            unknown.update(words[i] for i in np.flatnonzero(totals == 0))
        else:
            keys.append(_grams_of(wanted))
            values.append(_numbered(numbers, np.float32))
    rows = []
    for at in range(len(block)):
        ids, learns = block.column("ids")[at].as_py(), block.column("learns")[at].as_py()
        table = GramTable(np.concatenate(keys), np.concatenate(values))
        texts = _texts(block.column("texts")[at].as_py())
        start = 0
        while start < len(texts):
            stop, size = start, 0
            while stop < len(texts) and (size == 0 or size + len(texts[stop]) < PIECE_BYTES):
                size += len(texts[stop]) + 1
                stop += 1
            scores = table.of(np.concatenate([grams(t, order) for t in texts[start:stop]]))
            offsets = np.cumsum([0] + [len(t) + 1 for t in texts[start : stop - 1]])
            sums = np.add.reduceat(scores, offsets)
            for i in range(start, stop):
                words = texts[i].split(b" ") if texts[i] else []
                words.append(b"")
                missing = sum(map(unknown.__contains__, words)) if unknown and not learns[i] else 0
                base = sum(map(logs.__getitem__, words))
                rows.append((ids[i], learns[i], len(words), len(words) - missing, base, float(sums[i - start])))
            start = stop
    types = [id_type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(types)
    names = ["id", "learned", "n_tokens", "n_known", "base_log", "score"]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def ppm_scores(
    docs: DataFrame, learns: Column, order: int = ORDER, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every document under a byte model, and under a model of words, learned from the rows where `learns` holds.

    Returns id, learned, n_tokens, n_known, train_tokens, base_score, score; scores are log10 probabilities of the whole
    folded text and its end. `score` is by contexts of up to `order` bytes (6 at most) with escapes and exclusion;
    `base_score` sums log10((c + 0.1) / (N + 0.1 * (V + 1))) over the words and the end, of which V different ones and N
    in all were learned; n_known of the text's n_tokens were. A null text is empty: its end alone is scored. Rows that
    repeat are learned from and scored each time; where `learns` is null a row is not learned from.
    """
    if not 2 <= order <= 6:
        raise ValueError("order must be from 2 to 6")
    packed = blocks(docs, learns, id_col, text_col)
    count = packed.count()
    shards = min(max(LEAST_SHARDS, count), MOST_SHARDS)
    piece = StructType.fromDDL(_PIECE)
    pieces = stored(
        packed.select("block", "learns", "texts").mapInArrow(
            lambda parts: _pieces(parts, shards, order, to_arrow_schema(piece)), piece
        ),
        "pieces",
    )
    model = merged(pieces, count)
    # single-byte contexts: 257 x 257 counts at most in all
    low = (
        model.where(F.col("kind") == GRAMS)
        .select("low")
        .mapInArrow(_unfolded, "gram long, n long")
        .groupBy("gram")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    lows = np.array([[r["gram"] for r in low], [r["n"] for r in low]], dtype=np.int64).reshape(2, -1)
    total, known = (
        model.where(F.col("kind") == WORDS)
        .agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("known"), F.lit(0)))
        .first()
    )
    priced = (
        model.where(F.col("kind") == GRAMS)
        .select("shard", "keys", "counts")
        .mapInArrow(lambda parts: _priced(parts, order, lows), "shard int, keys binary, numbers binary")
        .select(F.lit(GRAMS).alias("kind"), "shard", F.col("keys").alias("model_keys"), "numbers")
    )
    words = model.where(F.col("kind") == WORDS).select(
        "kind", "shard", F.col("keys").alias("model_keys"), F.col("counts").alias("numbers")
    )
    answer = StructType.fromDDL("block long, kind int, keys binary, numbers binary")
    answers = asked(pieces, words.unionByName(priced)).mapInArrow(
        lambda parts: _answers(parts, to_arrow_schema(answer)), answer
    )
    id_field = packed.schema["ids"].dataType.elementType
    result = f"id {id_field.simpleString()}, learned boolean, n_tokens long, n_known long, base_log double, score double"
    id_type = to_arrow_schema(StructType().add("id", id_field)).field(0).type
    scores = (
        packed.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(lambda block, found: _block_scores(block, found, order, id_type), result)
    )
    base = F.col("base_log") - F.col("n_tokens") * F.log10(F.lit(total + 0.1 * (known + 1)))
    return scores.select(
        "id",
        "learned",
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        "score",
    )


def adaptive_score(data: bytes, order: int) -> float:
    """log10 probability of a text and its end when each byte is learned from as soon as it is scored."""
    seen: dict[bytes, dict[int, int]] = {}
    total = 0.0
    for at in range(len(data) + 1):
        symbol = data[at] if at < len(data) else END
        excluded: dict[int, int] = {}
        contexts = [data[at - length : at] for length in range(min(order, at), -1, -1)]
        for context in contexts:
            followers = {s: c for s, c in seen.get(context, {}).items() if s not in excluded}
            weight = sum(followers.values())
            if symbol in followers:
                total += np.log10((followers[symbol] - DISCOUNT) / weight)
                break
            if weight:
                total += np.log10(DISCOUNT * len(followers) / weight)
                excluded = seen[context]
        else:
            total -= np.log10(SYMBOLS - len(seen.get(b"", {})))
        for context in contexts:
            counts = seen.setdefault(context, {})
            counts[symbol] = counts.get(symbol, 0) + 1
    return float(total)


def adaptive_scores(docs: DataFrame, order: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, score): every text under a model that starts empty and learns as it goes."""

    def row(text: str) -> tuple:
        data = folded(text)
        return len(data), adaptive_score(data, order)

    return per_document(docs, row, "n_bytes long, score double", id_col, text_col)
