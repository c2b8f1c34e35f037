"""Token counts by section: a document is encoded once as a whole, and its tokens are attributed by their offsets.

Encoding sections one by one would count other tokens than the whole text has. Here each token's character span, known
from the bytes it stands for, is joined to the sections' intervals; a token that crosses a boundary is given by rule.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quayside.llm.common import column, kept_in_worker, small_parts

RULES = ("first", "last", "most", "share")

# Fixed value: how the vocabulary's texts are split into words before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# The library's pattern steps back through a run of white space one character at a time, on a stack that has an end.
LONG_RUN = 10_000


class Encoder:
    """A byte-level BPE vocabulary of ranks, with the spans of its tokens."""

    def __init__(self, ranks_file: bytes):
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks_file.splitlines() if line)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)

    def ids(self, text: str, long_run: int = LONG_RUN) -> np.ndarray:
        """The ids of a text. A long run of white space is one word of the pattern, but for its last character where
        something follows, so it is handed to the merges as it is."""
        parts, at = [], 0
        for run in regex.finditer(rf"\p{{White_Space}}{{{long_run},}}", text):
            stop = run.end() - (run.end() < len(text))
            parts.append(self.encoding.encode_to_numpy(text[at : run.start()], disallowed_special=()))
            if stop > run.start():
                parts.append(self.encoding._encode_single_piece(text[run.start() : stop]))
            at = stop
        parts.append(self.encoding.encode_to_numpy(text[at:], disallowed_special=()))
        return np.concatenate([np.asarray(p, dtype=np.int64) for p in parts])

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and the first and the end character of each token.

        A token that holds only a part of a character's bytes spans that character.
        """
        ids = self.ids(text)
        ends = np.cumsum(self.lengths[ids]) if len(ids) else np.zeros(0, dtype=np.int64)
        starts = ends - self.lengths[ids] if len(ids) else ends
        data = text.encode()
        if len(data) == len(text):
            return ids, starts, ends
        leads = (np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80
        character = np.cumsum(leads) - 1  # of each byte
        return ids, character[starts], character[ends - 1] + 1


def encoder_of(ranks_file: bytes) -> Encoder:
    return kept_in_worker(("ranks", ranks_file), lambda: Encoder(ranks_file))


def attributed(
    starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, stops: np.ndarray, rule: str
) -> tuple[np.ndarray, int, int]:
    """Tokens by section, how many tokens cross a boundary, and how many lie in no section at all.

    Sections are [bounds, stops), sorted and disjoint. A token belongs to the section with its first (rule "first") or
    last character, to the one with most of its characters, the earlier of equals ("most"), or to each by its share of
    characters ("share"). A token outside by the rule is in no section.
    """
    low = np.searchsorted(stops, starts, side="right")  # the first section that ends behind the token's start
    high = np.searchsorted(bounds, ends, side="left") - 1  # the last one that begins before its end
    touched = np.maximum(high - low + 1, 0)
    inside = np.zeros(len(starts), dtype=bool)
    at = np.flatnonzero(touched)
    inside[at] = (bounds[low[at]] <= starts[at]) & (ends[at] <= stops[low[at]])
    crossing = (touched > 0) & ~inside
    counts = np.zeros(len(bounds))
    np.add.at(counts, low[inside], 1.0)
    outside = int((touched == 0).sum())
    for token in np.flatnonzero(crossing):
        sections = np.arange(low[token], high[token] + 1)
        overlap = np.minimum(stops[sections], ends[token]) - np.maximum(bounds[sections], starts[token])
        if rule == "share":
            counts[sections] += overlap / (ends[token] - starts[token])
        elif rule == "most":
            counts[sections[np.argmax(overlap)]] += 1
        else:
            place = starts[token] if rule == "first" else ends[token] - 1
            held = sections[(bounds[sections] <= place) & (place < stops[sections])]
            if len(held):
                counts[held[0]] += 1
            else:
                outside += 1
    return counts, int(crossing.sum()), outside


def token_attribution(
    docs: DataFrame,
    ranks_path: str,
    sections_col: str | None = None,
    rule: str = "first",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Token counts of every document and of its sections, by one encoding of the whole text.

    `sections_col` holds array<struct<name: string, start: long, end: long>> in characters, disjoint; without it the
    sections are the paragraphs: lines with the line feed behind them, named by their number. Returned are the id,
    n_tokens, n_crossing (tokens over a boundary), n_outside (tokens in no section by the rule) and `sections`, an
    array of (name, start, end, n_tokens) in the order of the text; n_tokens is double under the rule "share", where a
    part outside all sections is in none. Nulls: a null text is empty, a null array is no section, entries with null
    bounds or of no length count no tokens. A section that begins before an earlier one has ended counts none either,
    and `n_overlapping` tells how many such there are. Repeated rows are answered each time. No shuffle.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    with open(ranks_path, "rb") as file:
        ranks = file.read()
    source = docs.select(
        column(id_col).alias(id_col),
        column(text_col).alias("text"),
        *([column(sections_col).alias("sections")] if sections_col else []),
    )
    fields = "n_tokens long, n_crossing long, n_outside long, n_overlapping long, "
    fields += "sections array<struct<name: string, start: long, end: long, n_tokens: double>>"
    schema = StructType([source.schema[id_col], *StructType.fromDDL(fields).fields])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(ranks)
        target = to_arrow_schema(schema)
        for part in small_parts(parts, 1):
            rows = []
            given = part.column(2).to_pylist() if sections_col else None
            for at, text in enumerate(part.column(1).to_pylist()):
                rows.append(_document(encoder, text or "", given[at] or [] if sections_col else None, rule))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            arrays = [part.column(0).cast(target.field(0).type)]
            arrays += [pa.array(values, type=target.field(i + 1).type) for i, values in enumerate(columns)]
            yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return source.mapInArrow(batches, schema)


def _document(encoder: Encoder, text: str, given: list[dict] | None, rule: str) -> tuple:
    _, starts, ends = encoder.spans(text)
    overlapping = 0
    if given is None:
        lengths = np.fromiter((len(line) + 1 for line in text.split("\n")), dtype=np.int64)
        stops = np.cumsum(lengths)
        stops[-1] -= 1  # no line feed behind the last one
        bounds = np.append(0, stops[:-1])
        names = [str(i) for i in range(len(stops))]
    else:
        usable = [s for s in given if s and s["start"] is not None and s["end"] is not None]
        usable.sort(key=lambda s: (s["start"], s["end"]))
        bounds = np.array([s["start"] for s in usable], dtype=np.int64)
        stops = np.maximum(np.array([s["end"] for s in usable], dtype=np.int64), bounds)
        names = [s["name"] for s in usable]
        until = 0
        for i in range(len(bounds)):
            if bounds[i] < until and stops[i] > bounds[i]:
                stops[i] = bounds[i]
                overlapping += 1
            until = max(until, stops[i])
    filled = np.flatnonzero(stops > bounds)
    counts = np.zeros(len(bounds))
    counts[filled], crossing, outside = attributed(starts, ends, bounds[filled], stops[filled], rule)
    keys = ("name", "start", "end", "n_tokens")
    rows = zip(names, bounds.tolist(), stops.tolist(), counts.tolist(), strict=True)
    return len(starts), crossing, outside, overlapping, [dict(zip(keys, row, strict=True)) for row in rows]
