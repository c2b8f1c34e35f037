"""SentencePiece encoding by a table of prefixes, and decoding.

A merge-type (BPE) model encodes every prefix of a text with one last token that is certain: the only token that ends
there and may stand behind the last token of the prefix before it. An automaton over the pieces finds the tokens that
end at each character, a test of neighbouring tokens picks the one, and the ids are read backwards from the end.

Texts are cut where no piece of the model can cross: in front of white space marks, around line feeds, and between a word
and a punctuation mark. Each such chunk is encoded for itself, and short chunks that come back are remembered.
"""

from __future__ import annotations

import codecs
import re
import struct
from itertools import groupby

import ahocorasick
from pyspark.sql import DataFrame
from sentencepiece import SentencePieceProcessor

from quayside.llm.common import kept_in_worker, per_document

SPACE = "▁"
CHUNKS_KEPT = 300_000
CHUNK_KEPT_CHARS = 40
NEVER = float("-inf")
MARKS = ".,;:!?"
PAIRS_KEPT = 250_000


def _each_byte(error: UnicodeDecodeError):
    return "�" * (error.end - error.start), error.end


codecs.register_error("quayside-each-byte", _each_byte)


class PieceTable(dict):
    """A merge-type model. As a dict it maps chunks to their ids as little-endian unsigned 32-bit integers."""

    def __init__(self, model: bytes):
        super().__init__()
        processor = SentencePieceProcessor(model_proto=model)
        self.begin, self.end = processor.bos_id(), processor.eos_id()
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte_id: dict[int, int] = {}
        self.surface: list[bytes] = []
        self.controls: set[int] = set()
        for number in range(processor.get_piece_size()):
            piece = processor.id_to_piece(number)
            if processor.is_control(number):
                self.controls.add(number)
                self.surface.append(b"")
            elif processor.is_unknown(number):
                self.surface.append(" ⁇ ".encode())
            elif processor.is_byte(number):
                self.byte_id[int(piece[1:-1], 16)] = number
                self.surface.append(bytes([int(piece[1:-1], 16)]))
            elif processor.is_unused(number):
                raise ValueError("a model with unused pieces splits them again, which the prefix table does not")
            else:
                self.score[piece] = processor.get_score(number)
                self.id[piece] = number
                self.surface.append(piece.replace(SPACE, " ").encode())
        if len(self.byte_id) != 256:
            raise ValueError("the model has no byte fallback")
        self.piece = {number: piece for piece, number in self.id.items()}
        self.size = processor.get_piece_size()
        self.pairs: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for piece, number in self.id.items():
            if len(piece) == 1 or self.merged(piece) == [piece]:  # a piece that no merges lead to is never a token
                self.automaton.add_word(piece, (len(piece), number))
        self.automaton.make_automaton()
        long = [piece for piece in self.id if len(piece) > 1]
        inner_space = any(SPACE in piece.lstrip(SPACE) for piece in long)
        line_feed = "" if any("\n" in piece for piece in long) else "\n"
        # marks that no piece has behind a letter: a word in front of one is a chunk of its own
        behind = {b for piece in long for a, b in zip(piece, piece[1:]) if a.isalpha()}  # noqa: B905
        marks = "".join(m for m in MARKS if m not in behind)
        word = rf"{SPACE}*[^\W\d_]+(?=[{re.escape(marks)}])|" if marks else ""
        pattern = rf"{word}{SPACE}+[^{SPACE}{line_feed}]*|{line_feed or SPACE}|[^{SPACE}{line_feed}]+"
        self.chunks = re.compile(r"(?s:.+)" if inner_space else pattern)

    def merged(self, text: str) -> list[str]:
        """What merging leads to: always the neighbours whose joint piece scores best, the first of equals."""
        parts = list(text)
        score = self.score.get
        joint = [score(a + b, NEVER) for a, b in zip(parts, parts[1:])]  # noqa: B905
        while joint:
            best = max(joint)
            if best == NEVER:
                break
            at = joint.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del joint[at]
            if at:
                joint[at - 1] = score(parts[at - 1] + parts[at], NEVER)
            if at < len(joint):
                joint[at] = score(parts[at] + parts[at + 1], NEVER)
        return parts

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens stay as they are when their texts meet. Remembered by left * size + right."""
        if len(self.pairs) >= PAIRS_KEPT:
            self.pairs.clear()
        first, second = self.piece[left], self.piece[right]
        stays = self.pairs[left * self.size + right] = self.merged(first + second) == [first, second]
        return stays

    def encode_chunk(self, chunk: str) -> bytes:
        pairs, size = self.pairs, self.size
        # of each prefix the last token and its length; none for the empty one and behind a character of no piece,
        # across which nothing merges
        last, lengths = [-1] * (len(chunk) + 1), [0] * (len(chunk) + 1)
        for end, (length, number) in self.automaton.iter(chunk):
            end += 1
            if last[end] >= 0:
                continue
            before = last[end - length]
            if before >= 0:
                stays = pairs.get(before * size + number)
                if not (self.compatible(before, number) if stays is None else stays):
                    continue
            last[end], lengths[end] = number, length
        ids: list[int] = []
        at = len(chunk)
        while at:
            if last[at] < 0:
                ids += [self.byte_id[b] for b in reversed(chunk[at - 1].encode())]
                at -= 1
            else:
                ids.append(last[at])
                at -= lengths[at]
        ids.reverse()
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, chunk: str) -> bytes:
        made = self.encode_chunk(chunk)
        if len(chunk) <= CHUNK_KEPT_CHARS:
            if len(self) >= CHUNKS_KEPT:
                self.clear()
            self[chunk] = made
        return made

    def encode(self, text: str, begin: bool = True, end: bool = True) -> bytes:
        """Packed ids of a text; an empty text has none but the begin and end ids."""
        body = b""
        if text:
            marked = SPACE + text.replace(" ", SPACE)
            body = b"".join(map(self.__getitem__, self.chunks.findall(marked)))
        edge = struct.Struct("<I").pack
        return (edge(self.begin) if begin else b"") + body + (edge(self.end) if end else b"")

    def decode(self, ids: bytes) -> str:
        """The text of packed ids: marks become blanks, the one put in front goes, stray bytes become U+FFFD each."""
        numbers = memoryview(ids).cast("I").tolist()
        inner = numbers[numbers[:1] == [self.begin] : len(numbers) - (numbers[-1:] == [self.end])]
        if self.controls.isdisjoint(inner):
            text = self._joined(inner)
        else:  # bytes on two sides of a control id are not one character
            runs = groupby(inner, key=self.controls.__contains__)
            text = "".join(self._joined(list(run)) for control, run in runs if not control)
        first = next((n for n in inner if n not in self.controls), None)
        return text[1:] if self.piece.get(first, "").startswith(SPACE) else text

    def _joined(self, numbers: list[int]) -> str:
        data = b"".join(map(self.surface.__getitem__, numbers))
        try:
            return data.decode()
        except UnicodeDecodeError:
            return data.decode(errors="quayside-each-byte")


def table_of(model: bytes) -> PieceTable:
    """The table of a model, kept with what it remembers for the tasks that a worker runs one after the other."""
    return kept_in_worker(("pieces", model), lambda: PieceTable(model))


def encoded(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every whole text with begin and end ids, and the text that the ids decode to.

    Columns: the id, n_tokens long, ids binary (little-endian unsigned 32-bit integers), decoded string. A null text is
    read as empty and gives the begin and end ids and an empty text. The model, half a megabyte, travels with the task.
    """
    with open(model_path, "rb") as file:
        model = file.read()

    def setup():
        table = table_of(model)

        def row(text: str) -> tuple:
            ids = table.encode(text)
            return len(ids) // 4, ids, table.decode(ids)

        return row

    return per_document(docs, None, "n_tokens long, ids binary, decoded string", id_col, text_col, setup)
