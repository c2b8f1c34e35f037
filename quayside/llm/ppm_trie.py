"""The numeric core of prediction by partial matching: grams of bytes, and the code length of each gram.

A text is a sequence of symbols: its bytes and one END. A gram is a symbol behind its `order` predecessors (END before
the start), packed into 9 bits a symbol with the predicted symbol last, so the gram of a shorter context is a mask.
"""

from __future__ import annotations

import numpy as np

END = 256
SYMBOLS = 257
BITS = 9
DISCOUNT = 0.3


def grams(data: bytes, order: int) -> np.ndarray:
    """One gram for each byte of `data` and for the end behind it."""
    symbols = np.full(order + len(data) + 1, END, dtype=np.int64)
    symbols[order : order + len(data)] = np.frombuffer(data, dtype=np.uint8)
    packed = symbols[: len(data) + 1].copy()
    for step in range(1, order + 1):
        packed <<= BITS
        packed |= symbols[step : step + len(data) + 1]
    return packed


def mask(order: int) -> int:
    return (1 << (BITS * (order + 1))) - 1


class Level:
    """Trained counts of the grams of one order, with totals by context."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        self.keys = keys[first]
        self.counts = np.add.reduceat(counts, first) if len(first) else counts
        contexts = self.keys >> BITS
        self.starts = np.flatnonzero(np.diff(contexts, prepend=-1))
        self.contexts = contexts[self.starts]
        self.totals = self.by_context(self.counts)
        self.distinct = np.diff(np.append(self.starts, len(self.keys)))

    def by_context(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.starts) if len(self.starts) else values[:0]

    def of(self, keys: np.ndarray) -> np.ndarray:
        return found(self.keys, self.counts, keys)


def found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """`values` of the sorted `keys` at `wanted`, 0 where a key is missing."""
    if not len(keys):
        return np.zeros(len(wanted), dtype=values.dtype)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


def code_lengths(wanted: np.ndarray, levels: list[Level]) -> np.ndarray:
    """log10 probability of the symbol of each gram in `wanted`; `levels` go from order 0 to the order of the grams.

    From the longest context down: a symbol that the context has seen c times has probability (c - DISCOUNT) / n, the
    escape to the next shorter context DISCOUNT * d / n, where n counts what the context saw and d how many different
    symbols. Symbols that the longer context knows are excluded from the counts of the shorter one. What order 0 has not
    seen is shared evenly by the symbols left over.
    """
    result = np.zeros(len(wanted))
    todo = np.arange(len(wanted))
    taken_total = np.zeros(len(wanted))
    taken_distinct = np.zeros(len(wanted))
    above: Level | None = None
    for order in range(len(levels) - 1, -1, -1):
        level = levels[order]
        keys = wanted[todo] & mask(order)
        if above is not None:
            # what the next longer context has seen is excluded here
            excluded = above.by_context(level.of(above.keys & mask(order)))
            longer = (wanted[todo] & mask(order + 1)) >> BITS
            taken_total = found(above.contexts, excluded, longer)
            taken_distinct = found(above.contexts, above.distinct, longer)
        total = found(level.contexts, level.totals, keys >> BITS) - taken_total[: len(todo)]
        distinct = found(level.contexts, level.distinct, keys >> BITS) - taken_distinct[: len(todo)]
        count = level.of(keys)
        hit = count > 0
        with np.errstate(divide="ignore", invalid="ignore"):
            result[todo] += np.where(
                hit,
                np.log10((count - DISCOUNT) / total),
                np.where(total > 0, np.log10(DISCOUNT * distinct / total), 0.0),
            )
        todo = todo[~hit]
        above = level
    if len(todo):
        result[todo] -= np.log10(SYMBOLS - len(levels[0].keys))
    return result


def levels_of(keys: np.ndarray, counts: np.ndarray, order: int, lowest: int = 0) -> list[Level]:
    """Levels `lowest` to `order` from the counts of the longest grams.

    A shorter gram counts once for each different byte in front of it that it was seen with, not for every time: a
    shorter context is asked only about what is new to the longer one (update exclusion).
    """
    trained = counts > 0
    keys, counts = keys[trained], counts[trained]
    built: list[Level] = []
    for length in range(order, lowest - 1, -1):
        level = Level(keys & mask(length), counts)
        keys, counts = level.keys, np.ones_like(level.counts)
        built.append(level)
    return built[::-1]


class GramTable:
    """Values by gram in an open hash table of numpy arrays: a lookup is a few passes over the wanted grams."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.zeros(1 << self.bits, dtype=np.float64)
        slots = self._slots(keys)
        left = np.arange(len(keys))
        while len(left):
            free = self.keys[slots[left]] == -1
            trying = left[free]
            self.keys[slots[trying]] = keys[trying]
            mine = trying[self.keys[slots[trying]] == keys[trying]]
            self.values[slots[mine]] = values[mine]
            placed = np.zeros(len(keys), dtype=bool)
            placed[mine] = True
            left = left[~placed[left]]
            slots[left] = (slots[left] + 1) & ((1 << self.bits) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def of(self, wanted: np.ndarray) -> np.ndarray:
        """Values at `wanted`, all of which are in the table."""
        slots = self._slots(wanted)
        result = self.values[slots]
        left = np.flatnonzero(self.keys[slots] != wanted)
        while len(left):
            slots[left] = (slots[left] + 1) & ((1 << self.bits) - 1)
            same = self.keys[slots[left]] == wanted[left]
            result[left[same]] = self.values[slots[left[same]]]
            left = left[~same]
        return result
