"""License notices in texts, with a bounded number of character edits.

A notice with at most k edits contains at least one of any k + 1 pieces of it unchanged. An automaton finds these seeds
in all texts at once; around each one the regex library looks for the notice with bounded errors and gives its span.
Phrases without edits are the case k = 0: the seed is the phrase.
"""

from __future__ import annotations

from dataclasses import dataclass

import ahocorasick
import regex
from pyspark.sql import DataFrame

from quayside.llm.common import per_document


@dataclass(frozen=True)
class Notice:
    """Words of a notice, lower-cased and joined by single blanks, its label, and how many edits are allowed."""

    words: str
    label: str
    edits: int


# Wording of phrases and notices, and their labels.
PHRASES = [
    Notice("mit license", "mit", 0),
    Notice("apache license", "apache", 0),
    Notice("general public license", "gpl", 0),
]
NOTICES = [
    Notice("released under the mit license", "mit", 3),
    Notice("permission is hereby granted free of charge to any person obtaining a copy", "mit", 6),
    Notice("licensed under the apache license version 2 0", "apache", 4),
    Notice("you may obtain a copy of the license at", "apache", 3),
    Notice("licensed under the gnu general public license version", "gpl", 5),
    Notice("under the terms of the gnu general public license", "gpl", 4),
    Notice("under the terms of the gnu lesser general public license", "lgpl", 4),
    Notice("redistribution and use in source and binary forms with or without modification", "bsd", 6),
    Notice("subject to the terms of the mozilla public license", "mpl", 4),
    Notice("licensed under cc by nc 4 0", "cc-by-nc", 1),
    Notice("licensed under cc by 4 0", "cc-by", 1),
    Notice("licensed under cc by sa 4 0", "cc-by-sa", 1),
    Notice("creative commons attribution", "cc", 2),
    Notice("all rights reserved", "reserved", 1),
]

FOLD = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)


def folded_words(text: str) -> list[bytes]:
    """Runs of digits, lower-cased ASCII letters and characters beyond ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split()


class NoticeFinder:
    """Finds all places of the notices in a text of single-blank words with a blank at both ends."""

    def __init__(self, notices: list[Notice]):
        self.notices = notices
        self.automaton = ahocorasick.Automaton()
        self.patterns = []
        seeds: dict[str, list[tuple[int, int]]] = {}
        for number, notice in enumerate(notices):
            target = f" {notice.words} " if notice.edits == 0 else notice.words
            fuzzy = f"(?b)(?:{regex.escape(target, literal_spaces=True)}){{e<={notice.edits}}}"
            self.patterns.append((target, regex.compile(fuzzy)))
            count = notice.edits + 1
            cuts = [len(target) * i // count for i in range(count + 1)]
            for start, stop in zip(cuts, cuts[1:], strict=False):
                seeds.setdefault(target[start:stop], []).append((number, start))
        for seed, uses in seeds.items():
            self.automaton.add_word(seed, (len(seed), uses))
        self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(notice, start, end, edits) of each place, from the left; the best of places that overlap."""
        wanted: dict[int, list[int]] = {}
        for end, (length, uses) in self.automaton.iter(text):
            for number, offset in uses:
                wanted.setdefault(number, []).append(end + 1 - length - offset)
        found = []
        for number, starts in wanted.items():
            target, pattern = self.patterns[number]
            edits = self.notices[number].edits
            if edits == 0:
                # the seed is the whole phrase between blanks: every hit is a place
                found += [(number, at + 1, at + len(target) - 1, 0) for at in starts]
                continue
            best: list[tuple[int, int, int, int]] = []
            for at in sorted(set(starts)):
                low = max(0, at - edits)
                match = pattern.search(text, low, min(len(text), at + len(target) + edits))
                if match is None:
                    continue
                place = (number, match.start(), match.end(), sum(match.fuzzy_counts))
                if best and place[1] < best[-1][2]:
                    if place[3] < best[-1][3]:
                        best[-1] = place
                else:
                    best.append(place)
            found += best
        return sorted(found, key=lambda place: (place[1], place[0]))


def license_scan(
    docs: DataFrame, notices: list[Notice] | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """n_words of every document and `places`: where a notice stands in it.

    A place has the notice, its label, the index of its first word, the span in the text of folded words joined by
    single blanks, and the edits. One pass without a shuffle. A null or empty text has no words and no places.
    """
    notices = notices if notices is not None else PHRASES + NOTICES

    def setup():
        finder = NoticeFinder(notices)

        def row(text: str) -> tuple:
            words = folded_words(text)
            joined = f" {b' '.join(words).decode('utf-8', 'replace')} "
            places = []
            counted, word = 0, 0
            for number, start, end, edits in finder.find(joined):
                # a match may begin with a blank: its first word is the one that holds its first other character
                first = start + (joined[start] == " ")
                word += joined.count(" ", counted, first)
                counted = max(counted, first)
                notice = notices[number]
                places.append((notice.words, notice.label, word - 1, start - 1, end - 1, edits))
            return len(words), places

        return row

    place = "notice string, label string, word long, start long, end long, edits int"
    return per_document(docs, None, f"n_words long, places array<struct<{place}>>", id_col, text_col, setup)
