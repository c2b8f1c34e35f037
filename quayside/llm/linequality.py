"""Quality by lines: lines that break a rule go first, then documents that lost too much of their text."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame

from quayside.llm.common import per_document

# Wording of pages around a text.
BOILERPLATE = [
    "accept cookies",
    "all rights reserved",
    "click here",
    "cookie policy",
    "enable javascript",
    "javascript is disabled",
    "log in to",
    "lorem ipsum",
    "privacy policy",
    "share on facebook",
    "sign up for our newsletter",
    "skip to content",
    "subscribe to our",
    "terms of service",
    "terms of use",
    "uses cookies",
]

SYMBOLS = re.compile(r"[#*$%&|<>]")
SEPARATORS = re.compile("[|»›•·]")
SHOUTS = re.compile(r"[!?]")
BLANKS = " \t\n\x0b\x0c\r"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LINE_END = tuple(".!?:;…。！？\"'”»)")


@dataclass(frozen=True)
class LineRules:
    """The rules of a line. Words are runs of characters other than ASCII white space.

    punctuation: a line without an end mark fails below `unended_words` words; one whose words carry more than
    `shout_share` exclamation or question marks each fails, and so does one with over `symbol_share` symbols a word.
    navigation: at least `separators` separators such as bars, and one for every `words_per_separator` words.
    boilerplate: a phrase of BOILERPLATE in a line of at most `boilerplate_words` words.
    repetition: a line of at least ten words whose distinct words are fewer than `distinct_share` of them.
    A document is rejected when the words on its failed lines are more than `lost_share` of its words.
    """

    unended_words: int = 6
    shout_share: float = 0.5
    symbol_share: float = 0.5
    separators: int = 2
    words_per_separator: float = 6.0
    boilerplate_words: int = 20
    distinct_share: float = 0.2
    lost_share: float = 0.5

    def broken(self, line: str, words: list[str]) -> str | None:
        """The first rule that a line with words breaks."""
        n = len(words)
        if n < self.unended_words and not line.rstrip(BLANKS).endswith(LINE_END):
            return "punctuation"
        if len(SHOUTS.findall(line)) > self.shout_share * n and n > 1:
            return "punctuation"
        bars = len(SEPARATORS.findall(line))
        if bars >= self.separators and bars * self.words_per_separator >= n:
            return "navigation"
        if len(SYMBOLS.findall(line)) > self.symbol_share * n and n > 1:
            return "punctuation"
        if n <= self.boilerplate_words:
            lowered = line.lower()
            if any(phrase in lowered for phrase in BOILERPLATE):
                return "boilerplate"
        if n >= 10 and len(set(words)) < self.distinct_share * n:
            return "repetition"
        return None


def repeated_words(words: list[str]) -> int:
    """Words that lie in a window of three words found twice or more."""
    windows = list(zip(words, words[1:], words[2:]))  # noqa: B905
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered, reach = 0, 0
    for at, window in enumerate(windows):
        if counts[window] > 1:
            covered += at + 3 - max(at, reach)
            reach = at + 3
    return covered


def measured(text: str, rules: LineRules) -> tuple:
    """What `line_quality` returns for one text."""
    words = WORDS.findall(text)
    dup_lines, lost = 0, 0
    seen: set[str] = set()
    kept: list[str] = []
    failed: Counter[str] = Counter()
    for line in text.split("\n"):
        own = WORDS.findall(line)
        if not own:
            kept.append(line)
            continue
        if line in seen:
            dup_lines += 1
        seen.add(line)
        rule = rules.broken(line, own)
        if rule is None:
            kept.append(line)
        else:
            failed[rule] += 1
            lost += len(own)
    names = ("punctuation", "navigation", "boilerplate", "repetition")
    return (
        len(words),
        sum(map(len, words)),
        len(SYMBOLS.findall(text)),
        dup_lines,
        repeated_words(words),
        lost,
        *(failed[name] for name in names),
        lost <= rules.lost_share * len(words),
        "\n".join(kept),
    )


FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lost_words long, "
    "n_punctuation long, n_navigation long, n_boilerplate long, n_repetition long, accepted boolean, cleaned string"
)


def line_quality(
    docs: DataFrame, rules: LineRules | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Counts, the number of lines that failed each rule, the verdict and the cleaned text of every document.

    One pass without a shuffle. A null or empty text has no words, loses none and is accepted; blank lines stay.
    """
    rules = rules or LineRules()
    return per_document(docs, lambda text: measured(text, rules), FIELDS, id_col, text_col)
