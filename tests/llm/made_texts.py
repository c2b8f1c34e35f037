"""Random texts for the tests."""

from __future__ import annotations

import random

WORDS = "river stone cloud paper light winter garden music silver orange table window market summer forest".split()

# names that operators use inside
CLASHING = "id row key version document text_version digest component n_lines kept copies size block high".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n)) + "."


def texts(seed: int, count: int) -> list[str | None]:
    """Random texts with shared lines, exact and near copies, junk, empty, blank, null and long ones."""
    rng = random.Random(seed)
    shared = [sentence(rng, 6) for _ in range(5)]
    made: list[str | None] = []
    for _ in range(count):
        lines = [sentence(rng, rng.randrange(3, 12)) for _ in range(rng.randrange(1, 8))]
        lines += [rng.choice(["  ", "\t"]) + rng.choice(shared).upper() for _ in range(rng.randrange(0, 3))]
        rng.shuffle(lines)
        made.append("\n".join(lines))
    for i in range(0, count, 9):
        words = made[i].split(" ")
        copy = list(words)
        copy[rng.randrange(len(copy))] = "changed"
        made += [made[i], " ".join(copy), " ".join(words[: len(words) // 2])]
    made += [None, "", " \n\t ", "one", "Zwei Wörter", "a b c d", "naïve 漢字 🙂\n\nend", sentence(rng, 3000)]
    return made
