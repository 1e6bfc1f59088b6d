"""Small corpora with the cases every operator must handle, and plain forms of the operators."""

from __future__ import annotations

import random
import re

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    words = ["".join(draw.choices("abcdeéßñ", k=draw.randint(2, 7))) for _ in range(n)]
    return "".join(w + draw.choice([" ", " ", " ", ". ", "\n"]) for w in words).strip()


def edited(text: str, seed: int, n: int) -> str:
    draw, words = random.Random(seed), text.split(" ")
    for _ in range(n):
        words[draw.randrange(len(words))] = f"w{draw.randrange(10**6)}"
    return " ".join(words)


def cases() -> list[tuple]:
    """Nulls, empty and short texts, copies, repeated rows, equal ids, near copies, a long text."""
    base, other = prose(1, 120), prose(2, 90)
    rows = [
        (1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, "one two", "b"), (5, "one  two", "b"),
        (6, base, "b"), (7, base, "b"), (7, base, "b"), (8, base.upper(), "c"), (9, other, "c"),
        (9, prose(3, 50), "c"), (None, prose(4, 40), "d"), (None, None, "d"), (10, "aaaa" * 300, "d"),
        (11, "é" * 900, "e"), (12, prose(5, 3000), "e"), (13, other + "\n" + prose(6, 60), "e"),
    ]
    rows += [(20 + i, edited(base, i, 1 + i % 6), "hot") for i in range(24)]
    rows += [(60 + i, prose(100 + i, 30) + "\n" + other[:430] + "\n" + prose(200 + i, 30), "hot") for i in range(6)]
    return rows


def shingle_set(text: str | None) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()
