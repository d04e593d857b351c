"""Plain versions of the operators' definitions, and awkward texts to try them on."""

from __future__ import annotations

import random
import re

AWKWARD = [None, "", " ", "\n\n", "a", "ümlaut Ünicode 漢字 words", "x" * 5000, "one two three", "tab\tand\x0bvertical\x0cfeed", "𝒜 😀 done"]


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary):x}" for _ in range(words))


def letter_words(text: str | None) -> list[str]:
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def spaced_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
