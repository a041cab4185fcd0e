"""Cutting text at places where byte-level pre-tokens always end."""

from __future__ import annotations

import re

# Fixed value: white space of the Unicode property White_Space.
CODES = [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
WHITE = "".join(map(chr, CODES))
#: White space with the text after it. A byte-level pre-token holds white space at its
#: start only, so each such part splits into pre-tokens as it does in its text.
PARTS = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
#: White space before a space; without any, a text may be cut before each space.
WHITE_PAIRS = [w + " " for w in WHITE]


def cut(text: str) -> tuple[list[str], list[str]]:
    """``PARTS`` of a text, and further ones given without the space they begin with."""
    if any(pair in text for pair in WHITE_PAIRS):
        return PARTS.findall(text), []
    spaced = text.split(" ")
    first = spaced.pop(0)
    return [first] if first else [], spaced


#: Signs that are a pre-token of their own at the end of a word.
STOPS = frozenset(",.;:!?")


def pre_tokens(part: str, findall) -> list[str]:
    """Pre-tokens of one of ``PARTS``; ``findall`` is that of the pattern.

    A word after one space, and a stop behind it, need no search: the pattern
    takes such a word whole.
    """
    if part[0] == " ":
        if part[1:].isalpha():
            return [part]
        if part[-1] in STOPS and part[1:-1].isalpha():
            return [part[:-1], part[-1]]
    return findall(part)


#: Parts kept by a worker with what was found for them; bounds its memory.
KEPT_PARTS = 400_000
#: Longer parts are worked out each time.
KEPT_CHARS = 64


class Kept(dict):
    """Remembers ``work(part)`` for up to ``limit`` parts; starts anew when full."""

    def __init__(self, work, limit: int = KEPT_PARTS):
        super().__init__()
        self.work, self.limit = work, limit

    def __missing__(self, part):
        found = self.work(part)
        if len(part) <= KEPT_CHARS:
            if len(self) >= self.limit:
                self.clear()
            self[part] = found
        return found
