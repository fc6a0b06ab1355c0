"""Cutting whole texts into units that byte-level BPE treats independently.

The pre-tokenizer never puts a character that is not white space and a following white
space into one pre-token, so a text can be cut before every run of white space that
follows something else. Frequent units are then encoded once per Python worker.
"""
from __future__ import annotations

import re
from collections.abc import Callable, Iterable

SPECIAL = "<|endoftext|>"
# The characters Unicode calls White_Space.
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
UNIT = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
ODD = re.compile(f"[\x00\t\x0b\x0c\r\x85\xa0  -     　]")
# Characters cut at a time, so that the units of a very long text are never all held at once.
PIECE = 1 << 19


def pieces(text: str, size: int = PIECE) -> Iterable[str]:
    """Consecutive parts of a text, cut only where a unit starts; a longer unit stays whole."""
    at = 0
    while len(text) - at > size:
        cut = _CUT.search(text, at + size)
        if cut is None:
            break
        yield text[at:cut.start() + 1]
        at = cut.start() + 1
    yield text[at:]


_CUT = re.compile(f"[^{SPACE}](?=[{SPACE}])")


def is_plain(text: str) -> bool:
    """Whether single spaces and line breaks inside a text that is not empty are its only white space."""
    return not (
        "  " in text or " \n" in text or "\n " in text or "\n\n" in text or text[0] in " \n" or text[-1] in " \n" or ODD.search(text)
    )


def keys(text: str) -> tuple[list[str], bool]:
    """Units of a text as cache keys, and whether the first key has a line break too many.

    A key starting with a line break or with NUL (then without it) is the unit itself;
    any other key stands for a space and the key.
    """
    if not text:
        return [], False
    if is_plain(text):
        return ("\n" + text).replace("\n", " \n").split(" ")[1:], True
    return ["\x00" + x for x in UNIT.findall(text)], False


def unit(key: str) -> str:
    return key[1:] if key[0] == "\x00" else key if key[0] == "\n" else " " + key


class Cache(dict):
    """Values of keys, computed for all new keys of a block at once, bounded by ``limit`` entries."""

    def __init__(self, compute: Callable[[list[str]], Iterable], limit: int = 1_000_000):
        super().__init__()
        self.compute, self.limit = compute, limit

    def learn(self, lists: list[list[str]]) -> None:
        new = set().union(*lists)
        if len(self) + len(new) > self.limit:
            self.clear()
        new = list(new.difference(self.keys())) if self else list(new)
        self.update(zip(new, self.compute([unit(k) for k in new])))


def segments(text: str) -> list[str]:
    """The text between special strings; each string between two segments is one token."""
    return text.split(SPECIAL)
