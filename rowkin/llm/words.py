"""Texts cut into words, many texts at once: markup removed, code points classed by table, runs found by numpy."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

TAG = re.compile(r"<[a-zA-Z/!?][^<>]*>|\[/?[a-zA-Z]{1,8}(?:=[^\[\]]*)?\]")
LETTER, DIGIT, UPPER = 1, 2, 4
AT_ONCE = 1_000_000  # characters cut at a time


def unmarked(text: str) -> str:
    """The text with entities read (also doubly escaped ones) and a blank for each tag, however long."""
    if "&" in text:
        text = html.unescape(html.unescape(text))
    return TAG.sub(" ", text) if "<" in text or "[" in text else text


def _kind(c: str) -> int:
    return (DIGIT if c.isdecimal() else LETTER if c.isalnum() else 0) | (UPPER if c.isupper() else 0)


@lru_cache(1)
def _table() -> np.ndarray:
    return np.array([_kind(chr(c)) for c in range(1 << 16)], dtype=np.uint8)


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def kinds(points: np.ndarray) -> np.ndarray:
    """LETTER or DIGIT, and UPPER, of every code point."""
    out = _table()[np.minimum(points, 0xFFFF)]
    high = points > 0xFFFF
    if high.any():
        each, at = np.unique(points[high], return_inverse=True)
        out[high] = np.array([_kind(chr(c)) for c in each], dtype=np.uint8)[at]
    return out


def runs(classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every run of one class other than 0."""
    edge = np.r_[0, classes, 0]
    change = edge[1:] != edge[:-1]
    return np.flatnonzero(change[:-1] & (classes != 0)), np.flatnonzero(change[1:] & (classes != 0)) + 1


def portions(texts: list[str], most: int = AT_ONCE) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``most`` characters together, or one longer text alone."""
    a = size = 0
    for b, t in enumerate(texts):
        if b > a and size + len(t) > most:
            yield a, b
            a, size = b, 0
        size += len(t)
    if a < len(texts):
        yield a, len(texts)


def joined(texts: list[str]) -> tuple[str, np.ndarray]:
    """The texts with two line ends after each, and where each begins."""
    lens = np.fromiter((len(t) + 2 for t in texts), dtype=np.int64, count=len(texts))
    return "\n\n".join([*texts, ""]), np.cumsum(lens) - lens


class Numbers(dict):
    """Words numbered in the order in which they are first asked for; ``new`` is told each."""

    def __init__(self, new):
        super().__init__()
        self.new = new

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new(word)
        return n

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))
