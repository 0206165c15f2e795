"""Texts to numbers of words, a batch at a time."""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

T = TypeVar("T")


_kept: dict[str, object] = {}


def kept(name: str, make: Callable[[], T]) -> T:
    """What a Python worker goes on with from one task to the next: the last thing made under a name, and no other."""
    if name not in _kept:
        _kept.clear()
        _kept[name] = make()
    return _kept[name]


class Recent:
    """What is known of words, in two generations of about `most` bytes each, so that frequent words stay.

    An entry counts with its word, its value and OVERHEAD for the objects around them.
    """

    OVERHEAD = 160

    def __init__(self, always: dict[str, T], most: int) -> None:
        self._always, self._most, self._bytes = always, most, 0
        self.known: dict[str, T] = dict(always)
        self._older: dict[str, T] = {}

    def missing(self, words: list[str]) -> list[str]:
        """Those of the words that are new; the others are known from here on. A full generation gives way first."""
        if self._bytes > self._most:
            self.known, self._older, self._bytes = dict(self._always), self.known, 0
        known, older, new = self.known, self._older, []
        for w in words:
            if w not in known:
                if w in older:
                    self.learn(w, older[w])
                else:
                    new.append(w)
        return new

    def learn(self, word: str, value: T) -> None:
        self.known[word] = value
        self._bytes += self.OVERHEAD + len(word) + (len(value) if isinstance(value, bytes) else 0)


class Words:
    """Splits texts at white space and gives each word its number; distinct words of a batch are looked up once.

    ascii_only: only the six white ASCII characters part words, and A-Z are lower-cased first; else any Unicode white space
    does. Splitting gives empty words at white ends; they have the number 0 and are left out, as are all words of number 0.
    """

    def __init__(self, number: Callable[[str], int], ascii_only: bool, most: int = 32 << 20) -> None:
        self._number, self._ascii = number, ascii_only
        self._recent: Recent = Recent({"": 0}, most)

    def numbers(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words of all texts one after another, and where each text starts (and the last one ends)."""
        arr = pa.array([t or "" for t in texts], pa.large_string())
        lists = pc.ascii_split_whitespace(pc.ascii_lower(arr)) if self._ascii else pc.utf8_split_whitespace(arr)
        flat = lists.values.dictionary_encode()
        words = flat.dictionary.to_pylist()
        for w in self._recent.missing(words):
            self._recent.learn(w, self._number(w))
        table = np.fromiter(map(self._recent.known.__getitem__, words), np.uint64, len(words))
        got = table[flat.indices.to_numpy()] if len(flat) else np.empty(0, np.uint64)
        kept = np.concatenate(([0], np.cumsum(got != 0)))
        return got[got != 0], kept[lists.offsets.to_numpy()]


def pieces(texts: list[str | None], most: int = 4 << 20) -> list[range]:
    """Ranges of texts of about so many characters each."""
    out, low, size = [], 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= most:
            out.append(range(low, i + 1))
            low, size = i + 1, 0
    return [*out, range(low, len(texts))] if low < len(texts) else out
