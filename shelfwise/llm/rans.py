"""Static range asymmetric numeral system over interleaved lanes.

A state x lies in [2^31, 2^63). A symbol of frequency f and start c, of 2^bits in all, takes it to
(x // f) * 2^bits + x % f + c; bits is 16, or 18 for tables of more than 2^15 symbols. Before that, states too large for f give up their low 32 bits. Token i of a block is coded
by lane i % lanes, so one step of all lanes is a few array operations. Decoding runs the steps the other way.
"""

from __future__ import annotations

import numpy as np

_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)


def bits_for(n_symbols: int) -> int:
    if n_symbols > 1 << 18:
        raise ValueError("more than 2^18 different symbols")
    return 16 if n_symbols <= 1 << 15 else 18


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts of present symbols, all positive, scaled to sum to 2^bits, each at least 1."""
    if not len(counts):
        return np.empty(0, np.uint32)
    total = 1 << bits_for(len(counts))
    f = np.maximum(1, (counts.astype(np.float64) * (total / counts.sum())).astype(np.int64))
    order, over, i = np.argsort(-f, kind="stable"), int(f.sum()) - total, 0
    f[order[0]] += max(0, -over)
    while over > 0:  # only rounding up of rare symbols can exceed the total, and large ones make room
        cut = min(over, int(f[order[i]]) // 2)
        f[order[i]] -= cut
        over -= cut
        i = (i + 1) % len(order)
    return f.astype(np.uint32)


class Table:
    """Frequencies of symbols, shared by the blocks that are coded with it."""

    def __init__(self, symbols: np.ndarray, freqs: np.ndarray) -> None:
        self.symbols, self.freqs = symbols.astype(np.uint32), freqs.astype(np.uint32)
        self._bits = bits_for(len(symbols))
        size = int(symbols.max()) + 1 if len(symbols) else 0
        starts = np.cumsum(freqs, dtype=np.int64) - freqs
        self._f, self._c = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self._f[symbols], self._c[symbols] = freqs, starts

    @classmethod
    def of(cls, ids: np.ndarray) -> Table:
        counts = np.bincount(ids) if len(ids) else np.empty(0, np.int64)
        symbols = np.flatnonzero(counts)
        return cls(symbols, frequencies(counts[symbols]))

    def encode(self, ids: np.ndarray, lanes: int) -> bytes:
        """One block: the lanes' last states, then the words in the order in which decoding takes them."""
        x = np.full(lanes, _LOW, np.uint64)
        f, c = self._f[ids], self._c[ids]
        limit, shift = f << np.uint64(63 - self._bits), np.uint64(self._bits)
        words: list[np.ndarray] = []
        for low in range((len(ids) - 1) // lanes * lanes if len(ids) else -1, -1, -lanes):
            fs = f[low : low + lanes]
            xs = x[: len(fs)]
            full = xs >= limit[low : low + lanes]
            if full.any():
                words.append(xs[full].astype(np.uint32))
                xs = np.where(full, xs >> _WORD, xs)
            q = xs // fs
            x[: len(fs)] = (q << shift) + (xs - q * fs) + c[low : low + lanes]
        return x.tobytes() + (np.concatenate(words[::-1]).tobytes() if words else b"")

    def decode(self, block: bytes, n: int, lanes: int) -> np.ndarray:
        x = np.frombuffer(block, np.uint64, lanes).copy()
        words = np.frombuffer(block, np.uint32, offset=8 * lanes).astype(np.uint64)
        out, at = np.empty(n, np.uint32), 0
        # what a slot stands for, in one word: symbol (26 bits), frequency (19) and place within it (19)
        by_slot = np.repeat(np.arange(len(self.symbols)), self.freqs)
        inside = np.arange(len(by_slot), dtype=np.uint64) - self._c[self.symbols[by_slot]]
        slots = (self.symbols.astype(np.uint64)[by_slot] << np.uint64(38)) | (self.freqs.astype(np.uint64)[by_slot] << np.uint64(19)) | inside
        shift, mask, low19 = np.uint64(self._bits), np.uint64((1 << self._bits) - 1), np.uint64((1 << 19) - 1)
        for low in range(0, n, lanes):
            xs = x[: min(lanes, n - low)]
            got = slots[(xs & mask).view(np.int64)]
            out[low : low + lanes] = got >> np.uint64(38)
            xs = ((got >> np.uint64(19)) & low19) * (xs >> shift) + (got & low19)
            short = np.flatnonzero(xs < _LOW)
            xs[short] = (xs[short] << _WORD) | words[at : at + len(short)]
            at += len(short)
            x[: len(xs)] = xs
        if at != len(words) or (x != _LOW).any():
            raise ValueError("damaged block")
        return out
