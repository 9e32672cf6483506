"""Vectorised text kernels used inside Arrow batches.

A *block* is a list of texts laid out as one array of code points, so that splitting into
words, hashing and sliding minima are numpy passes over the block instead of Python loops
over characters. Blocks are bounded by characters (``blocks``), which bounds memory.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

U64 = np.uint64
_CHAR_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xC2B2AE3D27D4EB4F


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) over an integer array."""
    z = x.astype(U64) + U64((seed * 0x632BE59BD9B4E019 + 0x9E3779B97F4A7C15) & (2**64 - 1))
    z ^= z >> U64(30)
    z *= U64(0xBF58476D1CE4E5B9)
    z ^= z >> U64(27)
    z *= U64(0x94D049BB133111EB)
    z ^= z >> U64(31)
    return z


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below n (the base is odd, so it has an inverse)."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(1 << 16, 1 << int(n).bit_length())
        tables = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, dtype=U64)
            p[0] = 1
            tables.append(np.multiply.accumulate(p))
        _POWERS[base] = have = (tables[0], tables[1])
    return have


class Rolling:
    """Hashes of any stretch of a sequence of 64-bit symbols, from one prefix sum."""

    def __init__(self, symbols: np.ndarray, base: int = _CHAR_BASE):
        self.base = base
        power, _ = _powers(base, len(symbols) + 1)
        self.prefix = np.zeros(len(symbols) + 1, dtype=U64)
        np.cumsum(symbols * power[: len(symbols)], out=self.prefix[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        _, inverse = _powers(self.base, len(self.prefix))
        return (self.prefix[end] - self.prefix[start]) * inverse[start]

    def grams(self, k: int) -> np.ndarray:
        """The hash of every run of k symbols."""
        n = len(self.prefix) - k
        if n <= 0:
            return np.zeros(0, dtype=U64)
        _, inverse = _powers(self.base, len(self.prefix))
        return (self.prefix[k:] - self.prefix[:n]) * inverse[:n]


@lru_cache(maxsize=1)
def word_table() -> np.ndarray:
    """True for each code point that is a letter or a digit (what ``str.isalnum`` accepts)."""
    return np.fromiter((chr(c).isalnum() for c in range(0x110000)), dtype=bool, count=0x110000)


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


class Words:
    """The words of a block of texts: maximal runs of letters or digits, lower-cased.

    ``start``/``end`` are places in ``code``, ``doc`` is the text's index in the block,
    ``first[d]:first[d + 1]`` are the words of text d, ``hash`` has one 64-bit value a word.
    """

    def __init__(self, texts: list[str | None]):
        low = [(t or "").lower() for t in texts]
        self.n_docs = len(low)
        self.code = codes("\n".join(low) + "\n")
        is_word = word_table()[self.code]
        edge = np.flatnonzero(np.diff(is_word.astype(np.int8), prepend=0))
        self.start, self.end = edge[0::2], edge[1::2]
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in low), dtype=np.int64, count=len(low)))
        self.ends = ends
        self.doc = np.searchsorted(ends, self.start, side="right")
        self.first = np.searchsorted(self.doc, np.arange(self.n_docs + 1))
        self.hash = mix(Rolling(mix(self.code, 1)).of(self.start, self.end), 2)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(place of first word, hash) of every run of k words inside one text."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=U64)
        inside = np.flatnonzero(self.doc[:n] == self.doc[k - 1 :])
        return inside, Rolling(self.hash, _WORD_BASE).grams(k)[inside]

    def word(self, i: int) -> str:
        return self.code[self.start[i] : self.end[i]].tobytes().decode("utf-32-le", "surrogatepass")

    def of(self, d: int) -> list[str]:
        return [self.word(i) for i in range(self.first[d], self.first[d + 1])]


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values, by doubling: log2(w) passes."""
    if len(x) < w:
        return x[:0]
    out, have = x, 1
    while have * 2 <= w:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < w:
        out = np.minimum(out[: len(x) - w + 1], out[w - have : w - have + len(x) - w + 1])
    return out


def sliding_max(x: np.ndarray, w: int) -> np.ndarray:
    return ~sliding_min(~x, w)


def blocks(texts: Iterable[str | None], most: int = 1_000_000) -> Iterator[tuple[int, list[str | None]]]:
    """(index of the first, texts) in blocks of about ``most`` characters, order kept."""
    block: list[str | None] = []
    size = begin = 0
    for i, t in enumerate(texts):
        if block and size + len(t or "") > most:
            yield begin, block
            block, size, begin = [], 0, i
        block.append(t)
        size += len(t or "") + 1
    if block:
        yield begin, block


def signed(x: np.ndarray) -> np.ndarray:
    """The bit pattern of an unsigned array as bigint."""
    return x.view(np.int64)
