"""Words of many texts at once, hashed with numpy inside a task.

A block of texts is one byte array. Classifying its bytes gives word bounds, and prefix sums
of ``T[byte] * B**position`` (modulo 2**64) give the hash of any byte range by one subtraction,
so there is no loop over words. The same trick over word hashes gives hashes of word ranges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are held as 8-byte numbers at a time; one longer text is a block of its own.
BLOCK_BYTES = 1_000_000
#: The same for operators that share an executor with others, and hold several arrays a word beside.
SMALL_BLOCK_BYTES = 250_000
#: Texts of a block at most.
BLOCK_TEXTS = 4_096

_ODD = 0x9E3779B97F4A7C15 | 1
_ODD_WORD = 0xD1342543DE82EF95 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit numbers: multiply and shift rounds."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_values(fold_case: bool) -> np.ndarray:
    """A random-looking number for each byte; A to Z count as a to z if ``fold_case``."""
    own = np.arange(256)
    if fold_case:
        own[65:91] += 32
    return mix(own.astype(np.uint64) * np.uint64(_ODD) + np.uint64(12345))


def word_bytes(kind: str) -> np.ndarray:
    """Which bytes belong to words: ``space`` (all but ASCII white space), ``alnum`` (digits,
    ASCII letters and all beyond ASCII) or ``letter`` (ASCII letters and all beyond ASCII)."""
    own = np.ones(256, dtype=bool)
    if kind == "space":
        own[[0x20, *range(0x09, 0x0E)]] = False
        return own
    own[:0x80] = False
    own[0x41:0x5B] = own[0x61:0x7B] = True
    if kind == "alnum":
        own[0x30:0x3A] = True
    return own


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Block:
    """Words of some consecutive texts."""

    def __init__(self, first: int, data: np.ndarray, bounds: np.ndarray, kind: str, fold_case: bool):
        self.first = first  # row of the first text in its batch
        self.n_texts = len(bounds) - 1
        self.data, self.bounds = data, bounds
        n = len(data)
        inside = word_bytes(kind)[data] if n else np.zeros(0, dtype=bool)
        cut = np.zeros(n + 1, dtype=bool)
        cut[bounds] = True
        before = np.concatenate([[False], inside[:-1]]) if n else inside
        after = np.concatenate([inside[1:], [False]]) if n else inside
        self.starts = np.flatnonzero(inside & (~before | cut[:-1]))
        self.ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
        self.n_words = len(self.starts)
        up = powers(_ODD, n + 1)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(byte_values(fold_case)[data] * up[:-1], dtype=np.uint64, out=total[1:])
        down = powers(pow(_ODD, -1, 2**64), n + 1)
        lengths = (self.ends - self.starts).astype(np.uint64)
        self.hashes = mix((total[self.ends] - total[self.starts]) * down[self.starts] + lengths * np.uint64(0xA24BAED4963EE407))
        #: words[w0[t]:w0[t+1]] are those of text t
        self.word_bounds = np.searchsorted(self.starts, bounds)
        self.text_of_word = np.repeat(np.arange(self.n_texts), np.diff(self.word_bounds))
        self._total = self._down = None

    def ranges(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Hashes of the word ranges [lo, hi)."""
        if self._total is None:
            n = self.n_words
            self._total = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(self.hashes * powers(_ODD_WORD, n), dtype=np.uint64, out=self._total[1:])
            self._down = powers(pow(_ODD_WORD, -1, 2**64), n + 1)
        return mix((self._total[hi] - self._total[lo]) * self._down[lo] + (hi - lo).astype(np.uint64))

    def windows(self, size: int) -> np.ndarray:
        """First words of all windows of ``size`` words that lie in one text."""
        if self.n_words < size:
            return np.zeros(0, dtype=np.int64)
        lo = np.arange(self.n_words - size + 1)
        return lo[self.text_of_word[: len(lo)] == self.text_of_word[size - 1 :]]


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column and their bounds; null is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, dtype=np.int64)
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)), bounds


def blocks(column: pa.Array, kind: str, fold_case: bool = False, most: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of consecutive texts of a column, each of ``most`` bytes or one text."""
    data, bounds = texts_of(column)
    first = 0
    while first < len(column):
        last = max(int(np.searchsorted(bounds, bounds[first] + most, side="right")) - 1, first + 1)
        last = min(last, first + BLOCK_TEXTS)
        own = bounds[first : last + 1]
        yield Block(first, data[own[0] : own[-1]], own - own[0], kind, fold_case)
        first = last
