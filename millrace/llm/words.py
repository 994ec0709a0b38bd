"""Words of many texts at once, as arrays: where they are, whose they are, and a 64-bit hash each.

A word is a longest run of bytes other than space and 0x09-0x0D in the UTF-8 text. Everything is
vectorised over a batch of texts; memory is about 40 bytes per byte of the slice that is hashed
at a time, and 24 bytes per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_SLICE = 1 << 20
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


@dataclass
class Words:
    """``start``, ``end`` are byte offsets in ``data``; word i of text d is ``first[d] + i``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    code: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """For each word, the index of its text."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from 64-bit hashes."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd base modulo 2**64, and of its inverse."""
    size = max(1 << 12, 1 << int(n - 1).bit_length())
    if size not in _POWERS:
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            out.append(np.multiply.accumulate(steps))
        if size > 2 * _SLICE:  # one giant word; not worth keeping
            return out[0], out[1]
        _POWERS[size] = (out[0], out[1])
    return _POWERS[size]


def _prefix_sums(data: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(len(data))[0][: len(data)], out=sums[1:])
    return sums


def split(texts: list[bytes], *, lower: bool = False, prefixes: tuple[int, ...] = ()) -> Words:
    """The words of ``texts``. With ``prefixes`` codes has a row for the word and one for each
    prefix of so many bytes (the whole word where it is shorter)."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    if lower:
        data = _LOWER[data]
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])
    gap = np.flatnonzero(_SPACE[data])
    # a word lies between two gaps that are not neighbours
    before = np.concatenate([[-1], gap[:-1]]) if len(gap) else gap
    real = gap - before > 1
    start, end = before[real] + 1, gap[real]
    codes = np.zeros((1 + len(prefixes), len(start)), np.uint64)
    at = 0
    while at < len(start):
        stop = max(at + 1, int(np.searchsorted(end, start[at] + _SLICE, "right")))
        low, high = int(start[at]), int(end[stop - 1])
        sums, back = _prefix_sums(data[low:high]), powers(high - low + 1)[1]
        s, e = start[at:stop] - low, end[at:stop] - low
        for row, width in enumerate((None, *prefixes)):
            stop_at = e if width is None else np.minimum(e, s + width)
            codes[row, at:stop] = mix((sums[stop_at] - sums[s]) * back[s] + np.uint64(row))
        at = stop
    first = np.searchsorted(start, begins)
    return Words(data, start, end, codes if prefixes else codes[0], first)


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a text column; NULL is empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def grams(words: Words, n: int, *, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``n`` words, and the bounds of each text's runs.

    A text of 1 to n-1 words has its whole sequence as its only run if ``short``, else none.
    """
    counts = words.counts()
    runs = np.maximum(counts - n + 1, 0)
    if short:
        runs = np.where((counts > 0) & (counts < n), 1, runs)
    bounds = np.concatenate([[0], np.cumsum(runs)])
    at = np.arange(bounds[-1]) + np.repeat(words.first[:-1] - bounds[:-1], runs)
    last = np.repeat(words.first[1:], runs)
    code = np.zeros(bounds[-1], np.uint64)
    padded = np.concatenate([words.code, np.zeros(n, np.uint64)])
    for k in range(n):
        here = padded[at + k]
        if short:
            here = np.where(at + k < last, here, np.uint64(0x5851F42D4C957F2D))
        code = mix(code * np.uint64(0xD6E8FEB86659FD93) + here)
    return code, bounds


def slices(texts: list[bytes], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about ``most`` bytes each, one text at least: bounds memory."""
    begin = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield begin, i
            begin, size = i, 0
        size += len(text) + 1
    if begin < len(texts):
        yield begin, len(texts)
