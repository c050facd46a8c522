"""Words, word shingles and MinHash values as numpy arrays.

Words are runs of letters and digits in lower case, each hashed to 64 bits; a shingle is
a mix of the hashes of ``SHINGLE`` words in a row. Sets of shingles are compared by these
64-bit values: two different shingles agree with a chance of about 2**-64 per pair.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SHINGLE = 5
_WORD = re.compile(r"[^\W_]+")
_REMEMBERED = 300_000
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


class _Hashes(dict):
    """Hashes of frequent words, kept per worker."""

    def __missing__(self, word: str) -> int:
        value = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) < _REMEMBERED:
            self[word] = value
        return value


_hashes = _Hashes()


def word_hashes(text: str | None) -> np.ndarray:
    words = _WORD.findall(text.lower()) if text else []
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def shingle_sequence(words: np.ndarray) -> np.ndarray:
    """The shingle at every position. Fewer than ``SHINGLE`` words make one shingle, none make none."""
    n = len(words)
    if not n:
        return words
    width = min(n, SHINGLE)
    out = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        out = out * _STEP + words[i : n - width + 1 + i]
    out ^= out >> np.uint64(31)
    out *= _MIX
    out ^= out >> np.uint64(29)
    return out


def seeds(number: int, seed: int) -> np.ndarray:
    """Odd multipliers, one per hash function."""
    return np.random.default_rng(seed).integers(1 << 31, 1 << 32, number, dtype=np.uint32) | np.uint32(1)


def fold(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(32)).astype(np.uint32)


def minhash(shingles: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """The least value of every hash function over the shingles (at least one)."""
    folded = fold(shingles)
    best = np.full(len(multipliers), 0xFFFFFFFF, np.uint32)
    for start in range(0, len(folded), 4096):
        block = folded[start : start + 4096]
        np.minimum(best, (multipliers[:, None] * block).min(axis=1), out=best)
    return best


def rows_of(batch: pa.RecordBatch, index: int, size: int = 4 << 20) -> Iterator[tuple[int, list]]:
    """(first row, values) of runs of rows with about ``size`` bytes in column ``index``, or one row."""
    column = batch.column(index)
    start, held = 0, 0
    for i, n in enumerate(pc.binary_length(column).to_pylist()):
        if i > start and held + (n or 0) > size:
            yield start, column.slice(start, i - start).to_pylist()
            start, held = i, 0
        held += n or 0
    if start < len(column):
        yield start, column.slice(start).to_pylist()
