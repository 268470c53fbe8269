"""Words and their hashes. A word is a run of bytes other than space and 0x09-0x0D, which is what `bytes.split` gives on UTF-8."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The column as UTF-8 bytes; null is empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit of a 64-bit value over all others."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


BASE = 0x9E3779B97F4A7C17  # 3 modulo 4, so that swapped words don't cancel
INVERSE = pow(BASE, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words, from the words' hashes: a polynomial modulo 2^64, by differences of one running sum."""
    size = len(h) - n + 1
    if size <= 0:
        return np.empty(0, np.uint64)
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * powers(BASE, len(h)), out=sums[1:])
    return mixed((sums[n:] - sums[:-n]) * powers(INVERSE, size) + np.uint64(n))
