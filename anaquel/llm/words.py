"""Words of Arrow string columns as 64-bit hashes, found in numpy over the UTF-8 bytes."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

_SEED = 20240607
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

# Words of anything but ASCII white space, and words of ASCII letters, digits and everything beyond ASCII.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_CODES_EXACT = np.random.default_rng(_SEED).integers(0, 1 << 64, 256, dtype=np.uint64)
_CODES = _CODES_EXACT[_LOWER]


# Powers are kept for so many exponents; larger ones are products of two.
_CHUNK = 1 << 16


@lru_cache(maxsize=None)
def _low_powers(base: int) -> np.ndarray:
    out = np.full(_CHUNK, np.uint64(base), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _high_powers(base: int, size: int) -> np.ndarray:
    """Powers of ``base`` to the multiples of ``_CHUNK``, for exponents below ``size``."""
    out = np.full(size // _CHUNK + 1, np.uint64(pow(base, _CHUNK, 1 << 64)), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def times_powers(values: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Value i times ``base`` to the i, modulo 2^64, in place."""
    low = _low_powers(base)
    for at, high in zip(range(0, len(values), _CHUNK), _high_powers(base, len(values))):
        part = values[at : at + _CHUNK]
        part *= low[: len(part)]
        part *= high
    return values


def power_of(exponents: np.ndarray, size: int, base: int = _INVERSE) -> np.ndarray:
    """``base`` to each exponent below ``size``, modulo 2^64."""
    return _low_powers(base)[exponents & (_CHUNK - 1)] * _high_powers(base, size)[exponents >> 16]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column in one array, and where each row starts (one more for the end); null is empty."""
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first, last = (int(offsets[0]), int(offsets[-1])) if len(offsets) else (0, 0)
    return data[first:last], offsets - first


def find_words(data: np.ndarray, rows: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words start and end, and the first word of each row (one more for the end).

    ``letters`` marks the bytes words consist of. Words do not span rows.
    """
    inside = letters[data]
    opens = np.zeros(len(data) + 1, bool)
    opens[rows] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | opens[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | opens[1:-1]
    begin = np.flatnonzero(starts)
    return begin, np.flatnonzero(ends) + 1, np.searchsorted(begin, rows)


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, with A-Z as a-z: a polynomial over random codes of the bytes."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(times_powers(_CODES[data]), out=sums[1:])
    return mix((sums[end] - sums[begin]) * power_of(begin, len(data)) + (end - begin).astype(np.uint64))


def chain_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """A hash of every ``length`` consecutive words, by their order; empty if there are fewer."""
    count = len(words) - length + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for k in range(length):
        total = (total + words[k : k + count]) * np.uint64(0x9FB21C651E98DF25)
        total ^= total >> np.uint64(29)
    return mix(total)
