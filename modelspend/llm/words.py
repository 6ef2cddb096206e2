"""Words of many texts at once: their bounds and 64-bit hashes, as numpy arrays over UTF-8 bytes."""

from __future__ import annotations

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
_RNG = np.random.Generator(np.random.PCG64(42))
#: A random 64-bit value for each byte, the same in every process.
_BYTE_VALUES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: Bytes of words that white space ends, and of words of ASCII letters, digits and all non-ASCII characters.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: Lower case for A-Z, every other byte unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix64's finalizer)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: Powers of the base and of its inverse, for the longest data so far.
_POWERS: list[np.ndarray] = []


def _powers(size: int) -> list[np.ndarray]:
    """More than ``size`` powers of the base, and of its inverse."""
    if not _POWERS or len(_POWERS[0]) <= size:
        most = 1 << max(20, size.bit_length())
        inverse = np.uint64(pow(int(_ODD), -1, 2**64))
        _POWERS[:] = [
            np.concatenate([[np.uint64(1)], np.full(most, base, np.uint64)]).cumprod(dtype=np.uint64)
            for base in (_ODD, inverse)
        ]
    return _POWERS


def word_bounds(data: np.ndarray, bounds: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in ``data``, and the index of the first word of each text.

    ``bounds`` are the texts' limits in ``data``; a word never crosses them.
    The last array has one entry more than there are texts.
    """
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(bounds), np.int64)
    inside = kind[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edge = bounds[(bounds > 0) & (bounds < len(data))]
    first[edge] = inside[edge]
    last[edge - 1] = inside[edge - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, bounds)


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """What :func:`span_hashes` needs of ``data``."""
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE_VALUES[data] * _powers(len(data))[0][: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span; the same wherever these bytes stand."""
    h = (sums[ends] - sums[starts]) * _powers(len(sums))[1][starts]
    return mix(h ^ ((ends - starts).astype(np.uint64) * _ODD))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each word in lower case (A-Z only)."""
    return span_hashes(prefix_sums(LOWER[data]), starts, ends)


def hash_of_bytes(word: bytes) -> int:
    """The hash of one word; the same as :func:`span_hashes` gives."""
    h = 0
    for i, b in enumerate(word):
        h += int(_BYTE_VALUES[b]) * pow(int(_ODD), i, 1 << 64)
    h = (h ^ (len(word) * int(_ODD))) & ((1 << 64) - 1)
    return int(mix(np.array([h], np.uint64))[0])


def hash_of(word: str) -> int:
    """The hash of one word in lower case (A-Z only)."""
    return hash_of_bytes(word.encode().lower())


def code_points(data: np.ndarray) -> np.ndarray:
    """For each byte offset (and the end), the number of code points before it."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out
