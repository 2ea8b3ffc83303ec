"""Vectorised words and window hashes over the bytes of many texts at once.

Prefix sums of ``T[byte] * R**position`` modulo 2**64 give the hash of any window by one subtraction
and one multiplication with a power of the inverse of R.
"""

from __future__ import annotations

import numpy as np

#: Words are maximal runs of bytes other than these.
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
_R = 0x9E3779B97F4A7C15 | 1
_R_INVERSE = pow(_R, -1, 1 << 64)
_TABLE = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    """base**0 .. base**(count-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < count:
        size = 1 << max(12, int(count - 1).bit_length())
        have = np.empty(size, np.uint64)
        have[0] = 1
        filled = 1
        while filled < size:
            have[filled : 2 * filled] = have[:filled] * np.uint64(pow(base, filled, 1 << 64))
            filled *= 2
        _powers[base] = have
    return have[:count]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_hashes(symbols: np.ndarray) -> np.ndarray:
    """Prefix sums over 64-bit symbols (bytes go through a table of random numbers first)."""
    if symbols.dtype == np.uint8:
        symbols = _TABLE[symbols]
    out = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(symbols * powers(_R, len(symbols)), out=out[1:])
    return out


def window_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mixed hashes of the windows [start, end)."""
    size = int(starts.max()) + 1 if len(starts) else 1
    return mix((prefix[ends] - prefix[starts]) * powers(_R_INVERSE, size)[starts])


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word, and the text it is in; words never cross texts."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    letter = ~SPACES[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = letter.copy()
    before[1:] &= ~letter[:-1] | edge[1:-1]
    after = letter
    after[:-1] &= ~(letter[1:]) | edge[1:-1]
    starts = np.flatnonzero(before)
    ends = np.flatnonzero(after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def lower_ascii(data: np.ndarray) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def in_one_text(text_of: np.ndarray, size: int) -> np.ndarray:
    """The positions at which ``size`` consecutive symbols belong to one text."""
    if len(text_of) < size:
        return np.zeros(0, np.int64)
    return np.flatnonzero(text_of[: len(text_of) - size + 1] == text_of[size - 1 :])


def member(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    """Which values occur in an ascending array."""
    if not len(ascending):
        return np.zeros(len(values), bool)
    at = np.searchsorted(ascending, values)
    at[at == len(ascending)] = 0
    return ascending[at] == values
