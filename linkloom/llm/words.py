"""Words, shingles and minwise sketches of many texts at once, as flat arrays."""

from __future__ import annotations

import numpy as np

_U = np.uint64


def _constants(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, n, dtype=np.int64).astype(_U)


BYTE_CODE = _constants(11, 256)
_PLACE = _U(0x9E3779B97F4A7C15)
_MIX = (_U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB))
# Bytes that separate words: space and the five controls from tab to carriage return.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mixed(h: np.ndarray) -> np.ndarray:
    """Every input bit reaches every output bit; one to one."""
    h = h ^ (h >> _U(30))
    h *= _MIX[0]
    h ^= h >> _U(27)
    h *= _MIX[1]
    h ^= h >> _U(31)
    return h


def word_spans(
    data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = BLANK
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words and, per text, the number of the first word (one more at the end)."""
    n = len(data)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    inside = ~blank[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    starts = np.flatnonzero(inside & (first[:n] | np.r_[True, ~inside[:-1]]))
    ends = np.flatnonzero(inside & (first[1:] | np.r_[~inside[1:], True])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit code of each word's bytes and length."""
    if len(starts) == 0:
        return np.zeros(0, _U)
    sizes = ends - starts
    longest = int(sizes.max())
    powers = np.ones(longest, _U)
    if longest > 1:
        powers[1:] = np.multiply.accumulate(np.full(longest - 1, _PLACE, _U))
    before = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum()), dtype=np.int64) - np.repeat(before, sizes)
    at = place + np.repeat(starts, sizes)
    codes = np.add.reduceat(BYTE_CODE[data[at]] * powers[place], before)
    return mixed(codes + sizes.astype(_U) * _MIX[0])


_STEP = _constants(23, 64) | _U(1)


def shingle_sets(
    codes: np.ndarray, firsts: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``width`` words of each text, sorted, and their offsets by text.

    A text with fewer words has its whole sequence as its only shingle; one without words has none.
    """
    sets, counts = [], np.zeros(len(firsts) - 1, np.int64)
    if len(codes) >= width:
        runs = np.zeros(len(codes) - width + 1, _U)
        for k in range(width):
            runs += codes[k : k + len(runs)] * _STEP[k]
        runs = mixed(runs + _U(width))
    for i in range(len(counts)):
        a, b = int(firsts[i]), int(firsts[i + 1])
        if b - a >= width:
            found = np.unique(runs[a : b - width + 1])
        elif b > a:
            found = mixed(np.array([(codes[a:b] * _STEP[: b - a]).sum() + _U(b - a)], _U))
        else:
            continue
        counts[i] = len(found)
        sets.append(found)
    flat = np.concatenate(sets) if sets else np.zeros(0, _U)
    return flat, np.r_[0, np.cumsum(counts)]


def sketches(flat: np.ndarray, offsets: np.ndarray, size: int, seed: int = 5) -> np.ndarray:
    """Minwise values of each set under ``size`` permutations; all ones for an empty set."""
    out = np.full((len(offsets) - 1, size), np.uint32(0xFFFFFFFF))
    full = np.flatnonzero(np.diff(offsets))
    if len(full) == 0:
        return out
    at = offsets[:-1][full]
    low = (flat >> _U(32)).astype(np.uint32)
    rng = np.random.default_rng(seed)
    flips = rng.integers(0, 2**32, size, dtype=np.uint32)
    factors = rng.integers(0, 2**32, size, dtype=np.uint32) | np.uint32(1)
    values = np.empty_like(low)
    for k in range(size):
        np.bitwise_xor(low, flips[k], out=values)
        np.multiply(values, factors[k], out=values)
        out[full, k] = np.minimum.reduceat(values, at)
    return out


def overlaps(flat: np.ndarray, offsets: np.ndarray, step: int = 4096) -> np.ndarray:
    """Exact intersection sizes of all pairs of sets.

    Elements in one set only cannot meet and are left out; the rest is a product of 0/1 matrices of
    ``step`` columns at a time.
    """
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(offsets))
    _, ids, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times[ids] > 1
    kept, ids = owner[shared], (np.cumsum(times > 1) - 1)[ids[shared]]
    order = np.argsort(ids, kind="stable")
    kept, ids = kept[order], ids[order]
    counts = np.zeros((n, n), np.float32)
    for c in range(0, int(ids[-1]) + 1 if len(ids) else 0, step):
        a, b = np.searchsorted(ids, (c, c + step))
        m = np.zeros((n, min(step, int(ids[-1]) + 1 - c)), np.float32)
        m[kept[a:b], ids[a:b] - c] = 1
        counts += m @ m.T
    return counts.astype(np.int64)
