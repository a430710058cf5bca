"""Words, shingles and their 64-bit hashes for a batch of texts, in numpy.

A word is ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. Hashes depend on the
word's bytes alone, not on its place, the batch or the machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORDS = 5
#: Bytes of text worked on at once; temporaries take about 40 times as much.
SLICE = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = [np.ones(1, _U), np.ones(1, _U)]


def mix(h: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


_LETTER = mix(np.arange(1, 257, dtype=_U) * _U(_BASE))
_PLACE = mix(np.arange(1000, 1064, dtype=_U) * _U(_BASE)) | _U(1)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(max(n, SLICE), _U(base))
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Runs of rows that hold about ``limit`` bytes; a longer row stands alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, last
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, byte behind, row) of every word."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    solid = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:-1]
    ends[:-1] &= ~solid[1:] | edge[1:-1]
    first = np.flatnonzero(begins)
    return first, np.flatnonzero(ends) + 1, np.searchsorted(offsets, first, "right") - 1


def word_hashes(data: np.ndarray, first: np.ndarray, behind: np.ndarray, lower: bool = True) -> np.ndarray:
    """A hash of each word's bytes; long inputs are cut between words."""
    out = np.empty(len(first), _U)
    begin = 0
    while begin < len(first):
        stop = max(begin + 1, int(np.searchsorted(behind, first[begin] + SLICE, "right")))
        low, high = int(first[begin]), int(behind[stop - 1])
        power, inverse = _power_tables(high - low)
        part = data[low:high]
        sums = np.zeros(high - low + 1, _U)
        np.cumsum(_LETTER[_LOWER[part] if lower else part] * power[:high - low], out=sums[1:])
        s, e = first[begin:stop] - low, behind[begin:stop] - low
        out[begin:stop] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(_U))
        begin = stop
    return out


def shingle_hashes(words: np.ndarray, row: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every run of ``size`` words of one row, in order.

    A row with fewer words has its whole sequence as its only shingle.
    """
    n = len(words)
    if not n:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    count = max(0, n - size + 1)
    total = np.zeros(count, _U)
    for i in range(size):
        total += words[i:i + count] * _PLACE[i]
    whole = row[:count] == row[size - 1:size - 1 + count]
    found, owner = mix(total[whole]), row[:count][whole]
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    lengths = np.diff(np.r_[starts, n])
    short = lengths < size
    if short.any():
        extra = []
        for s, length in zip(starts[short], lengths[short]):
            extra.append(int((words[s:s + length] * _PLACE[:length]).sum(dtype=_U)) + int(_PLACE[40 + int(length)]))
        found = np.concatenate([found, mix(np.array([x % (1 << 64) for x in extra], _U))])
        owner = np.concatenate([owner, row[starts[short]]])
        order = np.argsort(owner, kind="stable")
        found, owner = found[order], owner[order]
    return found, owner


def shingle_sets(column: pa.Array, size: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text of a string column."""
    data, offsets = text_bytes(column)
    for first, last in slices(offsets):
        part = data[offsets[first]:offsets[last]]
        begins, behind, row = word_spans(part, offsets[first:last + 1] - offsets[first])
        found, owner = shingle_hashes(word_hashes(part, begins, behind), row, size)
        cuts = np.searchsorted(owner, np.arange(last - first + 1))
        for i in range(last - first):
            yield distinct(found[cuts[i]:cuts[i + 1]])


def distinct(values: np.ndarray) -> np.ndarray:
    if len(values) < 2:
        return values
    values = np.sort(values)
    return values[np.r_[True, values[1:] != values[:-1]]]


def jaccard_parts(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sizes of intersection and union of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0, len(b)
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    shared = int((b[at] == a).sum())
    return shared, len(a) + len(b) - shared
