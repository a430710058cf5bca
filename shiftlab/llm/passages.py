"""Passages that documents share, by compact windows of shingle min-hashes.

The words of a text make a sequence of 5-word shingles. For a hash function, the
Cartesian tree over the shingles' hashes yields windows (l, c, r): c holds the
smallest hash of every stretch that lies in [l, r] and spans c. All stretches of at
least ``t`` shingles are so grouped by their min-hash into about 2n / t windows, and
two documents that share a stretch both have the window whose centre is the
smallest shingle of it.

Two groupings, no rounds of refinement. The first finds where texts can share
anything: an edit of a word changes 5 shingles of each text, so passages of 46
shingles or more that are 0.8 alike share a stretch of at least 21 shingles unbroken
(the fewest with one edit in the middle of the shortest). Windows of 21 shingles
have their centre in it, and ten shingles left or right of the centre as well; the
hash of those is the window's key. Every such pair so meets under a key, with one hash.

Equal texts are one from the start. Only stretches around a key that two documents have go on to the second: each
stretch of ``t`` shingles that holds no other key is filed under its own hash, and all under ``BANDS`` signatures
of ``ROWS`` min-hashes, once for every interval of stretches that share a signature. A
document meets the smallest doc_id under a key. For a stretch's own hash that
document is known to hold it, so no exact repeat is lost, whatever else the two
have; a signature's is alike with high probability, and other bands stand in
where it is not. Pairs are verified on both texts: runs of equal shingles, on all
diagonals, are joined over edits while their sets stay similar enough. A document
first meets the hub that most of its stretches have; what the passages so found cover is
settled, and only the others go on. All groupings are minima, combined before
their shuffle; work grows with windows, not with pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlab.llm import hashing, tokens
from shiftlab.llm.common import WORD, own_columns, ship, stored

WORDS = 50
SIMILAR = (80, 100)
#: Signatures of a stretch, and min-hashes in each.
BANDS, ROWS = 6, 3
#: Rounds in which a document meets only the hub that most of its open stretches have.
GREEDY = 2
#: Equal places of a pair of texts that are looked at together, and up to which all are listed.
PAIRS, ALL_PAIRS = 1 << 19, 1 << 20

#: Runs that are looked at together, and runs before one up to which all are looked at, whatever their place in the other text.
RUNS, FEW = 128, 256
#: Runs and those before them that are compared at once.
NEAR = 1 << 16
#: Open stretches of a batch of pairs that are told at once.
TOLD = 1 << 14

_U = np.uint64


def _seed(i: int) -> np.uint64:
    return hashing.mix(np.array([0x51ED270B + i], _U) * _U(0x9E3779B97F4A7C15))[0]


def compact_windows(values: np.ndarray, t: int) -> list[tuple[int, int, int]]:
    """(l, c, r), both ends included, of all windows of at least ``t`` values."""
    out = []
    todo = [(0, len(values) - 1)]
    while todo:
        low, high = todo.pop()
        if high - low + 1 < t:
            continue
        c = low + int(values[low:high + 1].argmin())
        out.append((low, c, high))
        todo.append((low, c - 1))
        todo.append((c + 1, high))
    return out


def sliding_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of the ``width`` values from each place on, as far as they reach."""
    step = 1
    while 2 * step <= width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    rest = width - step
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def unbroken(t: int, similar: tuple[int, int]) -> int:
    """Shingles in the longest run that passages of at least ``t`` share, however their edited words lie.

    With e words replaced, n shingles of each passage keep n - 5e in e + 1 runs, and are alike
    in the share (n - 5e) / (n + 5e). Similarities below a half are not looked into.
    """
    least, (near, of) = t, similar
    for edits in range(1, 100):
        n = max(t, -(-hashing.WORDS * edits * (of + near) // max(1, of - near)))
        least = min(least, -(-(n - hashing.WORDS * edits) // (edits + 1)))
    return max(1, least)


def _extents(values: np.ndarray, c: np.ndarray, low: np.ndarray, high: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """How far left of ``c`` all values are larger, and right of it none is smaller; below ``t`` places, from low to high."""
    out = np.zeros((2, len(c)), np.int64)
    for side, step in enumerate((-1, 1)):
        alive = np.arange(len(c))
        for d in range(1, t):
            at = c[alive] + step * d
            inside = at >= low[alive] if step < 0 else at <= high[alive]
            alive, at = alive[inside], at[inside]
            alive = alive[values[at] > values[c[alive]] if step < 0 else values[at] >= values[c[alive]]]
            if not len(alive):
                break
            out[side, alive] = d
    return out[0], out[1]


def window_rows(shingles: np.ndarray, cuts: np.ndarray, t: int) -> tuple[np.ndarray, ...]:
    """(key, row, place, first, last) of every window of at least ``t`` shingles, by the centre with half of them on either side.

    A row has the shingles between two ``cuts``. A place is twice the centre in its row, and one more
    for the right side. Every stretch that holds the ``t`` shingles from first to last has a window
    with this key. Windows are those of ``compact_windows``.
    """
    side = (t - 1) // 2
    none = np.zeros(0, np.int64)
    if len(shingles) < t:
        return np.zeros(0, _U), none, none, none, none
    values = hashing.mix(shingles ^ _seed(0))
    least = sliding_minima(values, side + 1)
    starts = len(least)
    # A centre is the smallest of half a window on one side of it at least.
    able = np.zeros(len(values), bool)
    able[:starts] = least == values[:starts]
    able[side:] |= least == values[side:]
    c = np.flatnonzero(able)
    row = np.searchsorted(cuts, c, "right") - 1
    begin, end = cuts[row], cuts[row + 1] - 1
    left, right = _extents(values, c, begin, end, t)
    wide = left + right + 1 >= t
    c, row, begin, left, right = c[wide], row[wide], begin[wide], left[wide], right[wide]
    first = np.clip(c - side, c - left, c + right - t + 1) - begin
    sides = stretch_hashes(shingles, side + 1)
    keys, use = [], []
    for n, ok, start in ((0, left >= side, c - side), (1, right >= side, c)):
        use.append(np.flatnonzero(ok))
        keys.append(hashing.mix(sides[start[ok]] + _seed(201 + n)))
    places = np.concatenate([2 * (c - begin)[use[0]], 2 * (c - begin)[use[1]] + 1])
    use = np.concatenate(use)
    return np.concatenate(keys), row[use], places, first[use], first[use] + t - 1


def window_keys(shingles: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, place, first, last) of ``window_rows`` for one text."""
    keys, _, places, first, last = window_rows(shingles, np.array([0, len(shingles)]), t)
    return keys, places, first, last


def marked(n: int, firsts: np.ndarray, lasts: np.ndarray) -> np.ndarray:
    """Which of ``n`` places lie from a first to its last; ends beyond the places are cut."""
    steps = np.zeros(n + 1, np.int64)
    low, high = np.maximum(firsts, 0), np.minimum(lasts, n - 1)
    able = low <= high
    np.add.at(steps, low[able], 1)
    np.subtract.at(steps, high[able] + 1, 1)
    return np.cumsum(steps)[:-1] > 0


def stretch_rows(shingles: np.ndarray, cuts: np.ndarray, opened: np.ndarray, of: np.ndarray, t: int, shared: int,
                 bands: int = BANDS, rows: int = ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, row, first, exact) of the stretches of ``t`` shingles around the ``opened`` places of windows of ``shared`` shingles.

    A row has the shingles between two ``cuts``, and the opened places with its number in ``of``.
    Stretches are filed by signatures: next stretches with one signature make one interval,
    filed once, by its middle. Those that can be in another text word for word, as they
    hold no window that other texts lack, are filed by their own hash too.
    """
    def starts(row, firsts, lasts):
        return marked(len(shingles), cuts[row] + np.maximum(firsts, 0), np.minimum(cuts[row] + lasts, cuts[row + 1] - t))

    none = np.zeros(0, np.int64)
    near = starts(of, opened // 2 - t + 1, opened // 2)
    use = np.flatnonzero(near)
    if not len(use):
        return np.zeros(0, _U), none, none, np.zeros(0, bool)
    _, row, places, first, last = window_rows(shingles, cuts, shared)
    own = ~np.isin((row << 32) + places, (of << 32) + opened)
    whole = near & ~starts(row[own], last[own] - t + 1, first[own])
    # Only shingles of such stretches matter; each stretch stays in one piece.
    held = marked(len(shingles), use, use + t - 1)
    shingles, at = shingles[held], (np.cumsum(held) - 1)[use]
    whole = np.flatnonzero(whole[use])
    keys, firsts = [hashing.mix(stretch_hashes(shingles, t)[at[whole]] + _seed(300))], [use[whole]]
    apart = np.r_[True, np.diff(use) != 1]
    for band in range(bands):
        signature = np.zeros(len(use), _U)
        for k in range(rows):
            least = sliding_minima(hashing.mix(shingles ^ _seed(1 + band * rows + k)), t)
            signature = hashing.mix(signature * _U(0x9E3779B97F4A7C15) + least[at])
        heads = apart.copy()
        heads[1:] |= signature[1:] != signature[:-1]
        heads = np.flatnonzero(heads)
        behind = np.r_[heads[1:], len(use)]
        keys.append(hashing.mix(signature[heads] + _seed(400 + band)))
        firsts.append(use[(heads + behind - 1) // 2])
    exact = np.zeros(sum(map(len, keys)), bool)
    exact[:len(whole)] = True
    firsts = np.concatenate(firsts)
    row = np.searchsorted(cuts, firsts, "right") - 1
    return np.concatenate(keys), row, firsts - cuts[row], exact


def stretch_keys(shingles: np.ndarray, opened: np.ndarray, t: int, shared: int, bands: int = BANDS,
                 rows: int = ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, first, exact) of ``stretch_rows`` for one text."""
    keys, _, first, exact = stretch_rows(shingles, np.array([0, len(shingles)]), opened, np.zeros(len(opened), np.int64), t, shared,
                                         bands, rows)
    return keys, first, exact


def shingle_slices(column: pa.Array):
    """(first row, row behind, shingle hashes, cuts between rows) of runs of texts; fewer words than a shingle give none."""
    data, offsets = hashing.text_bytes(column)
    for first, last in hashing.slices(offsets):
        part = data[offsets[first]:offsets[last]]
        begins, behind, row = hashing.word_spans(part, offsets[first:last + 1] - offsets[first])
        found, owner = hashing.shingle_hashes(hashing.word_hashes(part, begins, behind), row)
        long = np.bincount(row, minlength=last - first)[owner] >= hashing.WORDS
        if not long.all():
            found, owner = found[long], owner[long]
        yield first, last, found, np.searchsorted(owner, np.arange(last - first + 1))


def shingle_runs(column: pa.Array):
    """The shingle hashes of every text, in order; fewer words than a shingle give none."""
    for first, last, found, cuts in shingle_slices(column):
        for i in range(last - first):
            yield found[cuts[i]:cuts[i + 1]]


def filer(t: int):
    """Every key of a text with the place of each of its windows."""
    def run(batches):
        tokens.forget()
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for first, _, shingles, cuts in shingle_slices(batch.column("text")):
                keys, row, places, _, _ = window_rows(shingles, cuts, t)
                yield pa.record_batch([pa.array(keys.view(np.int64)), pa.array(ids[first + row]),
                                       pa.array(places.astype(np.int32))], ["key", "doc_id", "place"])
    return run


def refiler(t: int, shared: int):
    """Every stretch around an open window, by its own hash and by its signatures."""
    def run(batches):
        for batch in batches:
            ids, lists = batch.column("doc_id").to_numpy(zero_copy_only=False), batch.column("places")
            for first, last, shingles, cuts in shingle_slices(batch.column("text")):
                some = lists.slice(first, last - first)
                of = np.repeat(np.arange(last - first), pa.compute.list_value_length(some).to_numpy(zero_copy_only=False))
                keys, row, firsts, exact = stretch_rows(shingles, cuts, some.flatten().to_numpy().astype(np.int64), of, t, shared)
                yield pa.record_batch([pa.array(keys.view(np.int64)), pa.array(ids[first + row]),
                                       pa.array(firsts.astype(np.int32)), pa.array(exact)], ["key", "doc_id", "first", "exact"])
    return run


def stretch_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` values from each place on, as far as they reach."""
    if len(values) < width:
        return np.zeros(0, _U)
    out, done, bit, power = np.zeros(len(values), _U), 0, 1, values
    while True:
        if width & bit:
            n = len(values) - done - bit + 1
            out = hashing.mix(out[:n] * _U(0x9E3779B97F4A7C15) + power[done:done + n])
            done += bit
        if done == width:
            return out
        power = hashing.mix(power[:len(power) - bit] * _U(0xBF58476D1CE4E5B9) + power[bit:])
        bit *= 2


def _diagonal_runs(i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Rows (first i, first j, length) of the places that follow each other on a diagonal."""
    by = np.lexsort((i, j - i))
    i, j = i[by], j[by]
    apart = np.ones(len(i), bool)
    apart[1:] = (i[1:] - i[:-1] != 1) | (j[1:] - j[:-1] != 1)
    heads = np.flatnonzero(apart)
    return np.stack([i[heads], j[heads], np.append(heads[1:], len(i))[:len(heads)] - heads], 1)


def _portions(counts: np.ndarray, limit: int):
    """Runs of places that have about ``limit`` of the counts together; a larger one stands alone."""
    done, first = np.cumsum(counts), 0
    while first < len(counts):
        before = int(done[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(done, before + limit, "right")))
        yield first, last
        first = last


def _common_lengths(a: np.ndarray, b: np.ndarray):
    """A function of places in ``a`` and ``b``: how many values are equal from there on, by hashes of 1, 2, 4.. values."""
    levels = []
    while len(a) and len(b) and np.isin(a, b).any():
        levels.append((a, b))
        step = 1 << (len(levels) - 1)
        a, b = (hashing.mix(x[:max(0, len(x) - step)] * _U(0xBF58476D1CE4E5B9) + x[step:]) for x in (a, b))

    def lengths(i, j):
        out = np.zeros(len(i), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            x, y = i + out, j + out
            inside = np.flatnonzero((x < len(levels[k][0])) & (y < len(levels[k][1])))
            out[inside[levels[k][0][x[inside]] == levels[k][1][y[inside]]]] += 1 << k
        return out
    return lengths


def _runs_from_starts(a: np.ndarray, b: np.ndarray, pairs: int) -> list[np.ndarray]:
    """All maximal runs, by the places where one starts: equal ones behind different ones, or behind an end.

    Places of ``b`` are ranked by their value and the one before it. Those that start a run with a
    place of ``a`` are all of its value but one stretch of that ranking.
    """
    values = np.unique(np.r_[a, b])
    at_a, at_b = (np.searchsorted(values, x) + 1 for x in (a, b))
    base = len(values) + 2
    code = at_b * base + np.r_[0, at_b[:-1]]
    order = np.argsort(code, kind="stable")
    ranked = code[order]
    same = at_a * base + np.r_[base - 1, at_a[:-1]]
    low, high = np.searchsorted(ranked, at_a * base), np.searchsorted(ranked, (at_a + 1) * base)
    left = np.searchsorted(ranked, same) - low
    gap = np.searchsorted(ranked, same, "right") - low - left
    many = high - low - gap
    lengths, rows = _common_lengths(a, b), []
    for first, last in _portions(many, pairs):
        count = many[first:last]
        i = np.repeat(np.arange(first, last), count)
        nth = np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
        j = order[low[i] + nth + np.where(nth < left[i], 0, gap[i])]
        rows.append(np.stack([i, j, lengths(i, j)], 1))
    return rows


def equal_runs(a: np.ndarray, b: np.ndarray, t: int, pairs: int = PAIRS, all_pairs: int = ALL_PAIRS) -> np.ndarray:
    """Rows (first in a, first in b, length) of all maximal runs of equal shingles, by their place in ``a``.

    Up to ``all_pairs`` equal places are listed, and joined to runs; of more, as of texts that
    repeat themselves very often, only those that start a run. Both list the same runs, whatever
    ``t``, over portions of ``a`` with about ``pairs`` places of ``b`` each.
    """
    order = np.argsort(b, kind="stable")
    ranked = b[order]
    low = np.searchsorted(ranked, a)
    many = np.searchsorted(ranked, a, "right") - low
    if int(many.sum()) <= all_pairs:
        rows = []
        for first, last in _portions(many, pairs):
            count = many[first:last]
            i = np.repeat(np.arange(first, last), count)
            j = order[np.arange(len(i)) - np.repeat(np.cumsum(count) - count - low[first:last], count)]
            rows.append(_diagonal_runs(i, j))
        rows = np.concatenate(rows) if rows else np.zeros((0, 3), np.int64)
        rows = rows[np.lexsort((rows[:, 0], rows[:, 1] - rows[:, 0]))]
        apart = (np.diff(rows[:, 1] - rows[:, 0]) != 0) | (rows[1:, 0] != rows[:-1, 0] + rows[:-1, 2])
        heads = np.flatnonzero(np.r_[True, apart])[:len(rows)]
        if len(heads):
            rows = np.column_stack([rows[heads, :2], np.add.reduceat(rows[:, 2], heads)])
    else:
        rows = np.concatenate(_runs_from_starts(a, b, pairs))
    return rows[np.lexsort((rows[:, 1], rows[:, 0]))]


def _runs_among(a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, t: int) -> np.ndarray:
    """The runs of ``equal_runs`` that lie in the places ``at_a`` and ``at_b``, of which runs have all or none."""
    # Other places are left out; a value of its own for each text stands in every gap.
    parts, maps = [], []
    own = [v for v in range(4) if not ((a == _U(v)).any() or (b == _U(v)).any())]
    own = np.array(own, _U) if len(own) > 1 else np.setdiff1d(np.arange(len(a) + len(b) + 2).astype(_U), np.r_[a, b])
    for values, at, stop in ((a, at_a, own[0]), (b, at_b, own[1])):
        breaks = np.flatnonzero(np.diff(at) != 1) + 1
        parts.append(np.insert(values[at], breaks, stop))
        maps.append(np.insert(at, breaks, 0))
    runs = equal_runs(*parts, t)
    runs[:, 0], runs[:, 1] = maps[0][runs[:, 0]], maps[1][runs[:, 1]]
    return runs


def dense(held: np.ndarray, t: int, similar: tuple[int, int]) -> np.ndarray:
    """Which places lie in some stretch of at least ``t`` places that are held in the share ``similar``; no passage has others."""
    sums = np.r_[0, np.cumsum(np.where(held, similar[1] - similar[0], -similar[0]))]
    # The furthest end from each start.
    highest = np.maximum.accumulate(sums[::-1])
    ends = len(sums) - 1 - np.searchsorted(highest, sums)
    starts = np.flatnonzero(ends - np.arange(len(sums)) >= t)
    steps = np.zeros(len(sums), np.int64)
    np.add.at(steps, starts, 1)
    np.subtract.at(steps, ends[starts], 1)
    return np.cumsum(steps)[:-1] > 0


def _held(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which values of ``a`` the ranked ``b`` has."""
    if not len(b):
        return np.zeros(len(a), bool)
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return b[at] == a


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the range, place) of every place from each low to before its high."""
    count = np.maximum(0, high - low)
    of = np.repeat(np.arange(len(count)), count)
    return of, np.arange(len(of)) + np.repeat(low - np.cumsum(count) + count, count)


class Earlier:
    """Runs by their last places in both texts, to find those before a run that it can continue."""

    def __init__(self, runs: np.ndarray, similar: tuple[int, int]) -> None:
        self.i, self.j, self.size = runs.T
        self.last_a, self.last_b = self.i + self.size - 1, self.j + self.size - 1
        self.similar, self.width = similar, int(self.last_b.max(initial=0)) + 1
        code = self.last_a * self.width + self.last_b
        self.order = np.argsort(code, kind="stable")
        self.code, self.ends = code[self.order], self.last_a[self.order]
        self.distinct = np.unique(self.ends)

    def near(self, first: int, last: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(n, k, skipped) of the ``n``-th runs from first to before last, by ``n``, and runs k before them that they can continue.

        Skipped are the places of n that k ends behind. A passage that ends with k has at most ``most`` equal
        shingles, and is at least as wide; what lies further off is not similar enough however wide it is.
        """
        near, of = self.similar
        i1, j1 = self.last_a[first:last], self.last_b[first:last]
        reach = (of * self.size[first:last] + most * (of - near)) // near
        n, low, high = np.arange(last - first), self.ends.searchsorted(i1 - reach), self.ends.searchsorted(i1)
        if int((high - low).sum()) > FEW * (last - first):
            n, at = _ranges(self.distinct.searchsorted(i1 - reach), self.distinct.searchsorted(i1))
            at = self.distinct[at] * self.width
            low, high = self.code.searchsorted(at + np.maximum(0, j1 - reach)[n]), self.code.searchsorted(at + j1[n])
        found = [np.zeros((3, 0), np.int64)]
        for begin, end in _portions(high - low, NEAR):
            number, at = _ranges(low[begin:end], high[begin:end])
            x, k = first + n[begin + number], self.order[at]
            able = np.flatnonzero((k < x) & (self.last_b[k] < self.last_b[x]))
            x, k = x[able], k[able]
            size, skipped = self.size[x], np.maximum(0, np.maximum(self.last_a[k] + 1 - self.i[x], self.last_b[k] + 1 - self.j[x]))
            behind = np.maximum(self.last_a[x] - self.last_a[k], self.last_b[x] - self.last_b[k])
            able = np.flatnonzero((skipped < size) & (near * behind <= of * (size - skipped) + most * (of - near)))
            found.append(np.stack([x[able], k[able], skipped[able]]))
        x, k, skipped = np.concatenate(found, 1)
        while len(x):
            # Runs that continue none are as wide as they are, so it is known what they can be part of.
            later = np.zeros(last, bool)
            later[:first], later[x] = True, True
            equal = self.size[k] - skipped
            wide = np.maximum(self.last_a[x] - self.i[k], self.last_b[x] - self.j[k]) + 1
            able = later[k] | (equal > 0) & (of * (equal + self.size[x]) >= near * wide)
            if able.all():
                break
            x, k, skipped = x[able], k[able], skipped[able]
        return x, k, skipped


def shared_passages(a: np.ndarray, b: np.ndarray, t: int, similar: tuple[int, int]) -> list[tuple[int, int, int, int, float]]:
    """(first, last in a, first, last in b, similarity) of alike stretches of at least ``t`` shingles of ``a``.

    Each run of equal shingles, from left to right, continues that passage before
    it with which it makes the most equal shingles, as long as the sets of the joined
    stretches have the similarity; runs between them that lie elsewhere do not
    matter. A passage inside another stretch of ``a`` that has more is left out.
    """
    in_a = dense(_held(a, np.sort(b)), t, similar)
    if not in_a.any():
        return []
    in_b = dense(_held(b, np.sort(a)), t, similar)
    # Runs lie in dense places from end to end, or have none of them.
    at_a, at_b = np.flatnonzero(in_a), np.flatnonzero(in_b)
    runs = equal_runs(a, b, t) if len(at_a) == len(a) and len(at_b) == len(b) else _runs_among(a, b, at_a, at_b, t)
    # Short runs add nothing where long ones hold every place that a passage can have.
    long = runs[runs[:, 2] >= t]
    steps = np.zeros(len(a) + 1, np.int64)
    np.add.at(steps, long[:, 0], 1)
    np.subtract.at(steps, long[:, 0] + long[:, 2], 1)
    area = np.cumsum(in_a & ~np.r_[False, in_a[:-1]])
    left = np.bincount(area[in_a & (np.cumsum(steps)[:-1] == 0)], minlength=len(a) + 1) > 0
    runs = runs[(runs[:, 2] >= t) | left[area[runs[:, 0]]]]
    joins = np.flatnonzero(left[area[runs[:, 0]]])

    def alike(i0, i1, j0, j1):
        return hashing.jaccard_parts(hashing.distinct(a[i0:i1 + 1]), hashing.distinct(b[j0:j1 + 1]))

    # First and last in a, in b, and equal shingles, of the best passage that ends with each run.
    ends = np.stack([runs[:, 0], runs[:, 0] + runs[:, 2] - 1, runs[:, 1], runs[:, 1] + runs[:, 2] - 1, runs[:, 2]])
    likeness = np.ones(len(runs))
    joined = runs[joins]
    earlier = Earlier(joined, similar)
    first_a, first_b, equal = (x.tolist() for x in joined.T)
    near, of = similar
    begin, most = 0, 0
    while begin < len(joined):
        end = min(begin + RUNS, len(joined))
        most = max(most, int(joined[begin:end, 2].max()))
        # Enough for what the next runs add; where a passage has more, those behind it are looked at again.
        bound = min(2 * most, len(a), len(b))
        ns, ks, skipped = earlier.near(begin, end, bound)
        if not len(ns):
            begin = end
            continue
        heads = np.flatnonzero(np.append(True, ns[1:] != ns[:-1]))
        cuts, firsts = [*heads.tolist(), len(ns)], ns[heads]
        ks, skipped, begin = ks.tolist(), skipped.tolist(), end
        for g, (n, i1, j1, size) in enumerate(zip(
                firsts.tolist(), earlier.last_a[firsts].tolist(), earlier.last_b[firsts].tolist(), earlier.size[firsts].tolist())):
            able = []
            for k, gone in zip(ks[cuts[g]:cuts[g + 1]], skipped[cuts[g]:cuts[g + 1]]):
                more = equal[k] - gone
                if more > 0 and of * (more + size) >= near * (max(i1 - first_a[k], j1 - first_b[k]) + 1):
                    able.append((-more, k))
            for more, k in sorted(able):
                shared, union = alike(first_a[k], i1, first_b[k], j1)
                if of * shared >= near * union:
                    first_a[n], first_b[n], equal[n] = first_a[k], first_b[k], size - more
                    likeness[joins[n]] = shared / union
                    break
            most = max(most, equal[n])
            if most > bound:
                begin = n + 1
                break
    ends[0, joins], ends[2, joins], ends[4, joins] = first_a, first_b, equal
    long = np.flatnonzero((ends[1] - ends[0] + 1 >= t) & (ends[3] - ends[2] + 1 >= t))
    long = long[np.argsort(-ends[4, long], kind="stable")]
    found = []
    covered = bytearray(len(a))
    for (i0, i1, j0, j1, _), share in zip(ends[:, long].T.tolist(), likeness[long].tolist()):
        if covered.find(0, i0, i1 + 1) >= 0:
            found.append((i0, i1, j0, j1, share))
            covered[i0:i1 + 1] = b"\1" * (i1 + 1 - i0)
    return sorted(found)


PASSAGE = ("doc_id long, first_word long, n_words long, other_id long, other_first_word long, other_n_words long, "
           "similarity double")
#: A passage of a pair, or a stretch of the document that lies in none, with its hub.
VERIFIED = f"{PASSAGE}, first int, exact boolean, hub long"


def verifier(t: int, similar: tuple[int, int]):
    """The passages of a pair, and the document's stretches of other hubs that lie in none of them.

    A stretch that a hub holds exactly must lie in passages from end to end, another one with its middle.
    """
    def run(batches):
        extra = hashing.WORDS - 1
        names = [f.split(" ")[0] for f in VERIFIED.split(", ")]
        for batch in batches:
            ids, others = batch.column("doc_id").to_pylist(), batch.column("other_id").to_pylist()
            texts, hubs = batch.column("text"), batch.column("other_text")
            passages, left = [], []
            changes = [n for n in range(batch.num_rows) if not n or others[n] != others[n - 1]]
            known, anew, b = shingle_runs(hubs.take(pa.array(changes, pa.int64()))), set(changes), None
            for n, a in enumerate(shingle_runs(texts)):
                if n in anew:
                    b = next(known)
                if len(a) == len(b) and (a == b).all():
                    passages.append((ids[n], 0, len(a) + extra, others[n], 0, len(b) + extra, 1.0))
                    continue
                covered = np.zeros(len(a), np.int64)
                for i0, i1, j0, j1, alike in shared_passages(a, b, t, similar):
                    passages.append((ids[n], i0, i1 - i0 + 1 + extra, others[n], j0, j1 - j0 + 1 + extra, alike))
                    covered[i0:i1 + 1] = 1
                own = batch.column("windows")[n].values
                first, exact = own.field("first").to_numpy(), own.field("exact").to_numpy(zero_copy_only=False)
                sums = np.r_[0, np.cumsum(covered)]
                # Stretches of another text with this doc_id may lie beyond this one.
                able = first + t <= len(a)
                at = np.where(able, first, 0)
                settled = able & np.where(exact, sums[np.minimum(at + t, len(a))] - sums[at] == t,
                                          np.r_[covered, 0][np.minimum(at + t // 2, len(a))] > 0)
                rest = np.flatnonzero(~settled & (own.field("hub").to_numpy() != others[n]))
                if len(rest):
                    left.append((ids[n], others[n], own.take(pa.array(rest))))
            kinds = [pa.int64()] * 6 + [pa.float64(), pa.int32(), pa.bool_(), pa.int64()]
            columns = list(zip(*passages)) if passages else [[]] * 7
            yield pa.record_batch([*[pa.array(c, k) for c, k in zip(columns, kinds)],
                                   *[pa.nulls(len(passages), k) for k in kinds[7:]]], names)
            for first, last in _portions(np.array([len(own) for _, _, own in left], np.int64), TOLD):
                part = left[first:last]
                rows = [len(own) for _, _, own in part]
                doc_ids, met = (pa.array(np.repeat([x[c] for x in part], rows), pa.int64()) for c in (0, 1))
                n = len(doc_ids)
                yield pa.record_batch([doc_ids, *[pa.nulls(n, pa.int64())] * 2, met, *[pa.nulls(n, pa.int64())] * 2,
                                       pa.nulls(n, pa.float64()),
                                       *pa.concat_arrays([own for _, _, own in part]).flatten()], names)
    return run


def shared_keys(filed: DataFrame) -> DataFrame:
    """The keys that several documents have, with the smallest of them."""
    return filed.groupBy("key").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("last")).where("hub < last").select("key", "hub")


def equal_texts(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, other_id: documents whose text an earlier one has too, and the smallest that has it.

    Rows that repeat a doc_id with different texts are left out. Groups are minima of digests.
    """
    known = stored(docs.select("doc_id", F.md5("text").alias("digest"),
                               F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words")), "digests")
    smallest = known.groupBy("digest").agg(F.min("doc_id").alias("other_id"), F.max("doc_id").alias("last")).where(
        "other_id < last").select("digest", "other_id")
    several = known.groupBy("doc_id").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).where("low < high")
    return known.join(smallest, "digest").where("doc_id > other_id").select("doc_id", "n_words", "other_id").distinct().join(
        several, "doc_id", "left_anti")


def repeated_passages(docs: DataFrame, words: int = WORDS, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """doc_id, first_word, n_words, other_id, other_first_word, other_n_words, similarity: passages that an earlier document has too.

    A passage is a stretch of at least ``words`` words (``[^\\x20\\x09-\\x0D]+``, A-Z in
    lower case) of ``docs`` (doc_id integer, text) whose set of 5-word shingles has a
    Jaccard similarity of at least ``similar`` with that of a stretch of the document
    other_id, which is smaller than doc_id. Word places count from 0. Every
    document with a passage that an earlier one holds word for word has a row for it, with one
    earlier document; not every pair of documents has one. An edited passage has one with
    the probability that a band of its signatures is equal (README). Null and short texts have none;
    rows without doc_id are left out; rows that repeat a doc_id are not compared with each
    other. Other columns are ignored. Without rows, no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    t = max(2, words - hashing.WORDS + 1)
    docs = own_columns(docs, doc_id=F.col("doc_id").cast("long"), text="text").where("doc_id is not null and text is not null")
    shared = unbroken(t, similar)
    copies = stored(equal_texts(docs), "copies")
    seeds = stored(docs.mapInArrow(filer(shared), "key long, doc_id long, place int"), "windows")
    around = seeds.join(shared_keys(seeds).select("key"), "key").groupBy("doc_id").agg(F.collect_set("place").alias("places"))
    around = docs.join(around.join(copies, "doc_id", "left_anti"), "doc_id").withColumn("version", F.xxhash64("text"))
    around = stored(around.dropDuplicates(["doc_id", "version"]), "passage-texts")
    filed = stored(around.select("doc_id", "text", "places").mapInArrow(
        refiler(t, shared), "key long, doc_id long, first int, exact boolean"), "stretches")
    texts = around.select("doc_id", "text")
    opened = stored(filed.join(shared_keys(filed), "key").where("doc_id > hub").select("doc_id", "first", "exact", "hub"), "open-stretches")
    stretch = F.struct("first", "exact", "hub")
    none = F.lit(0).cast("long")
    found = [copies.where(F.col("n_words") >= t + hashing.WORDS - 1).select(
        "doc_id", none.alias("first_word"), "n_words", "other_id", none.alias("other_first_word"),
        F.col("n_words").alias("other_n_words"), F.lit(1.0).alias("similarity"))]

    def verified(pairs: DataFrame) -> DataFrame:
        both = pairs.join(texts, "doc_id").join(
            texts.select(F.col("doc_id").alias("other_id"), F.col("text").alias("other_text")), "other_id")
        checked = stored(both.select("doc_id", "other_id", "text", "other_text", "windows").mapInArrow(
            verifier(t, similar), VERIFIED), "passages")
        found.append(checked.where("hub is null").select(*[f.split(" ")[0] for f in PASSAGE.split(", ")]))
        return checked.where("hub is not null").select("doc_id", "first", "exact", "hub")

    for _ in range(GREEDY):
        counts = opened.groupBy("doc_id", "hub").agg(F.count("*").alias("n"))
        chosen = counts.groupBy("doc_id").agg(F.max_by("hub", F.struct("n", -F.col("hub"))).alias("other_id"))
        opened = verified(opened.groupBy("doc_id").agg(F.collect_list(stretch).alias("windows")).join(chosen, "doc_id"))
    verified(opened.groupBy("doc_id", F.col("hub").alias("other_id")).agg(F.collect_list(stretch).alias("windows")))
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out.distinct()


def cutter(batches):
    """Texts without the words of their passages; what is left keeps its bytes."""
    for batch in batches:
        texts, spans = batch.column("text").to_pylist(), batch.column("spans")
        out = []
        for n, text in enumerate(texts):
            if not spans[n].is_valid or text is None:
                out.append(text)
                continue
            data, offsets = hashing.text_bytes(pa.array([text]))
            first, behind, _ = hashing.word_spans(data, offsets)
            keep = np.ones(len(data), bool)
            for span in spans[n].as_py():
                low, high = span["first_word"], min(span["first_word"] + span["n_words"], len(first)) - 1
                keep[first[low]:behind[high]] = False
            out.append(data[keep].tobytes().decode())
        yield pa.record_batch([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])


def without_passages(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """doc_id and the new text of the documents that ``passages`` names by doc_id."""
    ship(docs.sparkSession)
    spans = passages.groupBy("doc_id").agg(F.collect_list(F.struct("first_word", "n_words")).alias("spans"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(spans, "doc_id").mapInArrow(
        cutter, "doc_id long, text string")
