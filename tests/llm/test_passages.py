"""Shared passages against a comparison of all pairs, with common lines and unrelated hubs in the way."""

import os
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shiftlab.llm import common, passages
from tests.llm import cases


def words_of(rng, n):
    return [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]


def shingles(words):
    return [tuple(words[i:i + 5]) for i in range(len(words) - 4)]


def longest_shared(a, b):
    """The most consecutive words that two texts share, by a table of shingles."""
    places = {}
    for j, s in enumerate(shingles(b)):
        places.setdefault(s, []).append(j)
    best, runs = 0, {}
    for i, s in enumerate(shingles(a)):
        now = {j: runs.get(j - 1, 0) + 1 for j in places.get(s, [])}
        best = max([best, *now.values()])
        runs = now
    return best + 4 if best else 0


def corpus(seed):
    rng = random.Random(seed)
    line, shared = words_of(rng, 12), [words_of(rng, n) for n in (50, 55, 70, 120)]
    docs = []
    for i in range(60):
        text = words_of(rng, rng.randint(0, 200))
        if i % 2:
            text += line + words_of(rng, rng.randint(0, 60))
        if i % 3 == 0:
            part = rng.choice(shared)
            text += (line if i % 4 == 0 else []) + part + words_of(rng, rng.randint(0, 90))
        if i % 10 == 9:
            text = list(docs[i - 4][1])
        docs.append((i, text))
    return docs


def check(docs, found, similar=0.8, least=50):
    texts = dict(docs)
    for r in found:
        assert r.other_id < r.doc_id and r.n_words >= least and r.other_n_words >= least
        a = set(shingles([w.lower() for w in texts[r.doc_id][r.first_word:r.first_word + r.n_words]]))
        b = set(shingles([w.lower() for w in texts[r.other_id][r.other_first_word:r.other_first_word + r.other_n_words]]))
        assert len(a) >= least - 4 and abs(len(a & b) / len(a | b) - r.similarity) < 1e-12 and r.similarity >= similar
    want = {i for n, (i, a) in enumerate(docs) if any(longest_shared(a, b) >= least for _, b in docs[:n])}
    assert {r.doc_id for r in found} == want


@pytest.mark.parametrize("seed", range(3))
def test_equals_all_pairs(spark, seed):
    docs = corpus(seed)
    found = passages.repeated_passages(cases.small(spark, [(i, " ".join(t)) for i, t in docs])).collect()
    assert len(found) > 10
    check(docs, found)


@pytest.mark.parametrize("greedy", [0, 2])
def test_hubs_that_only_share_a_line(spark, monkeypatch, greedy):
    """Many earlier documents hold most of the passage's shingles, but not the passage."""
    rng = random.Random(7)
    part = words_of(rng, 54)
    docs = [(i, words_of(rng, 60) + part[i % 20:i % 20 + 30] + words_of(rng, 60)) for i in range(40)]
    docs += [(100 + i, words_of(rng, 30) + part + words_of(rng, 30)) for i in range(3)]
    monkeypatch.setattr(passages, "GREEDY", greedy)
    found = passages.repeated_passages(cases.small(spark, [(i, " ".join(t)) for i, t in docs])).collect()
    check(docs, found)
    assert {101, 102} <= {r.doc_id for r in found}


def test_many_documents_with_a_long_line_below_the_bound(spark):
    """All share 45 words, none 50, but for two late pairs."""
    rng = random.Random(9)
    line = words_of(rng, 45)
    docs = [(i, words_of(rng, 40) + line + words_of(rng, 40)) for i in range(120)]
    tail, head = words_of(rng, 20), words_of(rng, 20)
    docs += [(200, words_of(rng, 30) + line + tail), (201, words_of(rng, 40) + line + tail + words_of(rng, 9)),
             (300, head + line + words_of(rng, 50)), (301, words_of(rng, 5) + head + line + words_of(rng, 60))]
    found = passages.repeated_passages(cases.small(spark, [(i, " ".join(t)) for i, t in docs])).collect()
    assert sorted((r.doc_id, r.other_id, r.n_words) for r in found) == [(201, 200, 65), (301, 300, 65)]


def test_edited_passages(spark):
    rng = random.Random(3)
    part = words_of(rng, 300)
    other = list(part)
    for at in range(40, 300, 60):
        other[at] = "edited"
    docs = [(1, words_of(rng, 50) + part), (2, [w.upper() for w in other] + words_of(rng, 50))]
    found = passages.repeated_passages(cases.small(spark, [(i, "\n".join(t)) for i, t in docs])).collect()
    assert [(r.doc_id, r.first_word, r.n_words, r.other_id, r.other_first_word) for r in found] == [(2, 0, 300, 1, 50)]
    assert 0.8 <= found[0].similarity < 0.95


def test_windows_hold_every_stretch_once():
    rng = np.random.default_rng(2)
    for n, t in ((1, 1), (30, 5), (60, 8), (7, 8)):
        values = rng.integers(0, 40, n)
        windows = passages.compact_windows(values, t)
        for i in range(n):
            for j in range(i + t - 1, n):
                held = [c for low, c, high in windows if low <= i <= c <= j <= high]
                assert held == [i + int(values[i:j + 1].argmin())]


def test_sliding_minima():
    values = np.random.default_rng(1).integers(0, 99, 50)
    for width in (1, 2, 7, 23, 50):
        assert passages.sliding_minima(values, width).tolist() == [values[i:i + width].min() for i in range(51 - width)]


def test_odd_documents(spark):
    assert passages.repeated_passages(cases.odd(spark)).collect() == []
    more = cases.ODD + [(70, "Before. " + cases.LONG.upper(), "en", "c", 0), (71, cases.LONG, "en", "c", 0), (None, cases.LONG, "en", "c", 0)]
    found = sorted(map(tuple, passages.repeated_passages(cases.docs(spark, more)).collect()))
    assert found == [(70, 1, 30000, 7, 0, 30000, 1.0), (71, 0, 30000, 7, 0, 30000, 1.0)]
    assert passages.repeated_passages(cases.docs(spark, [])).collect() == []


def test_cutting(spark):
    docs = cases.small(spark, [(1, "a b\n c d e"), (2, "x y")])
    spans = spark.createDataFrame([(1, 1, 2), (1, 2, 2), (1, 4, 9)], "doc_id long, first_word long, n_words long")
    assert passages.without_passages(docs, spans).collect() == [(1, "a  ")]


@pytest.mark.parametrize("before", [1, 3])
def test_hubs_that_repeat_a_line_of_the_passage(spark, before):
    """The hub holds the passage, and its first 30 words earlier too."""
    rng = random.Random(11)
    line, rest = words_of(rng, 30), words_of(rng, 24)
    hub = [w for _ in range(before) for w in line + words_of(rng, 40)]
    docs = [(1, hub + line + rest + words_of(rng, 20)), (2, words_of(rng, 25) + line + rest + words_of(rng, 33))]
    found = passages.repeated_passages(cases.small(spark, [(i, " ".join(t)) for i, t in docs])).collect()
    check(docs, found)
    assert [(r.doc_id, r.first_word, r.n_words, r.other_first_word) for r in found] == [(2, 25, 54, len(hub))]


def test_edits_whose_shingles_occur_elsewhere():
    """The words of an edit's gap stand in the other text as well, far away."""
    rng = random.Random(12)
    part = words_of(rng, 80)
    other = part[:40] + ["edited"] + part[41:]
    text = [part + words_of(rng, 60) + other[37:42] + words_of(rng, 10), words_of(rng, 10) + other]
    b, a = passages.shingle_runs(pa.array([" ".join(t) for t in text]))
    found = passages.shared_passages(a, b, 46, (80, 100))
    assert [f[:4] for f in found] == [(10, 85, 0, 75)]


def test_texts_that_repeat_themselves_very_often(spark):
    """Beyond the equal places that are all looked at an exact passage is met all the same."""
    rng = random.Random(13)
    line, rest = words_of(rng, 7), words_of(rng, 44)
    docs = [(1, line * 300 + words_of(rng, 30) + line * 5 + rest), (2, words_of(rng, 30) + line * 400 + rest + words_of(rng, 30))]
    b, a = passages.shingle_runs(pa.array([" ".join(t) for _, t in docs]))
    assert [len(passages.equal_runs(a, b, 46, all_pairs=n)) > 0 for n in (10, 1 << 30)] == [True, True]
    for n in (10, 1 << 30):
        runs = passages.equal_runs(a, b, 46, all_pairs=n)
        assert all((a[i:i + k] == b[j:j + k]).all() for i, j, k in runs.tolist())
        ends = 30 + 2800 + 44 - 5
        assert max(k for i, j, k in runs.tolist() if i + k - 1 == ends and j + k == len(b)) >= 75
    found = passages.repeated_passages(cases.small(spark, [(i, " ".join(t)) for i, t in docs])).collect()
    cut = {n for r in found for n in range(r.first_word, r.first_word + r.n_words)}
    assert cut == set(range(30, 30 + 2800 + 44)) and {r.similarity for r in found} == {1.0}


def test_every_centre_of_a_key_is_filed():
    part = " ".join(words_of(random.Random(14), 60))
    texts = pa.record_batch([pa.array([1]), pa.array([f"{part} {part} {part}"])], ["doc_id", "text"])
    filed = [r for b in passages.filer(21)([texts]) for r in b.to_pylist()]
    centres = {}
    for r in filed:
        centres.setdefault(r["key"], set()).add(r["place"])
    assert max(map(len, centres.values())) > 1


def test_dense_places():
    rng = np.random.default_rng(5)
    for _ in range(40):
        held, t = rng.random(40) < rng.random(), int(rng.integers(1, 12))
        want = np.zeros(40, bool)
        for i in range(40):
            for j in range(i + t, 41):
                if 100 * held[i:j].sum() >= 80 * (j - i):
                    want[i:j] = True
        assert (passages.dense(held, t, (80, 100)) == want).all()


def test_runs_of_portions_equal_those_of_the_whole():
    rng = np.random.default_rng(8)
    for n in (0, 1, 30, 90):
        a, b = (rng.integers(0, 6, n).astype(np.uint64) for _ in range(2))
        whole = passages.equal_runs(a, b, 5)
        assert all((a[i:i + k] == b[j:j + k]).all() for i, j, k in whole.tolist())
        assert whole[:, 2].sum() == (a[:, None] == b[None, :]).sum()
        for pairs in (1, 7, 50):
            assert passages.equal_runs(a, b, 5, pairs).tolist() == whole.tolist()


@pytest.mark.parametrize("lines", [100, 400])
def test_edited_passages_whose_hub_repeats_half_of_it(lines):
    """However often the hub holds the first 27 words alone, the passage goes on behind the edit."""
    rng = random.Random(15)
    part = words_of(rng, 60)
    hub = [w for _ in range(lines) for w in part[:27] + words_of(rng, 8)] + part
    text = words_of(rng, 20) + part[:27] + ["edited"] + part[28:] + words_of(rng, 20)
    b, a = passages.shingle_runs(pa.array([" ".join(t) for t in (hub, text)]))
    found = passages.shared_passages(a, b, 46, (80, 100))
    assert [(f[0], f[1], f[2]) for f in found] == [(20, 20 + 60 - 5, len(hub) - 60)]


def test_edited_passages_in_texts_that_repeat_a_line():
    rng = random.Random(16)
    part, line = words_of(rng, 56), words_of(rng, 30)
    hub = part[:28] + words_of(rng, 9) + [w for _ in range(160) for w in line + words_of(rng, 3)] + part
    text = [w for _ in range(160) for w in line + words_of(rng, 3)] + part[:28] + ["edited"] + part[29:]
    b, a = passages.shingle_runs(pa.array([" ".join(t) for t in (hub, text)]))
    found = passages.shared_passages(a, b, 46, (80, 100))
    assert any(f[1] == len(a) - 1 and f[1] - f[0] >= 51 for f in found)


def test_unbroken_runs_of_passages():
    assert passages.unbroken(46, (80, 100)) == 21 and passages.unbroken(3, (80, 100)) == 3
    rng = random.Random(17)
    for n in (50, 55, 60, 90, 135, 200):
        for _ in range(40):
            part = words_of(rng, n)
            other = list(part)
            for at in rng.sample(range(n), rng.randint(1, 4)):
                other[at] = f"edited{at}"
            a, b = passages.shingle_runs(pa.array([" ".join(part), " ".join(other)]))
            shared = len(np.intersect1d(a, b))
            if shared >= 0.8 * len(np.union1d(a, b)):
                assert passages.equal_runs(a, b, 46)[:, 2].max() >= 21
                assert len(np.intersect1d(passages.window_keys(a, 21)[0], passages.window_keys(b, 21)[0]))


def recall(n, place, trials):
    """Share of passages of ``n`` words with one edit that meet under a key of the second filing."""
    met, rng = 0, random.Random(n * 100 + place)
    for _ in range(trials):
        part = words_of(rng, n)
        other = part[:place] + ["edited"] + part[place + 1:]
        a, b = passages.shingle_runs(pa.array([" ".join(words_of(rng, 80) + t + words_of(rng, 80)) for t in (part, other)]))
        keys = [passages.stretch_keys(x, passages.window_keys(x, 21)[1], 46, 21)[0] for x in (a, b)]
        met += len(np.intersect1d(*keys)) > 0
    return met / trials


@pytest.mark.parametrize("n, place", [(50, 25), (50, 17), (55, 27), (60, 30)])
def test_recall_of_edited_passages(n, place):
    assert recall(n, place, 200) >= 0.95


def test_exact_stretches_are_filed_where_their_windows_are_shared():
    rng = random.Random(18)
    for n in (50, 51, 60, 90):
        for _ in range(20):
            part = words_of(rng, n)
            texts = [words_of(rng, rng.randint(0, 90)) + part + words_of(rng, rng.randint(0, 90)) for _ in range(2)]
            a, b = passages.shingle_runs(pa.array([" ".join(t) for t in texts]))
            keys, places = zip(*[passages.window_keys(x, 21)[:2] for x in (a, b)])
            filed = []
            for k in range(2):
                key, _, exact = passages.stretch_keys((a, b)[k], places[k][np.isin(keys[k], keys[1 - k])], 46, 21)
                filed.append(key[exact])
                assert n - 49 <= exact.sum() <= n - 49 + 60
            assert len(np.intersect1d(*filed)) == n - 49


def test_equal_texts(spark):
    rows = [(1, "a b"), (2, "a b"), (2, "a b"), (3, "c"), (4, "a b"), (4, "other"), (5, "")]
    assert passages.equal_texts(cases.small(spark, rows)).collect() == [(2, 2, 1)]


def test_runs_do_not_depend_on_how_many_places_are_equal():
    rng = np.random.default_rng(19)
    cases_of = [[rng.integers(0, kinds, n).astype(np.uint64) for n in sizes]
                for kinds, sizes in ((1, (9, 14)), (2, (40, 60)), (3, (70, 50)), (30, (90, 90)), (5, (1, 30)))]
    line = np.arange(7, dtype=np.uint64)
    cases_of.append([np.r_[np.tile(line, 9), line + 9, np.tile(line, 3)], np.r_[line + 9, np.tile(line, 12)]])
    for a, b in cases_of:
        listed = passages.equal_runs(a, b, 5).tolist()
        for pairs in (1, 40, 1 << 19):
            assert passages.equal_runs(a, b, 5, pairs, all_pairs=0).tolist() == listed
    assert passages.equal_runs(line, line + 9, 5, all_pairs=-1).tolist() == []


def test_edited_passages_in_texts_with_very_many_equal_places(spark):
    """A column of zeros makes more equal places than are listed; the edited passage goes on behind its edit all the same."""
    rng = random.Random(20)
    part, zeros = words_of(rng, 60), ["0"] * 1100
    hub = zeros + [w for _ in range(3) for w in part[:27] + words_of(rng, 8)] + part
    text = words_of(rng, 20) + part[:27] + ["edited"] + part[28:] + words_of(rng, 20) + zeros
    b, a = passages.shingle_runs(pa.array([" ".join(t) for t in (hub, text)]))
    assert (a[:, None] == b[None, :]).sum() > passages.ALL_PAIRS
    assert (20, 75, len(hub) - 60) in [f[:3] for f in passages.shared_passages(a, b, 46, (80, 100))]
    found = passages.repeated_passages(cases.small(spark, [(1, " ".join(hub)), (2, " ".join(text))])).collect()
    assert (20, 60) in {(r.first_word, r.n_words) for r in found}


def test_windows_of_many_texts_at_once():
    """Against the plain windows of each text, with equal values and with texts too short for one."""
    rng = np.random.default_rng(21)
    for t in (1, 2, 3, 8, 21):
        for kinds in (3, 1 << 40):
            sizes = rng.integers(0, 70, 12)
            cuts = np.r_[0, np.cumsum(sizes)]
            shingles = rng.integers(0, kinds, cuts[-1]).astype(np.uint64)
            want, side = set(), (t - 1) // 2
            for n in range(12):
                for low, c, high in passages.compact_windows(passages.hashing.mix(shingles[cuts[n]:cuts[n + 1]] ^ passages._seed(0)), t):
                    first = min(max(c - side, low), high - t + 1)
                    want |= {(n, 2 * c + k, first, first + t - 1) for k, ok in ((0, c - side >= low), (1, c + side <= high)) if ok}
            keys, *rows = passages.window_rows(shingles, cuts, t)
            found = list(zip(*[x.tolist() for x in rows]))
            assert set(found) == want and len(found) == len(want)
            for key, (n, place, _, _) in zip(keys, found):
                start = cuts[n] + place // 2 - (0 if place % 2 else side)
                part = passages.stretch_hashes(shingles[start:start + side + 1], side + 1)
                assert key == passages.hashing.mix(part + passages._seed(201 + place % 2))[0]


def test_stretches_of_many_texts_at_once():
    """A text's stretches do not depend on the texts beside it; places of a longer text with its doc_id add none."""
    rng = np.random.default_rng(22)
    sizes = [90, 10, 0, 46, 130, 45, 60]
    cuts = np.r_[0, np.cumsum(sizes)]
    shingles = rng.integers(0, 1 << 40, cuts[-1]).astype(np.uint64)
    opened, of, want = [], [], []
    for n, size in enumerate(sizes):
        part = shingles[cuts[n]:cuts[n + 1]]
        places = passages.window_keys(part, 21)[1]
        some = np.r_[places[rng.random(len(places)) < 0.7], 2 * size, 2 * size + 31]
        opened.append(some)
        of.append(np.full(len(some), n))
        keys, first, exact = passages.stretch_keys(part, some, 46, 21)
        assert not len(first) or first.max() + 46 <= size
        want += zip(keys.tolist(), [n] * len(keys), first.tolist(), exact.tolist())
    found = passages.stretch_rows(shingles, cuts, np.concatenate(opened), np.concatenate(of), 46, 21)
    assert sorted(zip(*[x.tolist() for x in found])) == sorted(want) and len(want) > 50


def test_runs_among_dense_places():
    rng = np.random.default_rng(23)
    for _ in range(30):
        a, b = (rng.integers(0, 9, 60).astype(np.uint64) for _ in range(2))
        a[20:50], b[5:35] = np.arange(100, 130), np.arange(100, 130)
        in_a, in_b = passages.dense(np.isin(a, b), 10, (80, 100)), passages.dense(np.isin(b, a), 10, (80, 100))
        runs = passages.equal_runs(a, b, 10)
        want = runs[in_a[runs[:, 0]] & in_b[runs[:, 1]]].tolist()
        assert passages._runs_among(a, b, np.flatnonzero(in_a), np.flatnonzero(in_b), 10).tolist() == want


def edited_lines(rng, t):
    """Two texts with lines in common, edited and repeated, of which no stretch of ``t`` shingles is equal."""
    lines = [rng.integers(0, 1 << 40, int(rng.integers(3, t))) for _ in range(6)]
    texts = []
    for _ in range(2):
        parts = [lines[k] for k in rng.integers(0, 6, 14)]
        parts = [np.r_[p[:2], p[2:][rng.random(len(p) - 2) < 0.98]] for p in parts]
        texts.append(np.concatenate([x for p in parts for x in (p, rng.integers(0, 1 << 40, int(rng.integers(1, 3))))]).astype(np.uint64))
    return texts


def joined_by_all(a, b, t, similar):
    """``shared_passages`` by every run before each one."""
    (near, of), sets = similar, lambda x, i, j: set(x[i:j + 1].tolist())
    held = [np.flatnonzero(passages.dense(np.isin(x, y), t, similar)) for x, y in ((a, b), (b, a))]
    rows = []
    for i, j, size in passages._runs_among(a, b, *held, t).tolist():
        assert size < t
        i1, j1, able = i + size - 1, j + size - 1, []
        best = (i, i1, j, j1, size, 1.0)
        for n, (k0, k1, l0, l1, equal, _) in enumerate(rows):
            skipped = max(0, k1 + 1 - i, l1 + 1 - j)
            more = equal + size - skipped
            if k1 < i1 and l1 < j1 and skipped < size < more and of * more >= near * (max(i1 - k0, j1 - l0) + 1):
                able.append((-more, n))
        for more, n in sorted(able):
            x, y = sets(a, rows[n][0], i1), sets(b, rows[n][2], j1)
            if of * len(x & y) >= near * len(x | y):
                best = (rows[n][0], i1, rows[n][2], j1, -more, len(x & y) / len(x | y))
                break
        rows.append(best)
    found, covered = [], set()
    for i0, i1, j0, j1, _, share in sorted((r for r in rows if min(r[1] - r[0], r[3] - r[2]) + 1 >= t), key=lambda r: -r[4]):
        if not covered.issuperset(range(i0, i1 + 1)):
            found.append((i0, i1, j0, j1, share))
            covered.update(range(i0, i1 + 1))
    return sorted(found)


@pytest.mark.parametrize("runs, few, pairs", [(1024, 256, 1 << 19), (3, 0, 5), (7, 1 << 30, 1 << 19)])
def test_runs_are_joined_as_by_all_before_them(monkeypatch, runs, few, pairs):
    """However many runs are looked at together."""
    monkeypatch.setattr(passages, "RUNS", runs)
    monkeypatch.setattr(passages, "FEW", few)
    monkeypatch.setattr(passages, "NEAR", pairs)
    rng, joined = np.random.default_rng(24), 0
    for _ in range(25):
        a, b = edited_lines(rng, 12)
        found = passages.shared_passages(a, b, 12, (70, 100))
        assert found == joined_by_all(a, b, 12, (70, 100))
        joined += sum(f[4] < 1 for f in found)
    assert joined > 20


def test_runs_that_no_passage_can_have_cost_no_steps():
    """Short lines in another order are runs, and no join: what is done does not grow by steps with them."""
    import cProfile
    import pstats
    rng = np.random.default_rng(25)
    lines = rng.integers(0, 1 << 40, (400, 9)).astype(np.uint64)
    a, b = (np.concatenate([lines[k] for k in rng.permutation(400)]) for _ in range(2))
    with cProfile.Profile() as steps:
        passages.shared_passages(a, b, 46, (80, 100))
    assert len(passages.equal_runs(a, b, 46)) > 390
    assert pstats.Stats(steps).total_calls < 4 * 390


def test_pairs_of_a_batch_are_told_together():
    """One batch of passages and one of what is left, however many pairs have either."""
    rng = random.Random(26)
    hubs, parts = [words_of(rng, 80) for _ in range(9)], [words_of(rng, 80) for _ in range(9)]
    kind = pa.struct([("first", pa.int32()), ("exact", pa.bool_()), ("hub", pa.int64())])
    open_ = [[{"first": 0, "exact": True, "hub": 0}, {"first": 80, "exact": True, "hub": 50 + n}] for n in range(9)]
    batch = pa.record_batch([pa.array(range(100, 109)), pa.array(range(9)), pa.array([" ".join(h + p) for h, p in zip(hubs, parts)]),
                             pa.array([" ".join(h) for h in hubs]), pa.array(open_, pa.list_(kind))],
                            ["doc_id", "other_id", "text", "other_text", "windows"])
    found = list(passages.verifier(46, (80, 100))(iter([batch])))
    assert len(found) <= 2
    rows = [tuple(r.values()) for b in found for r in b.to_pylist()]
    assert sorted(r for r in rows if r[-1] is None) == [(100 + n, 0, 80, n, 0, 80, 1.0, None, None, None) for n in range(9)]
    assert sorted((r[0], r[3], *r[7:]) for r in rows if r[-1] is not None) == [(100 + n, n, 80, True, 50 + n) for n in range(9)]


def test_stored_tables_leave_no_shuffle_files(spark):
    """They go when the table is written, not when the driver next collects garbage."""
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def files():
        return {name for folder in folders for _, _, names in os.walk(folder) for name in names if name.startswith("shuffle_")}

    old, before = files(), spark.conf.get(common.CLEANUP)
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    found = common.stored(rows.repartition(3, "n"), "test")
    until = time.monotonic() + 20
    while files() - old and time.monotonic() < until:
        time.sleep(0.1)
    assert not files() - old and spark.conf.get(common.CLEANUP) == before
    assert found.count() == 7
