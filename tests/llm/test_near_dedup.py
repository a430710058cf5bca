"""Near duplicates against all pairs; the pruning bounds; components against a plain search."""

import random

import pytest

from shiftlab.llm import near_dedup
from shiftlab.llm.components import components
from tests.llm import cases


def brute(rows, threshold=(85, 100)):
    """{doc_id: (n_shingles, component)}."""
    ids = [i for i, _ in rows]
    sets = cases.brute_sets([t for _, t in rows])
    links = [(ids[x], ids[y]) for x in range(len(ids)) for y in range(x)
             if sets[x] and sets[y] and ids[x] is not None and ids[y] is not None
             and threshold[1] * len(sets[x] & sets[y]) >= threshold[0] * len(sets[x] | sets[y])]
    name = cases.brute_components([i for i in ids if i is not None], links)
    return {i: (len(s), name.get(i)) for i, s in zip(ids, sets)}


def family(seed, size, words=120):
    """Texts that drift from each other, so that links form chains."""
    rng = random.Random(seed)
    text = [f"w{rng.randrange(9999)}" for _ in range(words)]
    out = []
    for i in range(size):
        for _ in range(rng.choice([0, 1, 1, 2])):
            text[rng.randrange(words)] = f"w{rng.randrange(9999)}"
        out.append((" ".join(text)).upper() if i % 3 == 0 else "\n".join(text))
    return out


@pytest.mark.parametrize("block,threshold", [(4, (85, 100)), (256, (85, 100)), (16, (80, 100))])
def test_equals_all_pairs(spark, monkeypatch, block, threshold):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    texts = [t for seed in range(6) for t in family(seed, 25)] + ["a b", "A  b", "a b c", "b a", "", None, " "]
    random.Random(1).shuffle(texts)
    rows = list(enumerate(texts))
    found = near_dedup.near_duplicates(cases.small(spark, rows), threshold).collect()
    want = brute(rows, threshold)
    assert len({c for _, c in want.values()}) < len(rows) - 20
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found) and len(found) == len(rows)


def test_odd_documents(spark):
    found = near_dedup.near_duplicates(cases.odd(spark)).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id, r.kept) for r in found) == [
        (-1, 4, None, True), (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 3, 5, True),
        (6, 3, 5, False), (6, 3, 5, False), (7, 29996, 7, True), (8, 5, 8, True)]


def test_no_documents(spark):
    assert near_dedup.near_duplicates(cases.docs(spark, [])).collect() == []


def test_bounds_keep_pairs_at_the_threshold():
    from math import comb
    for n, m in near_dedup.fewest_matches(0.85, 224):
        lost = sum(comb(n, k) * 0.85 ** k * 0.15 ** (n - k) for k in range(m))
        assert lost < 5e-4
    steps = near_dedup.fewest_matches(0.85, 224)
    assert near_dedup.bands_for(0.85) == 32 and near_dedup.bands_for(0.8) == 52
    assert [n for n, _ in steps] == list(range(32, 225, 32)) and steps[0][1] > 12


@pytest.mark.parametrize("links", [[], [(1, 1), (None, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)],
                                   [(2, 9), (9, 2), (5, 7), (7, 8), (8, 5), (1, 9)]])
def test_components(spark, links):
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert {r.id: r.component for r in found} == cases.brute_components({x for link in real for x in link}, real)
