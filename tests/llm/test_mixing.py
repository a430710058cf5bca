"""Mixing: targets by repeated sharing, words taken against a queue in plain Python, the schedule's evenness."""

import collections
import hashlib
import random
import re

import duckdb
import pytest

from shiftlab.llm import mixing
from shiftlab.llm.oracle import ORACLE
from shiftlab.llm.queries import QUERIES
from tests.llm import cases


def brute_targets(sizes, cycle=(3, 1, 2), share=1.5, most=2):
    """Share by weight, cap, share the excess again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(names)}
    found, open_names, left = {}, list(names), share * sum(sizes.values())
    while open_names:
        total = sum(weight[s] for s in open_names)
        part = {s: left * weight[s] / total for s in open_names}
        above = [s for s in open_names if part[s] > most * sizes[s]]
        if not above:
            found.update(part)
            break
        for s in above:
            found[s] = most * sizes[s]
            left -= found[s]
            open_names.remove(s)
    return found


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0d]+", text or ""))


def test_targets():
    rng = random.Random(1)
    for _ in range(200):
        sizes = {f"s{i}": rng.choice([0, 1, 5, 100, 3000]) for i in range(rng.randint(1, 9))}
        names = sorted(sizes)
        weights = [(3, 1, 2)[i % 3] for i in range(len(names))]
        found = mixing.targets([sizes[n] for n in names], weights, sum(sizes.values()) * 1.5)
        assert found == pytest.approx([brute_targets(sizes)[n] for n in names])


@pytest.mark.parametrize("block", [8, 1024])
def test_words_taken(spark, block):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 40, 300])), "en", rng.choice(["a", "b", "é", None]), 0) for i in range(80)]
    taken, mixture = mixing.mixed(cases.docs(spark, rows), block=block)
    found = {r.doc_id: r for r in taken.collect()}
    sizes = collections.Counter()
    for r in rows:
        sizes[r[3]] += size(r[1])
    for source, target in brute_targets(sizes).items():
        quota, at = round(target), 0
        for r in sorted((r for r in rows if r[3] == source), key=lambda r: hashlib.md5(str(r[0]).encode()).hexdigest()):
            n = size(r[1])
            want = sum(max(0, min(at + n, quota - p * sizes[source]) - at) for p in range(2))
            got = found[r[0]]
            assert (got.size, got.source_size, got.taken) == (n, sizes[source], want) and got.target == pytest.approx(target)
            at += n
    pieces = mixture.collect()
    by_doc = collections.Counter()
    slots = collections.defaultdict(set)
    for r in pieces:
        by_doc[r.doc_id] += r.n_words
        slots[r.slot].add(r.source)
    assert all(by_doc[i] == r.taken for i, r in found.items())
    scheduled = [s for s in slots if s < len(slots)]
    assert all(len(slots[s]) == 1 for s in scheduled) and len(scheduled) >= len(slots) - 6


def test_schedule_is_even(spark):
    counts = [600, 30, 370]
    found = mixing.schedule(spark, counts).collect()
    by_slot = {r.slot: r.number for r in found}
    assert sorted(by_slot) == list(range(1000))
    for length in (50, 200, 1000):
        for n, total in enumerate(counts):
            got = sum(by_slot[i] == n for i in range(length))
            assert abs(got - length * total / 1000) <= 3
    ranks = collections.defaultdict(list)
    for r in sorted(found, key=lambda r: r.slot):
        ranks[r.number].append(r.rank)
    assert all(r == list(range(len(r))) for r in ranks.values())


def test_odd_documents(spark):
    taken, _ = mixing.mixed(cases.odd(spark))
    found = taken.collect()
    assert len(found) == len(cases.ODD) and all(0 <= r.taken <= 2 * r.size for r in found)
    assert mixing.mixed(cases.docs(spark, []))[0].collect() == []
    nothing, mixture = mixing.mixed(cases.docs(spark, [(1, None, "en", "s", 0), (2, " ", "en", None, 1)]))
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in nothing.collect()) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
    assert mixture.collect() == []


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_their_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    result = con.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    want = sorted(map(repr, result.fetchall()))
    assert sorted(repr(tuple(r)) for r in QUERIES[name](spark, folder).select(*columns).collect()) == want
