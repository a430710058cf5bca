"""Exact top-k search against brute force in whole numbers, and how much a tree leaves out."""

import math

import duckdb
import numpy as np
import pytest

from shiftlab.llm import ball_trees
from shiftlab.llm.oracle import ORACLE
from shiftlab.llm.queries import QUERIES

KIND = "vec_id long, embedding array<double>, label int, entry string, shard int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], KIND)


def brute(rows, k=5, every=50):
    """[(query, rank, vec, score)] of rows that take part, in Python's whole numbers."""
    held = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            held[i] = [math.floor(256 * x) for x in v]
    out = []
    for q, a in held.items():
        if q % every == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in held.items() if i != q and len(a) == len(b))[:k]
            out += [(q, place + 1, i, -s) for place, (s, i) in enumerate(found)]
    return sorted(out)


def found(df):
    return sorted(map(tuple, df.collect()))


def vectors(rng, n, dims=6):
    return [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(n, dims)) * rng.uniform(0.1, 5, (n, 1)))]


def test_copies_lengths_and_odd_rows(spark):
    rng = np.random.default_rng(4)
    rows = vectors(rng, 400) + [(10_000 + i, v) for i, v in vectors(rng, 120, 3)]
    rows += [(20_000 + i, rows[3][1]) for i in range(200)] + [(-50, rows[3][1])]
    rows += [(30_000, [0.0] * 6), (30_001, [-0.0] * 6), (30_050, []), (30_051, []), (30_052, []), (30_100, [1.0])]
    odd = [(None, [1.0] * 6), (40_000, None), (40_050, [1.0, None] + [0.0] * 4), (40_100, [float("nan")] * 6),
           (40_150, [float("inf")] + [0.0] * 5)]
    assert found(ball_trees.largest(frame(spark, rows + odd + rows[5:9]))) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 7])
def test_few_rows(spark, n):
    rows = [(i * 50, [float(i % 3), 1.0]) for i in range(n)]
    assert found(ball_trees.largest(frame(spark, rows))) == brute(rows)


def test_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(ball_trees, "FEWEST", 50)
    monkeypatch.setattr(ball_trees, "BLOCK_BYTES", 6 * 8 * 4)
    monkeypatch.setattr(ball_trees, "LEAF", 8)
    rng = np.random.default_rng(5)
    rows = vectors(rng, 900) + [(5000 + i, [0.5] * 6) for i in range(60)]
    assert found(ball_trees.largest(frame(spark, rows), every=10)) == brute(rows, every=10)


def test_large_numbers_are_exact(spark):
    rng = np.random.default_rng(6)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.uniform(-1, 1, (120, 3)) * 2.0 ** 21)]
    want = brute(rows)
    assert max(s for *_, s in want) > 1 << 53
    assert found(ball_trees.largest(frame(spark, rows))) == want
    beyond = [(0, [1e300, 1.0]), (1, [1e300, 2.0]), (2, [-1e300, 0.0]), (50, [1.0, 1.0])]
    top = (1 << 63) - 1
    assert found(ball_trees.largest(frame(spark, beyond)))[:3] == [(0, 1, 1, top), (0, 2, 50, top), (0, 3, 2, -top)]


def test_a_tree_leaves_out_what_its_bounds_allow():
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(20, 8)) * 2000
    rows = np.floor(centres[rng.integers(0, 20, 20_000)] + rng.normal(size=(20_000, 8)) * 60)
    tree = ball_trees.BallTree(rows)
    entry = tree.order.astype(np.int64)
    assert sorted(entry) == list(range(len(rows)))
    bounds = tree.bounds(rows[:40])
    leaves = sum(x < 0 for x in tree.left)
    visits = []
    for i in range(40):
        value = (rows @ rows[i]).astype(np.int64)
        order = np.lexsort((np.arange(len(rows)), -value))[:6]
        score, names, visited = ball_trees.search(tree, entry, rows[i], bounds[i], 6, None, True)
        assert names.tolist() == order.tolist() and score.tolist() == value[order].tolist()
        visits.append(visited)
        again, same, fewer = ball_trees.search(tree, entry, rows[i], bounds[i], 6, int(score[-1]), True)
        assert same.tolist() == names.tolist() and fewer <= visited
        for node in range(len(tree.left)):
            assert (tree.rows[tree.first[node]:tree.behind[node]] @ rows[i]).max() <= bounds[i][node]
    assert np.mean(visits) < leaves / 2


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_query_equals_its_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    want = con.execute(ORACLE["op12_exact_top_k"]).fetchall()
    got = QUERIES["op12_exact_top_k"](spark, folder)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert found(got) == sorted(want)
