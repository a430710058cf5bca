"""Neighbours against brute force: recall on a table, exact results where all rows are met."""

import numpy as np
import pytest

from shiftlab.llm import neighbours
from shiftlab.llm.queries import QUERIES

KIND = "vec_id long, embedding array<float>, label int, entry string"


def brute(rows, k=20, every=20):
    """[(query, rank, vec, score)] for (id, vector) rows that take part."""
    ids = np.array([i for i, _ in rows])
    X = np.array([v for _, v in rows], np.float32).astype(float)
    out = []
    for i, x in zip(ids, X):
        if i % every == 0:
            value = neighbours.scores(X, x)
            order = [j for j in np.lexsort((ids, -value)) if ids[j] != i][:k]
            out += [(int(i), r + 1, int(ids[j]), float(value[j])) for r, j in enumerate(order)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x") for i, v in rows], KIND)


def found(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_on_a_table(spark, sf):
    folder = f"/root/testdata/{sf}"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    want = brute(rows)
    got = found(QUERIES["op5_nearest_neighbours"](spark, folder))
    assert [(q, r) for q, r, _, _ in got] == [(q, r) for q, r, _, _ in want]
    hits = {(q, v) for q, _, v, _ in got} & {(q, v) for q, _, v, _ in want}
    assert len(hits) >= 0.9 * len(want)
    true = {(q, v): s for q, _, v, s in brute(rows, k=len(rows))}
    assert all(true[q, v] == s for q, _, v, s in got)


def test_copies_norms_and_odd_rows(spark):
    rng = np.random.default_rng(4)
    vectors = (rng.normal(size=(300, 8)) * rng.uniform(0.1, 5, (300, 1))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(1000 + i, vectors[3].tolist()) for i in range(200)] + [(-20, vectors[3].tolist())]
    odd = [(None, [1.0] * 8), (2000, None), (2020, [0.0] * 8), (2040, [1.0, None] + [0.0] * 6), (2060, [float("nan")] * 8),
           (2080, [float("inf")] + [0.0] * 7), (2100, [1.0]), (2120, []), rows[5], rows[3]]
    assert found(neighbours.nearest(frame(spark, rows + odd))) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 15])
def test_few_rows(spark, n):
    rows = [(i * 10, [float(i % 3), 1.0]) for i in range(n)]
    assert found(neighbours.nearest(frame(spark, rows))) == (brute(rows) if n else [])


def test_blocks_and_bundles(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BUNDLE", 100)
    monkeypatch.setattr(neighbours, "QUERIES", 7)
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(400, 6)).astype(np.float32))]
    assert found(neighbours.nearest(frame(spark, rows))) == brute(rows)


def test_each_length_among_its_own(spark):
    """Vectors of other lengths than most are searched too, whatever their share."""
    rng = np.random.default_rng(8)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(60, 2)).astype(np.float32))]
    rows += [(100, [1.0, 2.0, 3.0]), (120, [0.5, -1.0, 2.0]), (140, [7.0])]
    rows += [(1000 + i, v.tolist()) for i, v in enumerate(rng.normal(size=(80, 5)).astype(np.float32))]
    want = sorted(x for n in (1, 2, 3, 5) for x in brute([(i, v) for i, v in rows if len(v) == n]))
    got = found(neighbours.nearest(frame(spark, rows)))
    assert got == want and {(100, 1, 120), (120, 1, 100)} <= {(q, r, v) for q, r, v, _ in got}
