"""Approximate nearest neighbours by inner product: a forest of random-projection trees.

Inner products become angles by one more coordinate, sqrt(M^2 - |x|^2), which makes
all rows equally long; a query has 0 there. Each tree splits a bounded sample at
the median of a projection, the direction between the means of two random halves.
Every row of the table is then led to one leaf of every tree.

A query walks all trees through one priority queue, nearest split first, and
stops when the leaves it has met hold ``VISITED`` of the table's rows (rows that
several trees offer count again). Leaves are dealt to tasks in bundles of
neighbouring leaves, with the queries that chose them, in blocks; a task scores its
pairs exactly and returns each query's best. The best of all bundles are ranked.

The sample only shapes the trees: every row is indexed, and no bundle, leaf or
query is cut. Equal vectors are one entry with its smallest ids, as many as a
result can hold, so that a vector that a third of all rows share stays one entry.
"""

from __future__ import annotations

import heapq
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftlab.llm.common import ship, stored

K, EVERY = 20, 20
TREES, LEAF = 8, 64
SAMPLE = 10_000
#: Rows that a query meets, as a share of all and at least.
VISITED, FEWEST = 0.85, 2_000
#: Rows of a bundle and queries of a block that meet in one task.
BUNDLE, QUERIES = 50_000, 5_000
SEED = 11


class Forest:
    """Trees over sampled rows; nodes of all trees lie in one list, leaves are numbered through."""

    def __init__(self, sample: np.ndarray, trees: int = TREES, leaf: int = LEAF):
        rng = np.random.default_rng(SEED)
        self.directions, self.cuts, self.children, self.leaf = [], [], [], []
        self.roots = [self._grow(sample, np.arange(len(sample)), leaf, rng) for _ in range(trees)]
        self.leaves = sum(n >= 0 for n in self.leaf)
        self.tree_of_leaf = np.searchsorted([self._first_leaf(r) for r in self.roots], np.arange(self.leaves), "right") - 1
        dims = sample.shape[1]
        self.directions = np.array([np.zeros(dims) if d is None else d for d in self.directions]).reshape(-1, dims)
        self.cuts, self.leaf = np.array(self.cuts), np.array(self.leaf)
        self.children = np.array(self.children)

    def _first_leaf(self, node: int) -> int:
        while self.leaf[node] < 0:
            node = self.children[node][0]
        return self.leaf[node]

    def _grow(self, sample, rows, leaf, rng) -> int:
        """A node over ``rows``; depth is bounded by the halving of a bounded sample."""
        node = len(self.leaf)
        for values, value in ((self.directions, None), (self.cuts, 0.0), (self.children, (-1, -1)), (self.leaf, -1)):
            values.append(value)
        low = high = rows[:0]
        if len(rows) > leaf:
            points = sample[rows]
            a, b = points[rng.choice(len(points), 2, replace=False)]
            for _ in range(4):
                side = points @ (a - b) > (a + b) @ (a - b) / 2
                if side.all() or not side.any():
                    break
                a, b = points[side].mean(0), points[~side].mean(0)
            direction = (a - b) / (np.linalg.norm(a - b) or 1.0)
            place = points @ direction
            cut = np.median(place)
            low, high = rows[place <= cut], rows[place > cut]
        if not len(low) or not len(high):
            self.leaf[node] = sum(n >= 0 for n in self.leaf)
            return node
        self.directions[node], self.cuts[node] = direction, float(cut)
        left = self._grow(sample, low, leaf, rng)
        self.children[node] = (left, self._grow(sample, high, leaf, rng))
        return node

    def place(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of every row in every tree: (rows, trees)."""
        out = np.empty((len(rows), len(self.roots)), np.int64)
        for t, root in enumerate(self.roots):
            node = np.full(len(rows), root)
            open_rows = np.arange(len(rows))
            while len(open_rows):
                open_rows = open_rows[self.leaf[node[open_rows]] < 0]
                at = node[open_rows]
                right = np.einsum("ij,ij->i", rows[open_rows], self.directions[at]) > self.cuts[at]
                node[open_rows] = self.children[at, right.astype(int)]
            out[:, t] = self.leaf[node]
        return out

    def visit(self, row: np.ndarray, sizes: np.ndarray, wanted: float) -> list[int]:
        """Leaves in the order of the nearest split on their way, until they hold ``wanted`` rows."""
        margin = self.directions @ row - self.cuts
        queue = [(0.0, root) for root in self.roots]
        found, met = [], 0
        while queue and met < wanted:
            far, node = heapq.heappop(queue)
            while self.leaf[node] < 0:
                right = int(margin[node] > 0)
                heapq.heappush(queue, (max(far, abs(margin[node])), int(self.children[node, 1 - right])))
                node = int(self.children[node, right])
            found.append(int(self.leaf[node]))
            met += sizes[self.leaf[node]]
        return found


def cleaner(batches):
    """vec_id, dims, vector (doubles, little-endian), norm of the rows that take part."""
    for batch in batches:
        ids, vectors = batch.column("vec_id").to_pylist(), batch.column("embedding")
        rows = []
        for i, name in enumerate(ids):
            if name is None or not vectors[i].is_valid or vectors[i].values.null_count:
                continue
            x = vectors[i].values.to_numpy(zero_copy_only=False).astype("<f8")
            if len(x) and np.isfinite(x).all() and x.any():
                rows.append((name, len(x), x.tobytes(), float(np.sqrt((x * x).sum()))))
        columns = list(zip(*rows)) if rows else [[], [], [], []]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.binary(), pa.float64()))],
                              ["vec_id", "dims", "vector", "norm"])


def _matrix(column, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, dims)


def _lifted(rows: np.ndarray, longest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(longest ** 2 - (rows * rows).sum(1), 0.0))
    return np.c_[rows, rest]


def placer(shared, longest: float, dims: int):
    def run(batches):
        for batch in batches:
            leaves = shared.value.place(_lifted(_matrix(batch.column("vector"), dims), longest))
            rows, trees = leaves.shape
            again = pa.array(np.repeat(np.arange(rows), trees))
            yield pa.record_batch([batch.column("entry").take(again), batch.column("vector").take(again), pa.array(leaves.ravel())],
                                  ["entry", "vector", "leaf"])
    return run


def router(shared, sizes: np.ndarray, wanted: float, bundle_of: np.ndarray, dims: int):
    def run(batches):
        for batch in batches:
            rows = _matrix(batch.column("vector"), dims)
            place, bundle, leaf = [], [], []
            for i, row in enumerate(np.c_[rows, np.zeros(len(rows))]):
                for x in shared.value.visit(row, sizes, wanted):
                    place.append(i)
                    bundle.append(int(bundle_of[x]))
                    leaf.append(x)
            at = pa.array(place, pa.int64())
            yield pa.record_batch([batch.column("query_id").take(at), pa.array(bundle, pa.int32()), pa.array(leaf, pa.int64())],
                                  ["query_id", "bundle", "leaf"])
    return run


def scores(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, each summed in the same order, so that equal rows score equally."""
    return (rows * query).sum(1)


def bundle_search(dims: int, k: int):
    """Best entries of one bundle for the queries of one block."""
    kind = pa.schema([("query_id", pa.int64()), ("entry", pa.int64()), ("score", pa.float64())])

    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        found = []
        if index.num_rows and queries.num_rows:
            leaf = index.column("leaf").to_numpy()
            order = np.argsort(leaf, kind="stable")
            leaf = leaf[order]
            # Trees offer an entry more than once; each is scored once per query.
            entry, first, number = np.unique(index.column("entry").to_numpy(), return_index=True, return_inverse=True)
            rows = _matrix(index.column("vector").take(pa.array(first)), dims)
            number = number[order]
            for i in range(queries.num_rows):
                query = np.frombuffer(queries.column("vector")[i].as_py(), "<f8")
                chosen = queries.column("leaves")[i].values.to_numpy()
                low, high = np.searchsorted(leaf, chosen), np.searchsorted(leaf, chosen, "right")
                met = np.zeros(len(entry), bool)
                for a, b in zip(low, high):
                    met[number[a:b]] = True
                near = np.flatnonzero(met)
                value = rows[near] @ query
                if len(near) > 2 * k:
                    bound = np.partition(value, -k)[-k]
                    near = near[value >= bound - 1e-9 * (1 + abs(bound))]
                value = scores(rows[near], query)
                best = np.lexsort((entry[near], -value))[:k]
                found.append((np.full(len(best), queries.column("query_id")[i].as_py()), entry[near[best]], value[best]))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [[], [], []]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kind.types)], schema=kind)
    return run


def nearest(table: DataFrame, k: int = K, every: int = EVERY, trees: int = TREES, visited: float = VISITED) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows of largest inner product found for each row whose vec_id ``every`` divides.

    ``table`` has vec_id (integer) and embedding (array of numbers). Scores are
    inner products in double precision; ties go to the smaller vec_id; a query is no
    candidate of its own. With ``k`` or fewer others, all are returned. Rows with
    a null vec_id or embedding, or one that is empty, all zero, or holds a null or a
    non-finite number, take no part. Vectors of different lengths have no inner
    product: each length is searched among its own, by a forest of its own. Rows that
    repeat a vec_id are one row, with the smallest of their vectors by bytes. Other columns
    are ignored. Without rows, no rows.
    """
    spark = table.sparkSession
    ship(spark)
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(
        cleaner, "vec_id long, dims int, vector binary, norm double")
    rows = stored(rows.groupBy("vec_id").agg(F.min(F.struct("dims", "vector", "norm")).alias("x")).select("vec_id", "x.*"), "vectors")
    widths = rows.groupBy("dims").agg(F.count("*").alias("n"), F.max("norm").alias("norm")).orderBy("dims").collect()
    if not widths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionByName, [
        _nearest_of(rows.where(F.col("dims") == w.dims), w.dims, w.n, w.norm, k, every, trees, visited) for w in widths])


def _nearest_of(rows: DataFrame, dims: int, total: int, longest: float, k: int, every: int, trees: int, visited: float) -> DataFrame:
    """:func:`nearest` over vectors of one length."""
    spark = rows.sparkSession
    # One entry per vector, named by its smallest id, with the ids that a result may need.
    ties = Window.partitionBy("vector").orderBy("vec_id")
    ids = stored(rows.select("vector", "vec_id").withColumn("place", F.row_number().over(ties)).where(F.col("place") <= k + 1), "ids")
    entries = ids.where("place = 1").select(F.col("vec_id").alias("entry"), "vector")
    names = ids.groupBy("vector").agg(F.min("vec_id").alias("entry"), F.collect_list("vec_id").alias("vec_ids")).select("entry", "vec_ids")

    sample = entries.orderBy(F.xxhash64("vector"), "entry").limit(SAMPLE).select("vector").toArrow()
    forest = Forest(_lifted(_matrix(sample.column("vector"), dims), longest), trees)
    shared = spark.sparkContext.broadcast(forest)
    index = stored(entries.mapInArrow(placer(shared, longest, dims), "entry long, vector binary, leaf long"), "leaves")
    sizes = np.zeros(forest.leaves, np.int64)
    for leaf, n in index.groupBy("leaf").agg(F.count("*")).collect():
        sizes[leaf] = n
    before = np.cumsum(sizes) - sizes
    bundle_of = (before // BUNDLE).astype(np.int32)

    queries = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "vector")
    blocks = max(1, -(-queries.count() // QUERIES))
    routes = queries.mapInArrow(router(shared, sizes, max(visited * total, FEWEST), bundle_of, dims),
                                "query_id long, bundle int, leaf long")
    routes = routes.groupBy("query_id", "bundle").agg(F.collect_list("leaf").alias("leaves")).join(queries, "query_id")
    routes = routes.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    bundle = F.element_at(F.lit(bundle_of.tolist()).cast("array<int>"), (F.col("leaf") + 1).cast("int"))
    dealt = index.withColumn("bundle", bundle).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    best = dealt.groupBy("bundle", "block").cogroup(routes.groupBy("bundle", "block")).applyInArrow(
        bundle_search(dims, k + 1), "query_id long, entry long, score double")

    top = Window.partitionBy("query_id").orderBy(F.desc("score"), "entry")
    best = best.distinct().withColumn("place", F.row_number().over(top)).where(F.col("place") <= k + 1)
    found = best.join(names, "entry").select("query_id", "score", F.explode("vec_ids").alias("vec_id"))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.where("vec_id != query_id").withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")
