"""Exact largest inner products of whole-number vectors: a ball tree per shard, branch and bound.

A component x becomes floor(256 x), so every score is a whole number and exact in
whatever order it is summed. The rows of one length are dealt by a hash into
shards of bounded size. A task gets one shard and one block of queries, and grows a
tree over the shard: a node knows the centre and radius of its rows, and no row below
it scores above ``q . centre + |q| radius``. A query walks the tree from the node of
the highest bound downwards and stops at the first bound below its current
last score, the ``k``-th best so far.

The current last score is shared: the first shard is searched alone, and what it finds
goes with the queries to all other shards, which so begin with a bound. Equal vectors
are one entry with as many of its smallest ids as a result can hold.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftlab.llm.common import ship, stored

K, EVERY = 5, 50
SCALE = 256
LEAF = 128
#: Bytes of vectors of a shard and of a block of queries that meet in one task, and rows a shard has at least before there are more.
SHARD_BYTES, BLOCK_BYTES, FEWEST = 32 << 20, 16 << 20, 4096
#: Queries whose bounds are worked out together.
SLICE = 512
#: Whole numbers below this are exact doubles, and so are sums that stay below it.
EXACT = float(1 << 53)
LONG = (1 << 63) - 1

ROW = "vec_id long, dims int, vector binary"
FOUND = "query_id long, entry long, score long"


def whole(values: np.ndarray) -> np.ndarray:
    """floor(256 x) as doubles that hold whole numbers; no negative zero."""
    limit = np.finfo(np.float64).max / SCALE
    return np.floor(np.clip(values, -limit, limit) * SCALE) + 0.0


def cleaner(batches):
    """vec_id, dims, vector (whole doubles, little-endian) of the rows that take part."""
    for batch in batches:
        ids, vectors = batch.column("vec_id").to_pylist(), batch.column("embedding")
        rows = []
        for i, name in enumerate(ids):
            if name is None or not vectors[i].is_valid or vectors[i].values.null_count:
                continue
            x = vectors[i].values.to_numpy(zero_copy_only=False).astype(np.float64)
            if np.isfinite(x).all():
                rows.append((name, len(x), whole(x).astype("<f8").tobytes()))
        columns = list(zip(*rows)) if rows else [[], [], []]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.binary()))],
                              ["vec_id", "dims", "vector"])


def matrix(column, dims: int) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), "<f8").reshape(len(rows), dims)


class BallTree:
    """Nodes over the rows in a new ``order``; a node's rows are one stretch of it."""

    def __init__(self, rows: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(rows))
        self.first, self.behind, self.left, centres, radii = [], [], [], [], []
        open_nodes = [self._node(0, len(rows))]
        while open_nodes:
            node = open_nodes.pop()
            a, b = self.first[node], self.behind[node]
            here = rows[self.order[a:b]]
            centre = here.mean(0)
            away = ((here - centre) ** 2).sum(1)
            centres.append((node, centre))
            radii.append((node, float(np.sqrt(away.max()))))
            if b - a <= leaf or not away.any():
                continue
            # Halves along the line between two far rows, so the depth is a logarithm whatever the data.
            one = here[away.argmax()]
            other = here[((here - one) ** 2).sum(1).argmax()]
            half = (b - a) // 2
            self.order[a:b] = self.order[a:b][np.argpartition(here @ (one - other), half)]
            self.left[node] = self._node(a, a + half)
            open_nodes += [self.left[node], self._node(a + half, b)]
        self.centres = np.array([c for _, c in sorted(centres, key=lambda x: x[0])])
        self.radii = np.array([r for _, r in sorted(radii)])
        self.rows = rows[self.order]

    def _node(self, first: int, behind: int) -> int:
        self.first.append(first)
        self.behind.append(behind)
        self.left.append(-1)
        return len(self.first) - 1

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """What no row below a node scores above, (queries, nodes), with room for rounding."""
        length = np.sqrt((queries ** 2).sum(1))[:, None]
        most = queries @ self.centres.T + length * self.radii
        room = length * (np.sqrt((self.centres ** 2).sum(1)) + self.radii)
        return most + 1e-9 * room + 1e-6


def exact_scores(rows: np.ndarray, query: np.ndarray, small: bool) -> np.ndarray:
    """Inner products as longs; one beyond a long's range is the nearest long."""
    if small:
        return (rows @ query).astype(np.int64)
    q = [int(x) for x in query]
    found = [sum(int(x) * y for x, y in zip(row, q)) for row in rows]
    return np.array([min(max(v, -LONG), LONG) for v in found], np.int64)


def best_of(score: np.ndarray, entry: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` highest scores, ties to the smaller entry."""
    order = np.lexsort((entry, -score))[:k]
    return score[order], entry[order]


def search(tree: BallTree, entry: np.ndarray, query: np.ndarray, bounds: np.ndarray, k: int, floor: int | None,
           small: bool) -> tuple[np.ndarray, np.ndarray, int]:
    """(scores, entries, nodes visited): the best of a shard that reach ``floor``, the last score found elsewhere."""
    score, names = np.zeros(0, np.int64), np.zeros(0, np.int64)
    queue, visited = [(-bounds[0], 0)], 0
    while queue:
        most, node = heapq.heappop(queue)
        # Rows that equal the last score still count: a smaller id goes first.
        if floor is not None and -most < floor:
            break
        visited += 1
        child = tree.left[node]
        if child >= 0:
            for x in (child, child + 1):
                if floor is None or bounds[x] >= floor:
                    heapq.heappush(queue, (-bounds[x], x))
            continue
        a, b = tree.first[node], tree.behind[node]
        value = exact_scores(tree.rows[a:b], query, small)
        near = np.arange(a, b) if floor is None else a + np.flatnonzero(value >= floor)
        score, names = best_of(np.r_[score, value[near - a]], np.r_[names, entry[near]], k)
        if len(score) == k:
            floor = int(score[-1]) if floor is None else max(floor, int(score[-1]))
    return score, names, visited


def cell_search(k: int):
    """The best of one shard for one block of queries."""
    kind = pa.schema([("query_id", pa.int64()), ("entry", pa.int64()), ("score", pa.int64())])

    def run(shard: pa.Table, block: pa.Table) -> pa.Table:
        found = []
        if shard.num_rows and block.num_rows:
            dims = shard.column("dims")[0].as_py()
            rows, queries = matrix(shard.column("vector"), dims), matrix(block.column("vector"), dims)
            with np.errstate(over="ignore", invalid="ignore"):
                tree = BallTree(rows)
            entry = shard.column("entry").to_numpy()[tree.order]
            ids, floors = block.column("query_id").to_numpy(), block.column("floor").to_pylist()
            with np.errstate(over="ignore", invalid="ignore"):
                longest = np.sqrt((rows ** 2).sum(1).max() if dims else 0.0)
                small = np.sqrt((queries ** 2).sum(1)) * longest < EXACT
            for low in range(0, len(queries), SLICE):
                part = queries[low:low + SLICE]
                with np.errstate(over="ignore", invalid="ignore"):
                    bounds = np.nan_to_num(tree.bounds(part), nan=np.inf, posinf=np.inf)
                for i, query in enumerate(part):
                    sure = bool(small[low + i])
                    score, names, _ = search(tree, entry, query, bounds[i] if sure else np.full(bounds.shape[1], np.inf), k,
                                             floors[low + i], sure)
                    found.append((np.full(len(score), ids[low + i]), names, score))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [[], [], []]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kind.types)], schema=kind)
    return run


def _parts(rows: Column, most: int) -> Column:
    """How many parts hold ``rows`` vectors, each of at most ``most`` bytes."""
    return F.ceil(rows * F.greatest(F.col("dims"), F.lit(1)) * 8 / most)


def largest(table: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` highest scores for each row whose vec_id ``every`` divides.

    ``table`` has vec_id (integer) and embedding (array of numbers). A score is the
    inner product of two vectors of floor(256 x), exactly; a query is no candidate
    of its own; ties go to the smaller vec_id; with ``k`` or fewer others all are
    returned. Rows with a null vec_id or embedding, or one that holds a null or a
    non-finite number, take no part; vectors of zeros and empty ones do. Vectors
    of different lengths have no inner product: each length is a table of its own. A score beyond
    a long's range is the nearest long. Rows that repeat a vec_id are one row, with
    the smallest of their vectors by bytes. Other columns are ignored. Without
    rows, no rows.
    """
    spark = table.sparkSession
    ship(spark)
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(cleaner, ROW)
    rows = rows.groupBy("vec_id").agg(F.min(F.struct("dims", "vector")).alias("x")).select("vec_id", "x.*")
    ties = Window.partitionBy("dims", "vector").orderBy("vec_id")
    rows = stored(rows, "whole-vectors")
    ids = stored(rows.withColumn("place", F.row_number().over(ties)).where(F.col("place") <= k + 1), "entry-ids")
    names = ids.groupBy("dims", "vector").agg(F.min("vec_id").alias("entry"), F.collect_list("vec_id").alias("vec_ids"))
    names = names.select("entry", "vec_ids")
    entries = ids.where("place = 1").select("dims", F.col("vec_id").alias("entry"), "vector")
    queries = rows.where(F.col("vec_id") % every == 0).select("dims", F.col("vec_id").alias("query_id"), "vector")

    # How each length is dealt; one row per length.
    n_queries = queries.groupBy("dims").agg(F.count("*").alias("n_queries"))
    cores = spark.sparkContext.defaultParallelism
    sizes = entries.groupBy("dims").agg(F.count("*").alias("n")).join(n_queries, "dims").select(
        "dims", F.greatest(_parts(F.col("n"), SHARD_BYTES), F.least(F.lit(cores), F.ceil(F.col("n") / FEWEST))).alias("shards"),
        _parts(F.col("n_queries"), BLOCK_BYTES).alias("blocks"))
    sizes = stored(sizes, "sizes")

    def dealt(df: DataFrame, key: str, parts: str) -> Column:
        return F.pmod(F.xxhash64(key), F.col(parts)).cast("int")

    shards = stored(entries.join(sizes, "dims").withColumn("shard", dealt(entries, "entry", "shards")).select(
        "dims", "entry", "vector", "shard", "blocks"), "shards")
    blocks = queries.join(sizes, "dims").withColumn("block", dealt(queries, "query_id", "blocks"))

    def searched(rows: DataFrame, asked: DataFrame) -> DataFrame:
        met = rows.withColumn("block", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int")))).drop("blocks")
        cell = ["dims", "shard", "block"]
        return met.groupBy(*cell).cogroup(asked.groupBy(*cell)).applyInArrow(cell_search(k + 1), FOUND)

    nothing = F.lit(None).cast("long")
    kept = ["dims", "shard", "block", "query_id", "vector", "floor"]
    first = stored(searched(shards.where("shard = 0"), blocks.withColumns({"shard": F.lit(0), "floor": nothing}).select(*kept)), "first-shard")
    floors = first.groupBy("query_id").agg(F.when(F.count("*") > k, F.min("score")).alias("floor"))
    others = blocks.where("shards > 1").join(floors, "query_id", "left").withColumn(
        "shard", F.explode(F.sequence(F.lit(1), (F.col("shards") - 1).cast("int")))).select(*kept)
    best = first.unionByName(searched(shards.where("shard > 0"), others))

    top = Window.partitionBy("query_id").orderBy(F.desc("score"), "entry")
    best = best.withColumn("place", F.row_number().over(top)).where(F.col("place") <= k + 1)
    found = best.join(names, "entry").select("query_id", "score", F.explode("vec_ids").alias("vec_id"))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.where("vec_id != query_id").withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")
