"""Packing into fixed windows in target proportions of sources: deficit round-robin.

Every source is a queue of tokens, its documents in the order of doc_id. The next
token always comes from the queue that is furthest behind its share, the one with
the smallest (tokens given + 1/2) / weight. So every window of ``WINDOW`` tokens
has each source's share to within a token or so, and what a queue is owed at the
end of a window is carried to the next.

What a queue has given by token G of the whole is a function of G and the weights
alone. A task therefore needs no other task's state to place its documents: only
where each queue stood when its rows began, one sum per source and task.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftlab.llm import tokens
from shiftlab.llm.common import own_columns, ship, stored

WINDOW = 1024
#: Queues of one mixture; more are an error, since every task holds their totals.
MOST_SOURCES = 20_000
#: Window ends times sources worked on at once.
CELLS = 1 << 20


class Schedule:
    """Where each queue stands after G tokens of the mixture."""

    def __init__(self, totals: np.ndarray, weights: np.ndarray):
        self.totals, self.weights = totals.astype(np.int64), weights.astype(np.float64)
        ends = self.totals / self.weights
        order = np.argsort(ends, kind="stable")
        open_weight = self.weights.sum() - np.r_[0.0, np.cumsum(self.weights[order])[:-1]]
        steps = np.diff(np.r_[0.0, ends[order]])
        self.times = np.r_[0.0, ends[order]]
        self.given = np.r_[0.0, np.cumsum(steps * np.maximum(open_weight, 0))]
        self.total = int(self.totals.sum())

    def _counts(self, time: np.ndarray) -> np.ndarray:
        return np.minimum(self.totals, np.floor(time[:, None] * self.weights + 0.5).astype(np.int64))

    def stands(self, at: np.ndarray) -> np.ndarray:
        """Tokens of each queue among the first ``at`` ones: (positions, queues)."""
        queues = len(self.totals)
        rows = max(1, CELLS // queues)
        return np.concatenate([self._stands(at[i:i + rows]) for i in range(0, len(at), rows)] or
                              [np.zeros((0, queues), np.int64)])

    def _stands(self, at: np.ndarray) -> np.ndarray:
        at = np.minimum(at, self.total)
        # Rounding gives each queue half a token more at most: never too many in all.
        early = np.maximum(at - 0.5 * len(self.totals) - 1, 0)
        given = self._counts(np.interp(early, self.given, self.times))
        given[early == 0] = 0
        missing = at - given.sum(1)
        rows = np.flatnonzero(missing > 0)
        while len(rows):
            some = given[rows]
            turn = np.where(some < self.totals, (some + 0.5) / self.weights, np.inf).argmin(1)
            given[rows, turn] += 1
            missing[rows] -= 1
            rows = rows[missing[rows] > 0]
        return given

    def near(self, queue: np.ndarray, position: np.ndarray) -> np.ndarray:
        """About how many tokens come before one of a queue; off by at most twice the queues."""
        return np.interp((position + 0.5) / self.weights[queue], self.times, self.given)

    def pieces(self, queue: np.ndarray, first: np.ndarray, length: np.ndarray, window: int):
        """(row, start in the run, length, window, place in the window) of runs of queues' tokens."""
        slack = 2 * len(self.totals) + 2
        last_window = max(0, (self.total - 1) // window)
        low = np.clip((self.near(queue, first) - slack) // window, 0, last_window).astype(np.int64)
        high = np.clip((self.near(queue, first + length - 1) + slack) // window, 0, last_window).astype(np.int64)
        many = high - low + 1
        row = np.repeat(np.arange(len(first)), many)
        win = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + low[row]
        wanted = np.unique(win)
        edges = np.unique(np.r_[wanted, wanted + 1])
        stands = self.stands(edges * window)
        begin, end = (stands[np.searchsorted(edges, w)] for w in (wanted, wanted + 1))
        place = np.zeros_like(begin)
        np.cumsum((end - begin)[:, :-1], axis=1, out=place[:, 1:])
        at, q = np.searchsorted(wanted, win), queue[row]
        a = np.maximum(first[row], begin[at, q])
        b = np.minimum(first[row] + length[row], end[at, q])
        keep = a < b
        row, win, a, b, at, q = row[keep], win[keep], a[keep], b[keep], at[keep], q[keep]
        return row, a - first[row], b - a, win, place[at, q] + a - begin[at, q]


def encoder(path: str, end: int):
    """Rows of a task, in order, with their ids and the tokens of their source before them in the task."""
    def run(batches):
        encode = tokens.id_encoder(path)
        tail = np.array([end], "<u4").astype(encode.dtype).tobytes()
        size = encode.dtype.itemsize
        stand: dict = {}
        for batch in batches:
            texts, sources = batch.column("text").to_pylist(), batch.column("source").to_pylist()
            for a, b in tokens.portions(texts):
                ids = [found + tail for found in encode(texts[a:b])]
                counts = [len(x) // size for x in ids]
                before = []
                for source, n in zip(sources[a:b], counts):
                    before.append(stand.get(source, 0))
                    stand[source] = before[-1] + n
                yield pa.record_batch(
                    [batch.column(c)[a:b] for c in ("doc_id", "source", "part")]
                    + [pa.array(before, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.binary()),
                       pa.array([size] * len(ids), pa.int32())],
                    ["doc_id", "source", "part", "before", "n", "ids", "width"])
    return run


def cutter(sources: list, totals: list[int], weights: list[float], window: int):
    place = {s: i for i, s in enumerate(sources)}

    def run(batches):
        schedule = Schedule(np.array(totals), np.array(weights))
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                queue = np.array([place[s] for s in part.column("source").to_pylist()], np.int64)
                first = part.column("first").to_numpy(zero_copy_only=False)
                length = part.column("n").to_numpy(zero_copy_only=False)
                row, start, n, win, offset = schedule.pieces(queue, first, length, window)
                widths, ids = part.column("width").to_pylist(), part.column("ids")
                crc = []
                now, data = -1, b""
                for r, s, e in zip(row.tolist(), (4 * start).tolist(), (4 * (start + n)).tolist()):
                    if r != now:
                        now, data = r, np.frombuffer(ids[r].as_buffer(), f"<u{widths[r]}").astype("<u4").tobytes()
                    crc.append(zlib.crc32(data[s:e]))
                yield pa.record_batch(
                    [part.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(n), pa.array(crc, pa.int64()),
                     pa.array(length[row]), pa.array(win), pa.array(offset)],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
    return run


def packed(docs: DataFrame, path: str, end: int = 0, window: int = WINDOW, weights: dict | None = None) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: the pieces of all ``docs`` (doc_id integer, text, source).

    A document is the ids of its whole text and ``end`` (null and empty texts:
    only ``end``). Every id lies in one piece; every sequence but the last holds
    ``window`` ids, so at most one is padded. ``weights`` gives sources' shares of
    every window; a source without one, and all by default, has its own share of
    all tokens, so that the queues end together. When a queue ends, the others
    share its part. A null source is a source. Rows with one doc_id, or none, are
    documents of their own. Other columns are ignored. Without rows, no rows.
    """
    ship(docs.sparkSession)
    docs = own_columns(docs, doc_id=F.col("doc_id").cast("long"), source=F.col("source").cast("string"), text="text")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = docs.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "source", "text")
    coded = stored(ranged.withColumn("part", F.spark_partition_id()).mapInArrow(
        encoder(path, end),
        "doc_id long, source string, part int, before long, n long, ids binary, width int"), "token-ids")
    sums = stored(coded.groupBy("source", "part").agg(F.sum("n").alias("n")), "queue-sums")
    queues = sums.groupBy("source").agg(F.sum("n").alias("n")).orderBy("source").limit(MOST_SOURCES + 1).collect()
    if len(queues) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    names, totals = [r.source for r in queues], [r.n for r in queues]
    if not names:
        return coded.selectExpr("doc_id", "0L start", "n length", "0L ids_crc32", "n doc_tokens", "0L sequence_id", "0L offset")
    share = [float((weights or {}).get(s, t / sum(totals))) for s, t in zip(names, totals)]
    if min(share) <= 0:
        raise ValueError("weights must be above 0: every token is packed")
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("source").alias("of"), F.col("part").alias("in"),
                         F.coalesce(F.sum("n").over(before), F.lit(0)).alias("carried"))
    placed = coded.join(starts, F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("in"))).select(
        "doc_id", "source", (F.col("carried") + F.col("before")).alias("first"), "n", "ids", "width")
    return placed.mapInArrow(
        cutter(names, totals, share, window),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
