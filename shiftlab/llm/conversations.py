"""Repair of conversations at least cost: run-length dynamic programming with min-plus powers.

The roles of a repaired conversation read ``(s?(ua)+)?``. That is an automaton of four states, and
a row is a symbol: its role's initial and its fault. One symbol's least costs
between states are a 4 x 4 min-plus matrix M, so a run of r equal symbols is M to the power r,
put together from powers M, M^2, M^4, ... that every worker keeps.

Min-plus products are associative, so a conversation need not fit in one task. Rows are
ranged by (conversation, place) into parts; a part's rows of a conversation are a segment
of a few numbers. Costs are carried back over the segments of a conversation, each segment is
unrolled for every state it may begin in, and the audit follows those
that join. Only fixed-width rows take part in this. Texts are shuffled once, to be
hashed in order, and no task holds more than a batch of them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlab.llm.common import own_columns, ship, stored

DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
ROLES = {"u": "user", "a": "assistant"}
#: States: nothing yet, after s, after u, after a; the first and the last may end.
STATES, FINAL = 4, (0, 3)
#: Where a role's initial leads, by state; the role that an inserted or re-roled row takes, by state.
STEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
NEXT = ("u", "u", "a", "u")
NEVER = 1 << 60
#: Symbols: 0 must go; 1 to 4 are sound rows by initial, 5 to 8 truncated ones.
INITIALS = "sua-"
LEGAL = {"su", "ua", "au"}
#: Rows of a run that are unrolled together.
BLOCK = 4096
#: Characters between words.
BLANKS = " \t\n\x0b\x0c\r"

_INSERTED = np.full((STATES, STATES), NEVER)
for _q in range(STATES):
    _at, _paid = _q, 0
    while _paid < 3 * INSERT:
        _INSERTED[_q, _at] = min(_INSERTED[_q, _at], _paid)
        _at, _paid = STEP[_at][NEXT[_at]], _paid + INSERT


def row_moves(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(initial of the edit, cost, next state) of what can become of a row, in the order of the initials."""
    found = [("D", DELETE, state)]
    if symbol:
        extra = TRUNCATED if symbol > 4 else 0
        kept = STEP[state].get(INITIALS[(symbol - 1) % 4])
        if kept is not None:
            found.append(("K", extra, kept))
        found.append(("R", REROLE + extra, STEP[state][NEXT[state]]))
    return found


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The min-plus product."""
    return np.minimum((a[:, :, None] + b[None, :, :]).min(1), NEVER)


def transition(symbol: int) -> np.ndarray:
    """Least cost from state to state over one row, rows inserted before it included."""
    one = np.full((STATES, STATES), NEVER)
    for q in range(STATES):
        for _, cost, to in row_moves(symbol, q):
            one[q, to] = min(one[q, to], cost)
    return product(_INSERTED, one)


_powers: dict[int, list[np.ndarray]] = {}


def advance(symbol: int, count: int, after: np.ndarray) -> np.ndarray:
    """Costs before a run of ``count`` rows, from those after it (a column per end)."""
    powers = _powers.setdefault(symbol, [transition(symbol)])
    bit = 0
    while count >> bit:
        if bit == len(powers):
            powers.append(product(powers[-1], powers[-1]))
        if count >> bit & 1:
            after = product(powers[bit], after)
        bit += 1
    return after


#: Costs behind the last row, where rows may still be inserted.
END = product(_INSERTED, np.array([[0 if q in FINAL else NEVER] for q in range(STATES)]))


def runs_of(symbols: list[int], copies: list[int]) -> list[tuple[int, int]]:
    """Equal consecutive symbols as (symbol, count); further copies of a row must go."""
    runs: list[list[int]] = []
    for symbol, n in zip(symbols, copies):
        for s, c in ((symbol, 1), (0, n - 1)):
            if c and runs and runs[-1][0] == s:
                runs[-1][1] += c
            elif c:
                runs.append([s, c])
    return [(s, c) for s, c in runs]


def unroll(runs: list[tuple[int, int]], after: list[int], state: int, last: bool) -> tuple[str, int]:
    """The cheapest edits of a segment, least by ASCII, from ``state`` on, and the state behind them.

    Each state and edit lead to one state, so the least text is found edit by edit among
    those whose cost and rest make up the whole.
    """
    behind = [np.array([[x] for x in after])]
    for symbol, count in reversed(runs):
        behind.append(advance(symbol, count, behind[-1]))
    behind.reverse()
    found: list[str] = []
    for (symbol, count), end in zip(runs, behind[1:]):
        moves = [row_moves(symbol, q) for q in range(STATES)]
        for low in range(0, count, BLOCK):
            size = min(BLOCK, count - low)
            rest = [advance(symbol, count - low - size, end)]
            for _ in range(size):
                rest.append(advance(symbol, 1, rest[-1]))
            costs = [r[:, 0].tolist() for r in reversed(rest)]
            for here, there in zip(costs, costs[1:]):
                done = False
                while not done:
                    inserted = STEP[state][NEXT[state]]
                    options = [(edit, cost + there[to], to, True) for edit, cost, to in moves[state]]
                    options.append(("I", INSERT + here[inserted], inserted, False))
                    edit, _, state, done = min(x for x in options if x[1] == here[state])
                    found.append(edit)
    while last and state not in FINAL:
        state = STEP[state][NEXT[state]]
        found.append("I")
    return "".join(found), state


def grouped(batches, columns: list[str], keys: int):
    """(key, rows) of consecutive rows with the same first ``keys`` columns; rows of one key are held together."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in columns]):
            if rows and row[:keys] != key:
                yield key, rows
                rows = []
            key = row[:keys]
            rows.append(row[keys:])
    if rows:
        yield key, rows


def _batch(rows: list[tuple], kind: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in kind]
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kind.types)], schema=kind)


def batched(rows, kind: pa.Schema, size: int = 1000):
    out = []
    for row in rows:
        out.append(row)
        if len(out) == size:
            yield _batch(out, kind)
            out = []
    yield _batch(out, kind)


SEGMENT = "conv_id long, part int, matrix array<long>, first string, last string, illegal long"
_SEGMENT = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("matrix", pa.list_(pa.int64())), ("first", pa.string()),
                      ("last", pa.string()), ("illegal", pa.int64())])


def summarise(batches):
    """What a segment does to costs, and the pairs of roles inside it that are not allowed."""
    def rows():
        for (conv, part), found in grouped(batches, ["conv_id", "part", "symbol", "initial", "copies"], 2):
            symbols, initials, copies = zip(*found)
            matrix = np.full((STATES, STATES), NEVER)
            np.fill_diagonal(matrix, 0)
            for symbol, count in reversed(runs_of(symbols, copies)):
                matrix = advance(symbol, count, matrix)
            pairs = sum(n - 1 for n in copies) + sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
            yield conv, part, matrix.ravel().tolist(), initials[0], initials[-1], pairs
    yield from batched(rows(), _SEGMENT)


CARRIED = "conv_id long, part int, after array<long>, opens boolean, closes boolean, cost long, illegal long"
_CARRIED = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("after", pa.list_(pa.int64())), ("opens", pa.bool_()),
                      ("closes", pa.bool_()), ("cost", pa.int64()), ("illegal", pa.int64())])


def carry(batches):
    """Costs behind every segment, from the segments of a conversation; a row per part at most."""
    def rows():
        for batch in batches:
            for conv, segments in zip(batch.column("conv_id").to_pylist(), batch.column("segments").to_pylist()):
                after, behind = END, []
                for s in reversed(segments):
                    behind.append(after[:, 0].tolist())
                    after = product(np.array(s["matrix"]).reshape(STATES, STATES), after)
                illegal = sum(s["illegal"] for s in segments)
                illegal += sum(a["last"] + b["first"] not in LEGAL for a, b in zip(segments, segments[1:]))
                for i, (s, costs) in enumerate(zip(segments, reversed(behind))):
                    yield conv, s["part"], costs, i == 0, i == len(segments) - 1, int(after[0, 0]), illegal
    yield from batched(rows(), _CARRIED)


UNROLLED = "conv_id long, part int, audits array<string>, ends array<int>, cost long, illegal long"
_UNROLLED = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("audits", pa.list_(pa.string())),
                       ("ends", pa.list_(pa.int32())), ("cost", pa.int64()), ("illegal", pa.int64())])


def unroller(batches):
    """The edits of every segment, by the state it begins in; a conversation's first begins with nothing."""
    def rows():
        columns = ["conv_id", "part", "symbol", "copies", "after", "opens", "closes", "cost", "illegal"]
        for (conv, part), found in grouped(batches, columns, 2):
            *_, after, opens, closes, cost, illegal = found[0]
            symbols, copies = zip(*[r[:2] for r in found[1:]])
            runs = runs_of(symbols, copies)
            before = np.array([[x] for x in after])
            for symbol, count in reversed(runs):
                before = advance(symbol, count, before)
            starts = [q for q in ((0,) if opens else range(STATES)) if before[q, 0] < NEVER]
            done = {q: unroll(runs, after, q, closes) for q in starts}
            yield (conv, part, [done[q][0] if q in done else None for q in range(STATES)],
                   [done[q][1] if q in done else None for q in range(STATES)], cost, illegal)
    yield from batched(rows(), _UNROLLED, 100)


REPAIRED = "conv_id long, cost long, illegal long, audit string, repaired_sha256 string"
_REPAIRED = pa.schema([("conv_id", pa.int64()), ("cost", pa.int64()), ("illegal", pa.int64()), ("audit", pa.string()),
                       ("repaired_sha256", pa.string())])


class Follower:
    """A conversation's edits, applied to its rows as they come."""

    def __init__(self, conv):
        self.conv, self.audit, self.cost, self.illegal = conv, [], 0, 0
        self.state = self.place = self.piece = 0
        self.begins = 0

    def segment(self, audits, ends, cost, illegal):
        self.audit.append(audits[self.begins])
        self.begins, self.cost, self.illegal = ends[self.begins], cost, illegal

    def _next(self) -> str:
        while self.piece < len(self.audit) and self.place == len(self.audit[self.piece]):
            self.piece, self.place = self.piece + 1, 0
        return self.audit[self.piece][self.place] if self.piece < len(self.audit) else ""

    def lines(self, role: str | None, text: str = ""):
        """(role, text) that the next row leads to, rows inserted before it included; ``None`` stands for the end."""
        while (edit := self._next()) and (role is not None or edit == "I"):
            self.place += 1
            if edit == "D":
                return
            initial = role[:1] if edit == "K" else NEXT[self.state]
            self.state = STEP[self.state][initial]
            yield (role if edit == "K" else ROLES[initial]), (text if edit != "I" else "")
            if edit != "I":
                return


def followed(batches):
    """(follower, role, text) of every repaired row, and (follower, None, None) behind each conversation."""
    columns = ["conv_id", "is_row", "role", "text", "copies", "audits", "ends", "cost", "illegal"]
    follower = None

    def finish():
        for line in follower.lines(None):
            yield follower, *line
        yield follower, None, None
    for batch in batches:
        for conv, is_row, role, text, copies, *segment in zip(*[batch.column(c).to_pylist() for c in columns]):
            if follower is None or follower.conv != conv:
                if follower is not None:
                    yield from finish()
                follower = Follower(conv)
            if not is_row:
                follower.segment(*segment)
                continue
            for _ in range(copies):
                for line in follower.lines(role, text):
                    yield follower, *line
    if follower is not None:
        yield from finish()


def digester(batches):
    """Edits and hash of every conversation."""
    def rows():
        sha, lines = hashlib.sha256(), 0
        for follower, role, text in followed(batches):
            if role is None:
                yield follower.conv, follower.cost, follower.illegal, "".join(follower.audit), sha.hexdigest()
                sha, lines = hashlib.sha256(), 0
                continue
            sha.update(f"\n{role}:{text}".encode() if lines else f"{role}:{text}".encode())
            lines += 1
    yield from batched(rows(), _REPAIRED, 100)


LINES = "conv_id long, line long, role string, text string"
_LINES = pa.schema([("conv_id", pa.int64()), ("line", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def liner(batches):
    """The repaired rows themselves, numbered from 0."""
    def rows():
        n = 0
        for follower, role, text in followed(batches):
            if role is not None:
                yield follower.conv, n, role, text
            n = n + 1 if role is not None else 0
    yield from batched(rows(), _LINES, 100)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows damaged by ``crc32(conv_id:turn) % 20``, for tests of the repair: 0 drops a row, 1 empties its text,
    2 takes ``.!?`` out, 3 says it twice, 4 makes it the user's. Nulls of role and text, and in the key, are one space."""
    rows = own_columns(conversations, conv_id=F.col("conv_id").cast("long"), turn=F.col("turn").cast("long"),
                       role=F.coalesce("role", F.lit(" ")), text=F.coalesce("text", F.lit(" ")))
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = rows.withColumn("kind", F.crc32(key) % 20).where("kind != 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 3, F.lit(2)).otherwise(F.lit(1)).alias("copies"))


def _faults(rows: DataFrame) -> DataFrame:
    """One short row per (conversation, turn, said): copies, initial, faults, symbol."""
    said = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    solid = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin(*INITIALS[:3]), initial).otherwise(F.lit(INITIALS[3]))
    rows = rows.withColumns({"digest": said, "solid": solid, "initial": initial}).withColumns({
        "blank": F.col("solid") == "", "cut": ~F.substring("solid", -1, 1).isin(".", "!", "?")})
    rows = rows.groupBy("conv_id", "turn", "digest", "initial", "blank", "cut").agg(F.sum("copies").cast("long").alias("copies"))
    rows = stored(rows, "said")
    earliest = rows.groupBy(F.col("conv_id").alias("_conv"), F.col("digest").alias("_digest")).agg(
        F.min("turn").alias("_turn"), F.bool_or(F.col("turn").isNull()).alias("_null"))
    rows = rows.join(earliest, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("digest") == F.col("_digest")))
    first = F.when(F.col("_null"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("_turn"))
    place = F.instr(F.lit(INITIALS), F.col("initial"))
    symbol = F.when(F.col("blank") | ~first, F.lit(0)).otherwise(place + F.when(F.col("cut"), F.lit(4)).otherwise(F.lit(0)))
    return rows.select(
        "conv_id", "turn", "digest", "copies", "initial", symbol.cast("int").alias("symbol"), "blank",
        F.when(F.col("blank"), F.lit(0)).otherwise(F.col("copies") - first.cast("int")).alias("duplicate"),
        (~F.col("blank") & first & F.col("cut")).cast("int").alias("truncated"))


def _edits(rows: DataFrame, faults: DataFrame) -> DataFrame:
    """Segments' edits and, behind them, the rows of each conversation in order, by task."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = ["conv_id", "turn", "digest"]
    ranged = faults.select(*place, "copies", "initial", "symbol").repartitionByRange(parts, *place)
    ranged = stored(ranged.withColumn("part", F.spark_partition_id()), "ranged-symbols")

    def by_segment(df, *order):
        return df.repartition("conv_id", "part").sortWithinPartitions("conv_id", "part", *order)
    segments = by_segment(ranged, "turn", "digest").mapInArrow(summarise, SEGMENT)
    segments = segments.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("part", "matrix", "first", "last", "illegal"))).alias("segments"))
    carried = stored(segments.mapInArrow(carry, CARRIED), "carried-costs")
    headed = carried.withColumn("is_row", F.lit(0)).unionByName(
        ranged.drop("initial").withColumn("is_row", F.lit(1)), allowMissingColumns=True)
    unrolled = by_segment(headed, "is_row", "turn", "digest").mapInArrow(unroller, UNROLLED)
    said = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    both = unrolled.withColumn("is_row", F.lit(0)).unionByName(
        rows.withColumns({"digest": said, "is_row": F.lit(1)}), allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "is_row", "part", "turn", "digest")


def _clean(rows: DataFrame) -> DataFrame:
    copies = F.col("copies").cast("int") if "copies" in rows.columns else F.lit(1)
    return own_columns(rows, conv_id=F.col("conv_id").cast("long"), turn=F.col("turn").cast("long"),
                       role=F.coalesce("role", F.lit(" ")), text=F.coalesce("text", F.lit(" ")), copies=copies)


def repaired_lines(rows: DataFrame) -> DataFrame:
    """conv_id, line, role, text: the conversations of :func:`repaired` as they read afterwards."""
    ship(rows.sparkSession)
    rows = _clean(rows)
    return _edits(rows, _faults(rows)).mapInArrow(liner, LINES)


def repaired(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, one row per conversation.

    ``rows`` has conv_id, turn, role, text and, if rows stand for several, ``copies``;
    a null role or text is one space, a null conv_id a conversation of its own. Rows go by turn,
    nulls first, then by a hash of role and text. ``ids`` names further
    conversations that have no rows: they get zeros, an empty audit and the hash of
    an empty text. gaps counts the turns missing between the first and the last.
    Of a row's faults the first counts: blank (no word), duplicate (role and text
    said before), truncated (does not end in ``.!?``). illegal counts neighbours
    whose initials are not su, ua or au; another initial, or none, is never allowed.

    Edits: Keep costs nothing, Rerole (to user or assistant) 1, Delete 2, Insert (an empty row of user or
    assistant) 5, and a truncated row that stays 5 more; blank and duplicate rows
    must go. audit holds the initials of the cheapest edits that make the roles read
    ``(s?(ua)+)?``, the least by ASCII if several are. repaired_sha256 is that of
    the ``role:text`` lines left. Other columns are ignored. Without rows, no rows but those of ``ids``.
    """
    ship(rows.sparkSession)
    rows = _clean(rows)
    faults = stored(_faults(rows), "faults")
    turns = faults.groupBy("conv_id", "turn").agg(
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(F.lit(0))).alias("blank"),
        F.sum("duplicate").alias("duplicate"), F.sum("truncated").alias("truncated"))
    counted = turns.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    edits = _edits(rows, faults).mapInArrow(digester, REPAIRED)
    known = rows.select("conv_id") if ids is None else rows.select("conv_id").union(ids.select(F.col("conv_id").cast("long")))
    known = known.distinct()
    found = known.join(counted.withColumnRenamed("conv_id", "_counted"), F.col("conv_id").eqNullSafe(F.col("_counted")), "left")
    found = found.join(edits.withColumnRenamed("conv_id", "_edited"), F.col("conv_id").eqNullSafe(F.col("_edited")), "left")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return found.select(
        "conv_id", *[F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
