"""Mixing sources to target weights along a low-discrepancy schedule.

Each source's documents are shuffled by a hash and cut into blocks of ``block``
tokens. Slot i of the mixture goes to the source whose part of [0, 1), laid out
by cumulative targets, holds the i-th golden-ratio point; the r-th slot of a source
takes its r-th block, and after the last block its first again. Any stretch of the
mixture so holds every source in proportion, and each source is taken exactly up
to its target, the last block in part.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shiftlab.llm import hashing
from shiftlab.llm.common import WORD, own_columns, running_total, ship, stored

CYCLE = (3, 1, 2)
#: Share of all tokens to take, in percent, and the most that a source gives, in times its size.
SHARE, REPEATS = 150, 2
BLOCK = 1024
MOST_SOURCES = 20_000
#: Slots whose ranks one task counts in order.
STRETCH = 1 << 14
#: 2 ** 32 divided by the golden ratio; the points are its multiples modulo 2 ** 32.
GOLDEN = 2654435769


def targets(sizes: list[int], weights: list[int], total: float, repeats: float = REPEATS) -> list[float]:
    """``total`` shared by weight, no part above ``repeats`` times its size; the excess is shared again.

    Sources fill up in the order of size to weight. Once one does not, none after
    it does, and they share what is left.
    """
    found = [0.0] * len(sizes)
    order = sorted(range(len(sizes)), key=lambda i: (sizes[i] / weights[i], i))
    left, open_weight = float(total), sum(weights)
    for place, i in enumerate(order):
        if repeats * sizes[i] * open_weight > left * weights[i]:
            for j in order[place:]:
                found[j] = left * weights[j] / open_weight
            break
        found[i] = float(repeats * sizes[i])
        left -= found[i]
        open_weight -= weights[i]
    return found


def slots_of(size: int, quota: int, block: int) -> int:
    """Blocks that a source gives, pass by pass."""
    return sum(-(-min(size, quota - at) // block) for at in range(0, quota, size)) if size else 0


def source_table(sized: DataFrame, cycle=CYCLE, share: float = SHARE) -> list[tuple]:
    """(source, size, target) of every source, by code point, null last."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("n")).limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    rows.sort(key=lambda r: (r.source is None, (r.source or "").encode()))
    sizes = [r.n for r in rows]
    weights = [cycle[i % len(cycle)] for i in range(len(rows))]
    return [(r.source, n, t) for r, n, t in zip(rows, sizes, targets(sizes, weights, sum(sizes) * share / 100))]


def schedule(spark: SparkSession, counts: list[int]) -> DataFrame:
    """(number, rank, slot) of as many slots as ``counts`` of all sources together.

    Ranks are counted within stretches of slots and carried from stretch to stretch
    by one row per source and stretch. A source may get a few slots more or fewer
    than its count.
    """
    total = sum(counts)
    ends, low = [], 0
    for n in counts[:-1]:
        low += n
        ends.append(low / total if total else 0.0)
    point = F.expr(f"(id % {1 << 31}L) * {GOLDEN}L % {1 << 32}L") / float(1 << 32)
    slots = spark.range(0, total).select(F.col("id").alias("slot"), point.alias("point"),
                                         F.floor(F.col("id") / STRETCH).alias("stretch"))
    bounds = F.array(*[F.lit(e) for e in ends]).cast("array<double>")
    placed = slots.withColumn("number", F.size(F.filter(bounds, lambda e: e <= F.col("point"))))
    sums = placed.groupBy("number", "stretch").agg(F.count("*").alias("n"))
    before = Window.partitionBy("number").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("number", "stretch", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("carried"))
    inside = Window.partitionBy("stretch", "number").orderBy("slot")
    ranked = placed.withColumn("within", F.row_number().over(inside) - 1)
    return ranked.join(sums, ["number", "stretch"]).select(
        "number", (F.col("carried") + F.col("within")).alias("rank"), "slot")


def mixed(docs: DataFrame, cycle=CYCLE, share: float = SHARE, block: int = BLOCK, seed: str = "") -> tuple[DataFrame, DataFrame]:
    """(documents, mixture) of ``docs`` (doc_id, text, source).

    documents: doc_id, size (words), source, source_size, target, taken: one row
    per row of ``docs``. mixture: slot, pass, doc_id, source, first_word, n_words:
    which words of which document stand in which slot.

    Sources by code point, null last, weigh ``cycle`` in turn. Together they give
    ``share`` percent of all words, none above twice its size. A null text has size
    0, is never in the mixture and taken 0 times. Rows that repeat a doc_id are
    documents of their own. The order of a source is by md5 of seed and doc_id, then
    by doc_id and size, so that reruns agree. Other columns are ignored. Without rows, no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = own_columns(docs, doc_id="doc_id", source=F.col("source").cast("string"), size=words)
    sized = stored(sized.withColumn("key", F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))),
                   "sizes")
    rows = source_table(sized, cycle, share)
    table = spark.createDataFrame(
        [(number, source, n, target, round(target)) for number, (source, n, target) in enumerate(rows)],
        "number int, source string, source_size long, target double, quota long")
    numbered = sized.join(table, sized.source.eqNullSafe(table.source)).select(
        "doc_id", sized.source, "size", "key", "number", "source_size", "target", "quota")
    ordered = stored(running_total(numbered, "number", ["key", "doc_id", "size"], "size", "first"), "queues")

    # Pieces of documents by block, and every pass over a block that the quota reaches.
    ends = F.col("first") + F.col("size")
    pieces = ordered.where("size > 0").withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("first") / block), F.floor((ends - 1) / block))))
    pieces = pieces.withColumn("a", F.greatest("first", F.col("block") * block)).withColumn(
        "b", F.least(ends, (F.col("block") + 1) * block))
    passes = pieces.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(REPEATS - 1))))
    offset = F.col("pass") * F.col("source_size")
    passes = passes.withColumn("b", F.least("b", F.col("quota") - offset)).where("a < b")
    blocks = F.ceil(F.col("source_size") / block)
    passes = passes.withColumn("rank", F.col("pass") * blocks + F.col("block"))
    counts = [slots_of(n, round(t), block) for _, n, t in rows]
    taken = passes.join(schedule(spark, counts), ["number", "rank"], "left")
    # Ranks that the schedule leaves open follow at its end.
    mixture = taken.select(
        F.coalesce("slot", F.lit(sum(counts)) + F.col("rank")).alias("slot"), "pass", "doc_id", "source",
        (F.col("a") - F.col("first")).alias("first_word"), (F.col("b") - F.col("a")).alias("n_words"),
        "key", "number", "first")
    mixture = stored(mixture, "mixture")
    per_doc = mixture.groupBy("number", "first", "key").agg(F.sum("n_words").alias("taken"))
    documents = ordered.join(per_doc, ["number", "first", "key"], "left").select(
        "doc_id", "size", "source", "source_size", "target",
        F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("taken"))
    return documents, mixture.drop("key", "number", "first")


def shortener(count: str):
    def run(batches):
        for batch in batches:
            texts = []
            for text, words in zip(batch.column("text").to_pylist(), batch.column(count).to_pylist()):
                data, offsets = hashing.text_bytes(pa.array([text], pa.string()))
                _, behind, _ = hashing.word_spans(data, offsets)
                texts.append(data[:behind[words - 1]].tobytes().decode() if words else "")
            changed = batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))
            if "n_chars" in batch.schema.names:
                at = batch.schema.get_field_index("n_chars")
                changed = changed.set_column(at, "n_chars", pa.array(list(map(len, texts)), batch.schema.field(at).type))
            yield changed
    return run


def shortened(docs: DataFrame, count: str) -> DataFrame:
    """Every text's first words, as many as the column ``count`` says; n_chars, if there, follows."""
    ship(docs.sparkSession)
    return docs.mapInArrow(shortener(count), docs.schema)
