"""SimHash fingerprints, and all fingerprints within a Hamming radius by permuted block tables.

Terms are runs of ``TERM`` words (``[^\\x20\\x09-\\x0D]+``, A-Z in lower case); a text
with fewer words is one term. Each term votes for every bit of the fingerprint,
with the sign of that bit in the term's hash and the weight 1 + log2(occurrences);
a bit is set where the sum is above 0.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftlab.llm import hashing
from shiftlab.llm.common import own_columns, ship, stored
from shiftlab.llm.tokens import portions

BITS = 128
TERM = 3
#: Weights are whole numbers of this part, so that sums do not depend on their order.
UNIT = 16
#: Terms whose votes are spread out at once.
CHUNK = 1 << 15
RADIUS, BLOCKS = 3, 4


def _lanes(found: np.ndarray, bits: int) -> list[np.ndarray]:
    return [hashing.mix(found ^ np.uint64(0x632BE59BD9B4E019 * i % (1 << 64))) for i in range(1, bits // 64 + 1)]


def _votes(found: np.ndarray, weight: np.ndarray, starts: np.ndarray, bits: int) -> np.ndarray:
    spread = np.unpackbits(np.stack(_lanes(found, bits), 1).view(np.uint8), axis=1).astype(np.int32)
    spread *= (2 * weight)[:, None]
    return np.add.reduceat(spread, starts, axis=0) - np.add.reduceat(weight, starts)[:, None]


def _equal_votes(found: np.ndarray, starts: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(group, votes) of up to 255 terms of weight 1 at a time; bits are counted in the bytes of whole lanes."""
    sizes = np.diff(np.r_[starts, len(found)])
    pieces = -(-sizes // 255)
    group = np.repeat(np.arange(len(starts)), pieces)
    begins = starts[group] + 255 * (np.arange(len(group)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    lanes = _lanes(found, bits)
    counts = np.empty((len(group), len(lanes), 8, 8), np.int32)
    for n, lane in enumerate(lanes):
        for k in range(8):
            sums = np.add.reduceat((lane >> np.uint64(7 - k)) & np.uint64(0x0101010101010101), begins)
            counts[:, n, :, k] = sums.view(np.uint8).reshape(len(group), 8)
    return group, 2 * counts.reshape(len(group), bits) - np.diff(np.r_[begins, len(found)])[:, None]


def fingerprints(column: pa.Array, bits: int = BITS, term: int = TERM) -> np.ndarray:
    """A row of ``bits`` / 8 bytes for each text; without words all are 0."""
    data, offsets = hashing.text_bytes(column)
    out = np.zeros((len(column), bits // 8), np.uint8)
    for first, last in hashing.slices(offsets):
        part = data[offsets[first]:offsets[last]]
        begins, behind, row = hashing.word_spans(part, offsets[first:last + 1] - offsets[first])
        found, owner = hashing.shingle_hashes(hashing.word_hashes(part, begins, behind), row, term)
        if not len(found):
            continue
        order = np.lexsort((found, owner))
        found, owner = found[order], owner[order]
        heads = np.flatnonzero(np.r_[True, (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])])
        weight = np.rint(UNIT * (1 + np.log2(np.diff(np.r_[heads, len(found)])))).astype(np.int32)
        found, owner = found[heads], owner[heads]
        sums = np.zeros((last - first, bits), np.int64)
        # Most terms occur once; their votes have one weight.
        once = weight == UNIT
        for at in range(0, len(found), CHUNK):
            part = once[at:at + CHUNK]
            some, single = owner[at:at + CHUNK][part], found[at:at + CHUNK][part]
            if len(single):
                starts = np.flatnonzero(np.r_[True, some[1:] != some[:-1]])
                group, votes = _equal_votes(single, starts, bits)
                np.add.at(sums, some[starts][group], UNIT * votes)
        found, owner, weight = found[~once], owner[~once], weight[~once]
        for at in range(0, len(found), CHUNK):
            some = owner[at:at + CHUNK]
            starts = np.flatnonzero(np.r_[True, some[1:] != some[:-1]])
            sums[some[starts]] += _votes(found[at:at + CHUNK], weight[at:at + CHUNK], starts, bits)
        out[first:last] = np.packbits(sums > 0, axis=1)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bits."""
    return 1.0 - np.bitwise_count(a ^ b).sum(1, dtype=np.int64) / (8.0 * a.shape[1])


def _hex(rows: np.ndarray) -> list[str]:
    return [r.tobytes().hex() for r in rows]


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the next text."""
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut]


COMPARED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
            "near_edited double, near_next double")
NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def compared(ids: list, texts: list[str], following: list[str], own: np.ndarray, after: np.ndarray) -> list[pa.Array]:
    """Columns of ``COMPARED`` for texts and those that follow them, with the fingerprints of both."""
    changed = [edited(t, f) for t, f in zip(texts, following)]
    other = fingerprints(pa.array(changed, pa.string()), 8 * own.shape[1])
    return [pa.array(ids, pa.int64()), pa.array(list(map(len, texts)), pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]), pa.array(_hex(own)), pa.array(_hex(other)),
            pa.array(likeness(own, other)), pa.array(likeness(own, after))]


def sequence(bits: int):
    """Rows of one task, in order: all but the last compared with their next; the first and last kept as edges."""
    def edge(part, kind, doc_id, text):
        empty = [pa.array([doc_id], pa.int64())] + [pa.nulls(1, pa.int64())] + [pa.nulls(1, pa.string())] * 3 + \
            [pa.nulls(1, pa.float64())] * 2
        return pa.record_batch([*empty, pa.array([part], pa.int32()), pa.array([kind]), pa.array([text], pa.string())],
                               [*NAMES, "part", "edge", "text"])

    def run(batches):
        last = None
        part = None
        for batch in batches:
            all_ids, all_texts = batch.column("doc_id").to_pylist(), batch.column("text").fill_null("").to_pylist()
            if part is None and all_ids:
                part = batch.column("part")[0].as_py()
                yield edge(part, "first", all_ids[0], all_texts[0])
            for a, b in portions(all_texts):
                ids, texts = all_ids[a:b], all_texts[a:b]
                if last is not None:
                    ids, texts = [last[0], *ids], [last[1], *texts]
                last = ids[-1], texts[-1]
                if len(ids) < 2:
                    continue
                whole = fingerprints(pa.array(texts, pa.string()), bits)
                n = len(ids) - 1
                yield pa.record_batch(
                    [*compared(ids[:-1], texts[:-1], texts[1:], whole[:-1], whole[1:]), pa.array([part] * n, pa.int32()),
                     pa.nulls(n, pa.string()), pa.nulls(n, pa.string())], [*NAMES, "part", "edge", "text"])
        if last is not None:
            yield edge(part, "last", *last)
    return run


def edge_rows(bits: int):
    def run(batches):
        for batch in batches:
            texts, following = batch.column("text").to_pylist(), batch.column("following").to_pylist()
            own, after = (fingerprints(pa.array(x, pa.string()), bits) for x in (texts, following))
            yield pa.record_batch(compared(batch.column("doc_id").to_pylist(), texts, following, own, after), NAMES)
    return run


def fingerprinted(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next: one row per row of ``docs`` (doc_id integer, text).

    The edited text has its last quarter (code points, rounded down) replaced by as
    many of the first of the next document, in ascending order of doc_id (null
    first; rows with one doc_id in the order of their texts); the first follows the
    last. near_edited and near_next are the shares of bits that a document's
    fingerprint has in common with the edited text's and the next document's. A
    null text is empty; without words a fingerprint is 0. Other columns are
    ignored. Without rows, no rows.

    Texts are ranged once by doc_id. Each task compares its own neighbours; only
    the first and the last text of each task meet in a second, short step.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = own_columns(docs, doc_id=F.col("doc_id").cast("long"), text="text")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = docs.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", F.coalesce("text", F.lit("")))
    found = stored(ranged.withColumn("part", F.spark_partition_id()).mapInArrow(
        sequence(bits), f"{COMPARED}, part int, edge string, text string"), "fingerprints")
    firsts = found.where("edge = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    order = Window.orderBy("part")
    parts_in_order = found.where("edge = 'first'").select("part").select(
        "part", F.coalesce(F.lead("part").over(order), F.min("part").over(
            order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("next_part"))
    lasts = found.where("edge = 'last'").select("part", "doc_id", "text").join(parts_in_order, "part").join(firsts, "next_part")
    return found.where("edge is null").select(*NAMES).union(
        lasts.select("doc_id", "text", "following").mapInArrow(edge_rows(bits), COMPARED))


def block_keys(fingerprint: str, bits: int, radius: int, blocks: int) -> Column:
    """The key of a hex fingerprint in every table.

    Bits are cut into ``blocks`` blocks. Two fingerprints within ``radius`` differ in at
    most so many blocks, so they agree on some ``blocks - radius`` of them: one
    table for each choice of those.
    """
    digits = bits // 4
    cuts = [round(digits * i / blocks) for i in range(blocks + 1)]
    block = [F.substring(fingerprint, cuts[i] + 1, cuts[i + 1] - cuts[i]) for i in range(blocks)]
    return F.array(*[F.xxhash64(F.lit(t), *[block[i] for i in chosen])
                     for t, chosen in enumerate(combinations(range(blocks), blocks - radius))])


def distance(a: str, b: str, bits: int) -> Column:
    """Differing bits of two hex fingerprints."""
    total = F.lit(0)
    for i in range(0, bits // 4, 8):
        x, y = (F.conv(F.substring(c, i + 1, 8), 16, 10).cast("long") for c in (a, b))
        total = total + F.bit_count(x.bitwiseXOR(y))
    return total


def within_radius(queries: DataFrame, index: DataFrame, bits: int = BITS, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """query, fingerprint, distance: for each fingerprint of ``queries``, those of ``index`` at most ``radius`` away, itself included.

    Both have a column fingerprint (hex). Equal fingerprints are one row on either
    side, so copies neither repeat work nor make pairs; documents are found through
    their fingerprint. Nulls find and match nothing. All are found for certain:
    ``blocks`` must be above ``radius``.
    """
    if blocks <= radius:
        raise ValueError("blocks must be above radius")
    keyed = [df.where(F.col("fingerprint").isNotNull()).select(F.col("fingerprint").alias(name)).distinct().withColumn(
        "key", F.explode(block_keys(name, bits, radius, blocks))) for df, name in ((queries, "query"), (index, "fingerprint"))]
    met = keyed[0].join(keyed[1], "key").withColumn("distance", distance("query", "fingerprint", bits))
    return met.where(F.col("distance") <= radius).select("query", "fingerprint", "distance").distinct()
