"""Near-duplicate documents: MinHash bands, sequential Bayesian pruning, exact check.

1. Every text becomes its set of 5-word shingles (64-bit hashes), a digest of the
   set and a signature of ``bands * rows`` minima of 16 bits. Documents with one
   digest have one set; from here on a class of them is its smallest doc_id.
2. Classes that share a band are candidates. Each is first held against the hub of
   the bucket, its smallest doc_id: one pair per member, however large the bucket.
3. Signatures of a pair are compared in batches. After each, the pair goes if the
   posterior probability that its similarity reaches the threshold (uniform prior,
   so a Beta of matches and misses) is below ``miss``. Survivors are checked on
   their full sets, from their texts.
4. Verified links make components. Buckets whose members lie in more than one
   component still hold pairs that no hub has settled: those members are cut into
   blocks of about ``BLOCK``, and blocks meet, compared and pruned in numpy, with
   only surviving pairs emitted. Pairs inside a component need no check, since a
   further link would not change it. So no link between components is lost to a
   cap, and no bucket is gathered into one task.

A pair at exactly the threshold shares no band with probability
``(1 - threshold ** rows) ** bands``; ``bands_for`` chooses bands to keep that below
``UNMET`` (32 bands of 7 at 0.85, 52 at 0.8).
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, comb, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlab.llm import hashing, tokens
from shiftlab.llm.common import own_columns, ship, stored
from shiftlab.llm.components import components

THRESHOLD = (85, 100)
SIMILAR = (80, 100)
ROWS = 7
#: Highest probability that a pair at the threshold shares no band.
UNMET = 5e-6
BATCH = 32
MISS = 1e-4
#: Members of a bucket that meet in one comparison of blocks.
BLOCK = 256


def bands_for(threshold: float, rows: int = ROWS, unmet: float = UNMET) -> int:
    """Bands of ``rows`` minima after which a pair at the threshold has met with all but ``unmet`` probability."""
    return ceil(log(unmet) / log(1 - threshold ** rows))


def fewest_matches(threshold: float, hashes: int, batch: int = BATCH, miss: float = MISS) -> list[tuple[int, int]]:
    """(hashes compared, fewest matches to go on), after each batch.

    With m of n equal, the similarity is Beta(m + 1, n - m + 1) and reaches t with
    probability P(Binomial(n + 1, t) <= m).
    """
    steps = []
    for n in [*range(batch, hashes, batch), hashes]:
        below, m = 0.0, -1
        while below < miss:
            m += 1
            below += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        steps.append((n, m))
    return steps


def likely(a: np.ndarray, b: np.ndarray, steps: list[tuple[int, int]]) -> np.ndarray:
    """Places of the pairs of signature rows that no batch prunes."""
    at = np.arange(len(a))
    matches = np.zeros(len(a), np.int64)
    done = 0
    for n, fewest in steps:
        matches = matches + (a[at, done:n] == b[at, done:n]).sum(1)
        stay = matches >= fewest
        at, matches, done = at[stay], matches[stay], n
    return at


def likely_between(a: np.ndarray, b: np.ndarray, apart: np.ndarray,
                   steps: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The same over the pairs of two blocks that ``apart`` marks."""
    n, fewest = steps[0]
    matches = np.zeros((len(a), len(b)), np.int16)
    for i in range(n):
        matches += a[:, i, None] == b[None, :, i]
    x, y = np.nonzero(apart & (matches >= fewest))
    stay = likely(a[x], b[y], steps)
    return x[stay], y[stay]


def signer(bands: int, rows: int, size: int):
    rng = np.random.default_rng(20240229)
    factor = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32) | np.uint32(1)
    shift = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()
        for batch in batches:
            counts, high, low, signs = [], [], [], []
            for found in hashing.shingle_sets(batch.column("text"), size):
                least = np.full(bands * rows, (1 << 32) - 1, np.uint32)
                small = (found >> np.uint64(32)).astype(np.uint32)
                for at in range(0, len(small), 1024):
                    hashed = small[at:at + 1024, None] * factor
                    hashed += shift
                    hashed ^= hashed >> np.uint32(15)
                    np.minimum(least, hashed.min(0), out=least)
                counts.append(len(found))
                high.append(int(hashing.mix(found).sum(dtype=np.uint64).astype(np.int64)))
                low.append(int(np.bitwise_xor.reduce(hashing.mix(found ^ np.uint64(0x5555555555555555)))
                               .astype(np.int64)) if len(found) else 0)
                signs.append(least.astype(np.uint16).tobytes() if len(found) else None)
            yield pa.record_batch([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(high, pa.int64()),
                                   pa.array(low, pa.int64()), pa.array(signs, pa.binary())],
                                  ["doc_id", "n_shingles", "digest_a", "digest_b", "signature"])
    return run


def signatures(docs: DataFrame, bands: int, rows: int = ROWS, size: int = hashing.WORDS) -> DataFrame:
    """doc_id, n_shingles, digest_a, digest_b, signature; without words 0 and null."""
    return docs.select("doc_id", "text").mapInArrow(
        signer(bands, rows, size),
        "doc_id long, n_shingles long, digest_a long, digest_b long, signature binary")


def matrix(column: pa.Array) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.uint16).reshape(len(column), -1)


def pruner(steps):
    def run(batches):
        for batch in batches:
            stay = likely(matrix(batch.column("sign_a")), matrix(batch.column("sign_b")), steps)
            yield pa.record_batch([batch.column(c).take(pa.array(stay)) for c in ("a", "b")], ["a", "b"])
    return run


def block_pruner(steps, threshold: tuple[int, int], rows: int):
    """Likely pairs across components, each from the first band that its two share, and none too unlike in size."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                x, y = row["x"], row["y"]
                ids = [np.array([m["id"] for m in side]) for side in (x, y)]
                of = [np.array([m["component"] for m in side]) for side in (x, y)]
                signs = [np.frombuffer(b"".join(m["signature"] for m in side), np.uint16).reshape(len(side), -1)
                         for side in (x, y)]
                apart = of[0][:, None] != of[1][None, :]
                if row["same"]:
                    apart &= ids[0][:, None] < ids[1][None, :]
                sizes = [np.array([m["n_shingles"] for m in side]) for side in (x, y)]
                low, high = np.minimum.outer(*sizes), np.maximum.outer(*sizes)
                apart &= threshold[1] * low >= threshold[0] * high
                i, j = likely_between(signs[0], signs[1], apart, steps)
                shared = (signs[0][i] == signs[1][j]).reshape(len(i), signs[0].shape[1] // rows, rows).all(2)
                first = shared.argmax(1) == row["band"]
                i, j = i[first], j[first]
                a, b = ids[0][i], ids[1][j]
                yield pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])
    return run


def verifier(threshold: tuple[int, int], size: int):
    """Pairs whose full shingle sets reach the threshold; a set is kept while it repeats from row to row."""
    def run(batches):
        for batch in batches:
            sets: dict = {}
            keep = []
            sides = []
            for c in ("a", "b"):
                ids = batch.column(c).to_pylist()
                texts = batch.column(f"text_{c}")
                first = {}
                for place, key in enumerate(ids):
                    first.setdefault(key, place)
                missing = [k for k in first if k not in sets]
                if missing:
                    picked = texts.take(pa.array([first[k] for k in missing]))
                    sets.update(zip(missing, hashing.shingle_sets(picked, size)))
                sides.append(ids)
            for a, b in zip(*sides):
                shared, union = hashing.jaccard_parts(sets[a], sets[b])
                keep.append(union > 0 and threshold[1] * shared >= threshold[0] * union)
            kept = pa.array(keep, pa.bool_())
            yield pa.record_batch([batch.column("a").filter(kept), batch.column("b").filter(kept)], ["a", "b"])
    return run


def near_duplicates(docs: DataFrame, threshold: tuple[int, int] = THRESHOLD, bands: int | None = None, rows: int = ROWS,
                    size: int = hashing.WORDS, batch: int = BATCH, miss: float = MISS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of ``docs`` (doc_id integer, text).

    Two documents are linked if their sets of ``size``-word shingles have a Jaccard
    similarity of at least ``threshold`` (as a fraction). A text with fewer words is
    one shingle. component_id is the smallest doc_id reachable by links, kept marks
    the document that bears it. Null, empty and blank texts have 0 shingles and are
    linked with nothing. Rows that repeat a doc_id are one document and each returned;
    a row without doc_id has a null component_id, is kept, and links nothing. Other
    columns of ``docs`` are ignored. Without rows, no rows.
    """
    ship(docs.sparkSession)
    docs = own_columns(docs, doc_id=F.col("doc_id").cast("long"), text="text")
    bands = bands or bands_for(threshold[0] / threshold[1], rows)
    steps = fewest_matches(threshold[0] / threshold[1], bands * rows, batch, miss)
    signed = stored(signatures(docs, bands, rows, size), "signatures")
    classes = stored(signed.where("n_shingles > 0 and doc_id is not null").groupBy("digest_a", "digest_b").agg(
        F.min("doc_id").alias("id")), "classes")
    heads = signed.where("n_shingles > 0").join(
        classes, (F.col("doc_id") == F.col("id"))
        & (signed.digest_a == classes.digest_a) & (signed.digest_b == classes.digest_b), "left_semi")
    keys = F.array(*[F.xxhash64(F.lit(i), F.substring("signature", 2 * rows * i + 1, 2 * rows)) for i in range(bands)])
    banded = heads.select(F.col("doc_id").alias("id"), F.posexplode(keys).alias("band", "bucket"))
    buckets = stored(banded.groupBy("bucket").agg(
        F.min("id").alias("hub"), F.max("id").alias("last"), F.count("*").alias("members")).where("hub < last"), "buckets")
    members = stored(banded.join(buckets.drop("last"), "bucket"), "members")

    candidates = stored(members.select(F.col("id")).distinct(), "candidates")
    told = stored(heads.join(candidates, F.col("doc_id") == F.col("id"), "left_semi").select(
        F.col("doc_id").alias("id"), "n_shingles", "signature"), "candidate-signatures")
    texts = stored(docs.join(candidates, F.col("doc_id") == F.col("id"), "left_semi").select(
        F.col("doc_id").alias("id"), "text"), "candidate-texts")

    def verified(pairs: DataFrame, purpose: str) -> DataFrame:
        for c in ("a", "b"):
            pairs = pairs.join(texts.select(F.col("id").alias(c), F.col("text").alias(f"text_{c}")), c)
        return stored(pairs.select("a", "b", "text_a", "text_b").mapInArrow(
            verifier(threshold, size), "a long, b long").distinct(), purpose)

    to_hub = members.where("id != hub").select(F.col("id").alias("b"), F.col("hub").alias("a"))
    pairs = to_hub.distinct()
    for c in ("a", "b"):
        pairs = pairs.join(told.select(F.col("id").alias(c), F.col("signature").alias(f"sign_{c}")), c)
    links = verified(pairs.select("a", "b", "sign_a", "sign_b").mapInArrow(pruner(steps), "a long, b long"), "hub-links")

    named = components(links)
    told = told.join(named, "id", "left").withColumn("component", F.coalesce("component", "id"))
    placed = stored(members.join(told.select("id", "component"), "id"), "placed")
    open_buckets = placed.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("bucket")
    blocks = placed.join(open_buckets, "bucket").withColumn(
        "block", F.pmod(F.xxhash64("id"), F.ceil(F.col("members") / BLOCK))).select("bucket", "band", "block", "id", "component")
    blocks = blocks.join(told.select("id", "n_shingles", "signature"), "id").groupBy("bucket", "band", "block").agg(
        F.collect_list(F.struct("id", "component", "n_shingles", "signature")).alias("rows"))
    blocks = stored(blocks, "blocks")
    x = blocks.select("bucket", "band", F.col("block").alias("block_x"), F.col("rows").alias("x"))
    y = blocks.select("bucket", F.col("block").alias("block_y"), F.col("rows").alias("y"))
    met = x.join(y, "bucket").where("block_x <= block_y").select(
        "x", "y", "band", (F.col("block_x") == F.col("block_y")).alias("same"))
    survivors = met.mapInArrow(block_pruner(steps, threshold, rows), "a long, b long").distinct()
    named = components(links.union(verified(survivors, "block-links")))

    found = classes.join(named, "id", "left").select(
        "digest_a", "digest_b", F.coalesce("component", "id").alias("component"))
    whole = signed.join(found, ["digest_a", "digest_b"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id")))
    return whole.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
