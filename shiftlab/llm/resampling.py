"""Importance resampling towards a target distribution over hashed word n-grams.

A text is collapsed to words with single spaces between them. One regular expression,
searched with overlaps and bounded by lookarounds, starts a match at every word and
spans the run of up to three words there; the spans of its groups are the
n-grams that begin with the word, and a CRC is carried from one to the next. Each
document keeps its buckets, two bytes per n-gram, so that texts are scanned once for counts and
weights alike.

A bucket's gain is the logarithm of its smoothed share in the target over that in the
documents; a document weighs the sum of its gains. Gumbel noise told from the id makes
the highest scores a sample without replacement in proportion to the weights.
"""

from __future__ import annotations

import math
import zlib
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlab.llm.common import own_columns, running_total, ship, stored

BUCKETS = 10_000
SEED = 42
LEAST_WORDS = 20
#: Percent of the long enough documents that are drawn.
SHARE = 5
#: Bytes of texts whose buckets go out together.
PART = 1 << 22

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Bytes that are in no word; all bytes of a character beyond ASCII are.
_BETWEEN = regex.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_RUN = regex.compile(rb"(?<= )([^ ]+)( [^ ]+)?( [^ ]+)?(?= )")


def ngram_buckets(text: str | None, buckets: int = BUCKETS) -> tuple[int, array]:
    """(words, the bucket of every run of one to three words)."""
    plain = _BETWEEN.sub(b" ", b" %b " % (text or "").encode().translate(_LOWER))
    found, words, crc = array("H"), 0, zlib.crc32
    put = found.append
    for match in _RUN.finditer(plain, overlapped=True):
        one, two, three = match.groups()
        words += 1
        value = crc(one)
        put(value % buckets)
        if two is not None:
            value = crc(two, value)
            put(value % buckets)
            if three is not None:
                put(crc(three, value) % buckets)
    return words, found


def scanner(buckets: int, named: bool = True):
    """n_words, n_features, buckets of every text; ``named`` keeps doc_id."""
    names = [*(["doc_id"] if named else []), "n_words", "n_features", "buckets"]

    def out(ids, rows):
        columns = [pa.array([w for w, _ in rows], pa.int64()), pa.array([len(b) for _, b in rows], pa.int64()),
                   pa.array([b.tobytes() for _, b in rows], pa.binary())]
        return pa.record_batch([*([ids] if named else []), *columns], names)

    def run(batches):
        for batch in batches:
            texts, first, size, rows = batch.column("text"), 0, 0, []
            for i in range(batch.num_rows):
                rows.append(ngram_buckets(texts[i].as_py(), buckets))
                size += 2 * len(rows[-1][1])
                if size > PART:
                    yield out(batch.column("doc_id").slice(first, i + 1 - first) if named else None, rows)
                    first, size, rows = i + 1, 0, []
            if rows:
                yield out(batch.column("doc_id").slice(first) if named else None, rows)
    return run


def counter(buckets: int):
    """(bucket, n) of all texts of a task: a row per bucket at most."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for cell in batch.column("buckets"):
                total += np.bincount(np.frombuffer(cell.as_buffer(), "<u2"), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], ["bucket", "n"])
    return run


def weigher(gains):
    """The sum of gains of every text."""
    def run(batches):
        for batch in batches:
            cells = batch.column("buckets")
            weights = [int(gains.value[np.frombuffer(c.as_buffer(), "<u2")].sum()) for c in cells]
            at = batch.schema.get_field_index("buckets")
            yield batch.set_column(at, "weight", pa.array(weights, pa.int64()))
    return run


def counts(scanned: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs; a fixed number of sums reaches the driver."""
    found = scanned.select("buckets").mapInArrow(counter(buckets), "bucket int, n long")
    total = np.zeros(buckets, np.int64)
    for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[row.bucket] = row.n
    return total


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the ratio of smoothed shares, per bucket."""
    n, s, t = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((b + 1.0) * (s + n) / ((a + 1.0) * (t + n))))
                     for a, b in zip(source.tolist(), target.tolist())], np.int64)


def noise(doc_id, seed: int = SEED):
    """floor(1000 times a Gumbel number) told from the id; a null id reads as an empty text."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resampled(docs: DataFrame, target: DataFrame, share: int = SHARE, least: int = LEAST_WORDS, buckets: int = BUCKETS,
              seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank: one row per row of ``docs`` (doc_id, text).

    ``target`` has text. Words are runs of ASCII digits, letters (A-Z lower-cased) and
    characters beyond ASCII; a null or empty text has none and weighs 0. Features
    are all runs of one to three words, repeats counted. The ``share`` percent of
    the documents with ``least`` words or more, rounded down, with the highest
    scores are drawn and ranked from 1; ties go to the smaller doc_id, a null one
    first, then to fewer features. Rows that repeat a doc_id are documents of their own.
    Other columns are ignored. Without documents, no rows; without target texts
    the gains tell documents of rare n-grams.
    """
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets are numbered in two bytes")
    spark = docs.sparkSession
    ship(spark)
    scanned = stored(own_columns(docs, doc_id=F.col("doc_id").cast("long"), text="text").mapInArrow(
        scanner(buckets), "doc_id long, n_words long, n_features long, buckets binary"), "ngram-buckets")
    wanted = stored(own_columns(target, text="text").mapInArrow(
        scanner(buckets, named=False), "n_words long, n_features long, buckets binary"), "target-buckets")
    gains = spark.sparkContext.broadcast(gains_of(counts(scanned, buckets), counts(wanted, buckets)))
    weighed = scanned.mapInArrow(weigher(gains), "doc_id long, n_words long, n_features long, weight long")
    weighed = stored(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "weights")

    enough = F.col("n_words") >= least
    drawn = weighed.where(enough).count() * share // 100
    ordered = weighed.where(enough).withColumns({"all": F.lit(0), "one": F.lit(1), "low": -F.col("score")})
    ordered = running_total(ordered, "all", ["low", "doc_id", "n_features"], "one", "before")
    place = F.col("before") + 1
    ranked = ordered.withColumn("rank", F.when(place <= drawn, place).cast("long"))
    rest = weighed.where(~enough).withColumn("rank", F.lit(None).cast("long"))
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    return ranked.select(*columns).unionByName(rest.select(*columns))
