"""Token counts of documents, map-side, through two tiers of piece lengths."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlab.llm import tokens
from shiftlab.llm.common import own_columns, ship

LIMIT = 4096
#: Entries of the broadcast tier, those that each task proposes, and the pieces a task counts at once.
FREQUENT, PROPOSED, COUNTED = 20_000, 4_000, 200_000


def tally(proposed: int, counted: int):
    """(piece, n) of the most frequent pieces of a task's texts.

    Where a task meets more pieces than it may count, the rarer half is forgotten.
    """
    def run(batches):
        seen: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                if text:
                    seen.update(text.split(" "))
                    if len(seen) > counted:
                        seen = Counter(dict(seen.most_common(counted // 2)))
        kept = [(p, n) for p, n in seen.most_common(2 * proposed) if 0 < len(p) <= tokens.LONGEST and "▁" not in p][:proposed]
        yield pa.record_batch([pa.array([p for p, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["piece", "n"])
    return run


def frequent_pieces(docs: DataFrame, pieces: int = FREQUENT, proposed: int = PROPOSED, counted: int = COUNTED) -> DataFrame:
    """(piece, n) of the most frequent pieces of the whole table, from what every task proposes.

    Texts stay where they are read: a task sends on a few thousand counts at most.
    """
    found = docs.select("text").mapInArrow(tally(proposed, counted), "piece string, n long")
    return found.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(pieces)


def frequent_lengths(docs: DataFrame, path: str) -> dict[str, int]:
    """Lengths of the most frequent pieces; they decide how much work is saved and never what is counted."""
    import sentencepiece
    found = [r.piece for r in frequent_pieces(docs).collect()]
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return dict(zip(found, tokens.piece_lengths(model, found)))


def counter(path: str, frequent):
    def run(batches):
        count = tokens.piece_counter(path, frequent.value).count
        for batch in batches:
            texts = batch.column("text").to_pylist()
            counts = [n for a, b in tokens.portions(texts) for n in count(texts[a:b])]
            yield pa.record_batch([batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                                  ["doc_id", "n_bytes", "n_tokens"])
    return run


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row for each row of ``docs`` (doc_id, text).

    n_tokens is the number of ids that the tokenizer in ``path`` (.model:
    sentencepiece, .json: tokenizers) gives the whole text, without ids for its
    beginning and end; over_limit tells if there are more than ``limit``. A null
    text is empty; an empty text has 0 ids. Rows are independent: doc_id may be null
    or repeat. Other columns are ignored. No text is shuffled: the most frequent
    pieces of the whole table, counted by every task over its own texts, travel as
    a broadcast table of at most ``FREQUENT`` entries, all others are encoded once per
    worker and kept there.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = own_columns(docs, doc_id="doc_id", text="text")
    frequent = {} if path.endswith(".json") else frequent_lengths(docs, path)
    kind = dict(docs.dtypes)["doc_id"]
    counted = docs.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")).mapInArrow(
        counter(path, spark.sparkContext.broadcast(frequent)), f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
