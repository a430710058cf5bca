"""From raw documents to packed training sequences, one written table per stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftlab.llm import language_id, mixing, near_dedup, packing, passages, tokens
from shiftlab.llm.common import WORD, documents, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Share of a text's characters that its language must have.
LEAST_SHARE = 0.4


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are mostly in one language stay; a missing ``lang`` is filled in.

    Rejected are texts that are null or without a letter, and those of which no
    language has that share. The model is counted over the labelled documents given.
    """
    model = language_id.train(docs.where(~language_id.held_out("doc_id")))
    found = language_id.identified(docs, model).drop("spans")
    found = stored(found.select("doc_id", "lang_pred", ((F.col("lang_pred") == "und") | (F.col("score") < LEAST_SHARE)).alias("gone")),
                   "languages")
    kept = docs.join(found.where("gone").select("doc_id").distinct(), "doc_id", "left_anti")
    missing = found.where("doc_id is not null").join(
        docs.where("lang is null").select("doc_id").distinct(), "doc_id", "left_semi").groupBy("doc_id").agg(
        F.min("lang_pred").alias("_lang_pred"))
    kept = kept.join(stored(missing, "missing-languages"), "doc_id", "left").withColumn("lang", F.coalesce("lang", "_lang_pred"))
    return kept.select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest doc_id."""
    found = near_dedup.near_duplicates(docs, near_dedup.SIMILAR)
    gone = stored(found.where(~F.col("kept")).select("doc_id").distinct(), "near-duplicates")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages stay in the smallest doc_id that has them; documents of which no word is left go."""
    found = stored(passages.repeated_passages(docs), "repeated")
    changed = passages.without_passages(docs, found).withColumnRenamed("text", "_rest").dropDuplicates(["doc_id"])
    joined = docs.join(stored(changed.withColumn("_cut", F.lit(True)), "cut-texts"), "doc_id", "left")
    size = F.length("_rest").cast(docs.schema["n_chars"].dataType)
    joined = joined.withColumns({"text": F.when(F.col("_cut"), F.col("_rest")).otherwise(F.col("text")),
                                 "n_chars": F.when(F.col("_cut"), size).otherwise(F.col("n_chars"))})
    return joined.where(F.col("_cut").isNull() | F.regexp_like("text", F.lit(WORD))).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it, at most twice; the last of a source may be cut short."""
    taken, _ = mixing.mixed(docs)
    taken = taken.groupBy("doc_id").agg(F.max("size").alias("size"), F.max("taken").alias("taken")).where("taken > 0")
    copy = F.explode(F.sequence(F.lit(0), F.ceil(F.col("taken") / F.col("size")).cast("int") - 1))
    copies = stored(taken.withColumn("copy", copy), "copies").select(
        F.col("doc_id").alias("_doc_id"), F.least("size", F.col("taken") - F.col("copy") * F.col("size")).alias("_words"),
        F.col("size").alias("_size"))
    found = docs.join(copies, F.col("doc_id").eqNullSafe(F.col("_doc_id")))
    whole = found.where("_words = _size").select(docs.columns)
    return whole.unionByName(mixing.shortened(found.where("_words < _size"), "_words").select(docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 1024 tokens that hold every source in proportion."""
    return packing.packed(docs, tokens.tokenizer_path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: Language models, signatures and tokenizers are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
