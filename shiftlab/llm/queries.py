"""One query per operator, over its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftlab.llm import (
    ball_trees, conversations, language_id, licences, mixing, near_dedup, neighbours, packing, passages, resampling, simhash, token_counts,
    token_files, tokens)
from shiftlab.llm.common import documents, shared_folder, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of near duplicates of every document."""
    return near_dedup.near_duplicates(documents(spark, sf_dir))


@query
def op3_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in sequences of 1024 tokens."""
    return packing.packed(documents(spark, sf_dir), tokens.tokenizer_path("byte_bpe_50k.json"), end=0)


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every document in bytes and tokens."""
    return token_counts.token_counts(documents(spark, sf_dir), tokens.tokenizer_path("piece_bpe_32k.model"))


@query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written to bit-packed files and read back."""
    folder = f"{shared_folder(spark)}/llm-token-files-{uuid.uuid4().hex}"
    token_files.write(documents(spark, sf_dir), folder, tokens.tokenizer_path("word_bpe_49k.json"), end=1)
    return token_files.read(spark, folder)


@query
def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mixture takes."""
    taken, _ = mixing.mixed(documents(spark, sf_dir))
    return taken.select("doc_id", "size", "source_size", "target", "taken")


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from two thirds of them."""
    docs = documents(spark, sf_dir)
    model = language_id.train(docs.where(~language_id.held_out("doc_id")))
    return language_id.identified(docs, model).drop("spans")


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return simhash.fingerprinted(documents(spark, sf_dir))


@query
def simhash_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints within the radius of those of every document whose id is divisible by 20, with their smallest document."""
    found = stored(simhash.fingerprinted(documents(spark, sf_dir)).select("doc_id", "fingerprint"), "searched")
    near = simhash.within_radius(found.where("doc_id % 20 = 0"), found)
    smallest = found.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n_documents"))
    return near.join(smallest, "fingerprint")


@query
def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every twentieth embedding."""
    return neighbours.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that an earlier document has too."""
    return passages.repeated_passages(documents(spark, sf_dir))


@query
def op6_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence that every document shows, or takes from a folder above it."""
    return licences.scanned(licences.laid_out(documents(spark, sf_dir)))


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation, and the cheapest edits that repair it."""
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conversations.repaired(conversations.damaged(table), table.select("conv_id"))


@query
def op12_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest scores of every fiftieth embedding, exactly."""
    return ball_trees.largest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight of every document towards the benchmark, and which are drawn."""
    return resampling.resampled(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
