"""Queries of this folder's operators over whole tables, and their SQL where it exists."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    hilbert, kneser_ney, language, merkle, minhash, mixing, quality_rules, repair, repeats, rule_ensemble, secrets, tiling, trie,
)
from millrace.llm.oracles import ORACLES  # noqa: F401  (part of this module's contract)
from millrace.llm.shipping import shipped

def tokenizer_file(name: str) -> str:
    """A public tokenizer's file, which is at the same place on every machine: in the folder
    that ``MILLRACE_TOKENIZERS`` names, or else in the package that brings them."""
    folder = os.environ.get("MILLRACE_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return shipped(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kneser-Ney scores of all documents, trained on nine folds of ten."""
    return kneser_ney.held_out_scores(table(spark, sf_dir, "documents"))


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents, by the trigram index."""
    return secrets.digests(table(spark, sf_dir, "documents"))


@query
def op3_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that have benchmark items, by tile coverage."""
    found = tiling.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("n_tiles", F.size("tiles")).drop("tiles")


@query
def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents alike in 85 % of their 3-word shingles."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), minhash.Likeness(3, 85))


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learnt from two folds of three."""
    return language.identified(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


@query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the sparse rule ensemble for all documents."""
    return rule_ensemble.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and the n-gram classifier's verdict for all documents."""
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judged(docs, quality_rules.train(docs, table(spark, sf_dir, "labels"))).drop("probability")


@query
def op7_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents along the Hilbert curve over language, source and size, in 16 shards."""
    rows = hilbert.placed(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    rows = mixing.copies(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query
def op9_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids as Re-Pair blocks, written, read back and decoded."""
    docs = table(spark, sf_dir, "documents")
    return repair.digests(spark, repair.written(docs, tokenizer_file("byte_bpe_50k.json")))


@query
def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the runs of 35 words that occur again anywhere."""
    rows = repeats.without_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all conversations, rebuilt with shared starts."""
    return trie.shared_starts(table(spark, sf_dir, "conversations"))


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves, roots and proofs of all documents, some of them tampered with."""
    return merkle.audited(table(spark, sf_dir, "documents"))
