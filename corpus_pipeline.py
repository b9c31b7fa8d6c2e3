"""From raw documents to token blocks: five stages, each by one operator of ``millrace.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read back as the next one's documents. The last returns what was read back from the
token blocks; the others return the columns of the documents they kept.

What the stages do with odd rows: null and empty texts fail the quality rules; a null
doc_id never has a duplicate; a document is dropped for a benchmark item whatever its
source; the mix repeats whole rows; repeated rows are encoded as documents of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import minhash, mixing, quality_rules, repair, tiling
from millrace.llm.catalogue import table, tokenizer_file
from millrace.llm.shipping import shipped
from millrace.session import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what passes the base rules and the n-gram classifier."""
    model = quality_rules.train(docs, table(spark, sf_dir, "labels"))
    return quality_rules.passing(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group alike in 80 % of its 5-word shingles."""
    shipped(spark)
    return minhash.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that have a benchmark item."""
    return tiling.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents until each source nears its target."""
    shipped(spark)
    return mixing.mixed(docs)


def token_blocks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode, compress, write, and read back."""
    shipped(spark)
    return repair.digests(spark, repair.written(docs, tokenizer_file("byte_bpe_50k.json")))


STAGES = [
    ("quality_rules", quality),
    ("minhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("mix_sources", mix),
    ("token_blocks", token_blocks),
]

# A learnt classifier, MinHash and a grammar are not expressions of SQL; tests/llm compares
# the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
