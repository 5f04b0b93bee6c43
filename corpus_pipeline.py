"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, BPE.

Every stage takes (spark, docs, sf_dir) and works on all its predecessor kept;
its result is written as Parquet in the shared folder and reread as the next
stage's docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricepanel.llm import bpe, decontaminate, line_dedup, quality, superminhash
from pricepanel.llm.queries import table, vocabulary
from pricepanel.llm.tables import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality.keep_documents(docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go from the texts; ``n_chars`` follows."""
    return line_dedup.drop_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays (five-word shingles, similarity 0.8 or more)."""
    return superminhash.remove_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document left, with digests of ids and decoded text."""
    return bpe.encoded(docs, vocabulary())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_deduplication),
    ("near_dedup", near_duplicates),
    ("decontamination", benchmark_decontamination),
    ("bpe", bpe_encoding),
]

#: BPE ids and components of near duplicates have no SQL form; tests/llm compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
