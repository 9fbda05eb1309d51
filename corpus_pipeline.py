"""The corpus pipeline: five operators, each over all that its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it as Parquet in the
shared folder and rereads it as the next stage's documents. All stages but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import decontam, lines, quality, simhash
from panelspark.llm.common import table
from panelspark.llm.queries import packed
from panelspark.sources.sinks import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or lie outside an adaptive fence go."""
    return quality.kept_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go; a document that loses all its lines goes with them."""
    names = [F.col(f"`{c}`") for c in docs.columns]
    left = lines.drop_recurring(docs).where("n_dropped = 0 OR n_dropped < n_lines")
    if "n_chars" in docs.columns:
        changed = "CASE WHEN n_dropped > 0 THEN CAST(length(text) AS BIGINT) ELSE n_chars END"
        left = left.withColumn("n_chars", F.expr(changed))
    return left.select(*names)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.one_per_component(docs, shingle=3, max_bits=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with at least 5 % of their words in benchmark windows go."""
    found = decontam.find(docs, table(spark, sf_dir, "benchmark"))
    return decontam.remove_documents(found).select(*[F.col(f"`{c}`") for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as pieces of token sequences."""
    return packed(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# SimHash components and token ids have no SQL form; a test compares run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
