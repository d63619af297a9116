"""The corpus pipeline: language ID, exact dedup, SimHash near-dedup, benchmark decontamination, best-fit packing.

Each stage takes (spark, docs, sf_dir); run() writes what it returns as Parquet in the shared folder and reads it again
for the next. All but the last stage return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import decontaminate, exact_dedup, language_id, near_copies, packing
from quire.llm.common import keep_rows, stash
from quire.llm.queries import held_out, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or of which no language has 0.3 of the letters, go."""
    return language_id.keep_identified(docs, language_id.fit(docs.where(~held_out())))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal without white space one stays."""
    found = exact_dedup.exact_dedup(docs)
    return keep_rows(docs, found.select(F.col("doc_id").alias("key"), "th", "kept"), "doc_id", "text")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that near copies link (SimHash, bands of minima, five words, 0.8 or more) the one with the smallest doc_id stays."""
    return keep_rows(docs, near_copies.near_copies(docs).select("key", "th", "kept"), "doc_id", "text")


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with a benchmark item go."""
    marked = docs.select(F.col("doc_id"), "text", F.xxhash64("text").alias("th"))
    found = decontaminate.overlaps(marked.select(F.struct("doc_id", "th").alias("row"), "text"), table(spark, sf_dir, "benchmark"), key="row")
    return keep_rows(docs, found.select(F.col("key.doc_id").alias("key"), F.col("key.th").alias("th"), F.lit(False).alias("kept")), "doc_id", "text")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 8192 bytes, without two documents of a source or of a cluster of duplicates in one."""
    return packing.pack(docs, F.octet_length("text"), F.col("source"), packing.cluster_of(F.col("text"))).withColumnRenamed("key", "doc_id")


STAGES = [("language_id", language), ("exact_dedup", exact), ("simhash_near_dedup", near), ("decontamination", benchmark), ("best_fit_packing", packed)]

#: SQL can't express the language model, SimHash and packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
