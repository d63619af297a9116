"""Stages of jobs: an append-only table of what was done, and whether it must be done again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD = "book_id string, stage string, state string, at string, cache_key string, output_sha256 string, message string"
STATES = ("pending", "running", "complete", "failed")
#: Version of what a cache key is made of; a new one makes all results stale.
KEY_VERSION = 1


def utc_stamp(at: Column) -> Column:
    return F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), at.cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def record(rows: DataFrame, folder: str) -> None:
    """Appends records; columns that are missing are null, a state that isn't known fails the write."""
    names = [c.split()[0] for c in RECORD.split(", ")]
    known = F.when(F.col("state").isin(*STATES), F.col("state")).otherwise(F.raise_error(F.concat(F.lit("unknown state "), F.coalesce("state", F.lit("null")))))
    rows = rows.withColumn("state", known)
    rows.select(*[F.col(c).cast("string") if c in rows.columns else F.lit(None).cast("string").alias(c) for c in names]).write.mode("append").json(folder)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """All records; lines that can't be read are left out."""
    return spark.read.schema(RECORD).option("mode", "DROPMALFORMED").json(folder).where("book_id is not null and stage is not null")


def latest(records: DataFrame) -> DataFrame:
    """The last record of each stage of each book; of several at one time the one whose state comes last."""
    rank = F.array_position(F.array(*[F.lit(s) for s in STATES]), F.col("state"))
    return records.groupBy("book_id", "stage").agg(F.max_by(F.struct("state", "at", "cache_key", "output_sha256", "message"), F.struct("at", rank.alias("rank"))).alias("r")).select("book_id", "stage", "r.*")


def cache_keys(pages: DataFrame, settings: dict[str, str], version: int = KEY_VERSION) -> DataFrame:
    """``book_id, cache_key``: changes with any page's content, name or place, any setting, and the version.

    Of ``pages(book_id, page_index, name, sha256)``. Pages are hashed in blocks of 1000, then the blocks, so that a book of
    any length is never one string.
    """
    one = F.to_json(F.struct("name", "page_index", "sha256"))
    blocks = pages.groupBy("book_id", (F.col("page_index") / 1000).cast("long").alias("b")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.struct(F.col("page_index").alias("i"), one.alias("x")))).getField("x"), "\n"), 256).alias("h"))
    fixed = ",".join(f"{k}={v}" for k, v in sorted(settings.items()))
    return blocks.groupBy("book_id").agg(F.sha2(F.concat(F.lit(f"{version};{fixed};"), F.array_join(F.array_sort(F.collect_list(F.struct("b", "h"))).getField("h"), ",")), 256).alias("cache_key"))


def cache_hits(keys: DataFrame, records: DataFrame, stage: str, outputs: DataFrame | None = None, missing: DataFrame | None = None) -> DataFrame:
    """``book_id`` of ``keys(book_id, cache_key)`` whose last record of the stage is complete with the same key, whose output
    (``outputs(book_id, sha256)``) is what the record says, and which miss no image (``missing(book_id)``)."""
    done = latest(records).where((F.col("stage") == stage) & (F.col("state") == "complete"))
    hits = keys.join(done, ["book_id", "cache_key"]).select("book_id", "output_sha256")
    if outputs is not None:
        hits = hits.join(outputs.select("book_id", F.col("sha256").alias("output_sha256")), ["book_id", "output_sha256"], "left_semi")
    if missing is not None:
        hits = hits.join(missing, "book_id", "left_anti")
    return hits.select("book_id")
