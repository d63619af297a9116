"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Everything is DataFrame code. A first scan keeps two numbers a row, the length of the normalised text and a hash of
its prefix, and counts them with map-side sums. Lengths, then (length, prefix) pairs, that only one row has are
settled. What survives is turned into a bitmap of fixed size, so that the second scan hashes the whole text of
surviving rows only, and only those rows are shuffled afterwards, as a few numbers and a hash each. A bit that two
pairs share costs one needless hash and cannot change the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Bitmap, key_bitmap, may_hold, stash, tidy

#: Code points of the normalised text that the second step hashes.
PREFIX = 128


def normalised(text: Column) -> Column:
    """The text without the characters ``[\\x20\\x09-\\x0D]``; null counts as empty. Plain replacements scan bytes, which
    is much faster than a regular expression."""
    out = F.coalesce(text, F.lit(""))
    for white in " \t\n\x0b\x0c\r":
        out = F.replace(out, F.lit(white), F.lit(""))
    return out


def _survivors(keys: DataFrame) -> Bitmap:
    """Bitmap of the (length, prefix hash) pairs of more than one row."""
    lengths = keys.groupBy("norm_len").agg(F.sum("n").alias("rows")).where("rows > 1").select("norm_len")
    return key_bitmap(keys.where("n > 1").join(lengths, "norm_len", "left_semi"), "norm_len", "prefix_hash")


@tidy
def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", digest: bool = False, prefix: int = PREFIX) -> DataFrame:
    """One row per input row: ``key, th, row_id, n_points, norm_len, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are identical without white space (``[\\x20\\x09-\\x0D]``). Of equal texts the row with the
    most code points stays, then the one with the smallest key (null last); of rows that are the same in both, one.
    ``text_sha256`` is null for rows that the first steps settled, unless ``digest`` asks for it everywhere.
    Null text counts as empty, all empty texts are equal. An empty table gives no rows. Other columns are not read,
    whatever their names.
    """
    texts = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    norm = normalised(F.col("_text"))
    texts = texts.select("_key", F.xxhash64("_text").alias("th"), F.char_length(F.coalesce("_text", F.lit(""))).cast("long").alias("n_points"), norm.alias("_norm"))
    texts = texts.withColumn("norm_len", F.octet_length("_norm").cast("long")).withColumn("prefix_hash", F.xxhash64(F.substring("_norm", 1, prefix)))
    keys = stash(texts.groupBy("norm_len", "prefix_hash").agg(F.count("*").alias("n")), "exact-keys")
    alive = may_hold(_survivors(keys), "norm_len", "prefix_hash")
    full = F.sha2(F.col("_norm").cast("binary"), 256)
    rows = texts.select(
        "_key", "th", F.monotonically_increasing_id().alias("row_id"), "n_points", "norm_len", "prefix_hash", alive.alias("alive"),
        (full if digest else F.when(alive, full)).alias("text_sha256"),
    )
    rows = stash(rows, "exact-rows")
    best = F.min(F.struct((-F.col("n_points")).alias("p"), F.col("_key").isNull().alias("z"), F.col("_key").alias("k"), F.col("row_id").alias("r")))
    groups = rows.where("alive").groupBy("norm_len", "prefix_hash", "text_sha256").agg(F.count("*").alias("group_size"), best.alias("best")).where("group_size > 1")
    groups = stash(groups.select("norm_len", "prefix_hash", "text_sha256", "group_size", F.col("best.k").alias("keep_id"), F.col("best.r").alias("keep_row")), "exact-groups")
    joined = rows.where("alive").join(groups, ["norm_len", "prefix_hash", "text_sha256"], "left")
    settled = rows.where("not alive").withColumns({"group_size": F.lit(None).cast("long"), "keep_id": F.lit(None).cast(rows.schema["_key"].dataType), "keep_row": F.lit(None).cast("long")})
    both = joined.unionByName(settled)
    alone = F.col("keep_row").isNull()
    return both.select(
        F.col("_key").alias(key), "th", "row_id", "n_points", "norm_len",
        F.when(alone, F.col("_key")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("keep_row") == F.col("row_id"))).alias("kept"), "text_sha256",
    )
