"""Operators over the order of blocks: labels, contents, chapters and sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def validate_labels(pages: DataFrame, book: str, index: str, label: str, value: str, kind: str) -> DataFrame:
    """Labels against their neighbours of the same kind: ``checked_label, confidence`` (1.0 consistent, 0.2 not, 0.0 no label)."""
    w = W.partitionBy(book, kind).orderBy(index)

    def bad(step: Column, pages_between: Column) -> Column:
        return F.coalesce((step <= 0) | (step > pages_between + 5), F.lit(False))

    before, at_before, after, at_after = F.lag(value).over(w), F.lag(index).over(w), F.lead(value).over(w), F.lead(index).over(w)
    wrong = bad(F.col(value) - before, F.col(index) - at_before) | bad(after - F.col(value), at_after - F.col(index))
    has = F.col(value).isNotNull()
    return pages.withColumns({"_wrong": wrong}).withColumns({"checked_label": F.when(has & ~F.col("_wrong"), F.col(label)), "confidence": F.when(~has, 0.0).when(F.col("_wrong"), 0.2).otherwise(1.0)}).drop("_wrong")


def contents_parent(entries: DataFrame, book: str, seq: str, level: str) -> DataFrame:
    """``parent_seq``: the nearest earlier entry of a smaller level (levels 1 to 3)."""
    w = W.partitionBy(book).orderBy(seq).rowsBetween(W.unboundedPreceding, -1)
    last = lambda k: F.max(F.when(F.col(level) < k, F.col(seq))).over(w)
    # an entry is the parent only if no smaller level came after it: of level 2 entries those after the last level 1
    return entries.withColumn("parent_seq", F.when(F.col(level) == 2, last(2)).when(F.col(level) == 3, last(3)))


def heading_jumps(headings: DataFrame, book: str, seq: str, level: str) -> DataFrame:
    """``jump``: the level is more than one deeper than the one before (at first 1; null counts as 1)."""
    own = F.coalesce(F.col(level), F.lit(1))
    return headings.withColumn("jump", own - F.lag(own, 1, 1).over(W.partitionBy(book).orderBy(seq)) > 1)


def chapters(blocks: DataFrame, book: str, seq: str, is_h1: Column, is_break: Column) -> DataFrame:
    """``chapter``: 0 before the first level-1 heading; a page break just before such a heading goes with it."""
    w = W.partitionBy(book).orderBy(seq)
    opens = is_h1.cast("int")
    return blocks.withColumns({"_o": opens, "_n": F.coalesce(F.lead(opens).over(w), F.lit(0)), "_b": is_break}).withColumn(
        "chapter", F.sum("_o").over(w) + F.when(F.col("_b") & (F.col("_n") == 1), 1).otherwise(0)
    ).drop("_o", "_n", "_b")


def greedy_parts(sizes: Column, most: int) -> Column:
    """struct(parts, last, sizes): pieces in order are put together until the next would go over ``most``."""
    start = F.struct(F.array().cast("array<bigint>").alias("done"), F.lit(None).cast("bigint").alias("run"))

    def fold(acc: Column, n: Column) -> Column:
        full = acc["run"].isNotNull() & (acc["run"] + n > most)
        return F.struct(F.when(full, F.concat(acc["done"], F.array(acc["run"]))).otherwise(acc["done"]).alias("done"), F.when(full, n.cast("bigint")).otherwise(F.coalesce(acc["run"], F.lit(0)) + n).cast("bigint").alias("run"))

    return F.aggregate(sizes, start, fold, lambda acc: F.when(acc["run"].isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["run"]))))
