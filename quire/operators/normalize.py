"""Books in their final order: labels of pages, levels of headings, hints for layout, paragraphs over page ends, page breaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import layout, text
from .adapter import INLINE, plain
from .sequence import validate_labels

#: Width of a page that isn't known.
WIDTH = 1000.0
#: How far the edges of two parts of a paragraph may lie apart, as a share of the page's width.
SHIFT = 0.08
#: Characters that end a paragraph. Fixed value.
TERMINAL = ".!?。！？」』:"
VISUAL = ("figure", "chart", "table")


def page_labels(pages: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """``book_id, page_no, page_idx, width, label, confidence``: the printed number of each page, if it fits those around it.

    ``labels(book_id, ord, text)`` replaces what the pages hold; it is joined by position, whatever the pages' own numbers.
    """
    rows = pages.select("book_id", "page_no", "page_idx", "width", "number_text")
    if labels is not None:
        rows = rows.drop("number_text").join(labels.select("book_id", F.col("ord").alias("page_no"), F.col("text").alias("number_text")), ["book_id", "page_no"], "left")
    parsed = rows.withColumn("l", text.page_label(F.coalesce("number_text", F.lit("")))).select("book_id", "page_no", "page_idx", "width", "l.*").withColumnRenamed("label", "raw")
    checked = validate_labels(parsed, "book_id", "page_no", "raw", "value", "kind")
    return checked.select("book_id", "page_no", "page_idx", "width", F.col("checked_label").alias("label"), "confidence")


def levels(blocks: DataFrame, mode: str = "code") -> DataFrame:
    """Headings without a level get that of their words, if these tell one."""
    return blocks.withColumn("level", F.when(F.col("kind") == "heading", F.coalesce("level", text.heading_level(plain(F.col("inlines")), mode))))


def level_warnings(blocks: DataFrame) -> DataFrame:
    unknown = blocks.where("kind = 'heading' and level is null")
    return unknown.select("book_id", "page_idx", "block_id", F.lit("HEADING_LEVEL_UNKNOWN").alias("code"), plain(F.col("inlines")).alias("message"))


def hints(blocks: DataFrame, labelled: DataFrame) -> DataFrame:
    """``hint`` of visual blocks: how much of the page's width they take, and where they stand."""
    width = labelled.select("book_id", "page_no", F.when(F.col("width") > 0, F.col("width")).alias("_width"))
    box = F.get("sources", F.lit(0))["bbox"]
    hint = layout.layout_hint(box["x0"], box["x1"], F.coalesce("_width", F.lit(WIDTH)))
    return blocks.join(width, ["book_id", "page_no"], "left").withColumn("hint", F.when(F.col("kind").isin(*VISUAL) & box.isNotNull(), hint)).drop("_width")


def _merges(edges: Column) -> Column:
    """For each page, in order, whether its first block goes on with the paragraph that the page before ends with. The box
    of a paragraph over several pages is that of its first part, so this is a fold over a book's pages, of a few numbers each."""
    first = lambda s: F.struct(F.lit(False).alias("paragraph"), F.lit(False).alias("open"), F.lit(False).alias("hyphen"), F.lit(None).cast("double").alias("x0"), F.lit(None).cast("double").alias("x1"))
    start = F.struct(F.array().cast("array<boolean>").alias("merged"), first(None).alias("last"))

    def fold(acc: Column, e: Column) -> Column:
        last = acc["last"]
        near = lambda a, b: F.coalesce(F.abs(a - b) / e["width"] <= SHIFT, F.lit(True))
        merged = (e["n"] > 0) & last["paragraph"] & last["open"] & e["paragraph"] & (e["starts"] | last["hyphen"])
        merged = F.coalesce(merged & ((e["width"] <= 0) | (near(last["x0"], e["x0"]) & near(last["x1"], e["x1"]))), F.lit(False))
        whole = merged & (e["n"] == 1)  # the page is one paragraph, which may go on
        ends = e["end"]
        now = F.struct(ends["paragraph"].alias("paragraph"), ends["open"].alias("open"), ends["hyphen"].alias("hyphen"), F.when(whole, last["x0"]).otherwise(ends["x0"]).alias("x0"), F.when(whole, last["x1"]).otherwise(ends["x1"]).alias("x1"))
        return F.struct(F.concat(acc["merged"], F.array(merged)).alias("merged"), F.when(e["n"] > 0, now).otherwise(first(None)).alias("last"))

    return F.aggregate(edges, start, fold)["merged"]


def merged_pages(blocks: DataFrame, labelled: DataFrame) -> DataFrame:
    """``book_id, page_no, merged``: whether a page's first block goes on with the paragraph before."""
    words = plain(F.filter("inlines", lambda x: x["kind"] == "text"))
    box = F.get("sources", F.lit(0))["bbox"]
    paragraph = (F.col("kind") == "paragraph") & (words != "")
    side = F.struct(
        paragraph.alias("paragraph"), (~F.contains(F.lit(TERMINAL), F.right(words, F.lit(1)))).alias("open"), F.endswith(words, F.lit("-")).alias("hyphen"),
        words.rlike("^[a-z,、，]").alias("starts"), box["x0"].alias("x0"), box["x1"].alias("x1"),
    )
    sides = blocks.select("book_id", "page_no", "place", side.alias("s")).groupBy("book_id", "page_no").agg(F.min_by("s", "place").alias("a"), F.max_by("s", "place").alias("z"), F.count("*").alias("n"))
    rows = labelled.select("book_id", "page_no", "width").join(sides, ["book_id", "page_no"], "left")
    edge = F.struct("page_no", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("width", F.lit(0.0)).alias("width"), F.col("a.paragraph").alias("paragraph"), F.col("a.starts").alias("starts"), F.col("a.x0").alias("x0"), F.col("a.x1").alias("x1"), F.col("z").alias("end"))
    found = rows.groupBy("book_id").agg(F.array_sort(F.collect_list(edge)).alias("edges"))  # a few numbers for each page of a book
    return found.select("book_id", F.explode(F.arrays_zip(F.transform("edges", lambda e: e["page_no"]).alias("page_no"), _merges(F.col("edges")).alias("merged"))).alias("m")).select("book_id", "m.*")


def normalize(blocks: DataFrame, labelled: DataFrame, mode: str = "code") -> DataFrame:
    """The blocks of books in order (``seq`` from 0), with page breaks and with paragraphs joined over page ends.

    A page begins with a page break, unless its first block goes on with a paragraph: then the paragraph's inlines hold a
    page boundary. Empty pages have a break, too. ``label`` of breaks and boundaries is the printed one, or ``scan-`` and
    the number of the page.
    """
    found = hints(levels(blocks, mode), labelled)
    merged = merged_pages(found, labelled)
    shown = text.scan_label(F.col("label"), F.col("page_idx"))
    pages = labelled.select("book_id", "page_no", "page_idx", shown.alias("label"), (F.col("confidence") >= 0.8).alias("sure")).join(merged, ["book_id", "page_no"], "left")
    breaks = pages.where("not coalesce(merged, false)").select("book_id", "page_no", "page_idx", F.lit(-1).alias("place"), F.lit("page_break").alias("kind"), "label", F.concat(F.lit("brk-"), F.format_string("%05d", F.col("page_no") + 1)).alias("block_id"))
    going_on = pages.where("merged").select("book_id", "page_no", F.col("label").alias("_label"))
    first = F.row_number().over(W.partitionBy("book_id", "page_no").orderBy("place")) == 1
    rows = found.withColumn("_first", first).join(going_on, ["book_id", "page_no"], "left").withColumn("_goes_on", F.col("_first") & F.col("_label").isNotNull())
    boundary = F.struct(F.lit("page_boundary").alias("kind"), F.col("_label").alias("text"), F.lit(None).cast("string").alias("latex")).cast(INLINE)
    rows = rows.withColumn("inlines", F.when(F.col("_goes_on"), F.concat(F.array(boundary), "inlines")).otherwise(F.col("inlines")))
    rows = rows.drop("_first", "_label").unionByName(breaks.withColumn("_goes_on", F.lit(False)), allowMissingColumns=True)
    order = W.partitionBy("book_id").orderBy("page_no", "place")
    rows = rows.withColumn("seq", F.sum(F.when(F.col("_goes_on"), 0).otherwise(1)).over(order) - 1)
    parts = rows.where("_goes_on or kind = 'paragraph'").groupBy("book_id", "seq").agg(F.array_sort(F.collect_list(F.struct("page_no", "place", "inlines", "sources"))).alias("_p"), F.count("*").alias("_n")).where("_n > 1")
    parts = parts.select("book_id", "seq", F.flatten(F.transform("_p", lambda x: x["inlines"])).alias("_inlines"), F.flatten(F.transform("_p", lambda x: x["sources"])).alias("_sources"))
    rows = rows.where("not _goes_on").join(parts, ["book_id", "seq"], "left")
    return rows.withColumns({"inlines": F.coalesce("_inlines", "inlines", F.array().cast(f"array<{INLINE}>")), "sources": F.coalesce("_sources", "sources")}).drop("_inlines", "_sources", "_goes_on")
