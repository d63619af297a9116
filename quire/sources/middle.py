"""Books as nested page JSON: reading, checking, and what stands in them.

A row is a book; ``book_id`` is its key in all tables. Types are given, never inferred, and missing fields are null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPAN = "struct<type:string,content:string,bbox:array<double>,image_path:string,html:string>"
LINE = f"struct<bbox:array<double>,spans:array<{SPAN}>>"
SUB = f"struct<type:string,bbox:array<double>,lines:array<{LINE}>>"
BLOCK = f"struct<type:string,level:int,sub_type:string,attribute:string,language:string,bbox:array<double>,lines:array<{LINE}>,blocks:array<{SUB}>>"
PAGE = f"struct<page_idx:int,page_size:array<double>,para_blocks:array<{BLOCK}>,discarded_blocks:array<{BLOCK}>>"
SCHEMA = f"_version_name string, _backend string, _effort string, _ocr_enable boolean, pdf_info array<{PAGE}>"
#: What the root of a document must say. Fixed values.
VERSION, BACKEND, EFFORT = "3.4.5", "hybrid", "high"
#: Fields of a block that are read; others are kept as extensions. Fixed values.
KNOWN = ("type", "level", "sub_type", "attribute", "language", "bbox", "lines", "blocks")


def read_middle(spark: SparkSession, path: str, glob: str = "*_middle.json") -> DataFrame:
    """Every file that fits glob in a folder and those below it, a row each: ``book_id`` is its path, then the fields, ``raw`` the text."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).option("wholetext", True).text(path)
    return parse_middle(files.select(F.col("_metadata.file_path").alias("book_id"), F.col("value").alias("raw")), "raw")


def parse_middle(books: DataFrame, raw: str) -> DataFrame:
    """The fields of each row's JSON text beside the other columns; all are null where it isn't an object."""
    return books.withColumn("_m", F.from_json(raw, SCHEMA)).select(*books.columns, "_m.*")


def one_per_folder(books: DataFrame, folder: Column) -> DataFrame:
    """``folder, n``: folders without exactly one document, which are errors."""
    return books.groupBy(folder.alias("folder")).agg(F.count("*").alias("n")).where("n != 1")


def root_issues(books: DataFrame, pages: Column | None = None) -> DataFrame:
    """``book_id, severity, code, message``: what is wrong with the root of each document. pages: how many were expected."""
    text = lambda c: F.coalesce(F.col(c), F.lit("absent"))
    tests = [
        (~F.col("_version_name").eqNullSafe(F.lit(VERSION)), "ERROR", "VERSION", F.concat(F.lit("version "), text("_version_name"))),
        (~F.col("_backend").eqNullSafe(F.lit(BACKEND)), "ERROR", "BACKEND", F.concat(F.lit("backend "), text("_backend"))),
        (F.col("_effort") != EFFORT, "ERROR", "EFFORT", F.concat(F.lit("effort "), text("_effort"))),
        (F.col("_effort").isNull(), "WARNING", "EFFORT", F.lit("effort absent")),
        (F.col("pdf_info").isNull(), "ERROR", "PAGES", F.lit("no list of pages")),
    ]
    if pages is not None:
        tests.append((F.size("pdf_info") != pages, "ERROR", "PAGE_COUNT", F.concat(F.size("pdf_info").cast("string"), F.lit(" pages, not "), pages.cast("string"))))
    found = F.array(*[F.when(test, F.struct(F.lit(s).alias("severity"), F.lit(c).alias("code"), m.alias("message"))) for test, s, c, m in tests])
    return books.select("book_id", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("i")).select("book_id", "i.*")


def source_books(books: DataFrame) -> DataFrame:
    """``book_id, version, backend, effort, page_count``, absent ones as ``unknown``."""
    return books.select("book_id", *[F.coalesce(F.col(c), F.lit("unknown")).alias(n) for c, n in (("_version_name", "version"), ("_backend", "backend"), ("_effort", "effort"))], F.greatest(F.size("pdf_info"), F.lit(0)).alias("page_count"))


def pages(books: DataFrame) -> DataFrame:
    """``book_id, page_no, page_idx, width, height, number_text, page``: page_no counts from 0, number_text is what stands in
    the blocks of page numbers (null where there is nothing)."""
    out = books.select("book_id", F.posexplode("pdf_info").alias("page_no", "page"))
    size = lambda i: F.coalesce(F.get("page.page_size", F.lit(i)), F.lit(0.0))
    numbers = F.filter("page.discarded_blocks", lambda b: b["type"] == "page_number")
    words = F.filter(F.transform(F.flatten(F.transform(numbers, spans_of)), lambda s: s["content"]), lambda x: F.trim(F.coalesce(x, F.lit(""))) != "")
    return out.select("book_id", "page_no", F.coalesce("page.page_idx", "page_no").alias("page_idx"), size(0).alias("width"), size(1).alias("height"), F.nullif(F.array_join(words, " "), F.lit("")).alias("number_text"), "page")


def spans_of(block: Column) -> Column:
    """The spans of a block's own lines, in order."""
    empty = F.array().cast(f"array<{SPAN}>")
    return F.flatten(F.transform(F.coalesce(block["lines"], F.array().cast(f"array<{LINE}>")), lambda x: F.coalesce(x["spans"], empty)))


def all_spans(block: Column) -> Column:
    """The spans of a block and of its parts."""
    subs = F.coalesce(block["blocks"], F.array().cast(f"array<{SUB}>"))
    return F.concat(spans_of(block), F.flatten(F.transform(subs, spans_of)))


def extensions(books: DataFrame, raw: str = "raw") -> DataFrame:
    """``book_id, page_no, block_no, field, value``: fields of blocks that the schema doesn't know, as JSON text."""
    v = books.select("book_id", F.try_parse_json(raw).alias("v"))
    paged = v.select("book_id", F.posexplode(F.try_variant_get("v", "$.pdf_info", "array<variant>")).alias("page_no", "p"))
    blocks = paged.select("book_id", "page_no", F.posexplode(F.try_variant_get("p", "$.para_blocks", "array<variant>")).alias("block_no", "b"))
    fields = blocks.select("book_id", "page_no", "block_no", F.explode(F.try_variant_get("b", "$", "map<string,variant>")).alias("field", "value"))
    return fields.where(~F.col("field").isin(*KNOWN)).withColumn("value", F.to_json("value"))


def referenced_images(books: DataFrame) -> DataFrame:
    """``book_id, ord, path``: every image path in the order of the document, repeated ones too."""
    blocks = lambda c: F.coalesce(F.col("p")[c], F.array().cast(f"array<{BLOCK}>"))
    listed = books.select("book_id", F.posexplode("pdf_info").alias("page_no", "p")).select("book_id", "page_no", F.posexplode(F.flatten(F.transform(F.concat(blocks("para_blocks"), blocks("discarded_blocks")), all_spans))).alias("ord", "s"))
    return listed.where(F.trim(F.coalesce("s.image_path", F.lit(""))) != "").select("book_id", "page_no", "ord", F.col("s.image_path").alias("path"))


def missing_images(references: DataFrame, files: DataFrame) -> DataFrame:
    """References of which neither the path nor the path under images/ is among ``files(book_id, path)``."""
    a, b = files.select("book_id", "path"), files.where(F.startswith("path", F.lit("images/"))).select("book_id", F.substring("path", 8, 1 << 20).alias("path"))
    return references.join(a.unionByName(b).distinct(), ["book_id", "path"], "left_anti")


# ------------------------------------------------------------------ counts of what stands in documents


def block_types(books: DataFrame) -> DataFrame:
    """``book_id, type, n`` of blocks, their parts counted too."""
    b = pages(books).select("book_id", F.explode("page.para_blocks").alias("b"))
    named = F.coalesce(F.col("b.type"), F.lit("unknown"))
    parts = F.transform(F.coalesce(F.col("b.blocks"), F.array().cast(f"array<{SUB}>")), lambda x: F.coalesce(x["type"], F.lit("unknown")))
    return b.select("book_id", F.explode(F.concat(F.array(named), parts)).alias("type")).groupBy("book_id", "type").agg(F.count("*").alias("n"))


def discarded_types(books: DataFrame) -> DataFrame:
    return pages(books).select("book_id", F.explode("page.discarded_blocks").alias("b")).groupBy("book_id", F.coalesce("b.type", F.lit("unknown")).alias("type")).agg(F.count("*").alias("n"))


def span_types(books: DataFrame) -> DataFrame:
    b = pages(books).select("book_id", F.explode("page.para_blocks").alias("b")).select("book_id", F.explode(all_spans(F.col("b"))).alias("s"))
    return b.groupBy("book_id", F.coalesce("s.type", F.lit("unknown")).alias("type")).agg(F.count("*").alias("n"))


def page_sizes(books: DataFrame) -> DataFrame:
    """``book_id, size, n``: width and height with an x between them, or ``unknown``."""
    known = F.size("page.page_size") == 2
    name = F.when(known, F.concat_ws("x", F.format_string("%.0f", "width"), F.format_string("%.0f", "height"))).otherwise("unknown")
    return pages(books).groupBy("book_id", name.alias("size")).agg(F.count("*").alias("n"))


def titles(books: DataFrame) -> DataFrame:
    """``book_id, with_level, without_level`` of titles."""
    b = pages(books).select("book_id", F.explode("page.para_blocks").alias("b")).where("b.type = 'title'")
    return b.groupBy("book_id").agg(F.count_if(F.col("b.level").isNotNull()).alias("with_level"), F.count_if(F.col("b.level").isNull()).alias("without_level"))


def inspect(books: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """One row a book: version, backend, effort, page_count, maps of page sizes, block, discarded and span types, titles with
    and without a level, referenced images, and of these missing ones (null without ``files``)."""

    def as_map(counts: DataFrame, name: str, key: str = "type") -> DataFrame:
        return counts.groupBy("book_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(key, "n")))).alias(name))

    images = referenced_images(books)
    out = source_books(books)
    for part in (as_map(page_sizes(books), "page_sizes", "size"), as_map(block_types(books), "block_types"), as_map(discarded_types(books), "discarded_types"), as_map(span_types(books), "span_types"), titles(books), images.groupBy("book_id").agg(F.count("*").alias("images"))):
        out = out.join(part, "book_id", "left")
    if files is None:
        return out.withColumn("missing_images", F.lit(None).cast("long")).fillna(0, ["with_level", "without_level", "images"])
    lost = missing_images(images, files).groupBy("book_id").agg(F.count("*").alias("missing_images"))
    return out.join(lost, "book_id", "left").fillna(0, ["with_level", "without_level", "images", "missing_images"])
