"""Folders of page images: which files are pages, in which order, and what is wrong with them."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import layout, text

#: Files that systems leave in folders. Fixed values.
SYSTEM = ("desktop.ini", "thumbs.db", ".ds_store")
#: Names of a list that a message quotes from each end.
QUOTED = 5


def is_page(name: Column) -> Column:
    """Whether a file is an image of a page: not hidden, not a system's own, with a suffix of an image."""
    return ~F.startswith(name, F.lit(".")) & ~F.lower(name).isin(*SYSTEM) & text.media_type(name).isNotNull()


def dimensions(data: bytes) -> tuple[int, int] | None:
    """Width and height from the head of a PNG, JPEG, WebP or TIFF file; null for anything else."""
    try:
        if data[:8] == b"\x89PNG\r\n\x1a\n" and data[12:16] == b"IHDR":
            return struct.unpack(">II", data[16:24])
        if data[:2] == b"\xff\xd8":
            at = 2
            while at + 9 <= len(data):
                if data[at] != 0xFF:
                    return None
                mark = data[at + 1]
                if 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC):
                    height, width = struct.unpack(">HH", data[at + 5 : at + 9])
                    return width, height
                at += 2 if mark in (0xFF, 0x01) or 0xD0 <= mark <= 0xD7 else 2 + struct.unpack(">H", data[at + 2 : at + 4])[0]
            return None
        if data[:4] == b"RIFF" and data[8:12] == b"WEBP":
            if data[12:16] == b"VP8X":
                return 1 + int.from_bytes(data[24:27], "little"), 1 + int.from_bytes(data[27:30], "little")
            if data[12:16] == b"VP8L":
                bits = int.from_bytes(data[21:25], "little")
                return 1 + (bits & 0x3FFF), 1 + (bits >> 14 & 0x3FFF)
            width, height = struct.unpack("<HH", data[26:30])
            return width & 0x3FFF, height & 0x3FFF
        if data[:4] in (b"II*\0", b"MM\0*"):
            order = "<" if data[:2] == b"II" else ">"
            at = struct.unpack(order + "I", data[4:8])[0]
            found = {}
            for i in range(struct.unpack(order + "H", data[at : at + 2])[0]):
                tag, kind, _, value = struct.unpack(order + "HHI4s", data[at + 2 + 12 * i : at + 14 + 12 * i])
                if tag in (256, 257):
                    found[tag] = struct.unpack(order + ("H" if kind == 3 else "I"), value[: 2 if kind == 3 else 4])[0]
            return found[256], found[257]
    except (struct.error, IndexError, KeyError):
        return None
    return None


@F.pandas_udf(T.StructType([T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())]))
def image_size(content: pd.Series) -> pd.DataFrame:
    found = [dimensions(bytes(c)) if c is not None else None for c in content]
    return pd.DataFrame({"width": pd.array([f[0] if f else None for f in found], "Int32"), "height": pd.array([f[1] if f else None for f in found], "Int32")})


def read_folder(spark: SparkSession, folder: str) -> DataFrame:
    """``book_id, name, content`` of the files right in a folder (or in each of several that a pattern names).

    Spark's readers pass over empty files, so the driver lists these, by name alone.
    """
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/*")
    listed = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    empty = [(x.getPath().toString(), b"") for x in listed or [] if x.isFile() and x.getLen() == 0]
    if empty:
        files = files.unionByName(spark.createDataFrame(empty, "path string, content binary"))
    return files.select(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("book_id"), F.regexp_extract("path", "([^/]*)$", 1).alias("name"), "content")


def page_manifest(files: DataFrame) -> DataFrame:
    """``book_id, page_index, name, suffix, byte_size, sha256, width, height, aspect_ratio, is_duplicate, first_name, extreme,
    error`` of each page in natural order of the names. ``first_name`` is the first page with the same content."""
    size = image_size("content")
    rows = files.where(is_page(F.col("name"))).select("book_id", "name", F.lower(F.regexp_extract("name", r"(\.[^.]*)$", 1)).alias("suffix"), F.octet_length("content").cast("long").alias("byte_size"), F.sha2("content", 256).alias("sha256"), size.alias("size"))
    ratio = layout.aspect(F.col("size.width"), F.nullif("size.height", F.lit(0)))
    order = [text.natural_key(F.col("name")), F.col("name")]
    same = W.partitionBy("book_id", "sha256").orderBy(*order)
    error = F.when(F.col("byte_size") == 0, "EMPTY_FILE").when(F.col("size.width").isNull(), "CORRUPT_IMAGE").when((F.col("size.width") < 1) | (F.col("size.height") < 1), "ZERO_DIMENSION")
    return rows.select(
        "book_id", (F.row_number().over(W.partitionBy("book_id").orderBy(*order)) - 1).alias("page_index"), "name", "suffix", "byte_size", "sha256", "size.width", "size.height", ratio.alias("aspect_ratio"),
        (F.row_number().over(same) > 1).alias("is_duplicate"), F.first_value("name").over(same).alias("first_name"), F.coalesce(layout.is_extreme(ratio), F.lit(False)).alias("extreme"), error.alias("error"),
    )


def manifest_totals(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """``book_id, pages, bytes, duplicates, extremes, errors, first_names, last_names, state``: a row for each folder with files;
    state is ``failed`` where there are no pages, or one can't be used."""
    names = F.transform(F.array_sort(F.collect_list(F.struct("page_index", "name"))), lambda x: x["name"])
    counted = manifest.groupBy("book_id").agg(
        F.count("*").alias("pages"), F.sum("byte_size").alias("bytes"), F.count_if("is_duplicate").alias("duplicates"), F.count_if("extreme").alias("extremes"), F.count_if(F.col("error").isNotNull()).alias("errors"), names.alias("n")
    )
    rows = files.select("book_id").distinct().join(counted, "book_id", "left").fillna(0)
    some = lambda x: F.coalesce(x, F.array().cast("array<string>"))
    last = F.reverse(F.slice(F.reverse(some(F.col("n"))), 1, QUOTED))
    return rows.select("book_id", "pages", "bytes", "duplicates", "extremes", "errors", F.slice(some(F.col("n")), 1, QUOTED).alias("first_names"), last.alias("last_names"), F.when((F.col("pages") == 0) | (F.col("errors") > 0), "failed").otherwise("complete").alias("state"))
