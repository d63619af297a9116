"""Packages of books: the package document, navigation, and the archive with everything in it."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators.validate import MIMETYPE

CONTAINER = (
    '<?xml version="1.0" encoding="UTF-8"?>\n<container version="1.0" xmlns="urn:oasis:names:tc:opendocument:xmlns:container"><rootfiles>'
    '<rootfile full-path="OEBPS/package.opf" media-type="application/oebps-package+xml"/></rootfiles></container>'
)
STYLE = "body{margin:5%;line-height:1.5}figure{margin:1em 0}.size-small{width:36%}.size-medium{width:72%}.align-center{margin:auto}.align-right{margin-left:auto}.table-wrap{overflow-x:auto}pre{white-space:pre-wrap}img{max-width:100%}.list-marker-preserved{list-style:none}"
#: The time in archives that must come out the same each time.
EPOCH = "1980-01-01T00:00:00Z"


def _esc(x: Column) -> Column:
    return text.escape_attribute(F.coalesce(x, F.lit("")))


def package_opf(books: DataFrame, documents: DataFrame, assets: DataFrame | None = None, modified: str = EPOCH) -> DataFrame:
    """``book_id, name, content``: the package document of each of ``books(book_id, title, language, identifier[, authors])``.

    Documents stand in the spine in their order; blank authors are left out.
    """
    doc = F.struct("first", F.concat(F.lit('<item id="'), _esc(F.col("doc_id")), F.lit('" href="'), _esc(F.col("href")), F.lit('" media-type="application/xhtml+xml"'), F.when(F.col("has_math"), ' properties="mathml"').otherwise(""), F.lit("/>")).alias("item"), F.concat(F.lit('<itemref idref="'), _esc(F.col("doc_id")), F.lit('"/>')).alias("ref"))
    listed = documents.groupBy("book_id").agg(F.array_sort(F.collect_list(doc)).alias("d"))  # of a book
    rows = books.join(listed, "book_id", "left")
    if assets is not None:
        item = F.concat(F.lit('<item id="'), _esc(F.col("asset_id")), F.lit('" href="images/'), _esc(F.regexp_replace("path", "^.*/", "")), F.lit('" media-type="'), _esc(F.col("media_type")), F.lit('"/>'))
        rows = rows.join(assets.groupBy("book_id").agg(F.array_sort(F.collect_list(item)).alias("a")), "book_id", "left")
    else:
        rows = rows.withColumn("a", F.lit(None).cast("array<string>"))
    authors = F.filter("authors", lambda x: F.trim(F.coalesce(x, F.lit(""))) != "") if "authors" in books.columns else F.array().cast("array<string>")
    joined = lambda c, f: F.coalesce(F.array_join(F.transform(c, lambda x: x[f]), ""), F.lit(""))
    content = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<package xmlns="http://www.idpf.org/2007/opf" version="3.0" unique-identifier="id"><metadata xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:identifier id="id">'),
        text.escape("identifier"), F.lit("</dc:identifier><dc:title>"), text.escape("title"), F.lit("</dc:title><dc:language>"), text.escape("language"), F.lit("</dc:language>"),
        F.array_join(F.transform(authors, lambda x: F.concat(F.lit("<dc:creator>"), text.escape(F.trim(x)), F.lit("</dc:creator>"))), ""),
        F.lit(f'<meta property="dcterms:modified">{modified}</meta></metadata><manifest><item id="nav" href="nav.xhtml" media-type="application/xhtml+xml" properties="nav"/><item id="style" href="styles/book.css" media-type="text/css"/>'),
        joined("d", "item"), F.coalesce(F.array_join("a", ""), F.lit("")), F.lit("</manifest><spine>"), joined("d", "ref"), F.lit("</spine></package>"),
    )
    return rows.select("book_id", F.lit("OEBPS/package.opf").alias("name"), F.encode(content, "UTF-8").alias("content"))


def nav_xhtml(books: DataFrame, contents: DataFrame, pages: DataFrame) -> DataFrame:
    """``book_id, name, content``: contents as nested lists, the list of pages if there are any, and where the text begins.

    An entry's children are those that name it as their parent; there are three levels at most, so three steps nest them.
    """
    link = F.concat(F.lit('<a href="'), _esc(F.col("href")), F.lit('">'), text.escape("title"), F.lit("</a>"))
    rows = contents.select("book_id", "seq", "parent_seq", link.alias("link"), F.lit("").alias("under"))
    for _ in range(2):  # the entries' lists, then those of their children's children
        lists = rows.where("parent_seq is not null").groupBy("book_id", F.col("parent_seq").alias("seq")).agg(F.array_sort(F.collect_list(F.struct("seq", F.concat(F.lit("<li>"), "link", "under", F.lit("</li>")).alias("x")))).alias("l"))
        lists = lists.select("book_id", "seq", F.concat(F.lit("<ol>"), F.array_join(F.transform("l", lambda x: x["x"]), ""), F.lit("</ol>")).alias("_u"))
        rows = rows.join(lists, ["book_id", "seq"], "left").withColumn("under", F.coalesce("_u", F.lit(""))).drop("_u")
    one = F.struct("seq", F.concat(F.lit("<li>"), "link", "under", F.lit("</li>")).alias("x"))
    tops = rows.where("parent_seq is null").groupBy("book_id").agg(F.array_sort(F.collect_list(one)).alias("t"))
    page = F.struct("page_idx", F.concat(F.lit('<li><a href="'), _esc(F.col("target")), F.lit('">'), text.escape("label"), F.lit("</a></li>")).alias("x"))
    listed = pages.groupBy("book_id").agg(F.array_sort(F.collect_list(page)).alias("p"))
    start = contents.groupBy("book_id").agg(F.min_by("href", "seq").alias("start"))
    found = books.select("book_id", "title").join(tops, "book_id", "left").join(listed, "book_id", "left").join(start, "book_id", "left")
    inner = lambda c: F.coalesce(F.array_join(F.transform(c, lambda x: x["x"]), ""), F.lit(""))
    content = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<html xmlns="http://www.w3.org/1999/xhtml" xmlns:epub="http://www.idpf.org/2007/ops"><head><title>'), text.escape("title"),
        F.lit('</title></head><body><nav epub:type="toc" id="toc"><ol>'), inner("t"), F.lit("</ol></nav>"),
        F.when(F.size("p") > 0, F.concat(F.lit('<nav epub:type="page-list" hidden="hidden"><ol>'), inner("p"), F.lit("</ol></nav>"))).otherwise(""),
        F.lit('<nav epub:type="landmarks" hidden="hidden"><ol><li><a epub:type="bodymatter" href="'), _esc(F.col("start")), F.lit('">Start</a></li></ol></nav></body></html>'),
    )
    return found.select("book_id", F.lit("OEBPS/nav.xhtml").alias("name"), F.encode(content, "UTF-8").alias("content"))


def entries(books: DataFrame, documents: DataFrame, contents: DataFrame, pages: DataFrame, assets: DataFrame | None = None, pictures: DataFrame | None = None, modified: str = EPOCH) -> DataFrame:
    """``book_id, ord, name, method, content, error`` of each book's files, mimetype first and uncompressed, the others in the
    order of their names. ``pictures(book_id, path, content)`` are the files of assets."""
    constant = lambda name, body: books.select("book_id", F.lit(name).alias("name"), F.encode(F.lit(body), "UTF-8").alias("content"))
    parts = [
        constant("META-INF/container.xml", CONTAINER), constant("OEBPS/styles/book.css", STYLE), package_opf(books, documents, assets, modified), nav_xhtml(books, contents, pages),
        documents.select("book_id", F.concat(F.lit("OEBPS/"), "href").alias("name"), F.encode("xhtml", "UTF-8").alias("content")),
    ]
    if assets is not None and pictures is not None:
        parts.append(assets.select("book_id", "path").join(pictures, ["book_id", "path"]).select("book_id", F.concat(F.lit("OEBPS/images/"), F.regexp_replace("path", "^.*/", "")).alias("name"), "content"))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    from pyspark.sql import Window as W

    place = F.row_number().over(W.partitionBy("book_id").orderBy("name"))
    rows = rows.select("book_id", place.alias("ord"), "name", F.lit(zipfile.ZIP_DEFLATED).alias("method"), "content")
    first = books.select("book_id", F.lit(0).alias("ord"), F.lit("mimetype").alias("name"), F.lit(zipfile.ZIP_STORED).alias("method"), F.encode(F.lit(MIMETYPE), "UTF-8").alias("content"))
    return first.unionByName(rows).withColumn("error", F.lit(None).cast("string"))


def archives(files: DataFrame, modified: str = EPOCH) -> DataFrame:
    """``book_id, content``: the zip file of each book's entries, read again to be sure. The same entries give the same bytes."""
    stamp = tuple(int(modified[a:b]) for a, b in ((0, 4), (5, 7), (8, 10), (11, 13), (14, 16), (17, 19)))

    def run(book: pd.DataFrame) -> pd.DataFrame:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as archive:
            for name, method, content in book.sort_values("ord")[["name", "method", "content"]].itertuples(index=False):
                info = zipfile.ZipInfo(name, stamp)
                info.compress_type = int(method)
                archive.writestr(info, bytes(content))
        with zipfile.ZipFile(io.BytesIO(out.getvalue())) as archive:
            if archive.testzip() is not None or archive.namelist()[0] != "mimetype":
                raise ValueError(f"the archive of {book['book_id'].iloc[0]} can't be read again")
        return pd.DataFrame({"book_id": [book["book_id"].iloc[0]], "content": [out.getvalue()]})

    kind = files.schema["book_id"].dataType.simpleString()
    return files.select("book_id", "ord", "name", "method", "content").groupBy("book_id").applyInPandas(run, f"book_id {kind}, content binary")
