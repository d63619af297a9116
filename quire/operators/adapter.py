"""Blocks of books from nested page JSON: typed, in reading order, with their inlines.

All is column expressions over a page's arrays; rows never meet those of another page, but for the running number of a
book's blocks, which needs the sizes of its pages before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import layout, text
from ..sources.middle import BLOCK, LINE, SPAN, SUB, pages, spans_of

INLINE = "struct<kind:string,text:string,latex:string>"
SOURCE = "struct<page_idx:int,bbox:struct<x0:double,y0:double,x1:double,y1:double>,source_type:string,source_index:int,line_bboxes:array<array<double>>,span_bboxes:array<array<double>>>"
#: Kind of a block by its type; others are unknown. Fixed values.
KINDS = {
    "title": "heading", "text": "paragraph", "image": "figure", "chart": "chart", "table": "table", "code": "code", "interline_equation": "display_math",
    "list": "list", "index": "index", "aside_text": "aside", "page_footnote": "footnote",
}
#: Characters of an unknown block that its warning quotes.
QUOTED = 100


def _none(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def inlines(spans: Column) -> Column:
    """Runs of text, joined to prose, and the inline equations between them; empty runs go."""
    start = F.array().cast("array<struct<math:boolean,pieces:array<string>,latex:string>>")

    def fold(acc: Column, s: Column) -> Column:
        math = F.coalesce(s["type"] == "inline_equation", F.lit(False))
        content = F.coalesce(s["content"], F.lit(""))
        last = F.get(acc, F.size(acc) - 1)
        own = F.struct(math.alias("math"), F.when(math, F.array().cast("array<string>")).otherwise(F.array(content)).alias("pieces"), F.when(math, text.one_dollar(content)).alias("latex"))
        joined = F.struct(F.lit(False).alias("math"), F.concat(last["pieces"], F.array(content)).alias("pieces"), F.lit(None).cast("string").alias("latex"))
        goes_on = ~math & F.coalesce(~last["math"], F.lit(False))
        return F.when(goes_on, F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(acc, F.array(own)))

    runs = F.aggregate(spans, start, fold)
    named = F.transform(runs, lambda r: F.struct(F.when(r["math"], "inline_math").otherwise("text").alias("kind"), F.when(~r["math"], text.join_prose(r["pieces"])).alias("text"), r["latex"].alias("latex")))
    return F.filter(named, lambda x: (x["kind"] == "inline_math") | (x["text"] != ""))


def code_text(lines: Column) -> Column:
    """Spans as they are, lines between line feeds."""
    return F.array_join(F.transform(F.coalesce(lines, _none(LINE)), lambda x: F.array_join(F.transform(F.coalesce(x["spans"], _none(SPAN)), lambda s: F.coalesce(s["content"], F.lit(""))), "")), "\n")


def plain(inline: Column) -> Column:
    """The text of inlines, mathematics as LaTeX."""
    return F.array_join(F.transform(inline, lambda x: F.coalesce(x["text"], x["latex"], F.lit(""))), "")


def _subs(block: Column) -> Column:
    return F.coalesce(block["blocks"], _none(SUB))


def _last(spans: Column, field: str) -> Column:
    found = F.filter(spans, lambda s: F.trim(F.coalesce(s[field], F.lit(""))) != "")
    return F.get(found, F.size(found) - 1)[field]


def reading_order(bodies: Column, extras: Column) -> Column:
    """``array<struct<ord, y0>>``: bodies in their order; of the extras, one after another, asides with a box go before the
    first that begins lower, all others to the end."""

    def insert(acc: Column, x: Column) -> Column:
        at = F.array_position(F.transform(acc, lambda a: F.coalesce(a["y0"] > x["y0"], F.lit(False))), True)
        at = F.when(x["aside"] & (at > 0), at - 1).otherwise(F.size(acc)).cast("int")
        own = F.array(F.struct(x["ord"].alias("ord"), x["y0"].alias("y0")))
        rest = F.slice(acc, at + 1, F.greatest(F.size(acc) - at, F.lit(0)))
        return F.concat(F.slice(acc, F.lit(1), at), own, rest)

    return F.aggregate(extras, bodies, insert)


def blocks(books: DataFrame, legacy_lists: bool = False) -> DataFrame:
    """``book_id, page_no, page_idx, place, block_id`` and what the block holds; ``error`` says what can't be used.

    ``legacy_lists`` reads the attribute of lists as older data wants it: whatever holds ``ordered``, ``unordered`` too, is
    an ordered list. Books without pages, and null ones, give no rows. A text without inlines is left out, though it counts
    in the numbers of block ids. Headers, footers and page numbers are left out.
    """
    kept = lambda b: b["type"].isin("aside_text", "page_footnote")
    listed = F.concat(
        F.transform(F.coalesce("page.para_blocks", _none(BLOCK)), lambda b: F.struct(F.lit(False).alias("extra"), b.alias("b"))),
        F.transform(F.filter(F.coalesce("page.discarded_blocks", _none(BLOCK)), kept), lambda b: F.struct(F.lit(True).alias("extra"), b.alias("b"))),
    )
    paged = pages(books).select("book_id", "page_no", "page_idx", listed.alias("listed"))
    before = F.coalesce(F.sum(F.size("listed")).over(W.partitionBy("book_id").orderBy("page_no").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    holds = lambda b: F.exists(spans_of(b), lambda s: (s["type"] == "inline_equation") | (text.strip(F.coalesce(s["content"], F.lit(""))) != ""))
    place = F.transform("listed", lambda x, i: F.struct(i.alias("ord"), F.get(x["b"]["bbox"], F.lit(1)).alias("y0"), (x["b"]["type"] == "aside_text").alias("aside"), x["extra"].alias("extra"), ((x["b"]["type"] == "text") & ~holds(x["b"])).alias("void")))
    paged = paged.withColumn("before", before).withColumn("p", F.filter(place, lambda x: ~F.coalesce(x["void"], F.lit(False))))
    bodies = F.transform(F.filter("p", lambda x: ~x["extra"]), lambda x: F.struct(x["ord"].alias("ord"), x["y0"].alias("y0")))
    order = reading_order(bodies, F.filter("p", lambda x: x["extra"]))
    rows = paged.select("book_id", "page_no", "page_idx", "before", "listed", F.posexplode(order).alias("place", "o"))
    rows = rows.select("book_id", "page_no", "page_idx", "place", F.format_string("blk-%05d", F.col("before") + F.col("o.ord") + 1).alias("block_id"), F.col("o.ord").alias("ord"), F.get("listed", "o.ord")["b"].alias("b"))
    return _typed(rows, legacy_lists)


def _typed(rows: DataFrame, legacy_lists: bool) -> DataFrame:
    b, type_ = F.col("b"), F.coalesce("b.type", F.lit("unknown"))
    lines = F.coalesce(b["lines"], _none(LINE))
    # the inlines of the block, of its parts, and of its lines, each worked out once
    subs = F.transform(_subs(b), spans_of)
    units = F.concat(F.array(spans_of(b)), subs, F.when(F.coalesce(type_.isin("list", "index"), F.lit(False)), F.transform(lines, lambda x: F.coalesce(x["spans"], _none(SPAN)))).otherwise(F.array().cast(f"array<array<{SPAN}>>")))
    rows = rows.withColumn("_u", F.transform(units, inlines)).withColumn("_own", spans_of(b)).withColumn("_every", F.concat(spans_of(b), F.flatten(subs)))
    own, every, n = F.col("_own"), F.col("_every"), F.size(_subs(b))
    prose_of, of_subs, of_lines = F.get("_u", F.lit(0)), F.slice("_u", F.lit(2), n), F.slice("_u", n + 2, F.greatest(F.size("_u") - n - 1, F.lit(0)))
    parts = lambda word: F.flatten(F.filter(of_subs, lambda _, i: F.contains(F.get(_subs(b), i)["type"], F.lit(word))))
    kinds = F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv])
    kind = F.coalesce(F.try_element_at(kinds, type_), F.lit("unknown"))
    visual, is_code = type_.isin("image", "chart", "table"), type_ == "code"
    image, html = _last(every, "image_path"), _last(every, "html")
    described = F.when(type_ == "chart", F.nullif(F.array_join(F.transform(F.filter(every, lambda s: (s["type"] == "chart") & s["content"].isNotNull()), lambda s: s["content"]), "\n"), F.lit("")))
    bodies = F.filter(_subs(b), lambda s: F.contains(s["type"], F.lit("body")))
    code = F.when(F.size(bodies) > 0, F.array_join(F.transform(bodies, lambda s: code_text(s["lines"])), "\n")).otherwise(code_text(lines))
    items = F.filter(F.when(n > 0, of_subs).otherwise(of_lines), lambda x: F.size(x) > 0)
    mark = F.lower(F.coalesce(b["attribute"], F.lit("")))
    ordered = F.when(F.contains(mark, F.lit("ordered")), True) if legacy_lists else F.when(mark.rlike(r"\bunordered\b"), False).when(mark.rlike(r"\bordered\b"), True)
    written = F.array_join(F.transform(F.filter(prose_of, lambda x: x["kind"] == "text"), lambda x: x["text"]), " ")
    # what has no picture or markup to show falls back to what it has
    kind = F.when(kind.isin("figure", "chart") & image.isNull(), "unknown").when((kind == "table") & html.isNull() & image.isNotNull(), "figure").otherwise(kind)
    source = F.struct(
        F.col("page_idx"), layout.bbox(b["bbox"]).alias("bbox"), type_.alias("source_type"), F.col("ord").alias("source_index"),
        F.transform(lines, lambda x: x["bbox"]).alias("line_bboxes"), F.transform(own, lambda s: s["bbox"]).alias("span_bboxes"),
    )
    prose = type_.isin("title", "text", "aside_text", "page_footnote")
    known = F.array_contains(F.map_keys(kinds), type_)
    return rows.select(
        "book_id", "page_no", "page_idx", "place", "block_id", kind.alias("kind"),
        F.when((type_ == "title") & b["level"].between(1, 6), b["level"]).alias("level"),
        F.when(prose, prose_of).otherwise(_none(INLINE)).alias("inlines"),
        F.when(visual | is_code, parts("caption")).otherwise(_none(INLINE)).alias("captions"),
        F.when(visual | is_code, parts("footnote")).otherwise(_none(INLINE)).alias("notes"),
        F.when(type_.isin("list", "index"), items).otherwise(F.array().cast(f"array<array<{INLINE}>>")).alias("items"),
        F.when(is_code, code).when((type_ == "chart") & (kind == "unknown"), F.coalesce(described, written)).when(kind == "unknown", written).when(type_ == "chart", described).alias("text"),
        F.when(type_ == "interline_equation", text.two_dollars(F.coalesce(_last(own, "content"), F.lit("")))).alias("latex"),
        F.when(type_ == "table", html).alias("html"), F.when(visual | (type_ == "interline_equation"), image).alias("image_path"),
        F.when(is_code, F.when(b["sub_type"] == "algorithm", "algorithm").otherwise("code")).alias("sub_kind"), F.when(type_ == "list", ordered).alias("ordered"), b["language"].alias("language"),
        F.array(source.cast(SOURCE)).alias("sources"),
        F.when((kind == "table") & html.isNull(), "TABLE_WITHOUT_CONTENT").alias("error"),
        F.when(~known, F.struct(F.lit("UNKNOWN_BLOCK_TYPE").alias("code"), F.concat(type_, F.lit(": "), F.left(written, F.lit(QUOTED))).alias("message"))).alias("warning"),
    )


def warnings(found: DataFrame) -> DataFrame:
    """``book_id, page_idx, block_id, code, message`` of blocks with a warning or an error."""
    own = found.where("warning is not null").select("book_id", "page_idx", "block_id", "warning.code", "warning.message")
    return own.unionByName(found.where("error is not null").select("book_id", "page_idx", "block_id", F.col("error").alias("code"), F.lit("neither markup nor picture").alias("message")))


def assets(found: DataFrame, files: DataFrame) -> DataFrame:
    """``book_id, asset_id, path, media_type, sha256, byte_size, role``: a row for each different content of the pictures that
    blocks show, with the first one's path and role; ``files`` has ``book_id, path, sha256, byte_size``. ``paths`` are the
    ways in which blocks name it.

    A picture is looked up by its path, then under images/. Those not found are left out (see middle.missing_images), and
    a suffix without a media type gives a null one.
    """
    shown = found.where("image_path is not null").select("book_id", "page_no", "place", "image_path", "kind")
    near = files.select("book_id", F.col("path").alias("image_path"), F.struct("path", "sha256", "byte_size").alias("a"))
    under = files.where(F.startswith("path", F.lit("images/"))).select("book_id", F.substring("path", 8, 1 << 20).alias("image_path"), F.struct("path", "sha256", "byte_size").alias("b"))
    met = shown.join(near, ["book_id", "image_path"], "left").join(under, ["book_id", "image_path"], "left").withColumn("f", F.coalesce("b", "a")).where("f is not null")
    order = F.struct("page_no", "place")
    one = met.groupBy("book_id", "f.sha256").agg(F.min_by("f", order).alias("f"), F.min_by("kind", order).alias("role"), F.sort_array(F.collect_set("image_path")).alias("paths"))
    return one.select("book_id", F.concat(F.lit("asset-"), F.left("f.sha256", F.lit(16))).alias("asset_id"), "f.path", text.media_type(F.col("f.path")).alias("media_type"), "f.sha256", "f.byte_size", "role", "paths")
