"""Blocks as XHTML, and what navigation needs: contents, pages, documents.

A block's XHTML is a column expression; only tables and mathematics go through Python. Documents are put together from
their blocks at the end, by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import layout, markup, text
from .adapter import INLINE, plain
from .sequence import contents_parent

#: Deepest level of headings in the contents.
CONTENTS_LEVEL = 3
_lit = F.lit


def _cat(*parts: Column | str) -> Column:
    return F.concat(*[_lit(p) if isinstance(p, str) else p for p in parts])


def _wrap(tag: str, inner: Column, attributes: str = "") -> Column:
    return _cat(f"<{tag}{attributes}>", inner, f"</{tag}>")


def page_mark(id_: Column, label: Column) -> Column:
    return _cat('<span id="', id_, '" epub:type="pagebreak" role="doc-pagebreak" aria-label="', text.escape_attribute(label), '"></span>')


def inline_xhtml(inlines: Column, math: Column, page_ids: Column | None = None) -> Column:
    """Inlines one after another; ``math`` holds the MathML of each one's LaTeX, null where there is none, so that the LaTeX stays."""

    def one(x: Column, i: Column) -> Column:
        latex = F.coalesce(F.get(math, i), _cat('<code class="math-unconverted">', text.escape(F.coalesce(x["latex"], _lit(""))), "</code>"))
        id_ = text.label_id(x["text"], _lit(0)) if page_ids is None else F.get(page_ids, i)
        return F.when(x["kind"] == "inline_math", latex).when(x["kind"] == "page_boundary", page_mark(id_, x["text"])).when(x["kind"] == "line_break", "<br/>").otherwise(text.escape(F.coalesce(x["text"], _lit(""))))

    return F.array_join(F.transform(inlines, one), "")


def numbered(blocks: DataFrame) -> DataFrame:
    """Adds what runs through a book or a document: the headings' numbers, and ids of page breaks that are unique in a document."""
    book, doc = W.partitionBy("book_id").orderBy("seq"), W.partitionBy("book_id", "doc_id", "_base").orderBy("seq")
    rows = blocks.withColumn("heading_no", F.when(F.col("kind") == "heading", F.sum(F.when(F.col("kind") == "heading", 1).otherwise(0)).over(book)))
    rows = rows.withColumn("_base", F.when(F.col("kind") == "page_break", text.label_id(F.col("label"), F.col("page_idx"))))
    nth = F.row_number().over(doc)
    return rows.withColumn("anchor", F.when(F.col("_base").isNotNull(), F.when(nth == 1, F.col("_base")).otherwise(F.concat("_base", _lit("-"), nth.cast("string"))))).drop("_base")


def fragments(blocks: DataFrame, assets: DataFrame | None = None) -> DataFrame:
    """Adds ``xhtml`` and ``issues`` (codes of warnings) to numbered blocks with ``doc_id``. ``assets(book_id, asset_id, path, paths)``: what adapter.assets gives; without it pictures keep the names that blocks give them."""
    if assets is not None:
        found = assets.select("book_id", "asset_id", F.col("path").alias("_path"), F.explode("paths").alias("image_path"))
        blocks = blocks.join(found, ["book_id", "image_path"], "left")
    else:
        blocks = blocks.withColumns({"asset_id": _lit(None).cast("string"), "_path": _lit(None).cast("string")})
    empty = F.array().cast(f"array<{INLINE}>")
    own, captions, notes = (F.coalesce(c, empty) for c in ("inlines", "captions", "notes"))
    items = F.coalesce("items", F.array().cast(f"array<array<{INLINE}>>"))
    # all inlines of a block in one array, so that a block's mathematics goes to Python once
    latex = lambda xs: F.transform(xs, lambda x: F.when(x["kind"] == "inline_math", x["latex"]))
    rows = blocks.withColumn("_math", markup.inline_mathml(latex(F.concat(own, captions, notes, F.flatten(items)))))
    rows = rows.withColumn("_table", markup.sanitize_table("html")).withColumn("_display", markup.display_mathml(text.latex(F.col("latex"))))
    cut = lambda start, n: F.slice("_math", start + 1, n)
    at_captions, at_notes = F.size(own), F.size(own) + F.size(captions)
    main = inline_xhtml(own, cut(_lit(0), F.size(own)))
    caption, note = inline_xhtml(captions, cut(at_captions, F.size(captions))), inline_xhtml(notes, cut(at_notes, F.size(notes)))
    before = F.aggregate(items, F.array(at_notes + F.size(notes)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + F.size(x))))
    listed = F.transform(items, lambda x, i: inline_xhtml(x, F.slice("_math", F.get(before, i) + 1, F.size(x))))
    points = F.array_join(F.transform(listed, lambda x: _cat("<li>", x, "</li>")), "")
    level = F.least(F.greatest(F.coalesce("level", _lit(2)), _lit(1)), _lit(6)).cast("string")
    heading = _cat("<h", level, ' id="', F.col("anchor"), '">', main, "</h", level, ">")
    alt = text.escape_attribute(plain(captions))
    picture = F.when(F.col("image_path").isNotNull(), _cat('<img src="', text.escape_attribute(text.image_source(F.regexp_replace(F.coalesce("_path", "image_path"), "^.*/", ""))), '" alt="', alt, '"/>'))
    figcaption = F.when(caption != "", _wrap("figcaption", caption)).otherwise("")
    noted = F.when(note != "", _cat('<p class="note">', note, "</p>")).otherwise("")
    classes = layout.layout_classes(F.col("hint"))
    figure = _cat('<figure class="', F.col("kind"), " ", classes, '">', figcaption, F.coalesce(picture, _lit("")), noted, "</figure>")
    table = _cat('<figure class="table ', classes, '">', figcaption, '<div class="table-wrap">', F.coalesce("_table", picture, _lit("")), "</div>", noted, "</figure>")
    listing = _cat("<pre><code", F.when(F.col("language").isNotNull(), _cat(' class="', text.code_class(F.col("language")), '"')).otherwise(""), ">", text.escape(F.coalesce("text", _lit(""))), "</code></pre>")
    code = F.when((caption != "") | (note != ""), _cat('<figure class="code-listing">', figcaption, listing, noted, "</figure>")).otherwise(listing)
    math = F.coalesce("_display", picture, _cat('<code class="math-unconverted">', text.escape(F.coalesce("latex", _lit(""))), "</code>"))
    kinds = {
        "page_break": page_mark(F.col("anchor"), F.col("label")), "heading": heading, "paragraph": _wrap("p", main), "display_math": _cat('<div class="math-display">', math, "</div>"), "code": code,
        "figure": figure, "chart": figure, "table": table,
        "list": F.when(F.col("ordered"), _wrap("ol", points)).when(F.col("ordered").isNull(), _wrap("ul", points, ' class="list-marker-preserved"')).otherwise(_wrap("ul", points)),
        "aside": _wrap("aside", _wrap("p", main)), "footnote": _cat('<aside epub:type="footnote" id="fn-', F.col("block_id"), '"><p>', main, "</p></aside>"), "index": _cat('<section epub:type="index"><ul>', points, "</ul></section>"),
        "unknown": F.when(F.coalesce("text", _lit("")) != "", _cat('<div class="unknown">', text.escape(F.col("text")), "</div>")).otherwise(F.coalesce(figure, _lit(""))),
    }
    xhtml = _lit("")
    for kind, made in kinds.items():
        xhtml = F.when(F.col("kind") == kind, made).otherwise(xhtml)
    lost = F.exists(F.arrays_zip(F.concat(own, captions, notes, F.flatten(items)).alias("x"), F.col("_math").alias("m")), lambda z: (z["x"]["kind"] == "inline_math") & z["m"].isNull())
    lost = lost | ((F.col("kind") == "display_math") & F.col("_display").isNull() & F.col("image_path").isNull())
    tests = [
        (lost, "MATH_UNCONVERTED"), ((F.col("kind") == "heading") & F.col("level").isNull(), "HEADING_LEVEL_FALLBACK"),
        (F.col("kind").isin("figure", "chart") & (plain(captions) == ""), "ACCESSIBILITY_EMPTY_ALT"), ((F.col("kind") == "unknown") & (F.coalesce("text", _lit("")) != ""), "UNKNOWN_BLOCK_RENDERED"),
    ]
    issues = F.filter(F.array(*[F.when(test, code_) for test, code_ in tests]), lambda x: x.isNotNull())
    anchor = F.when(F.col("kind") == "heading", _cat("h-", F.col("heading_no").cast("string"), "-", text.slug(plain(own)))).otherwise(F.col("anchor"))
    rows = rows.withColumn("anchor", anchor).withColumn("issues", issues)
    return rows.withColumn("xhtml", F.coalesce(xhtml, _lit(""))).drop("_math", "_table", "_display", "_path")


def documents(rendered: DataFrame) -> DataFrame:
    """``book_id, doc_id, href, title, xhtml, has_math``: a file for each document."""
    one = rendered.groupBy("book_id", "doc_id", "href").agg(
        F.min("seq").alias("first"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "xhtml"))), lambda x: x["xhtml"]), "\n").alias("body"),
        F.min_by(plain(F.col("inlines")), F.when(F.col("kind") == "heading", F.col("seq"))).alias("title"),
    )  # of a document, which split bounds
    title = F.coalesce("title", "doc_id")
    head = '<?xml version="1.0" encoding="UTF-8"?>\n<html xmlns="http://www.w3.org/1999/xhtml" xmlns:epub="http://www.idpf.org/2007/ops"><head><title>'
    page = _cat(head, text.escape(title), '</title><link rel="stylesheet" type="text/css" href="../styles/book.css"/></head><body>\n', F.col("body"), "\n</body></html>")
    return one.select("book_id", "doc_id", "href", "first", title.alias("title"), page.alias("xhtml"), F.contains("body", _lit("<math")).alias("has_math"))


def contents(rendered: DataFrame, titles: DataFrame | None = None) -> DataFrame:
    """``book_id, seq, title, href, level, parent_seq``: headings down to level 3. A book without any has one entry, its title, to its first document."""
    level = F.least(F.greatest(F.coalesce("level", _lit(2)), _lit(1)), _lit(6))
    rows = rendered.where("kind = 'heading'").withColumn("level", level).where(F.col("level") <= CONTENTS_LEVEL)
    title = F.coalesce(F.nullif(text.strip(plain(F.col("inlines"))), _lit("")), _lit("Section"))
    rows = contents_parent(rows.select("book_id", F.col("seq").cast("long").alias("seq"), title.alias("title"), _cat(F.col("href"), "#", F.col("anchor")).alias("href"), "level"), "book_id", "seq", "level")
    first = rendered.groupBy("book_id").agg(F.min_by("href", "seq").alias("href"), F.max((F.col("kind") == "heading") & (level <= CONTENTS_LEVEL)).alias("any")).where("not any")
    if titles is None:
        first = first.withColumn("title", _lit("Untitled Book"))
    else:
        first = first.join(titles.select("book_id", "title"), "book_id", "left")
    return rows.unionByName(first.select("book_id", _lit(0).cast("long").alias("seq"), F.coalesce("title", _lit("Untitled Book")).alias("title"), "href", _lit(1).alias("level"), _lit(None).cast("long").alias("parent_seq")))


def page_map(rendered: DataFrame, labelled: DataFrame) -> DataFrame:
    """``book_id, page_idx, label, target``: where each source page begins; those that nothing shows begin the first document."""
    breaks = rendered.where("kind = 'page_break'").select("book_id", "page_idx", "label", _cat(F.col("href"), "#", F.col("anchor")).alias("target"))
    inside = rendered.where("kind = 'paragraph'").select("book_id", "href", "seq", F.explode(F.filter("inlines", lambda x: x["kind"] == "page_boundary")).alias("b"))
    shown = labelled.select("book_id", "page_idx", text.scan_label(F.col("label"), F.col("page_idx")).alias("label"))
    inside = inside.join(shown.withColumnRenamed("label", "_l"), (inside["book_id"] == shown["book_id"]) & (F.col("b.text") == F.col("_l"))).select(inside["book_id"], "page_idx", F.col("_l").alias("label"), _cat(F.col("href"), "#", text.label_id(F.col("_l"), F.col("page_idx"))).alias("target"))
    known = breaks.unionByName(inside).dropDuplicates(["book_id", "page_idx"])
    first = rendered.groupBy("book_id").agg(F.min_by("href", "seq").alias("href"))
    rest = shown.join(known, ["book_id", "page_idx"], "left_anti").join(first, "book_id").select("book_id", "page_idx", "label", _cat(F.col("href"), "#", text.label_id(F.col("label"), F.col("page_idx"))).alias("target"))
    return known.unionByName(rest)


def render_counts(rendered: DataFrame) -> DataFrame:
    """``book_id`` and the numbers of figures, charts, tables, code, display and inline mathematics, and of fallbacks."""
    n = lambda kind: F.count_if(F.col("kind") == kind).alias(f"{kind}s" if kind != "code" else "code")
    inline = F.when(F.col("kind") == "paragraph", F.size(F.filter("inlines", lambda x: x["kind"] == "inline_math"))).otherwise(0)
    fallback = F.size(F.filter("issues", lambda x: x.rlike("FALLBACK|UNCONVERTED")))
    return rendered.groupBy("book_id").agg(*[n(k) for k in ("figure", "chart", "table", "code", "display_math")], F.sum(inline).alias("inline_math"), F.sum(fallback).alias("fallbacks"))


def metadata(rendered: DataFrame, given: DataFrame | None = None) -> DataFrame:
    """``book_id, title, language, identifier``: of each what was given, else what the blocks tell, else a default.

    ``given(book_id, title, language, identifier)``; blank values, and the language ``auto``, count as absent. The
    identifier follows from the book's key, so that it is the same each time.
    """
    words = plain(F.filter("inlines", lambda x: x["kind"] == "text"))
    h1 = F.when((F.col("kind") == "heading") & (F.col("level") == 1) & (text.strip(words) != ""), F.col("seq"))
    listed = F.array_sort(F.collect_list(F.when(F.col("kind").isin("paragraph", "heading"), F.struct("seq", F.left(words, _lit(10_000)).alias("t")))))
    found = rendered.groupBy("book_id").agg(F.min_by(text.strip(words), h1).alias("h1"), listed.alias("l"))  # of a book
    sample = F.left(F.array_join(F.transform("l", lambda x: x["t"]), ""), _lit(10_000))
    found = found.select("book_id", "h1", text.language(sample).alias("language"))
    clean = lambda c: F.nullif(text.strip(F.col(c)), _lit(""))
    if given is None:
        given = found.select("book_id", *[_lit(None).cast("string").alias(c) for c in ("title", "language", "identifier")])
    given = given.select("book_id", clean("title").alias("_t"), F.nullif(clean("language"), _lit("auto")).alias("_l"), clean("identifier").alias("_i"))
    digest = F.sha2(F.col("book_id").cast("string"), 256)
    uuid = _cat("urn:uuid:", *[x for i, (a, n) in enumerate(((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))) for x in ([_lit("-")] if i else []) + [F.substring(digest, a, n)]])
    return found.join(given, "book_id", "left").select("book_id", F.coalesce("_t", "h1", _lit("Untitled Book")).alias("title"), F.coalesce("_l", "language").alias("language"), F.coalesce("_i", uuid).alias("identifier"))
