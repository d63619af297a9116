"""How much of a book's source is in what was rendered: counts, five checks, ten metrics. A row a book throughout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.middle import pages, spans_of
from .adapter import plain
from .sequence import heading_jumps

#: Types of blocks that a reader would miss. Fixed values; ``strict`` takes the name that equations really have.
MEANINGFUL = ("title", "text", "image", "chart", "table", "code", "equation_interline", "list", "index")
MEANINGFUL_STRICT = tuple(t if t != "equation_interline" else "interline_equation" for t in MEANINGFUL)
#: Share of the source's blocks that must be there.
LEAST = 0.7


def source_counts(books: DataFrame, strict: bool = False) -> DataFrame:
    """``book_id, pages, meaningful, titles, codes, tables, figures, captions, math, inline_math`` of the sources."""
    rows = pages(books).select("book_id", "page_no", F.explode_outer("page.para_blocks").alias("b"))
    type_ = F.col("b.type")
    of = lambda *t: F.count_if(type_.isin(*t))
    inline = F.size(F.filter(spans_of(F.col("b")), lambda s: s["type"] == "inline_equation"))
    captions = F.size(F.filter("b.blocks", lambda s: F.contains(s["type"], F.lit("caption")))) if strict else F.lit(0)
    counted = rows.groupBy("book_id").agg(
        F.count_distinct("page_no").alias("pages"), of(*(MEANINGFUL_STRICT if strict else MEANINGFUL)).alias("meaningful"), of("title").alias("titles"), of("code").alias("codes"), of("table").alias("tables"),
        of("image", "chart").alias("figures"), F.sum(F.greatest(F.coalesce(captions, F.lit(0)), F.lit(0))).alias("captions"), of("interline_equation").alias("math"), F.sum(F.greatest(F.coalesce(inline, F.lit(0)), F.lit(0))).alias("inline_math"),
    )
    return books.select("book_id").join(counted, "book_id", "left").fillna(0)


def rendered_counts(rendered: DataFrame, strict: bool = False) -> DataFrame:
    """``book_id, blocks, unknown, codes_out, tables_out, figures_out, captions_out, math_out, math_lost, headings, known, jumps, wrong_levels``."""
    kind = F.col("kind")
    n = lambda c: F.count_if(c)
    jumps = heading_jumps(rendered.where("kind = 'heading'").select("book_id", "seq", "level"), "book_id", "seq", "level").groupBy("book_id").agg(F.count_if("jump").alias("jumps"))
    lost = F.exists("issues", lambda x: x == "MATH_UNCONVERTED")
    out = rendered.groupBy("book_id").agg(
        (n(kind != "page_break") if strict else F.count("*")).alias("blocks"), n(kind == "unknown").alias("unknown"), n(kind == "code").alias("codes_out"), n(kind == "table").alias("tables_out"),
        n(kind.isin("figure", "chart")).alias("figures_out"), n(plain(F.col("captions")) != "").alias("captions_out"), n(kind == "display_math").alias("math_out"), n((kind == "display_math") & lost).alias("math_lost"),
        n(kind == "heading").alias("headings"), n((kind == "heading") & F.col("level").isNotNull()).alias("known"), n((kind == "heading") & ~F.coalesce("level", F.lit(1)).between(1, 6)).alias("wrong_levels"),
    )
    return out.join(jumps, "book_id", "left").fillna(0)


def _rate(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(F.least(F.lit(1.0), F.greatest(part, F.lit(0)) / whole), 4)).otherwise(F.lit(1.0))


def checks(source: DataFrame, out: DataFrame) -> DataFrame:
    """``book_id, check, passed`` of the five checks; a book of which nothing was rendered counts as one without blocks."""
    rows = source.join(out, "book_id", "left").fillna(0)
    mapped = F.col("blocks") - F.col("unknown")
    tests = {
        "content_loss": (F.col("meaningful") == 0) | (mapped >= LEAST * F.col("meaningful")), "math": (F.col("math") == 0) | (F.col("math_out") >= F.col("math")), "tables": F.col("tables_out") >= F.col("tables"),
        "code": F.col("codes_out") >= F.col("codes"), "headings": (F.col("wrong_levels") == 0) & (F.col("jumps") == 0),
    }
    return rows.select("book_id", F.explode(F.array(*[F.struct(F.lit(k).alias("check"), v.alias("passed")) for k, v in tests.items()])).alias("c")).select("book_id", "c.*")


def metrics(source: DataFrame, out: DataFrame, issues: DataFrame | None = None) -> DataFrame:
    """``book_id`` and the ten metrics: rates are 1 where the source has nothing; ``errors`` counts fatal issues and errors."""
    rows = source.join(out, "book_id", "left").fillna(0)
    if issues is not None:
        bad = issues.where("severity in ('FATAL', 'ERROR')").groupBy("book_id").agg(F.count("*").alias("errors"))
        rows = rows.join(bad, "book_id", "left").fillna(0, ["errors"])
    else:
        rows = rows.withColumn("errors", F.lit(0).cast("long"))
    c = F.col
    return rows.select(
        "book_id", _rate(c("blocks") - c("unknown"), c("meaningful")).alias("block_coverage"), _rate(c("math_out") - c("math_lost"), c("math_out")).alias("math_semantic_rate"), _rate(c("tables_out"), c("tables")).alias("table_semantic_rate"),
        _rate(c("codes_out"), c("codes")).alias("code_text_rate"), _rate(c("captions_out"), c("captions")).alias("caption_retention"), _rate(c("known"), c("headings")).alias("heading_level_known_rate"), c("unknown").alias("unknown_blocks"),
        F.round(c("unknown") * 100.0 / F.greatest(c("pages"), F.lit(1)), 2).alias("unknown_per_100_pages"), c("math_lost").alias("math_fallbacks"), "errors",
    )


def page_report(labelled: DataFrame, rendered: DataFrame, targets: DataFrame) -> DataFrame:
    """``book_id, page_idx, label, confidence, block_ids, target`` of each page, pages without blocks too."""
    own = rendered.where("kind != 'page_break'").groupBy("book_id", F.coalesce(F.get("sources", F.lit(0))["page_idx"], F.lit(0)).alias("page_idx")).agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "block_id"))), lambda x: x["block_id"]).alias("block_ids"))
    rows = labelled.select("book_id", "page_idx", "label", "confidence").join(own, ["book_id", "page_idx"], "left").join(targets.select("book_id", "page_idx", "target"), ["book_id", "page_idx"], "left")
    return rows.withColumn("block_ids", F.coalesce("block_ids", F.array().cast("array<string>")))
