"""Queries over whole books. A conversation stands in for a book: its turns are blocks, three to a page, written as nested
page JSON and read back through the source, so that each query goes the way that real documents go."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import batches, markup
from ..operators import adapter, normalize, quality, splitter, validate
from ..sources import middle
from .books import Conversion
from .catalogue import query, read
from .workspace import Workspace

#: Type of a turn's block, in words that both engines read.
_TYPE = "case when role = 'user' then 'title' when role = 'system' then 'aside_text' when turn % 11 = 7 then 'list' when turn % 11 = 9 then 'code' when turn % 11 = 10 then 'interline_equation' when turn % 13 = 12 then 'odd' else 'text' end"
_KIND = "case type when 'title' then 'heading' when 'aside_text' then 'aside' when 'interline_equation' then 'display_math' when 'text' then 'paragraph' when 'odd' then 'unknown' else type end"
_ROWS = f"(select conv_id, turn, role, coalesce(text, '') as text, {_TYPE} as type, case when role = 'user' and turn % 2 = 0 then 1 + turn % 3 end as level, row_number() over (partition by conv_id order by turn) - 1 as i from {{conversations}})"
#: What DuckDB makes of a piece of prose.
_PROSE = "trim(regexp_replace(trim(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), ' ' || chr(9) || chr(10)), '[ \\t]+', ' ', 'g'))"


def conversation_books(spark, sf_dir) -> DataFrame:
    """``book_id``, and the fields of nested page JSON, of each conversation."""
    rows = spark.sql("select * from " + _ROWS, conversations=read(spark, sf_dir, "conversations"))
    span = F.struct(F.when(F.col("type") == "interline_equation", "interline_equation").otherwise("text").alias("type"), F.col("text").alias("content"))
    block = F.struct(F.col("type"), F.col("level").cast("int").alias("level"), F.array(F.struct(F.array(span).alias("spans"))).alias("lines"))
    pages = rows.groupBy("conv_id", (F.col("i") / 3).cast("int").alias("p")).agg(F.array_sort(F.collect_list(F.struct("i", block.alias("b")))).alias("b"))
    page = F.struct(F.col("p").alias("page_idx"), F.array(F.lit(1000.0), F.lit(1400.0)).alias("page_size"), F.transform("b", lambda x: x["b"]).alias("para_blocks"))
    books = pages.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("p", page.alias("page")))), lambda x: x["page"]).alias("pdf_info"))
    raw = F.to_json(F.struct(F.lit("3.4.5").alias("_version_name"), F.lit("hybrid").alias("_backend"), F.lit("high").alias("_effort"), "pdf_info"))
    return middle.parse_middle(books.select(F.col("conv_id").alias("book_id"), raw.alias("raw")), "raw").drop("raw")


def _oracle(sql: str) -> str:
    return sql.replace("{rows}", _ROWS.format(conversations="conversations"))


@query(_oracle(f"""select conv_id as book_id, 'blk-' || lpad(cast(i + 1 as varchar), 5, '0') as block_id, {_KIND} as kind, cast(level as integer) as level,
    case when type in ('title', 'text', 'aside_text') then {_PROSE} when type = 'list' then '- ' || {_PROSE} when type = 'odd' then {_PROSE} when type = 'code' then text end as body
    from {{rows}} where not (type in ('text') and {_PROSE} = '') and type <> 'interline_equation'"""))
def book_blocks(spark, sf_dir):
    found = adapter.blocks(conversation_books(spark, sf_dir)).where("kind != 'display_math'")
    body = F.when(F.col("kind") == "list", F.concat(F.lit("- "), adapter.plain(F.flatten("items")))).when(F.col("kind").isin("code", "unknown"), F.col("text")).otherwise(adapter.plain(F.col("inlines")))
    return found.select("book_id", "block_id", "kind", "level", body.alias("body"))


_EDGES = f"""(select *, {_PROSE} as t, i // 3 as p, row_number() over (partition by conv_id, i // 3 order by i) as a, row_number() over (partition by conv_id, i // 3 order by i desc) as z from {{rows}} where not (type = 'text' and {_PROSE} = ''))"""
_MERGED = f"""(select n.conv_id, n.p, coalesce(f.type = 'text' and l.type = 'text' and not contains('.!?。！？」』:', right(l.t, 1)) and (regexp_matches(f.t, '^[a-z,、，]') or ends_with(l.t, '-')), false) as merged
    from (select distinct conv_id, i // 3 as p from {{rows}}) n left join {_EDGES} f on f.conv_id = n.conv_id and f.p = n.p and f.a = 1 left join {_EDGES} l on l.conv_id = n.conv_id and l.p = n.p - 1 and l.z = 1)"""


@query(_oracle(f"select conv_id as book_id, cast(p as integer) as page_no, merged from {_MERGED}"))
def book_merges(spark, sf_dir):
    books = conversation_books(spark, sf_dir)
    return normalize.merged_pages(adapter.blocks(books), normalize.page_labels(middle.pages(books)))


@query(_oracle(f"""select b.conv_id as book_id, b.n + p.n as blocks, p.n as breaks from (select conv_id, count(*) as n from {_EDGES} group by conv_id) b
    join (select conv_id, count(*) filter (where not merged) - count(*) filter (where merged) as x, count(*) filter (where not merged) as n, count(*) filter (where merged) as m from {_MERGED} group by conv_id) p on p.conv_id = b.conv_id and p.m = 0
    union all select b.conv_id, b.n + p.n - p.m, p.n from (select conv_id, count(*) as n from {_EDGES} group by conv_id) b join (select conv_id, count(*) filter (where not merged) as n, count(*) filter (where merged) as m from {_MERGED} group by conv_id) p on p.conv_id = b.conv_id and p.m > 0"""))
def book_sequence(spark, sf_dir):
    books = conversation_books(spark, sf_dir)
    found = normalize.normalize(adapter.blocks(books), normalize.page_labels(middle.pages(books)))
    return found.groupBy("book_id").agg(F.count("*").alias("blocks"), F.count_if(F.col("kind") == "page_break").alias("breaks"))


@query(_oracle("""select conv_id as book_id, type, count(*) as n from {rows} group by 1, 2"""))
def book_block_types(spark, sf_dir):
    return middle.block_types(conversation_books(spark, sf_dir))


@query(_oracle(f"""select conv_id as book_id, count(distinct i // 3) as pages, count(*) filter (where type in ('title', 'text', 'image', 'chart', 'table', 'code', 'list', 'index')) as meaningful, count(*) filter (where type = 'title') as titles,
    count(*) filter (where type = 'code') as codes, count(*) filter (where type = 'interline_equation') as math from {{rows}} group by 1"""))
def book_source_counts(spark, sf_dir):
    return quality.source_counts(conversation_books(spark, sf_dir)).select("book_id", "pages", "meaningful", "titles", "codes", "math")


@query()
def book_sections(spark, sf_dir):
    """Parts of 3000 characters at most; tests/test_books.py holds the splitter against cases of each rule."""
    books = conversation_books(spark, sf_dir)
    found = normalize.normalize(adapter.blocks(books), normalize.page_labels(middle.pages(books)))
    measured = Workspace(spark).table("measured", splitter.measured(found).select("book_id", "seq", "kind", "level", "chars", "pages"))
    return splitter.split(measured, most_chars=3000).select("book_id", "seq", "kind", "chars", "doc_id")


@query(_oracle("select distinct conv_id as book_id, cast(0 as bigint) as fatal, cast(0 as bigint) as error, true as valid from {rows}"))
def book_packages(spark, sf_dir):
    """The whole way: JSON, blocks, documents, archives, which are read again and tested. Every package must be valid."""
    return Conversion(conversation_books(spark, sf_dir)).verdicts.select("book_id", "fatal", "error", "valid")


@query()
def book_metrics(spark, sf_dir):
    return Conversion(conversation_books(spark, sf_dir)).metrics


@query()
def html_tables(spark, sf_dir):
    """The first table of each page as XML that is safe to show; null without one."""
    batches.bound_batches(spark)
    return read(spark, sf_dir, "pages").select("page_id", markup.sanitize_table("html").alias("markup"))


@query("""select page_id as book_id, n as broken from (select page_id, 1 as n from pages where contains(html, '<script'))""".replace("1 as n", "cast(1 as bigint) as n"))
def entry_scripts(spark, sf_dir):
    """Rule V-11 over pages, each as the one text of a package; where a page can't be read as XML, its markup is searched."""
    pages = read(spark, sf_dir, "pages").select(F.col("page_id").alias("book_id"), "html")
    entries = pages.select("book_id", F.lit("a.xhtml").alias("name"), F.encode("html", "UTF-8").alias("content"))
    parsed = validate.parse_xml(entries)
    tags = parsed.select("book_id", F.exists("nodes", lambda n: F.lower(n["tag"]) == "script").alias("s"), F.col("broken").isNotNull().alias("b"))
    found = tags.join(pages, "book_id").where(F.col("s") | (F.col("b") & F.contains("html", F.lit("<script"))))
    return found.select("book_id", F.lit(1).cast("long").alias("broken"))
