"""Chapters, and parts of bounded size, of books.

Only a few numbers a block go to Python, by book: where a group is cut depends on where the one before was, and a cut
may lie behind the block that makes the group too large.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .adapter import plain

#: Characters and source pages of a part, at most.
MOST_CHARS, MOST_PAGES = 100_000, 50

Block = tuple[str, int, int, list[int]]  # kind, level, characters, pages


def char_count(kind: Column) -> Column:
    """Characters of a block: of the text of its inlines, its code, markup or LaTeX; others have none."""
    n = lambda x: F.coalesce(F.length(x), F.lit(0))
    prose = n(plain(F.filter("inlines", lambda x: x["kind"] == "text")))
    listed = F.aggregate(F.coalesce("items", F.array().cast("array<array<struct<kind:string,text:string,latex:string>>>")), F.lit(0), lambda a, x: a + F.coalesce(F.length(plain(F.filter(x, lambda y: y["kind"] == "text"))), F.lit(0)))
    return F.when(kind.isin("heading", "paragraph", "aside", "footnote"), prose).when(kind.isin("list", "index"), listed).when(kind == "code", n(F.col("text"))).when(kind == "unknown", n(F.col("text"))).when(kind == "table", n(F.col("html"))).when(kind == "display_math", n(F.col("latex"))).otherwise(0)


def block_pages(sources: Column, page_idx: Column) -> Column:
    """The different pages that a block comes from."""
    return F.array_distinct(F.coalesce(F.transform(sources, lambda s: s["page_idx"]), F.array(page_idx)))


def page_span(pages: Column) -> Column:
    return F.coalesce(F.array_max(pages) - F.array_min(pages) + 1, F.lit(0))


def chapters_of(blocks: list[Block]) -> list[tuple[bool, int, int]]:
    """(whether it lies before the first chapter, first block, block after the last) of each chapter.

    A page break right before a level-1 heading goes with it. What lies before the first such heading is matter of its
    own, if it holds more than page breaks; else it goes with the first chapter.
    """
    opens = [i for i, (kind, level, _, _) in enumerate(blocks) if kind == "heading" and level == 1]
    starts = [i - 1 if i and blocks[i - 1][0] == "page_break" else i for i in opens]
    if not starts:
        return [(True, 0, len(blocks))] if any(b[0] != "page_break" for b in blocks) else [(False, 0, len(blocks))]
    out = list(zip([False] * len(starts), starts, [*starts[1:], len(blocks)], strict=True))
    if any(b[0] != "page_break" for b in blocks[: starts[0]]):
        return [(True, 0, starts[0]), *out]
    return [(False, 0, out[0][2]), *out[1:]]


def cuts(blocks: list[Block], most_chars: int = MOST_CHARS, most_pages: int = MOST_PAGES) -> list[int]:
    """Where a chapter is cut: before the nearest level-2 heading behind the block that makes a part too large, else before
    that block, and before a page break that stands there. Where that is the very start, the rest stays whole."""
    out, todo = [], [(0, len(blocks))]
    while todo:
        start, stop = todo.pop()
        chars, low, high = 0, None, None
        for i in range(start, stop):
            chars += blocks[i][2]
            for p in blocks[i][3]:
                low, high = p if low is None else min(low, p), p if high is None else max(high, p)
            if i > start and (chars > most_chars or (low is not None and high - low + 1 > most_pages)):
                at = next((k for k in range(i, start, -1) if blocks[k][0] == "heading" and blocks[k][1] == 2), i)
                if blocks[at - 1][0] == "page_break":
                    at -= 1
                if at > start:
                    out.append(at)
                    todo += [(start, at), (at, stop)]
                break
    return sorted(out)


def sections_of(blocks: list[Block], most_chars: int = MOST_CHARS, most_pages: int = MOST_PAGES) -> list[str]:
    """The name of the part of each block: ``frontmatter``, if that is one part, and numbered parts."""
    out, number = [], 0
    for front, a, b in chapters_of(blocks):
        at = [0, *cuts(blocks[a:b], most_chars, most_pages), b - a]
        for x, y in zip(at[:-1], at[1:], strict=True):
            if front and len(at) == 2:
                name = "frontmatter"
            else:
                number += 1
                name = f"part-{number:04d}"
            out += [name] * (y - x)
    return out


def split(blocks: DataFrame, most_chars: int = MOST_CHARS, most_pages: int = MOST_PAGES) -> DataFrame:
    """``doc_id`` and ``href`` of each block of ``blocks(book_id, seq, kind, level, chars, pages)``, all other columns kept."""

    def run(book: pd.DataFrame) -> pd.DataFrame:
        book = book.sort_values("seq")
        rows = [(k, -1 if pd.isna(v) else int(v), int(c), [int(p) for p in q]) for k, v, c, q in zip(book["kind"], book["level"], book["chars"], book["pages"], strict=True)]
        return pd.DataFrame({"book_id": book["book_id"], "seq": book["seq"], "doc_id": sections_of(rows, most_chars, most_pages)})

    kind = blocks.schema["book_id"].dataType.simpleString()
    found = blocks.select("book_id", "seq", "kind", "level", "chars", "pages").groupBy("book_id").applyInPandas(run, f"book_id {kind}, seq long, doc_id string")
    return blocks.join(found, ["book_id", "seq"]).withColumn("href", F.concat(F.lit("text/"), "doc_id", F.lit(".xhtml")))


def measured(blocks: DataFrame) -> DataFrame:
    """Adds ``chars`` and ``pages``, which split needs."""
    return blocks.withColumns({"chars": char_count(F.col("kind")), "pages": block_pages(F.col("sources"), F.col("page_idx"))})
