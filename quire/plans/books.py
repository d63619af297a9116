"""Books from nested page JSON to packages: the whole way, as one set of DataFrames over any number of books."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from ..operators import adapter, normalize, quality, render, splitter, validate
from ..sinks import package
from ..sources import archives, middle
from .workspace import Workspace


class ConversionError(Exception):
    """What went wrong in a stage, for those who want an exception; tables of issues say it of all books at once."""

    def __init__(self, stage: str, message: str, details: dict | None = None):
        super().__init__(f"[{stage}] {message}")
        self.stage, self.details = stage, details or {}


@dataclass(frozen=True)
class Settings:
    most_chars: int = splitter.MOST_CHARS
    most_pages: int = splitter.MOST_PAGES
    heading_mode: str = "code"
    legacy_lists: bool = False
    strict: bool = False
    modified: str = package.EPOCH

    def __post_init__(self) -> None:
        if self.most_chars < 1 or self.most_pages < 1:
            raise ConversionError("settings", "limits of parts must be positive")
        if self.heading_mode not in ("code", "spec"):
            raise ConversionError("settings", "heading_mode is code or spec")


@dataclass
class Conversion:
    """Each attribute is a table with ``book_id``; none is computed before it is asked for. Those that others are made of
    are written to the workspace first, so that no plan holds the whole way, and no stage is done twice.

    ``books`` is what middle.parse_middle gives; ``files(book_id, path, content)`` are their pictures; ``labels`` and
    ``given`` as in normalize.page_labels and render.metadata. Books whose root has an error are left out: see ``rejected``.
    """

    books: DataFrame
    files: DataFrame | None = None
    labels: DataFrame | None = None
    given: DataFrame | None = None
    settings: Settings = Settings()
    folder: str | None = None

    @cached_property
    def workspace(self) -> Workspace:
        return Workspace(self.books.sparkSession, self.folder, "books")

    @cached_property
    def root_issues(self) -> DataFrame:
        return middle.root_issues(self.books)

    @cached_property
    def rejected(self) -> DataFrame:
        return self.root_issues.where("severity = 'ERROR'").select("book_id").distinct()

    @cached_property
    def accepted(self) -> DataFrame:
        return self.workspace.table("accepted", self.books.join(self.rejected, "book_id", "left_anti"))

    @cached_property
    def labelled(self) -> DataFrame:
        return self.workspace.table("labelled", normalize.page_labels(middle.pages(self.accepted), self.labels))

    @cached_property
    def raw_blocks(self) -> DataFrame:
        return self.workspace.table("raw_blocks", adapter.blocks(self.accepted, self.settings.legacy_lists))

    @cached_property
    def blocks(self) -> DataFrame:
        """In order, in documents, not yet rendered. Tables without content are left out: they are among the warnings."""
        found = normalize.normalize(self.raw_blocks.where("error is null"), self.labelled, self.settings.heading_mode)
        measured = self.workspace.table("normalized", splitter.measured(found))
        return self.workspace.table("blocks", splitter.split(measured, self.settings.most_chars, self.settings.most_pages))

    @cached_property
    def assets(self) -> DataFrame | None:
        if self.files is None:
            return None
        hashed = self.files.select("book_id", "path", F.sha2("content", 256).alias("sha256"), F.octet_length("content").alias("byte_size"))
        return self.workspace.table("assets", adapter.assets(self.raw_blocks, hashed))

    @cached_property
    def rendered(self) -> DataFrame:
        return self.workspace.table("rendered", render.fragments(render.numbered(self.blocks), self.assets))

    @cached_property
    def warnings(self) -> DataFrame:
        own = self.rendered.select("book_id", "page_idx", "block_id", F.explode("issues").alias("code"), F.lit(None).cast("string").alias("message"))
        levels = normalize.level_warnings(normalize.levels(self.raw_blocks, self.settings.heading_mode))
        return adapter.warnings(self.raw_blocks).unionByName(levels).unionByName(own)

    @cached_property
    def metadata(self) -> DataFrame:
        return self.workspace.table("metadata", render.metadata(self.rendered, self.given))

    @cached_property
    def documents(self) -> DataFrame:
        return self.workspace.table("documents", render.documents(self.rendered))

    @cached_property
    def contents(self) -> DataFrame:
        return render.contents(self.rendered, self.metadata)

    @cached_property
    def page_map(self) -> DataFrame:
        return render.page_map(self.rendered, self.labelled)

    @cached_property
    def entries(self) -> DataFrame:
        return package.entries(self.metadata, self.documents, self.contents, self.page_map, self.assets, self.files, self.settings.modified)

    @cached_property
    def archives(self) -> DataFrame:
        return self.workspace.table("archives", package.archives(self.entries, self.settings.modified))

    @cached_property
    def issues(self) -> DataFrame:
        """Of the archives as they were written, which are read again for it."""
        entries = self.workspace.table("entries", archives.unpack(self.archives))
        return validate.issues(entries, self.workspace.table("parsed", validate.parse_xml(entries)))

    @cached_property
    def verdicts(self) -> DataFrame:
        return validate.verdicts(self.issues, self.metadata, self.settings.strict)

    @cached_property
    def checks(self) -> DataFrame:
        return quality.checks(quality.source_counts(self.accepted, self.settings.strict), quality.rendered_counts(self.rendered, self.settings.strict))

    @cached_property
    def metrics(self) -> DataFrame:
        return quality.metrics(quality.source_counts(self.accepted, self.settings.strict), quality.rendered_counts(self.rendered, self.settings.strict))

    @cached_property
    def page_report(self) -> DataFrame:
        return quality.page_report(self.labelled, self.rendered, self.page_map)

    @cached_property
    def summary(self) -> DataFrame:
        """A row a book: title, language, pages, documents, blocks, headings, warnings."""
        counted = self.rendered.groupBy("book_id").agg(F.count_distinct("doc_id").alias("documents"), F.count("*").alias("blocks"), F.count_if(F.col("kind") == "heading").alias("headings"), F.sum(F.size("issues")).alias("warnings"))
        return self.metadata.join(middle.source_books(self.accepted).select("book_id", "page_count"), "book_id", "left").join(counted, "book_id").withColumn("title", strip(F.col("title")))
