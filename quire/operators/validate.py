"""Rules that a package keeps. Each is a DataFrame of issues, so all books are tested at once: ``book_id, rule, severity, file, message``.

XML goes through Python once, in lots, which lists what stands in it; the rules are joins and filters over that.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import batches, text

MIMETYPE = "application/epub+zip"
CONTAINER = "META-INF/container.xml"
MATHML = "http://www.w3.org/1998/Math/MathML"
SEVERITIES = ("FATAL", "ERROR", "WARNING", "INFO")
PARSED = "name string, broken string, nodes array<struct<tag:string,space:string,attributes:map<string,string>>>"


def _issue(rows: DataFrame, rule: str, message: Column | str, file: Column | None = None, severity: str = "ERROR") -> DataFrame:
    message = F.lit(message) if isinstance(message, str) else message
    return rows.select("book_id", F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), (F.lit(None).cast("string") if file is None else file).alias("file"), message.alias("message"))


class _Nodes:
    """Takes a parser's elements as columns, in the order of the document; no tree is kept."""

    def __init__(self) -> None:
        self.tags, self.spaces, self.keys, self.values = [], [], [], []
        self.of_node, self.of_entry = [0], [0]  # where each one's attributes, and nodes, end

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        space, _, tag = tag[1:].partition("}") if tag.startswith("{") else ("", "", tag)
        named = {k.rpartition("}")[2]: v for k, v in attributes.items()}
        self.tags.append(tag)
        self.spaces.append(space)
        self.keys += named
        self.values += named.values()
        self.of_node.append(len(self.keys))

    def close(self) -> None:
        """The target of a parser must have one."""

    def read(self, content: bytes) -> str | None:
        """Adds an entry; why it can't be read, if so, and then it has no nodes."""
        try:
            parser = ET.XMLParser(target=self)
            parser.feed(content)
            parser.close()
            error = None
        except ET.ParseError as e:
            error, n = str(e), self.of_entry[-1]
            del self.tags[n:], self.spaces[n:], self.of_node[n + 1 :], self.keys[self.of_node[n] :], self.values[self.of_node[n] :]
        self.of_entry.append(len(self.tags))
        return error

    def column(self) -> pa.Array:
        offsets = lambda x: pa.array(x, pa.int32())
        words = lambda x: pa.array(x, pa.string())
        attributes = pa.MapArray.from_arrays(offsets(self.of_node), words(self.keys), words(self.values))
        return pa.ListArray.from_arrays(offsets(self.of_entry), pa.StructArray.from_arrays([words(self.tags), words(self.spaces), attributes], ["tag", "space", "attributes"]))


def parse_xml(entries: DataFrame) -> DataFrame:
    """``book_id, name, broken, nodes`` of each XML entry: why it can't be read, or its elements with their attributes, in order.

    A worker holds the elements of a lot of entries at once, as columns."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            content = batch.column("content")
            for a, b in batches.lots(pc.binary_length(content).to_pylist()):
                nodes = _Nodes()
                broken = [nodes.read(x.as_py()) for x in content[a:b]]
                yield pa.RecordBatch.from_arrays([batch.column("book_id")[a:b], batch.column("name")[a:b], pa.array(broken, pa.string()), nodes.column()], ["book_id", "name", "broken", "nodes"])

    batches.bound_batches(entries.sparkSession)
    xml = entries.where(F.col("content").isNotNull() & F.lower("name").rlike(r"\.(xml|opf|xhtml|html|htm|ncx)$"))
    return xml.select("book_id", "name", "content").mapInArrow(run, f"book_id {entries.schema['book_id'].dataType.simpleString()}, {PARSED}")


def resolve(base: Column, path: Column) -> Column:
    """A path as seen from the file ``base``, from the root of the archive."""
    folder = F.regexp_extract(base, "^(.*/)", 1)
    return text.normal_path(F.concat(folder, path))


def package_of(parsed: DataFrame) -> DataFrame:
    """``book_id, opf``: the package document that the container names."""
    roots = parsed.where(F.col("name") == CONTAINER).select("book_id", F.filter("nodes", lambda n: n["tag"] == "rootfile").alias("r"))
    return roots.select("book_id", F.get("r", F.lit(0))["attributes"]["full-path"].alias("opf"))


def manifest_of(parsed: DataFrame, packages: DataFrame) -> DataFrame:
    """``book_id, opf, item_id, file, media_type, properties`` of each item; file is seen from the root."""
    rows = parsed.join(packages, "book_id").where(F.col("name") == F.col("opf"))
    items = rows.select("book_id", "opf", F.explode(F.filter("nodes", lambda n: n["tag"] == "item")).alias("n")).select("book_id", "opf", F.col("n.attributes").alias("a"))
    return items.select("book_id", "opf", F.col("a")["id"].alias("item_id"), resolve(F.col("opf"), F.coalesce(F.col("a")["href"], F.lit(""))).alias("file"), F.col("a")["media-type"].alias("media_type"), F.split(F.coalesce(F.col("a")["properties"], F.lit("")), r"\s+").alias("properties"))


def issues(entries: DataFrame, parsed: DataFrame | None = None) -> DataFrame:
    """All issues of ``entries(book_id, ord, name, method, content, error)``.

    Entries and ``parsed`` (what parse_xml gives) are read by each rule, so give tables that are written. Where the archive, its container or its package document can't be read, the rules that need them find nothing more.
    Books without entries are unknown here: list them by archives.unpack, which gives a row for a missing one.
    """
    parsed = parse_xml(entries) if parsed is None else parsed
    files = entries.where("name is not null").select("book_id", "name").distinct()
    at_first = entries.where("ord = 0")
    first_is = at_first.where(F.col("name") == "mimetype")
    books = entries.where("ord >= 0").select("book_id").distinct()
    named = parsed.where(F.col("name") == CONTAINER)
    packages = package_of(parsed)
    manifest = manifest_of(parsed, packages)
    found_opf = packages.where("opf is not null").join(files, (packages["book_id"] == files["book_id"]) & (F.col("opf") == F.col("name")), "left_semi")
    opf = parsed.join(packages, "book_id").where(F.col("name") == F.col("opf"))
    spine = opf.select("book_id", "opf", F.explode(F.filter("nodes", lambda n: n["tag"] == "itemref")).alias("n")).select("book_id", "opf", F.col("n.attributes")["idref"].alias("item_id"))
    nav = manifest.groupBy("book_id").agg(F.count_if(F.array_contains("properties", "nav")).alias("n")).where("n != 1")

    texts = manifest.where("media_type = 'application/xhtml+xml'").select("book_id", F.col("file").alias("name"), "properties").dropDuplicates(["book_id", "name"])
    docs = parsed.join(texts, ["book_id", "name"])
    nodes = docs.where("broken is null").select("book_id", "name", "properties", F.explode("nodes").alias("n")).select("book_id", "name", "properties", "n.*")
    ids = nodes.select("book_id", "name", F.col("attributes")["id"].alias("id")).where("id is not null")
    handlers = nodes.select("book_id", "name", "tag", F.explode(F.filter(F.map_keys("attributes"), lambda k: F.startswith(F.lower(k), F.lit("on")))).alias("k"))
    sources = nodes.select("book_id", "name", F.col("attributes")["src"].alias("src")).where("src is not null")
    remote = F.col("src").rlike("^(?i)(https?:|//)")
    local = sources.where(~remote & ~F.startswith("src", F.lit("data:"))).withColumn("file", resolve(F.col("name"), F.col("src")))
    links = nodes.where("tag = 'a'").select("book_id", "name", F.col("attributes")["href"].alias("href")).where(F.col("href").isNotNull() & ~text.is_external(F.col("href")))
    links = links.withColumn("to", text.href_parts(F.col("href")))
    links = links.select("book_id", "name", "href", F.when(F.col("to.document") == "", F.col("name")).otherwise(resolve(F.col("name"), F.col("to.document"))).alias("file"), F.nullif("to.fragment", F.lit("")).alias("id"))
    known = files.withColumnRenamed("name", "file")
    anchors = parsed.where("broken is null").select("book_id", F.col("name").alias("file"), F.explode("nodes").alias("n")).select("book_id", "file", F.col("n.attributes")["id"].alias("id")).where("id is not null").distinct()
    # a fragment can be missing only in a document that is there and can be read
    into = links.where("id is not null").join(parsed.where("broken is null").select("book_id", F.col("name").alias("file")), ["book_id", "file"], "left_semi")
    quoted = lambda column, *words: F.concat_ws(" ", F.coalesce(F.col(column), F.lit("?")), *[F.lit(w) for w in words])

    parts = [
        _issue(entries.where("error = 'missing'"), "V-01", "the file is missing", severity="FATAL"),
        _issue(at_first.where("name != 'mimetype' or name is null"), "V-02", "the first entry isn't mimetype", F.col("name")),
        _issue(first_is.where("method != 0"), "V-02", "mimetype is compressed", F.col("name")),
        _issue(first_is.where(F.decode("content", "ISO-8859-1") != MIMETYPE), "V-02", "mimetype holds something else", F.col("name")),
        _issue(entries.where(F.contains("name", F.lit("\\"))), "V-03", "a backslash in a name", F.col("name")),
        _issue(books.join(files.where(F.col("name") == CONTAINER), "book_id", "left_anti"), "V-04", "no container", F.lit(CONTAINER), "FATAL"),
        _issue(named.where("broken is not null"), "V-04", F.concat(F.lit("the container can't be read: "), F.col("broken")), F.lit(CONTAINER)),
        _issue(packages.join(named.where("broken is null"), "book_id", "left_semi").where("opf is null"), "V-04", "no rootfile", F.lit(CONTAINER)),
        _issue(packages.where("opf is not null").join(found_opf, "book_id", "left_anti"), "V-04", "the rootfile is missing", F.col("opf")),
        _issue(opf.where("broken is not null"), "V-05", F.concat(F.lit("the package can't be read: "), F.col("broken")), F.col("opf"), "FATAL"),
        _issue(manifest.join(known, ["book_id", "file"], "left_anti"), "V-06", quoted("item_id", "isn't in the archive"), F.col("file")),
        _issue(nav, "V-07", F.concat(F.col("n").cast("string"), F.lit(" items with the property nav"))),
        _issue(spine.join(manifest, ["book_id", "item_id"], "left_anti"), "V-08", quoted("item_id", "isn't in the manifest"), F.col("opf")),
        _issue(ids.groupBy("book_id", "name", "id").count().where("count > 1").withColumn("i", F.explode(F.sequence(F.lit(2).cast("long"), "count"))), "V-09", quoted("id", "stands twice"), F.col("name")),
        _issue(nodes.where(F.col("space") == MATHML).select("book_id", "name", "properties").distinct().where(~F.array_contains("properties", "mathml")), "V-10", "MathML without the property", F.col("name")),
        _issue(nodes.where("lower(tag) = 'script'").select("book_id", "name").distinct(), "V-11", "a script", F.col("name")),
        _issue(handlers, "V-12", F.concat_ws(" ", "k", F.lit("of"), "tag"), F.col("name")),
        _issue(docs.where("broken is not null"), "V-13", F.concat(F.lit("can't be read: "), F.col("broken")), F.col("name")),
        _issue(sources.where(remote), "V-14", quoted("src", "lies elsewhere"), F.col("name")),
        _issue(local.join(known, ["book_id", "file"], "left_anti"), "V-14", quoted("src", "isn't in the archive"), F.col("name")),
        _issue(links.join(known, ["book_id", "file"], "left_anti"), "V-15", quoted("href", "leads nowhere"), F.col("name")),
        _issue(into.join(anchors, ["book_id", "file", "id"], "left_anti"), "V-15", quoted("href", "leads to no id"), F.col("name")),
        _issue(entries.where("error like 'corrupt%'"), "V-16", F.col("error"), F.col("name"), "FATAL"),
    ]
    return reduce(DataFrame.unionByName, parts)


def external_issues(reports: DataFrame, column: str = "json") -> DataFrame:
    """Issues of another checker's reports, JSON with ``messages``: of each message its first place; unknown severities are warnings."""
    shape = "struct<messages:array<struct<ID:string,severity:string,message:string,locations:array<struct<path:string,line:int,column:int>>>>>"
    rows = reports.select("book_id", F.explode(F.from_json(column, shape)["messages"]).alias("m"))
    severity = F.upper(F.coalesce("m.severity", F.lit("")))
    return rows.select("book_id", F.col("m.ID").alias("rule"), F.when(severity.isin(*SEVERITIES), severity).otherwise("WARNING").alias("severity"), F.get("m.locations", F.lit(0))["path"].alias("file"), F.col("m.message").alias("message"))


def severity_counts(found: DataFrame, books: DataFrame | None = None) -> DataFrame:
    """``book_id`` and the number of issues of each severity; with ``books(book_id)`` also of books without any."""
    counted = found.groupBy("book_id").agg(*[F.count_if(F.col("severity") == s).alias(s.lower()) for s in SEVERITIES])
    return counted if books is None else books.select("book_id").join(counted, "book_id", "left").fillna(0)


def verdicts(found: DataFrame, books: DataFrame, strict: bool = False) -> DataFrame:
    """``book_id, valid``: no fatal issue and no error; if strict, no warning either."""
    bad = F.col("fatal") + F.col("error") + (F.col("warning") if strict else F.lit(0))
    return severity_counts(found, books).withColumn("valid", bad == 0)
