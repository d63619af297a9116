"""Books from nested page JSON to packages, on documents that take each branch."""

import json
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from quire.functions import markup
from quire.operators import adapter, normalize, splitter, validate
from quire.plans.books import Conversion, Settings
from quire.sinks import package
from quire.sources import archives, images, middle, stages


def line(*spans):
    return {"spans": [{"type": t, "content": c} if t not in ("image", "html") else {"type": "image" if t == "image" else "table", "image_path": c if t == "image" else None, "html": c if t == "html" else None} for t, c in spans]}


def block(type_, *texts, bbox=None, **more):
    return {"type": type_, "bbox": bbox, "lines": [line(*t) if isinstance(t, list) else line(("text", t)) for t in texts], **more}


def sub(type_, *texts):
    return {"type": type_, "lines": [line(*t) if isinstance(t, list) else line(("text", t)) for t in texts]}


def page(i, blocks, discarded=(), size=(1000, 1400)):
    return {"page_idx": i, "page_size": list(size), "para_blocks": blocks, "discarded_blocks": list(discarded)}


PAGES = [
    page(0, [
        block("title", "Chapter 1 Ways of rivers", level=1, bbox=[100, 50, 900, 90]), block("text", "Water finds a way, and men an-", "swer it with bridges.", "  ", bbox=[100, 100, 900, 200]),
        block("text", [("text", "Its speed"), ("inline_equation", "$v = s/t$"), ("text", "grows <here>.")], bbox=[100, 300, 900, 400]), block("text", "  ", bbox=[100, 420, 900, 430]),
        block("interline_equation", [("interline_equation", "$$\\frac{a}{b} + \\sqrt{x^2}$$")], bbox=[100, 450, 900, 500]), block("text", "The stream that leaves the lake goes", bbox=[100, 600, 900, 700]),
    ], [block("aside_text", "In the margin.", bbox=[10, 250, 90, 280]), block("header", "Rivers"), block("page_number", "iii")]),
    page(1, [
        block("text", "on to the sea.", bbox=[110, 100, 905, 150]), block("title", "1.1 Tools", bbox=[100, 160, 900, 200]),
        block("code", language="C++!", sub_type="code", blocks=[sub("code_caption", "A listing"), sub("code_body", "if (a < b)", "  return;")]), block("code", "plain", sub_type="algorithm"),
        block("image", bbox=[0, 500, 300, 600], blocks=[sub("image_body", [("image", "river.png")]), sub("image_caption", "A river"), sub("image_footnote", "Drawn by hand")]),
        block("chart", bbox=[250, 600, 750, 700], blocks=[sub("chart_body", [("chart", "rising"), ("image", "chart.png")])]), block("chart", blocks=[sub("chart_body", [("chart", "no picture")])]),
        block("table", bbox=[0, 700, 1000, 800], blocks=[sub("table_caption", "Depths"), sub("table_body", [("html", "<table><tr><td onclick='x()' rowspan=2>1<td>2</tr><script>bad</script></table>")])]),
        block("table", blocks=[sub("table_body", [("image", "table.png")])]), block("table", blocks=[sub("table_body", "nothing")]),
        block("list", attribute="ordered", blocks=[sub("list_item", "one"), sub("list_item", " "), sub("list_item", "two")]), block("list", "x", "y", attribute="unordered"), block("list", "z"), block("index", "Lake 1", "River 2"),
        block("banner", "Never seen before"),
    ], [block("page_footnote", "A note."), block("page_number", "iv")]),
    page(2, []),
    page(3, [block("text", "and so it ends", bbox=[100, 100, 900, 150]), block("title", "Chapter 2", level=1), block("title", "Deep", level=3)], [block("page_number", "99")]),
]
RAW = json.dumps({"_version_name": "3.4.5", "_backend": "hybrid", "_effort": "high", "_ocr_enable": True, "pdf_info": PAGES, "_extra": 1})


def png(width, height, salt=b""):
    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    body = zlib.compress(b"".join(b"\0" + b"\0" * width for _ in range(height)))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)) + chunk(b"tEXt", b"s\0" + salt) + chunk(b"IDAT", body) + chunk(b"IEND", b"")


@pytest.fixture(scope="module")
def books(spark):
    rows = [("a", RAW), ("b", json.dumps({"_version_name": "1", "pdf_info": []})), ("c", "no json"), ("d", None)]
    return middle.parse_middle(spark.createDataFrame(rows, "book_id string, raw string"), "raw")


@pytest.fixture(scope="module")
def done(spark, books):
    files = spark.createDataFrame([("a", "images/river.png", png(3, 2, b"r")), ("a", "chart.png", png(3, 2, b"c")), ("a", "images/table.png", png(3, 2, b"r"))], "book_id string, path string, content binary")
    out = Conversion(books, files)
    yield out
    out.workspace.close()


def test_roots(done):
    found = {(r.book_id, r.severity, r.code) for r in done.root_issues.collect()}
    assert {b for b, s, _ in found if s == "ERROR"} == {"b", "c", "d"} and ("b", "ERROR", "VERSION") in found and ("c", "ERROR", "PAGES") in found
    assert [r.book_id for r in done.accepted.collect()] == ["a"]


def test_blocks(done):
    rows = sorted(done.raw_blocks.collect(), key=lambda r: (r.page_no, r.place))
    assert [r.kind for r in rows if r.page_no == 0] == ["heading", "paragraph", "aside", "paragraph", "display_math", "paragraph"]
    assert [r.block_id for r in rows][:6] == ["blk-00001", "blk-00002", "blk-00007", "blk-00003", "blk-00005", "blk-00006"]
    assert rows[1].inlines[0].text == "Water finds a way, and men answer it with bridges."
    assert [(x.kind, x.text, x.latex) for x in rows[3].inlines] == [("text", "Its speed", None), ("inline_math", None, "v = s/t"), ("text", "grows <here>.", None)]
    assert rows[4].latex == "\\frac{a}{b} + \\sqrt{x^2}"
    second = [r for r in rows if r.page_no == 1]
    assert [r.kind for r in second] == ["paragraph", "heading", "code", "code", "figure", "chart", "unknown", "table", "figure", "table", "list", "list", "list", "index", "unknown", "footnote"]
    assert (second[2].text, second[2].sub_kind, second[2].language, second[2].captions[0].text) == ("if (a < b)\n  return;", "code", "C++!", "A listing") and (second[3].text, second[3].sub_kind) == ("plain", "algorithm")
    assert (second[4].image_path, second[4].captions[0].text, second[4].notes[0].text, second[5].text, second[6].text) == ("river.png", "A river", "Drawn by hand", "rising", "no picture")
    assert second[9].error == "TABLE_WITHOUT_CONTENT" and [len(r.items) for r in second[10:14]] == [2, 2, 1, 2] and [r.ordered for r in second[10:13]] == [True, False, None]
    assert second[14].text == "Never seen before" and second[14].warning.code == "UNKNOWN_BLOCK_TYPE"
    assert [r.ordered for r in adapter.blocks(done.accepted, legacy_lists=True).where("kind = 'list'").orderBy("place").collect()] == [True, True, None]


def test_normalized(done):
    labels = {r.page_no: (r.label, r.confidence) for r in done.labelled.collect()}
    assert labels == {0: ("iii", 1.0), 1: ("iv", 1.0), 2: (None, 0.0), 3: ("99", 1.0)}
    rows = sorted(done.blocks.collect(), key=lambda r: r.seq)
    assert [r.seq for r in rows] == list(range(len(rows)))
    assert [(r.page_no, r.label) for r in rows if r.kind == "page_break"] == [(0, "iii"), (2, "scan-3"), (3, "99")]
    joined = next(r for r in rows if r.kind == "paragraph" and len(r.sources) == 2)
    assert [(x.kind, x.text) for x in joined.inlines] == [("text", "The stream that leaves the lake goes"), ("page_boundary", "iv"), ("text", "on to the sea.")]
    hints = {r.image_path: r.hint for r in rows if r.hint is not None}
    assert (hints["river.png"].size_class, hints["river.png"].alignment, hints["river.png"].width_ratio) == ("small", "left", 0.3) and hints["chart.png"].alignment == "center"
    assert [r.level for r in rows if r.kind == "heading"] == [1, 1, 1, 3]
    assert [d for d, _ in __import__("itertools").groupby(r.doc_id for r in rows)] == ["part-0001", "part-0002", "part-0003"]


def test_merge_rules(spark):
    """A paragraph over three pages, against the box of its first part; a full stop, a capital and a shift keep pages apart."""
    def books(*texts, x=(100, 100, 100)):
        pages = [page(i, [block("text", t, bbox=[x[i], 0, x[i] + 800, 10])]) for i, t in enumerate(texts)]
        return middle.parse_middle(spark.createDataFrame([("k", json.dumps({"pdf_info": pages}))], "book_id string, raw string"), "raw")

    def merged(b):
        return [r.merged for r in normalize.merged_pages(adapter.blocks(b), normalize.page_labels(middle.pages(b))).orderBy("page_no").collect()]

    assert merged(books("one goes", "on and", "on")) == [False, True, True]
    assert merged(books("one ends.", "on and", "On")) == [False, False, False]
    assert merged(books("one hy-", "Phen", "on", x=(100, 170, 190))) == [False, True, False]
    assert merged(books("one goes", "on and", "on", x=(100, 300, 300))) == [False, False, True]


def test_rendered(done):
    xhtml = {r.block_id: r.xhtml for r in done.rendered.collect()}
    by_kind = {}
    for r in done.rendered.orderBy("seq").collect():
        by_kind.setdefault(r.kind, []).append(r.xhtml)
    assert by_kind["heading"][0] == '<h1 id="h-1-chapter-1-ways-of-rivers">Chapter 1 Ways of rivers</h1>' and by_kind["heading"][3].startswith('<h3 id="h-4-deep">')
    assert "<mfrac><mi>v</mi>" not in xhtml["blk-00003"] and "<mi>v</mi><mo>=</mo>" in xhtml["blk-00003"] and "grows &lt;here&gt;." in xhtml["blk-00003"]
    assert "<mfrac><mi>a</mi><mi>b</mi></mfrac>" in by_kind["display_math"][0]
    assert by_kind["code"][0] == '<figure class="code-listing"><figcaption>A listing</figcaption><pre><code class="language-c++">if (a &lt; b)\n  return;</code></pre></figure>' and by_kind["code"][1] == "<pre><code>plain</code></pre>"
    assert by_kind["figure"][0] == '<figure class="figure size-small align-left"><figcaption>A river</figcaption><img src="../images/river.png" alt="A river"/><p class="note">Drawn by hand</p></figure>'
    assert by_kind["table"] == ['<figure class="table size-large align-center"><figcaption>Depths</figcaption><div class="table-wrap"><table><tr><td rowspan="2">1</td><td>2</td></tr></table></div></figure>']
    assert by_kind["list"] == ["<ol><li>one</li><li>two</li></ol>", "<ul><li>x</li><li>y</li></ul>", '<ul class="list-marker-preserved"><li>z</li></ul>'] and by_kind["index"] == ['<section epub:type="index"><ul><li>Lake 1</li><li>River 2</li></ul></section>']
    assert by_kind["footnote"][0].endswith("<p>A note.</p></aside>") and by_kind["unknown"] == ['<div class="unknown">no picture</div>', '<div class="unknown">Never seen before</div>']
    assert by_kind["page_break"][1] == '<span id="scan-page-000003" epub:type="pagebreak" role="doc-pagebreak" aria-label="scan-3"></span>'
    codes = {r.code for r in done.warnings.collect()}
    assert {"UNKNOWN_BLOCK_TYPE", "TABLE_WITHOUT_CONTENT", "ACCESSIBILITY_EMPTY_ALT", "UNKNOWN_BLOCK_RENDERED"} <= codes and "MATH_UNCONVERTED" not in codes


def test_navigation(done):
    toc = sorted(done.contents.collect(), key=lambda r: r.seq)
    assert [(r.title, r.level) for r in toc] == [("Chapter 1 Ways of rivers", 1), ("1.1 Tools", 1), ("Chapter 2", 1), ("Deep", 3)] and toc[3].parent_seq == toc[2].seq and toc[0].parent_seq is None
    pages = {r.page_idx: (r.label, r.target) for r in done.page_map.collect()}
    assert pages[0] == ("iii", "text/part-0001.xhtml#page-iii") and pages[1] == ("iv", "text/part-0001.xhtml#page-iv") and pages[3][0] == "99" and len(pages) == 4
    meta = done.metadata.collect()[0]
    assert (meta.title, meta.language) == ("Chapter 1 Ways of rivers", "en") and meta.identifier.startswith("urn:uuid:")


def test_package(done):
    assert [(r.rule, r.severity, r.file, r.message) for r in done.issues.collect()] == []
    entries = done.entries.orderBy("ord").collect()
    assert entries[0].name == "mimetype" and entries[0].method == 0 and [r.name for r in entries[1:]] == sorted(r.name for r in entries[1:])
    assert {"OEBPS/images/river.png", "OEBPS/images/chart.png"} <= {r.name for r in entries}
    one, two = bytes(done.archives.collect()[0].content), bytes(package.archives(done.entries.repartition(3)).collect()[0].content)
    assert one == two and done.verdicts.collect()[0].valid
    nav = next(bytes(r.content).decode() for r in entries if r.name == "OEBPS/nav.xhtml")
    assert '#h-3-chapter-2">Chapter 2</a><ol><li><a href="text/part-0003.xhtml#h-4-deep">Deep</a></li></ol></li>' in nav


def test_quality(done):
    checks = {r.check: r.passed for r in done.checks.collect()}
    assert checks == {"content_loss": True, "math": True, "tables": False, "code": True, "headings": False}
    m = done.metrics.collect()[0]
    assert (m.block_coverage, m.math_semantic_rate, m.table_semantic_rate, m.code_text_rate, m.unknown_blocks, m.unknown_per_100_pages) == (1.0, 1.0, 0.3333, 1.0, 2, 50.0)
    report = {r.page_idx: r for r in done.page_report.collect()}
    assert len(report) == 4 and report[2].block_ids == [] and "blk-00001" in report[0].block_ids and report[0].target.endswith("#page-iii")
    s = done.summary.collect()[0]
    assert (s.page_count, s.documents, s.headings) == (4, 3, 4)


def test_inspect(done, spark):
    files = spark.createDataFrame([("a", "images/river.png")], "book_id string, path string")
    found = {r.book_id: r for r in middle.inspect(done.books, files).collect()}
    a = found["a"]
    assert (a.page_count, a.page_sizes, a.images, a.missing_images, a.with_level, a.without_level) == (4, {"1000x1400": 4}, 3, 2, 3, 1)
    assert a.block_types["text"] == 6 and a.block_types["list_item"] == 3 and a.discarded_types == {"aside_text": 1, "header": 1, "page_footnote": 1, "page_number": 3} and a.span_types["inline_equation"] == 1
    assert found["c"].page_count == 0 and found["d"].images == 0
    raw = json.dumps({"pdf_info": [{"para_blocks": [{"type": "text", "_debug": {"x": 1}, "mark": "m"}]}]})
    extra = middle.extensions(spark.createDataFrame([("e", raw), ("f", "{")], "book_id string, raw string")).collect()
    assert {(r.page_no, r.block_no, r.field, r.value) for r in extra} == {(0, 0, "_debug", '{"x":1}'), (0, 0, "mark", '"m"')}


def test_splitter():
    P, H1, H2, B = ("paragraph", -1, 10, [0]), ("heading", 1, 5, [0]), ("heading", 2, 5, [0]), ("page_break", -1, 0, [0])
    big = ("paragraph", -1, 60_000, [0])
    assert splitter.sections_of([P, H1, P, H1, P]) == ["frontmatter"] + ["part-0001"] * 2 + ["part-0002"] * 2
    assert splitter.sections_of([B, H1, P, B, H1]) == ["part-0001"] * 3 + ["part-0002"] * 2
    assert splitter.sections_of([H1, big, H2, big]) == ["part-0001"] * 2 + ["part-0002"] * 2
    assert splitter.sections_of([H1, big, B, big]) == ["part-0001"] * 2 + ["part-0002"] * 2
    assert splitter.sections_of([B, ("paragraph", -1, 120_000, [0]), P]) == ["frontmatter"] * 3  # cut at the very start: whole
    assert splitter.sections_of([big, big, big]) == ["part-0001", "part-0002", "part-0003"] and splitter.sections_of([]) == []
    pages = [("paragraph", -1, 1, [i]) for i in range(120)]
    assert [splitter.sections_of([H1, *pages]).count(f"part-000{k}") for k in (1, 2, 3)] == [51, 50, 20]


def test_tables():
    clean = markup.clean_table
    assert clean(None) is None and clean("  ") is None and clean("<p>no table</p>") is None
    assert clean('<div><table class="x numeric" style="a"><tr><td onclick="b" COLSPAN=2>a &lt; b<!-- c --></td></tr></table><table><tr><td>second</td></tr></table>') == '<table class="numeric"><tr><td colspan="2">a &lt; b</td></tr></table>'
    assert clean("<table><tr><td><div>in <b>bold</b></div> after<br><eq>x < 1</eq></td></tr></table>") == '<table><tr><td>in <b>bold</b> after<br/><span class="math-inline" data-latex="x &lt; 1">x &lt; 1</span></td></tr></table>'
    assert clean('<table><tr><td><img src="http://x/y.png"><img src="javascript:x"><img src="a.png" alt="q"></table>') == '<table><tr><td><img data-asset-id="a.png" alt="q"/></td></tr></table>'
    assert clean("<table><tr><td>a<td>b<tr><td>c<script>x</script>") == "<table><tr><td>a</td><td>b</td></tr><tr><td>c</td></tr></table>"


@pytest.mark.parametrize("latex", [r"\frac{a}{b}", r"\sqrt[3]{x}", "x_i^2", r"\sum_{i=1}^{n} i", r"\int_0^1 x\,dx", r"\alpha+\Omega", r"\begin{pmatrix}a&b\\c&d\end{pmatrix}", r"\left(\frac{1}{2}\right)", r"\mathrm{kg}", "a<b", "f'(x)"])
def test_mathml(latex):
    import xml.etree.ElementTree as ET

    root = ET.fromstring(markup.mathml(latex))
    assert root.tag.endswith("math") and root[0][1].text == latex


@pytest.mark.parametrize("latex", [None, " ", r"\begin{invalid_env", r"\unknown{x}", "{a", "a}", r"\frac{a}", "x^"])
def test_no_mathml(latex):
    assert markup.mathml(latex) is None


def entries_of(spark, files, book="k"):
    rows = [(book, i, n, m, c.encode() if isinstance(c, str) else c, e) for i, (n, m, c, e) in enumerate(files)]
    return spark.createDataFrame(rows, "book_id string, ord int, name string, method int, content binary, error string")


def issues_of(entries):
    entries = entries.cache()
    return validate.issues(entries, validate.parse_xml(entries).cache())


def test_rules(spark):
    """A hit of each rule."""
    container = '<container xmlns="urn:c"><rootfiles><rootfile full-path="P/p.opf"/></rootfiles></container>'
    item = '<item id="{0}" href="{0}.xhtml" media-type="application/xhtml+xml"{1}/>'
    opf = f'<package xmlns="http://www.idpf.org/2007/opf"><manifest>{item.format("a", "")}{item.format("b", "")}{item.format("gone", "")}{item.format("c", "")}</manifest><spine><itemref idref="a"/><itemref idref="nobody"/></spine></package>'
    a = """<html xmlns="http://www.w3.org/1999/xhtml"><body id="x"><p id="x" onclick="y()">t</p><script/><script/><math xmlns="http://www.w3.org/1998/Math/MathML"/><img src="http://far/z.png"/><img src="../Q/none.png"/><img src="../P/here.png"/>
    <a href="#x"/><a href="#nowhere"/><a href="b.xhtml#x"/><a href="c.xhtml"/><a href="lost.xhtml#f"/><a href="https://far/"/><a href="mailto:x"/></body></html>"""
    files = [("first", 8, "x", None), ("mimetype", 0, "application/epub+zip", None), ("META-INF/container.xml", 8, container, None), ("P/p.opf", 8, opf, None), ("P/a.xhtml", 8, a, None), ("P/b.xhtml", 8, "<html><p></html>", None), ("P/c.xhtml", 8, "<html/>", None), ("P/here.png", 8, "", None), ("P\\back", 8, "", None), ("P/bad", 8, None, "corrupt: crc")]
    found = sorted((r.rule, r.file) for r in issues_of(entries_of(spark, files)).collect())
    assert found == [("V-02", "first"), ("V-03", "P\\back"), ("V-06", "P/gone.xhtml"), ("V-07", None), ("V-08", "P/p.opf"), ("V-09", "P/a.xhtml"), ("V-10", "P/a.xhtml"), ("V-11", "P/a.xhtml"), ("V-12", "P/a.xhtml"), ("V-13", "P/b.xhtml"), ("V-14", "P/a.xhtml"), ("V-14", "P/a.xhtml"), ("V-15", "P/a.xhtml"), ("V-15", "P/a.xhtml"), ("V-16", "P/bad")]
    others = [
        ("m", [("mimetype", 8, "text/plain", None)], [("V-02", "ERROR"), ("V-02", "ERROR"), ("V-04", "FATAL")]), ("n", [("mimetype", 0, "application/epub+zip", None), ("META-INF/container.xml", 8, "<x", None)], [("V-04", "ERROR")]),
        ("o", [("mimetype", 0, "application/epub+zip", None), ("META-INF/container.xml", 8, "<x/>", None)], [("V-04", "ERROR")]), ("p", [("mimetype", 0, "application/epub+zip", None), ("META-INF/container.xml", 8, container, None)], [("V-04", "ERROR")]),
        ("q", [("mimetype", 0, "application/epub+zip", None), ("META-INF/container.xml", 8, container, None), ("P/p.opf", 8, "<package", None)], [("V-05", "FATAL")]),
    ]
    rows = None
    for book, files, _ in others:
        own = entries_of(spark, files, book)
        rows = own if rows is None else rows.unionByName(own)
    broken = archives.unpack(spark.createDataFrame([("r", b"no zip"), ("s", None)], "book_id string, content binary"))
    found = issues_of(rows.unionByName(broken)).collect()
    for book, _, wanted in others:
        assert sorted((r.rule, r.severity) for r in found if r.book_id == book) == wanted
    assert [(r.book_id, r.rule, r.severity) for r in found if r.book_id in "rs"] == [("s", "V-01", "FATAL"), ("r", "V-16", "FATAL")]
    counts = {r.book_id: r for r in validate.verdicts(issues_of(rows), rows.select("book_id").distinct().unionByName(spark.createDataFrame([("fine",)], "book_id string"))).collect()}
    assert counts["fine"].valid and not counts["q"].valid and counts["q"].fatal == 1
    report = json.dumps({"messages": [{"ID": "X-1", "severity": "USAGE", "message": "m", "locations": [{"path": "a"}, {"path": "b"}]}, {"ID": "X-2", "severity": "error", "message": "n", "locations": []}]})
    outer = validate.external_issues(spark.createDataFrame([("k", report)], "book_id string, json string")).collect()
    assert [(r.rule, r.severity, r.file) for r in outer] == [("X-1", "WARNING", "a"), ("X-2", "ERROR", None)]


def test_images(spark, tmp_path):
    for name, data in {"p10.png": png(100, 500), "p2.PNG": png(10, 10), "p1.png": png(10, 10), "x.txt": b"t", ".hid.png": png(1, 1), "Thumbs.db": b"x", "p3.jpg": b"", "p4.tif": b"zz"}.items():
        (tmp_path / name).write_bytes(data)
    files = images.read_folder(spark, str(tmp_path))
    rows = images.page_manifest(files).orderBy("page_index").collect()
    assert [r.name for r in rows] == ["p1.png", "p2.PNG", "p3.jpg", "p4.tif", "p10.png"]
    assert [r.is_duplicate for r in rows] == [False, True, False, False, False] and rows[1].first_name == "p1.png" and rows[4].extreme and (rows[4].width, rows[4].height, rows[4].aspect_ratio) == (100, 500, 0.2)
    assert [r.error for r in rows] == [None, None, "EMPTY_FILE", "CORRUPT_IMAGE", None]
    t = images.manifest_totals(files, images.page_manifest(files)).collect()[0]
    assert (t.pages, t.duplicates, t.extremes, t.errors, t.state, t.last_names[-1]) == (5, 1, 1, 2, "failed", "p10.png")
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08\x00\x07\x00\x09\x03"
    assert images.dimensions(jpeg) == (9, 7) and images.dimensions(b"II*\0\x08\0\0\0\x02\0\0\x01\x04\0\x01\0\0\0\x05\0\0\0\x01\x01\x03\0\x01\0\0\0\x06\0\0\0") == (5, 6)


def test_stages(spark, tmp_path):
    folder = str(tmp_path / "stages")
    pages = spark.createDataFrame([("a", 0, "p1", "s1"), ("a", 1, "p2", "s2"), ("b", 0, "p1", "s1")], "book_id string, page_index int, name string, sha256 string")
    keys = stages.cache_keys(pages, {"effort": "high"})
    key = {r.book_id: r.cache_key for r in keys.collect()}
    changed = {r.book_id: r.cache_key for r in stages.cache_keys(pages, {"effort": "low"}).collect()}
    assert key["a"] != key["b"] and not set(key.values()) & set(changed.values())
    rows = [("a", "ocr", "running", "2026-01-01T00:00:00Z", None, None), ("a", "ocr", "complete", "2026-01-01T00:00:00Z", key["a"], "o1"), ("b", "ocr", "failed", "2026-01-02T00:00:00Z", key["b"], None)]
    stages.record(spark.createDataFrame(rows, "book_id string, stage string, state string, at string, cache_key string, output_sha256 string"), folder)
    (tmp_path / "stages" / "broken.json").write_text("{no json\n")
    records = stages.read_records(spark, folder)
    assert {(r.book_id, r.state) for r in stages.latest(records).collect()} == {("a", "complete"), ("b", "failed")}
    assert [r.book_id for r in stages.cache_hits(keys, records, "ocr").collect()] == ["a"]
    assert stages.cache_hits(keys, records, "ocr", outputs=spark.createDataFrame([("a", "other")], "book_id string, sha256 string")).collect() == []
    with pytest.raises(Exception, match="unknown state"):
        stages.record(spark.createDataFrame([("a", "x", "odd")], "book_id string, stage string, state string"), folder)
    assert spark.sql("select date'2026-01-02' as d").select(stages.utc_stamp(F.col("d").cast("timestamp")).alias("s")).collect()[0].s == "2026-01-02T00:00:00Z"


def test_settings():
    with pytest.raises(Exception, match=r"\[settings\]"):
        Settings(most_chars=0)


def test_python_holds_lots(spark, monkeypatch):
    """What goes to Python at once is bounded by bytes: of many entries in a batch, and of many in one archive."""
    import io
    import zipfile

    import pandas as pd
    import pyarrow as pa

    body = b"<a>" + b"<b id='x'/>" * 20_000 + b"</a>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as file:
        for i in range(30):
            file.writestr(f"{i}.xml", body)
    whole = spark.createDataFrame([(7, out.getvalue())], "book_id long, content binary")
    entries = archives.unpack(whole)
    found = validate.parse_xml(entries).selectExpr("name", "broken", "size(nodes) as n").collect()
    assert sorted((r.name, r.broken, r.n) for r in found) == sorted((f"{i}.xml", None, 20_001) for i in range(30))
    for kind in ("mapInArrow", "mapInPandas"):
        monkeypatch.setattr(type(whole), kind, lambda self, f, schema: f)
    frames = list(archives.unpack(whole)(iter([pd.DataFrame({"book_id": [7], "content": [out.getvalue()]})])))
    assert sum(map(len, frames)) == 30 and max(sum(map(len, f["content"])) for f in frames) < 2 << 20
    rows = {"book_id": [7] * 30, "name": [f"{i}.xml" for i in range(30)], "content": [body] * 30}
    parse = validate.parse_xml(entries)
    try:
        lots = [x.num_rows for x in parse(iter([pa.RecordBatch.from_pydict(rows)]))]
    except TypeError:
        lots = [len(x) for x in parse(iter([pd.DataFrame(rows)]))]
    assert sum(lots) == 30 and max(lots) <= 5


def test_lots():
    from quire.functions import batches

    assert list(batches.lots([])) == [] and list(batches.lots([9], 5)) == [(0, 1)]
    assert list(batches.lots([1, 2, 3, 9, 0, 5, 5], 5)) == [(0, 2), (2, 3), (3, 4), (4, 6), (6, 7)]
