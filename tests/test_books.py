"""Books from payloads to packages, on small fixtures and against sequential simulations."""

import io
import json
import random
import zipfile
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from folio.operators import analyzer as A
from folio.operators import evidence as E
from folio.operators import findings as D
from folio.operators import golden as G
from folio.operators import packaging as K
from folio.operators import rendering as X
from folio.operators import runtime as R
from folio.sources import files as S
from folio.streaming import ingest as I


def typography(**changed):
    return {"posture": "roman", "weight": "normal", "vertical_position": "baseline", "caps_style": "normal", "decorations": []} | changed


def span(text, language="en", br=False, **style):
    return {"text": text, "language": language, "source_typography": typography(**style), "semantic_line_break_after": br}


def block(role, *spans, language="en", level=None, heading="unknown", marker=None, region=None):
    return {"role_hint": role, "content": [span(s) if isinstance(s, str) else s for s in spans], "dominant_language": language, "heading_level_hint": level, "heading_role_hint": heading, "marker": marker, "region": region, "alignment": None}


def payload(*blocks, printed=None):
    return {"page_kind_hint": "text", "dominant_language": "en", "printed_page_number": printed, "blocks": list(blocks), "warnings": []}


def pages(spark, *books):
    """Typed pages of lists of (number, payload)."""
    rows = [(f"b{i}", n, number, f"b{i}p{n}", json.dumps(p)) for i, book in enumerate(books) for n, (number, p) in enumerate(book)]
    judged = E.normalized(spark.createDataFrame(rows, "book_id string, page_pos int, page_number int, page_id string, raw string"))
    assert judged.where("size(violations) > 0").count() == 0
    return judged.select("book_id", "page_pos", "page_number", "page")


def test_contract(spark):
    good = payload(block("paragraph", "a"))
    bad = {
        "extra key": good | {"x": 1},
        "missing key": {k: v for k, v in good.items() if k != "warnings"},
        "kind": good | {"page_kind_hint": "poster"},
        "flag for a level": payload(block("heading", "a", level=True)),
        "level of a paragraph": payload(block("paragraph", "a", level=2)),
        "level 7": payload(block("heading", "a", level=7)),
        "region outside": payload(block("image", region={"x": 0.5, "y": 0, "width": 0.6, "height": 0.1})),
        "decorations twice": payload(block("paragraph", span("a", decorations=["underline", "underline"]))),
        "ordinal 0": payload(block("list_item", "a", marker={"kind": "numeric", "raw_text": None, "ordinal": 0})),
        "list": payload(block("list", "a")),
        "not finite": payload(block("image", region={"x": float("nan"), "y": 0, "width": 0.6, "height": 0.1})),
    }
    rows = [("good", json.dumps(good)), ("null", None), ("text", "{")] + [(k, json.dumps(v)) for k, v in bad.items()]
    out = {r.page_id: r for r in E.normalized(spark.createDataFrame(rows, "page_id string, raw string")).collect()}
    assert {k for k, r in out.items() if not r.violations} == {"good"} and out["good"].page.blocks[0].content[0].span_id == "good:block:0001:span:0001"
    assert all(r.page is None for k, r in out.items() if k != "good")
    assert E.normalized(spark.createDataFrame([], "page_id string, raw string")).count() == 0
    old = {"page_kind": "text", "blocks": [{"type": "image_caption", "content": [{"text": "x", "typography": typography()}], "language": "vi"}], "warnings": [], "more": 1}
    row = E.normalized(spark.createDataFrame([("o", json.dumps(old)), ("p", json.dumps(old | {"blocks": [{"type": "quote", "content": [], "level": 1}]}))], "page_id string, raw string"), version=4).orderBy("page_id").collect()
    assert row[0].page.blocks[0].role_hint == "caption" and row[0].page.blocks[0].content[0].language == "vi" and row[1].violations


def test_round_trip(spark):
    source = F.struct(F.lit("s").alias("source_id"), F.lit("u").alias("uri"), F.lit(None).cast("string").alias("sha256"), F.lit(None).cast("string").alias("media_type"), F.create_map(F.lit("page_number"), F.lit(3)).alias("metadata"))
    stored = pages(spark, [(1, payload(block("image", region={"x": 0, "y": 0.25, "width": 1, "height": 0.5}), block("paragraph", "é \"q\"")))]).select(E.stored_page(F.col("page"), source).alias("stored"))
    text = stored.first().stored
    rows = spark.createDataFrame([(text,), (text.replace(":block:0002", ":block:0003"),), (text.replace('"sequence_index":1', '"sequence_index":0'),), (text.replace('"uri":"u"', '"uri":""'),)], "stored string")
    assert [len(r.violations) for r in E.reloaded(rows).collect()] == [0, 1, 1, 1]


def test_structure(spark):
    numeric = lambda n: {"kind": "numeric", "raw_text": None, "ordinal": n}
    region = {"x": 0.1, "y": 0.1, "width": 0.2, "height": 0.2}
    book = [
        (1, payload(block("page_header", "My Book 1"), block("heading", "T", heading="genre_label"), block("list_item", "one", marker=numeric(1)), block("list_item", "two", marker=numeric(2)), printed="1")),
        (2, payload(block("page_header", "2 MY  BOOK"), block("list_item", "three", marker=numeric(3)), block("list_item", "nine", marker=numeric(9)), block("quote", "Das", language="de"), block("quote", "x", language=None), block("quote", "that", language="en"), block("attribution", "A"), printed="2")),
        (3, payload(block("verse", span("a", br=True), span("b", br=True)), block("verse"), block("image", region=region), block("caption", "C"), block("image"), block("caption", "D"), block("caption", "E"), block("table", "t"))),
    ]
    a = A.analyze(pages(spark, book))
    got = a.nodes.orderBy("node_pos").collect()
    assert [(n.node_type, len(n.children or [])) for n in got] == [("heading", 0), ("list", 3), ("list", 1), ("quotation", 2), ("quotation", 1), ("attribution", 0), ("verse", 3), ("figure", 2)]
    assert got[1].node_id == "b0p0:block:0003:node:list" and got[1].list_kind == "ordered" and [c.ordinal for c in got[1].children] == [1, 2, 3]
    assert [[s.text for s in c.spans] for c in got[6].children] == [["a"], ["b"], []] and got[6].children[1].node_id.endswith(":node:verse-line:0002")
    assert {r.text for r in a.unresolved.collect()} == {"", "D", "E", "t"}
    assert [(r.normalized_text, r.repeated) for r in a.furniture.orderBy("page_index").collect()] == [("My Book", True), ("MY BOOK", True)]
    assert [(r.candidate_id, r.confidence) for r in a.candidates.collect()] == [("b0p0:block:0002:candidate:inset", 0.75)]
    kinds = {(r.kind, r.source_id.split(":")[2], r.target_id.split(":")[2], r.confidence) for r in a.relationships.collect()}
    # An item may go on in the first of the next page; only one neighbour of the attribution is a quotation.
    assert kinds == {("continues_to", "0004", "0002", 0.99), ("attribution_of", "0007", "0006", 0.95)}
    with pytest.raises(ValueError, match="page_id"):
        A.analyze(pages(spark, book).unionByName(pages(spark, book)))
    assert A.analyze(pages(spark, book).limit(0)).nodes.count() == 0


def test_footnotes_and_translations(spark):
    sup = lambda t: span(t, vertical_position="superscript")
    book = [(1, payload(block("paragraph", "x", sup("1"), sup("(a.)"), sup("9")), block("quote", span("Guten Tag", language="de"), language="de"), block("quote", "Good day"), block("attribution", "N."), block("footnote", sup("1."), "first"), block("footnote", sup("A"), "second"), block("footnote", sup("9"), "x"), block("footnote", sup("9"), "y"), block("footnote", "5", "z")))]
    a = A.analyze(pages(spark, book))
    got = {(r.kind, r.source_id.split(":", 1)[1], r.target_id.split(":", 1)[1], r.confidence) for r in a.relationships.collect()}
    assert got == {("footnote_ref", "block:0001:span:0002", "block:0005:node:footnote", 1.0), ("footnote_ref", "block:0001:span:0003", "block:0006:node:footnote", 1.0), ("attribution_of", "block:0004:node:attribution", "block:0003:node:quotation", 0.95), ("translation_of", "block:0003:node:quotation", "block:0002:node:quotation", 0.9)}
    assert [r.label for r in a.nodes.where("node_type = 'footnote'").orderBy("node_pos").collect()] == ["1", "A", "9", "9", None]


def simulated(kinds, edges):
    """Chains as a walk over nodes: kinds by position, edges (i -> j) with 0.99, 0.95 (all but typography) or less."""
    out, i = [], 0
    while i < len(kinds):
        chain, notes, at = [i], [], i
        if kinds[i] == "paragraph":
            while True:
                j = at + 1
                while j < len(kinds) and kinds[j] == "footnote":
                    j += 1
                if j >= len(kinds) or kinds[j] != "paragraph" or edges.get((chain[-1], j), 0) < 0.95:
                    break
                notes += range(at + 1, j)
                chain.append(j)
                at = j
        elif kinds[i] == "list":
            while at + 1 < len(kinds) and kinds[at + 1] == "paragraph" and edges.get((at, at + 1), 0) >= 0.99:
                at += 1
                chain.append(at)
        out.append(chain)
        out += [[k] for k in notes]
        i = at + 1
    return out


def test_chains(spark):
    rng = random.Random(3)
    flow, links, want = [], [], {}
    style = ("roman", "normal", "baseline", "normal", [])
    for b in range(120):
        kinds = [rng.choice(["paragraph", "paragraph", "paragraph", "list", "footnote", "heading"]) for _ in range(rng.randint(1, 12))]
        edges = {}
        for j in range(1, len(kinds)):
            if kinds[j] == "paragraph" and rng.random() < 0.8:
                i = j - 1
                while i > 0 and kinds[i] == "footnote" and rng.random() < 0.8:
                    i -= 1
                edges[i, j] = rng.choice([0.99, 0.99, 0.95, 0.9])
        want[str(b)] = simulated(kinds, edges)
        for i, k in enumerate(kinds):
            spans = [(f"{b}.{i}s", f"t{i}", "en", style, [], [])]
            kids = [(f"{b}.{i}.item", "list_item", 1, None, spans, [(f"p{i}", f"{b}.{i}", [])])] if k == "list" else None
            flow.append((str(b), i + 1, f"{b}.{i}", k, kids, None if k == "list" else spans, [(f"p{i}", f"{b}.{i}", [])]))
        for (i, j), c in edges.items():
            tail = f"{b}.{i}.item" if kinds[i] == "list" else f"{b}.{i}"
            links.append((str(b), f"{tail}>{j}", tail, f"{b}.{j}", c, [A.ENDS_OPEN, A.STARTS_LOW, A.ONE_LANGUAGE]))
    st = f"struct<span_id:string,text:string,language:string,source_typography:{E.TYPOGRAPHY_TYPE},semantic_marks:array<string>,provenance:array<struct<page_id:string,block_id:string,span_ids:array<string>>>>"
    pt = "array<struct<page_id:string,block_id:string,span_ids:array<string>>>"
    nodes = spark.createDataFrame(flow, f"book_id string, node_pos int, node_id string, node_type string, children array<struct<node_id:string,node_type:string,ordinal:int,marker:{E.MARKER_TYPE},spans:array<{st}>,provenance:{pt}>>, spans array<{st}>, provenance {pt}")
    edge = spark.createDataFrame(links, "book_id string, relationship_id string, source_id string, target_id string, confidence double, reasons array<string>")
    merged, used = A.resolved_chains(nodes, edge)
    got = {}
    for r in merged.orderBy("book_id", "node_pos").collect():
        got.setdefault(r.book_id, []).append([int(p.block_id.split(".")[1]) for p in r.provenance])
        text = "".join(s.text for s in (r.children[-1].spans if r.node_type == "list" else r.spans))
        assert text == " ".join("t" + p.block_id.split(".")[1] for p in r.provenance)
    assert got == want
    assert used.count() == sum(len(c) - 1 for chains in want.values() for c in chains)


def test_projection_and_decisions(spark):
    book = [(7, payload(block("page_header", "H"), block("paragraph", span("one  two", br=True), span("three")), block("image"), block("paragraph", "f4.Next x2")))]
    typed = pages(spark, book)
    proj = D.projections(typed).persist()
    p = proj.first()
    assert p.text == "one two three f4.Next x2" and [(a.start, a.end, a.span_offset) for a in p.anchors] == [(0, 4, 0), (4, 7, 5), (8, 13, 0), (14, 24, 0)]
    heur = D.boundary_findings(proj)
    assert [(r.finding_id, r.text, r.suggested_text) for r in heur.orderBy("finding_id").collect()] == [("page-0007-heur-0001", "f4.Next", "f 4.Next"), ("page-0007-heur-0002", "x2", "x 2")]
    reading = spark.createDataFrame([("b0", p.page_id, "one two thre f4.Next, x2")], "book_id string, page_id string, reading string")
    diff = D.difference_findings(proj, reading).persist()
    assert [(r.kind, r.severity, r.text, r.reference_text) for r in diff.orderBy("start").collect()] == [("extra_text", "minor", "e", ""), ("missing_text", "minor", "", ",")]
    both = diff.select(*D.FINDING).unionByName(heur.select(*D.FINDING))
    made = lambda *rows: spark.createDataFrame([("b0", *r) for r in rows], "book_id string, finding_id string, decision string, replacement_text string")
    resolutions, edits = D.imported_decisions(made(("page-0007-ocr-0001", "use_ocr", None), ("page-0007-heur-0002", "manual", "x two"), ("page-0007-heur-0001", "keep_source", None)), both, proj)
    assert resolutions.count() == 3 and edits.count() == 2
    fixed = D.corrected_pages(typed, edits)
    assert D.projections(fixed).first().text == "one two thre f4.Next x two"
    for bad, why in ((("nope", "keep_source", None), "unknown finding"), (("page-0007-ocr-0001", "use_suggestion", None), "no replacement"), (("page-0007-ocr-0001", "guess", None), "unknown decision")):
        with pytest.raises(ValueError, match=why):
            D.imported_decisions(made(bad), both, proj)
    with pytest.raises(ValueError, match="stale"):
        D.imported_decisions(made(("page-0007-ocr-0001", "use_ocr", None)), both.withColumn("text", F.lit("q")), proj)
    with pytest.raises(ValueError, match="correction"):
        D.corrected_pages(typed, edits.unionByName(edits))


def test_differences():
    rng = random.Random(2)
    for _ in range(50):
        a = "".join(rng.choice("ab c.") for _ in range(rng.randint(0, 60)))
        b = "".join(c for c in a if rng.random() < 0.8)
        ratio, groups = D.matched(a, b)
        assert ratio == SequenceMatcher(None, a, b, autojunk=False).ratio()
        left = a
        for s, e, c, d in reversed(groups):
            left = left[:s] + b[c:d] + left[e:]
        assert left == b
    big = " ".join(rng.choice(["some", "words", "here"]) + str(i) for i in range(3000))
    changed = big.replace("words7", "worlds7")
    ratio, groups = D.matched(big, changed)
    left = big
    for s, e, c, d in reversed(groups):
        left = left[:s] + changed[c:d] + left[e:]
    assert ratio > 0.99 and left == changed


def test_diacritics_and_kinds(spark):
    rows = spark.createDataFrame([("Việt đ", "Viet d"), ("Viet", "Việt"), ("ab", "ac"), ("", "x"), (None, "x")], "text string, reference_text string")
    assert [r.diacritics_only for r in D.diacritic_loss(rows).collect()] == [True, False, False, False, False]


def written(df):
    """df as if it had been written and read again."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def small_book(spark):
    sup = lambda t: span(t, vertical_position="superscript")
    numeric = lambda n: {"kind": "numeric", "raw_text": None, "ordinal": n}
    book = [
        (1, payload(block("heading", "Chapter 1", heading="chapter_label"), block("heading", "Start", sup("1"), "here", heading="chapter_title"), block("paragraph", span("**It** & \"he\"", posture="italic"), span("é", language="fr")), block("list_item", "x", marker=numeric(3)), block("list_item", "y", marker=numeric(4)), block("quote", "q"), block("footnote", sup("1"), "Note"))),
        (2, payload(block("heading", "Part", heading="section_title"), block("verse", span("l1", br=True), "l2"), block("image", region={"x": 0, "y": 0, "width": 1, "height": 1}), block("caption", "Cap"), block("heading", "Deep", heading="subsection_title"))),
    ]
    a = A.analyze(pages(spark, book))
    nodes = written(X.projected(a.nodes, a.relationships))
    books = spark.createDataFrame([("b0", "A & B", "en")], "book_id string, title string, language string")
    return nodes, books


def test_rendering_and_package(spark):
    nodes, books = small_book(spark)
    docs = written(X.rendered(nodes, books))
    text = {r.file: r.content for r in docs.orderBy("position").collect()}
    assert list(text) == ["chapter-0001.xhtml", "section-0001.xhtml", "subsection-0001.xhtml", "endnotes.xhtml"]
    one = text["chapter-0001.xhtml"]
    assert '<hgroup class="heading-group">\n      <p id="b0p0:block:0001:node:heading" class="heading-label role-chapter-label">Chapter 1</p>\n      <h1 id="b0p0:block:0002:node:heading" class="role-chapter-title">Start<sup class="noteref"><a id="b0p0:block:0002:span:0002" epub:type="noteref" href="endnotes.xhtml#b0p0:block:0007:node:footnote">1</a></sup>here</h1>\n    </hgroup>' in one
    assert '<span class="source-italic">**It** &amp; &quot;he&quot;</span><span lang="fr" xml:lang="fr">é</span></p>' in one
    assert '<ol id="b0p0:block:0004:node:list" start="3">\n      <li id="b0p0:block:0004:node:list-item">x</li>\n      <li id="b0p0:block:0005:node:list-item">y</li>\n    </ol>' in one
    assert '<blockquote id="b0p0:block:0006:node:quotation">\n      <p id="b0p0:block:0006:node:quote-paragraph">q</p>\n    </blockquote>' in one and "<title>A &amp; B</title>" in one
    assert '<p class="verse-line" id="b0p1:block:0002:node:verse-line:0002">l2</p>' in text["section-0001.xhtml"] and "<figcaption>Cap</figcaption>" in text["section-0001.xhtml"]
    assert '<p><span class="endnote-label">1</span> Note <a class="footnote-backlink" epub:type="backlink" href="chapter-0001.xhtml#b0p0:block:0002:span:0002" aria-label="Back to reference">↩</a></p>' in text["endnotes.xhtml"]
    chunks = X.grouped_headings(X.chunked(nodes))
    entries = written(K.toc_entries(chunks))
    assert [(r.label, r.level, r.depth) for r in entries.orderBy("node_pos").collect()] == [("Start here", 1, 1), ("Part", 2, 2), ("Deep", 3, 3)]
    meta = books.select("book_id", *(F.col(c) if c in ("title", "language") else (F.array(F.lit("N. N.")) if c == "authors" else F.lit(None).cast("array<string>" if c in ("subjects", "contributors") else "string")).alias(c) for c in K.METADATA_FIELDS))
    image = nodes.where("node_type = 'figure'").select("book_id", F.col("asset_id").alias("file"), F.lit(b"png").alias("data"))
    epub = written(K.packaged(meta, docs, entries, image, "2020-01-02T03:04:05Z"))
    data = bytes(epub.first().epub)
    z = zipfile.ZipFile(io.BytesIO(data))
    assert z.namelist()[:4] == ["mimetype", "META-INF/container.xml", "EPUB/package.opf", "EPUB/nav.xhtml"] and "<dc:creator id=\"creator-1\">N. N.</dc:creator>" in z.read("EPUB/package.opf").decode()
    assert K.validated(epub).first().problems == []
    assert data == bytes(K.packaged(meta, docs, entries, image, "2020-01-02T03:04:05Z").first().epub)
    lame = written(K.packaged(meta, docs.where("file <> 'endnotes.xhtml'"), entries, image, "2020-01-02T03:04:05Z"))
    assert len(K.validated(lame).first().problems) == 1
    assert K.archive_problems(b"no zip") and K.archive_problems(data[:-200])
    with pytest.raises(ValueError, match="title"):
        K.packaged(meta.withColumn("title", F.lit(None).cast("string")), docs, entries, image)
    with pytest.raises(ValueError):
        K.checked_timestamp("2020-13-01T00:00:00Z")


def test_chunk_files(spark):
    book = [(1, payload(block("paragraph", "a"), block("heading", "u", heading="unknown"), block("heading", "v", heading="section_title")))]
    a = A.analyze(pages(spark, book, [(1, payload(block("paragraph", "only")))]))
    files = {(r.book_id, r.file) for r in X.chunked(X.projected(a.nodes, a.relationships)).select("book_id", "file").collect()}
    assert files == {("b0", "section-0001.xhtml"), ("b0", "section-0002.xhtml"), ("b0", "section-0003.xhtml"), ("b1", "content.xhtml")}


def test_golden(spark):
    graphic = {"kind": "graphic", "raw_text": None, "ordinal": None}
    cases = {
        "page-0068": payload(block("verse", span("a", br=True), span("b", br=True), span("c", br=True), span("d"))),
        "page-0378": payload(block("paragraph", "p"), *(block("list_item", "x", marker={"kind": "numeric", "raw_text": None, "ordinal": n}) for n in range(10, 18))),
        "page-0397": payload(*(block("paragraph", "– a") for _ in range(4))),
        "page-0402": payload(block("heading", G.SCENARIO, heading="scenario_label", marker=graphic), block("heading", G.TITLE, heading="subtitle")),
        "other": payload(),
    }
    judged = E.normalized(spark.createDataFrame([(k, json.dumps(v)) for k, v in cases.items()] + [("broken", "{}")], "page_id string, raw string")).select(F.col("page_id").alias("case_id"), "page")
    got = {(r.case_id, r.check): r.passed for r in G.evaluated(judged).collect()}
    assert got == {("page-0068", "four_semantic_verse_breaks"): True, ("page-0068", "four_line_verse_node"): True, ("page-0378", "ordered_list_10_to_17"): True, ("page-0378", "leading_prose_outside_list"): True, ("page-0397", "dash_dialogue_not_list"): True, ("page-0397", "four_dash_dialogue_paragraphs"): True, ("page-0402", "scenario_label_and_title_roles"): False, ("page-0402", "graphic_marker_not_unicode_text"): True, ("other", "fixture_normalizes"): True, ("broken", "fixture_normalizes"): False}
    text, ok = G.report(G.evaluated(judged))
    assert not ok and "structure: 7/8" in text and len(G.CHECK_NAMES) == 22


def test_runs_and_selection(spark, tmp_path):
    source = {"source_id": "s", "uri": "u", "sha256": None, "media_type": None, "metadata": {"page_number": 2}}
    for run, number in (("page-0002", 2), ("page-0001", 1)):
        page = E.identified(f"p{number}", payload(block("paragraph", "x"))) | {"source": source | {"metadata": {"page_number": number}}}
        (tmp_path / "book" / run / "normalized").mkdir(parents=True)
        (tmp_path / "book" / run / "normalized" / "page.json").write_text(json.dumps(page))
        (tmp_path / "book" / run / "manifest.json").write_text("{}")
    loaded = S.loaded_pages(S.page_runs(spark, str(tmp_path)))
    assert [(r.book_id, r.page_pos, r.page_number, r.page.page_id) for r in loaded.orderBy("page_pos").collect()] == [("book", 1, 1, "p1"), ("book", 2, 2, "p2")]
    out = lambda *n: spark.createDataFrame([("book", k) for k in n], "book_id string, page_number int")
    assert S.without_excluded(loaded, out(1)).count() == 1
    for bad in (out(5), out(1, 2)):
        with pytest.raises(ValueError):
            S.without_excluded(loaded, bad)
    assert S.selected_pages(loaded, 2, 2).count() == 1
    for a, b in ((0, None), (2, 1), (1, 3)):
        with pytest.raises(ValueError):
            S.selected_pages(loaded, a, b)
    with pytest.raises(ValueError, match="page_number"):
        S.loaded_pages(S.page_runs(spark, str(tmp_path)).unionByName(S.page_runs(spark, str(tmp_path))))
    assert S.page_runs(spark, str(tmp_path / "none")).count() == 0


def test_metadata_and_words(spark):
    files = spark.createDataFrame([("a", '{"title":" T ","author":"X","series_index":2.5,"more":1}'), ("b", '{"title":"","subjects":[1]}'), ("c", "[]")], "book_id string, text string")
    got = {r.book_id: r for r in S.book_metadata(files).collect()}
    assert (got["a"].title, got["a"].authors, got["a"].series_index, got["a"].violations) == ("T", ["X"], "2.5", []) and len(got["b"].violations) == 2 and got["c"].violations == ["no object"]
    base = S.book_metadata(files).where("book_id <> 'c'")
    given = lambda *r: spark.createDataFrame(list(r), "book_id string, title string, language string, author string")
    assert {r.book_id: (r.title, r.authors) for r in S.merged_metadata(base, given(("b", "B", None, "Y"))).collect()} == {"a": ("T", ["X"]), "b": ("B", ["Y"])}
    for bad in (given(("a", " ", None, None)), given(("a", "A", None, None))):
        with pytest.raises(ValueError):
            S.merged_metadata(base, bad)
    tsv = "level\tconf\ttext\tleft\ttop\twidth\theight\n5\t90.5\t ab \t1\t2\t3\t4\n4\t99\tno\t1\t2\t3\t4\n5\t10\tlow\t1\t2\t3\t4\n5\t95\t \t1\t2\t3\t4"
    words = S.recognised_words(spark.createDataFrame([("b", "p", tsv)], "book_id string, page_id string, tsv string"), 50.0)
    assert [(r.word, r.confidence, r.left) for r in words.collect()] == [("ab", 90.5, 1)]


def test_routes():
    free, paid = {"name": "f", "tier": "free", "max_attempts": 3}, {"name": "p", "tier": "paid", "max_attempts": 2}
    assert R.checked_routes([free, paid]) == [free] and R.checked_routes([free, paid], "free-then-paid") == [free, paid]
    for routes, policy in (([], "free-only"), ([paid], "free-only"), ([paid, free], "free-then-paid"), ([free | {"max_attempts": 0}], "free-only"), ([free], "any")):
        with pytest.raises(ValueError):
            R.checked_routes(routes, policy)
    with pytest.raises(ValueError):
        R.checked_routes([free], base=2.0, most=1.0)


def test_ingest(spark, tmp_path):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    (folder / "b").mkdir(parents=True)
    (folder / "b" / "1.json").write_text(json.dumps(payload(block("paragraph", "old"))))
    (folder / "b" / "2.json").write_text("{}")
    for text in (None, "new"):
        if text:
            (folder / "b" / "3.json").write_text(json.dumps(payload(block("paragraph", text))))
        I.ingest(I.arriving(spark, str(folder)), out, state).awaitTermination()
    assert sorted(r.page_number for r in I.current_pages(spark, out).collect()) == [1, 3]
    assert [(r.pages, r.quarantined) for r in I.progress(spark, out).orderBy("batch").collect()] == [(1, 1), (1, 0)]
    assert [r.book_id for r in I.touched_books(spark, out, 0).collect()] == ["b"]
