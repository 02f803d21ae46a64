"""From analysed nodes to XHTML documents: semantics, spine chunks, heading groups, elements, endnotes.

Markup is built with column expressions, a string for each node; documents are ordered concatenations of them, one row a
document, so a book never has to fit in one task but for the list of its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.functions.text import escape_markup, footnote_text, without_markup_stars

LABEL_ROLES = ("chapter_label", "genre_label", "scenario_label")
UNRANKED_ROLES = (*LABEL_ROLES, "subtitle")
DEFAULT_LEVELS = {"chapter_title": 1, "section_title": 2, "subsection_title": 3, "scenario_title": 3, "unknown": 2}
STEMS = {"chapter_title": "chapter", "section_title": "section", "subsection_title": "subsection", "scenario_title": "scenario"}
ENDNOTES = "endnotes.xhtml"
INLINE_TYPE = "struct<text:string,language:string,marks:array<string>,italic:boolean,target_id:string,source_span_id:string>"


def chosen(key: Column, values: dict, other: object = None) -> Column:
    """values[key] as a chain of when; other where there is none."""
    out = None
    for k, v in values.items():
        out = F.when(key == k, F.lit(v)) if out is None else out.when(key == k, F.lit(v))
    return out.otherwise(F.lit(other))


def heading_level(role: Column, level: Column) -> Column:
    """Null for labels and subtitles; a heading's own level where it is 1 to 6, else that of its role."""
    return F.when(~role.isin(*UNRANKED_ROLES), F.when(level.between(1, 6), level).otherwise(chosen(role, DEFAULT_LEVELS)))


def figure_file(node: Column) -> Column:
    return F.concat(F.lit("figure-"), F.substring(F.sha2(node, 256), 1, 16), F.lit(".png"))


def pixel_box(region: Column, width: Column, height: Column) -> Column:
    """(left, top, right, bottom) of a region of fractions, inside the image and at least a pixel wide and high."""

    def side(at: Column, size: Column, whole: Column) -> tuple[Column, Column]:
        low = F.greatest(F.lit(0), F.least(whole - 1, F.floor(at * whole).cast("int")))
        return low, F.greatest(low + 1, F.least(whole, F.ceil((at + size) * whole).cast("int")))

    left, right = side(region["x"], region["width"], width)
    top, bottom = side(region["y"], region["height"], height)
    return F.struct(left.alias("left"), top.alias("top"), right.alias("right"), bottom.alias("bottom"))


def figure_sources(nodes: DataFrame, images: DataFrame) -> DataFrame:
    """Figures with the page image (book_id, page_id, uri) they are cut from and their file; uri is null if it is missing, or
    if a figure doesn't come from one page."""
    pages = F.array_distinct(F.transform("provenance", lambda p: p["page_id"]))
    rows = nodes.where("node_type = 'figure'").select("book_id", "node_id", "region", F.when(F.size(pages) == 1, pages[0]).alias("page_id"), figure_file(F.col("node_id")).alias("file"))
    return rows.join(images.select("book_id", "page_id", "uri"), ["book_id", "page_id"], "left")


def _inlines(spans: Column, refs: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["text"].alias("text"), s["language"].alias("language"), s["semantic_marks"].alias("marks"), F.coalesce(s["source_typography"]["posture"] == "italic", F.lit(False)).alias("italic"), F.try_element_at(refs, s["span_id"]).alias("target_id"), s["span_id"].alias("source_span_id")))


def projected(nodes: DataFrame, relationships: DataFrame) -> DataFrame:
    """nodes with inlines for spans: content of their own and of children. Only marks and italics of the source are kept,
    superscripts that refer to a footnote have its target_id, heading levels are resolved, and a footnote's text no
    longer starts with its label. nodes come from analyzer.analyze()."""
    block = F.regexp_extract("source_id", r"^(.*):span:\d+\z", 1)
    refs = relationships.where("kind = 'footnote_ref'").select("book_id", block.alias("block_id"), F.struct("source_id", "target_id").alias("r"))
    owned = nodes.select("book_id", "node_id", F.explode("provenance").alias("p")).select("book_id", "node_id", F.col("p.block_id").alias("block_id"))
    by_node = owned.join(refs, ["book_id", "block_id"]).groupBy("book_id", "node_id").agg(F.map_from_entries(F.collect_set("r")).alias("_refs"))
    none = F.map_from_entries(F.array().cast("array<struct<a:string,b:string>>"))
    rows = nodes.join(by_node, ["book_id", "node_id"], "left").withColumn("_refs", F.coalesce("_refs", none))
    own = _inlines(F.col("spans"), F.col("_refs"))
    filled = F.array_position(F.transform(own, lambda i: i["text"].rlike(r"(?U)\S").cast("int")), F.lit(1)).cast("int")
    is_label = (F.col("node_type") == "footnote") & F.col("label").isNotNull() & (footnote_text(F.get(own, filled - 1)["text"]) == F.col("label"))
    content = F.when(F.coalesce(is_label, F.lit(False)), F.filter(own, lambda _, i: i != filled - 1)).otherwise(own)
    children = F.transform("children", lambda c: F.struct(c["node_id"].alias("node_id"), c["node_type"].alias("node_type"), c["ordinal"].alias("ordinal"), _inlines(c["spans"], F.col("_refs")).alias("content")))
    level = F.when(F.col("node_type") == "heading", heading_level(F.col("role"), F.col("level")))
    return rows.select("book_id", "node_pos", "node_id", "node_type", "role", level.alias("level"), "list_kind", "label", F.when(F.col("node_type") == "figure", F.concat(F.lit("assets/"), figure_file(F.col("node_id")))).alias("asset_id"), content.alias("content"), children.alias("children"))


def projection_warnings(relationships: DataFrame) -> DataFrame:
    """(book_id, warning) for continuations that were left open."""
    return relationships.where("kind = 'continues_to'").select("book_id", F.concat(F.lit("unresolved continuation: "), "source_id", F.lit(" -> "), "target_id").alias("warning"))


def _attribute(name: str, value: Column) -> Column:
    return F.concat(F.lit(f' {name}="'), escape_markup(value), F.lit('"'))


def inline_markup(i: Column, language: Column) -> Column:
    """An inline: text, strong, em, one span for italics and another language, and a link if it refers to a note."""
    styled, ref = i["italic"] | (F.size(i["marks"]) > 0), i["target_id"].isNotNull()
    foreign = F.coalesce(i["language"] != F.coalesce(language, F.lit("")), F.lit(False))
    strong, em = (F.array_contains(i["marks"], m) for m in ("strong", "emphasis"))
    some = lambda when, text: F.when(when, text).otherwise("")
    link = F.concat(F.lit('<sup class="noteref"><a'), F.coalesce(_attribute("id", i["source_span_id"]), F.lit("")), F.lit(f' epub:type="noteref" href="{ENDNOTES}#'), escape_markup(i["target_id"]), F.lit('">'))
    span = F.concat(F.lit("<span"), some(i["italic"], ' class="source-italic"'), some(foreign, F.concat(_attribute("lang", i["language"]), _attribute("xml:lang", i["language"]))), F.lit(">"))
    # Written from the outside in, so that no part of the expression stands twice.
    opened = (some(ref, link), some(i["italic"] | foreign, span), some(em, "<em>"), some(strong, "<strong>"))
    closed = (some(strong, "</strong>"), some(em, "</em>"), some(i["italic"] | foreign, "</span>"), some(ref, "</a></sup>"))
    return F.concat(*opened, escape_markup(F.when(styled, without_markup_stars(i["text"])).otherwise(i["text"])), *closed)


def content_markup(content: Column, language: Column) -> Column:
    return F.array_join(F.transform(content, lambda i: inline_markup(i, language)), "")


def text_element(tag: Column, node: Column, inner: Column, indent: Column, css: Column | None = None) -> Column:
    shown = F.coalesce(_attribute("class", css), F.lit("")) if css is not None else F.lit("")
    return F.concat(indent, F.lit("<"), tag, _attribute("id", node), shown, F.lit(">"), inner, F.lit("</"), tag, F.lit(">"))


def list_values(children: Column) -> Column:
    """For each item of an ordered list the ordinal to state, null where it is the expected one: one more than the last
    known ordinal and the items behind it. Before any is known nothing is expected."""

    def step(state: Column, item: Column) -> Column:
        o, due = item["ordinal"], state["due"]
        value = F.when(due.isNotNull() & (o != due), o)
        return F.struct(F.coalesce(o + 1, due + 1).alias("due"), F.concat(state["values"], F.array(value)).alias("values"))

    return F.aggregate(children, F.struct(F.get(children, F.lit(0))["ordinal"].alias("due"), F.array().cast("array<int>").alias("values")), step, lambda s: s["values"])


def _list_markup(n: DataFrame, language: Column, indent: str) -> Column:
    ordered = F.col("list_kind") == "ordered"
    tag = F.when(ordered, "ol").otherwise("ul")
    first = F.get("children", F.lit(0))["ordinal"]
    start = F.when(ordered & (first != 1), F.concat(F.lit(' start="'), first.cast("string"), F.lit('"'))).otherwise("")
    values = F.when(ordered, list_values(F.col("children"))).otherwise(F.transform("children", lambda _: F.lit(None).cast("int")))
    item = lambda c, v: F.concat(F.lit(f"{indent}  <li"), _attribute("id", c["node_id"]), F.coalesce(F.concat(F.lit(' value="'), v.cast("string"), F.lit('"')), F.lit("")), F.lit(">"), content_markup(c["content"], language), F.lit("</li>\n"))
    items = F.array_join(F.zip_with("children", values, item), "")
    return F.concat(F.lit(f"{indent}<"), tag, _attribute("id", F.col("node_id")), start, F.lit(">\n"), items, F.lit(f"{indent}</"), tag, F.lit(">"))


def node_markup(language: Column, indent: str = "    ") -> Column:
    """The element of a projected node that stands in the text; headings of groups are indented by two more."""
    col, inner = F.col, content_markup(F.col("content"), language)
    child = lambda tag, css: F.array_join(F.transform("children", lambda c: F.concat(F.lit(f"{indent}  <{tag}"), css, _attribute("id", c["node_id"]), F.lit(">"), content_markup(c["content"], language), F.lit(f"</{tag}>\n"))), "")
    role = F.replace("role", F.lit("_"), F.lit("-"))
    rank = F.col("level").isNotNull()
    heading = text_element(F.when(rank, F.concat(F.lit("h"), F.col("level").cast("string"))).otherwise("p"), col("node_id"), inner, F.when(col("grouped"), f"{indent}  ").otherwise(indent), F.when(rank, F.concat(F.lit("role-"), role)).otherwise(F.concat(F.lit("heading-label role-"), role)))
    caption = F.get(F.filter("children", lambda c: c["node_type"] == "caption"), F.lit(0))["content"]
    words = F.regexp_replace(F.array_join(F.transform(caption, lambda i: i["text"]), ""), r"(?U)^\s+|\s+\z", "")
    shown = F.when(F.size(caption) > 0, F.concat(F.lit(f"{indent}  <figcaption>"), content_markup(caption, language), F.lit("</figcaption>\n"))).otherwise("")
    figure = F.concat(F.lit(f"{indent}<figure"), _attribute("id", col("node_id")), F.lit(f'>\n{indent}  <img src="../'), escape_markup(col("asset_id")), F.lit('"'), _attribute("alt", F.coalesce(words, F.lit(""))), F.lit(" />\n"), shown, F.lit(f"{indent}</figure>"))
    verse = F.concat(F.lit(f'{indent}<div class="verse"'), _attribute("id", col("node_id")), F.lit(">\n"), child("p", F.lit(' class="verse-line"')), F.lit(f"{indent}</div>"))
    quote = F.concat(F.lit(f"{indent}<blockquote"), _attribute("id", col("node_id")), F.lit(">\n"), child("p", F.lit("")), F.lit(f"{indent}</blockquote>"))
    plain = lambda css: text_element(F.lit("p"), col("node_id"), inner, F.lit(indent), css)
    kind = col("node_type")
    return F.when(kind == "paragraph", plain(None)).when(kind == "heading", heading).when(kind == "list", _list_markup(None, language, indent)).when(kind == "verse", verse).when(kind == "quotation", quote).when(kind == "figure", figure).when(kind == "attribution", plain(F.lit("attribution")))


def chunked(nodes: DataFrame) -> DataFrame:
    """Projected nodes besides footnotes with chunk (from 1) and file. A chunk starts at a label, and at any other heading
    but a subtitle unless a label stands right before it; its file is named after the title that follows its labels. The window over a book
    sees places and roles only, and content is joined by its place: nodes are read twice, so give it a table that was written."""
    w = Window.partitionBy("book_id").orderBy("node_pos")
    is_heading = F.col("node_type") == "heading"
    label = F.coalesce(is_heading & F.col("role").isin(*LABEL_ROLES), F.lit(False))
    starts = F.coalesce(is_heading & ~F.col("role").isin(*UNRANKED_ROLES), F.lit(False))
    body = nodes.where("node_type <> 'footnote'")
    rows = body.select("book_id", "node_pos", "node_type", "role").withColumn("_label", label).withColumn("_starts", starts)
    cut = F.row_number().over(w).eqNullSafe(1) | F.col("_label") | (F.col("_starts") & ~F.lag("_label").over(w))
    rows = rows.withColumn("chunk", F.sum(cut.cast("int")).over(w))
    first = rows.groupBy("book_id", "chunk").agg(F.min_by(F.struct("node_type", "role"), F.when(~F.col("_label"), F.col("node_pos"))).alias("f"))
    stem = F.when(F.col("f.node_type") == "heading", chosen(F.col("f.role"), STEMS))
    named = first.withColumn("_stem", stem).withColumn("_n", F.count("*").over(Window.partitionBy("book_id"))).withColumn("_k", F.row_number().over(Window.partitionBy("book_id", F.coalesce("_stem", F.lit("section"))).orderBy("chunk")))
    file = F.when((F.col("_n") == 1) & F.col("_stem").isNull(), "content.xhtml").otherwise(F.concat(F.coalesce("_stem", F.lit("section")), F.lit("-"), F.format_string("%04d", "_k"), F.lit(".xhtml")))
    placed = rows.select("book_id", "node_pos", "chunk").join(named.select("book_id", "chunk", file.alias("file")), ["book_id", "chunk"])
    return body.join(placed, ["book_id", "node_pos"])


def grouped_headings(chunks: DataFrame) -> DataFrame:
    """Adds heading_run and grouped: of a run of headings in a chunk, those from behind the second last that has a level on
    form a group if one of them has a level and there are two or more."""
    w = Window.partitionBy("book_id", "chunk").orderBy("node_pos")
    new = ~((F.col("node_type") == "heading") & F.coalesce(F.lag("node_type").over(w) == "heading", F.lit(False)))
    rows = chunks.withColumn("heading_run", F.sum(new.cast("int")).over(w))
    whole = Window.partitionBy("book_id", "chunk", "heading_run")
    ranked = F.col("level").isNotNull().cast("int")
    left = F.sum(ranked).over(whole.orderBy(F.col("node_pos").desc()))
    rows = rows.withColumn("_in", (F.col("node_type") == "heading") & (left <= 1))
    size, some = F.count_if(F.col("_in")).over(whole), F.max(F.when(F.col("_in"), ranked)).over(whole)
    return rows.withColumn("grouped", F.col("_in") & (size >= 2) & (some == 1)).drop("_in")


def _document(language: Column, title: Column, body: Column) -> Column:
    tongue = F.coalesce(language, F.lit("und"))
    return F.concat(
        F.lit('<?xml version="1.0" encoding="utf-8"?>\n<!DOCTYPE html>\n<html xmlns="http://www.w3.org/1999/xhtml" xmlns:epub="http://www.idpf.org/2007/ops"'),
        _attribute("lang", tongue), _attribute("xml:lang", tongue),
        F.lit('>\n  <head>\n    <meta charset="utf-8" />\n    <title>'), escape_markup(title),
        F.lit('</title>\n    <link rel="stylesheet" type="text/css" href="../styles/book.css" />\n  </head>\n'), body, F.lit("</html>\n"),
    )


def content_documents(chunks: DataFrame, books: DataFrame) -> DataFrame:
    """(book_id, position, file, content) of the chunks; books (book_id, title, language). chunks come from grouped_headings()."""
    rows = chunks.join(books.select("book_id", "title", "language"), "book_id")
    element = node_markup(F.col("language"))
    of_group = F.when(F.col("grouped"), F.col("heading_run"))
    parts = rows.select("book_id", "chunk", "file", "title", "language", "node_pos", of_group.alias("run"), element.alias("markup"))
    # Headings of a group become one element at the place of their first.
    w = Window.partitionBy("book_id", "chunk", "run")
    placed = parts.withColumn("at", F.when(F.col("run").isNull(), F.col("node_pos")).otherwise(F.min("node_pos").over(w)))
    one = placed.groupBy("book_id", "chunk", "file", "title", "language", "at", "run").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("node_pos", "markup"))), lambda x: x["markup"]), "\n").alias("markup"))
    wrapped = F.when(F.col("run").isNull(), F.col("markup")).otherwise(F.concat(F.lit('    <hgroup class="heading-group">\n'), "markup", F.lit("\n    </hgroup>")))
    docs = one.groupBy("book_id", "chunk", "file", "title", "language").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", wrapped.alias("m")))), lambda x: x["m"]), "\n").alias("body"))
    body = F.concat(F.lit('  <body epub:type="bodymatter">\n'), "body", F.lit("\n  </body>\n"))
    return docs.select("book_id", F.col("chunk").cast("int").alias("position"), "file", _document(F.col("language"), F.col("title"), body).alias("content"))


def _inlines_of(nodes: DataFrame, *keep: str) -> DataFrame:
    """A row for each inline of a node, its own and its children's, in order."""
    own = F.transform(F.coalesce("content", F.array().cast(f"array<{INLINE_TYPE}>")), lambda i: i)
    kids = F.coalesce(F.flatten(F.transform("children", lambda c: c["content"])), F.array().cast(f"array<{INLINE_TYPE}>"))
    return nodes.select(*keep, "node_pos", F.posexplode(F.concat(own, kids)).alias("i_pos", "i"))


def backlinks(chunks: DataFrame) -> DataFrame:
    """(book_id, node_id, links): for each footnote the markup of links to its references, in reading order, numbered if
    there are more than one."""
    refs = _inlines_of(chunks, "book_id", "file").where("i.target_id is not null")
    by = refs.groupBy("book_id", F.col("i.target_id").alias("node_id")).agg(F.sort_array(F.collect_list(F.struct("node_pos", "i_pos", "file", F.col("i.source_span_id").alias("id")))).alias("r"))
    name = lambda i: F.when(F.size("r") == 1, "Back to reference").otherwise(F.concat(F.lit("Back to reference "), (i + 1).cast("string")))
    link = lambda x, i: F.concat(F.lit('<a class="footnote-backlink" epub:type="backlink" href="'), x["file"], F.lit("#"), escape_markup(x["id"]), F.lit('"'), _attribute("aria-label", name(i)), F.lit(">↩</a>"))
    return by.select("book_id", "node_id", F.array_join(F.transform("r", link), " ").alias("links"))


def endnotes_documents(nodes: DataFrame, chunks: DataFrame, books: DataFrame) -> DataFrame:
    """(book_id, position, file, content): the notes of each book that has some, in one document behind all others."""
    notes = nodes.where("node_type = 'footnote'").join(backlinks(chunks), ["book_id", "node_id"], "left").join(books.select("book_id", "title", "language"), "book_id")
    label = F.when(F.coalesce("label", F.lit("")) != "", F.concat(F.lit('<span class="endnote-label">'), escape_markup(F.col("label")), F.lit("</span> "))).otherwise("")
    item = F.concat(F.lit("      <li"), _attribute("id", F.col("node_id")), F.lit(' epub:type="endnote">\n        <p>'), label, content_markup(F.col("content"), F.col("language")), F.coalesce(F.concat(F.lit(" "), "links"), F.lit("")), F.lit("</p>\n      </li>\n"))
    docs = notes.groupBy("book_id", "language").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("node_pos", item.alias("m")))), lambda x: x["m"]), "").alias("items"))
    body = F.concat(F.lit('  <body epub:type="backmatter">\n    <section id="endnotes" epub:type="endnotes">\n      <h1>Notes</h1>\n      <ol class="endnotes-list">\n'), "items", F.lit("      </ol>\n    </section>\n  </body>\n"))
    return docs.select("book_id", F.lit(1 << 30).alias("position"), F.lit(ENDNOTES).alias("file"), _document(F.col("language"), F.lit("Notes"), body).alias("content"))


def linkable_ids(nodes: DataFrame, chunks: DataFrame) -> DataFrame:
    """(book_id, id, file) of everything a link may point at: nodes, list items, verse lines, quoted paragraphs, references, notes."""
    here = chunks.select("book_id", "file", "node_id", F.filter(F.coalesce(F.transform("children", lambda c: F.when(c["node_type"].isin("list_item", "verse_line", "paragraph"), c["node_id"])), F.array().cast("array<string>")), lambda x: x.isNotNull()).alias("kids"))
    ids = here.select("book_id", "file", F.explode(F.concat(F.array("node_id"), "kids")).alias("id"))
    refs = _inlines_of(chunks, "book_id", "file").where("i.target_id is not null").select("book_id", "file", F.col("i.source_span_id").alias("id"))
    notes = nodes.where("node_type = 'footnote'").select("book_id", F.lit(ENDNOTES).alias("file"), F.col("node_id").alias("id"))
    return ids.unionByName(refs).unionByName(notes).select("book_id", "id", "file")


def rendered(nodes: DataFrame, books: DataFrame) -> DataFrame:
    """(book_id, position, file, content) of all documents of books (book_id, title, language), from projected nodes. They
    are read several times, so give it a table that was written, not the plan of a whole analysis. Raises ValueError if an
    id would stand in two documents or a reference has no note."""
    chunks = grouped_headings(chunked(nodes))
    ids = linkable_ids(nodes, chunks)
    twice = ids.groupBy("book_id", "id").agg(F.count_distinct("file").alias("n")).where("n > 1").limit(5).collect()
    if twice:
        raise ValueError(f"ids in two documents: {[(r['book_id'], r['id']) for r in twice]}")
    aims = _inlines_of(chunks, "book_id").where("i.target_id is not null").select("book_id", F.col("i.target_id").alias("id")).distinct()
    lost = aims.join(ids, ["book_id", "id"], "left_anti").limit(5).collect()
    if lost:
        raise ValueError(f"references without a note: {[(r['book_id'], r['id']) for r in lost]}")
    return content_documents(chunks, books).unionByName(endnotes_documents(nodes, chunks, books))
