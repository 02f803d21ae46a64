"""Queries over whole books of typed pages, each next to the SQL with the same rows.

Stand-ins: a book is a source, a page a document in the order of doc_id, its physical number doc_id div 20 + 1, its blocks
the lines of the text. A block's role, marker, region, language and superscripts follow from (doc_id, line number).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.functions import text as T
from folio.operators import analyzer as A
from folio.operators import backup as U
from folio.operators import buildmanifest as B
from folio.operators import documents as J
from folio.operators import evidence as E
from folio.operators import findings as D
from folio.operators import frontmatter as M
from folio.operators import packaging as K
from folio.operators import ready as Y
from folio.operators import rendering as X
from folio.operators import report as P
from folio.operators import runtime as R
from folio.plans.catalogue import query, read
from folio.sources import files as S
from folio.sources.outputs import dropped, written

ROLES = ("paragraph", "paragraph", "quote", "verse", "list_item", "list_item", "footnote", "heading", "attribution", "image", "caption", "table", "quote")
HEADINGS = ("chapter_title", "section_title", "genre_label", "subtitle", "scenario_title", "unknown")


def typed_pages(spark: SparkSession, d: str) -> DataFrame:
    """(book_id, page_pos, page_number, page)."""
    plain = lambda v: F.struct(F.lit("roman").alias("posture"), F.lit("normal").alias("weight"), F.lit(v).alias("vertical_position"), F.lit("normal").alias("caps_style"), F.array().cast("array<string>").alias("decorations"))
    doc = F.col("doc_id")
    pid = F.concat(F.lit("p"), doc.cast("string"))
    pick = lambda values, k: F.get(F.array(*map(F.lit, values)), (k % len(values)).cast("int"))

    def block(line, i):
        bid = T.block_id(pid, i)
        role = F.when(i == 0, "page_header").otherwise(pick(ROLES, doc * 7 + i * 3))
        tongue = F.when((role == "quote") & (i % 5 == 0), "xx").when((role == "quote") & (i % 5 == 1), None).otherwise(F.col("lang"))
        span = lambda n, t, v: F.struct(T.span_id(bid, F.lit(n)).alias("span_id"), t.alias("text"), tongue.alias("language"), plain(v).alias("source_typography"), F.lit(False).alias("semantic_line_break_after"))
        label = F.concat(F.lit("("), (i % 3 + 1).cast("string"), F.lit(".)"))
        spans = F.when(role == "footnote", F.array(span(0, label, "superscript"), span(1, line, "baseline"))).when((role == "paragraph") & (i % 2 == 0), F.array(span(0, line, "baseline"), span(1, label, "superscript"))).otherwise(F.array(span(0, line, "baseline")))
        heading = role == "heading"
        marker = F.when(role == "list_item", F.struct(F.when(doc % 2 == 0, "numeric").otherwise("bullet").alias("kind"), F.lit(None).cast("string").alias("raw_text"), F.when(doc % 2 == 0, i + 1).cast("int").alias("ordinal")))
        region = F.when((role == "image") & (i % 2 == 0), F.struct(F.lit(0.1).alias("x"), F.lit(0.2).alias("y"), F.lit(0.5).alias("width"), F.lit(0.25).alias("height")))
        return F.struct(bid.alias("block_id"), i.cast("int").alias("sequence_index"), role.alias("role_hint"), spans.alias("content"), tongue.alias("dominant_language"), F.when(heading & (i % 2 == 0), i % 7).cast("int").alias("heading_level_hint"), F.when(heading, pick(HEADINGS, doc + i)).otherwise("unknown").alias("heading_role_hint"), marker.alias("marker"), region.alias("region"), F.lit(None).cast("string").alias("alignment"))

    page = F.struct(pid.alias("page_id"), F.lit("text").alias("page_kind_hint"), F.col("lang").alias("dominant_language"), F.when(doc % 3 == 0, (F.floor(doc / 20) + 1).cast("string")).alias("printed_page_number"), F.transform(F.split("text", "\n"), block).alias("blocks"), F.array().cast("array<string>").alias("warnings"))
    rows = read(spark, d, "documents").select(F.col("source").alias("book_id"), doc.alias("page_pos"), (F.floor(doc / 20) + 1).cast("int").alias("page_number"), page.cast(E.PAGE_TYPE).alias("page"))
    return rows


_TYPED = f"""t0 AS (SELECT source AS book_id, doc_id, 'p' || doc_id AS page_id, doc_id // 20 + 1 AS number, lang, split(text, chr(10)) AS l FROM documents),
t1 AS (SELECT book_id, doc_id, page_id, number, lang, unnest(range(len(l)))::INTEGER AS seq, unnest(l) AS line FROM t0),
t2 AS (SELECT *, page_id || ':block:' || printf('%04d', seq + 1) AS block_id, CASE WHEN seq = 0 THEN 'page_header' ELSE {list(ROLES)}[(doc_id * 7 + seq * 3) % {len(ROLES)} + 1] END AS role FROM t1),
t AS (SELECT *, CASE WHEN role = 'quote' AND seq % 5 = 0 THEN 'xx' WHEN role = 'quote' AND seq % 5 = 1 THEN NULL ELSE lang END AS tongue, CASE WHEN role = 'list_item' AND doc_id % 2 = 0 THEN seq + 1 END AS ordinal, role = 'list_item' AND doc_id % 2 = 0 AS ordered, role = 'image' AND seq % 2 = 0 AS region,
 CASE WHEN role = 'footnote' THEN '(' || (seq % 3 + 1) || '.)' || line WHEN role = 'paragraph' AND seq % 2 = 0 THEN line || '(' || (seq % 3 + 1) || '.)' ELSE line END AS text FROM t2)"""

_PLACED = _TYPED + """, b0 AS (SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY doc_id, seq) AS pos FROM t WHERE role <> 'page_header'),
b1 AS (SELECT *, lag(role) OVER w AS prole, lag(doc_id) OVER w = doc_id AS same, coalesce(lag(number) OVER w + 1 = number, FALSE) AS follows, lag(ordered) OVER w AS pordered, lag(ordinal) OVER w AS pordinal, lag(region) OVER w AS pregion FROM b0 WINDOW w AS (PARTITION BY book_id ORDER BY pos)),
b2 AS (SELECT *, coalesce(same AND prole = role, FALSE) AS alike, sum(CASE WHEN coalesce(same AND prole = role, FALSE) THEN 0 ELSE 1 END) OVER (PARTITION BY book_id ORDER BY pos) AS run FROM b1),
b3 AS (SELECT *, last_value(tongue IGNORE NULLS) OVER (PARTITION BY book_id, run ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS known FROM b2),
b4 AS (SELECT *, coalesce(CASE WHEN role = 'list_item' THEN prole = 'list_item' AND (same OR follows) AND pordered = ordered AND (NOT ordered OR pordinal IS NULL OR ordinal IS NULL OR ordinal = pordinal + 1)
  WHEN role = 'caption' THEN same AND prole = 'image' WHEN role = 'verse' THEN alike WHEN role = 'quote' THEN alike AND coalesce(known = tongue, TRUE) ELSE FALSE END, FALSE) AS joins FROM b3),
b5 AS (SELECT *, sum(CASE WHEN joins THEN 0 ELSE 1 END) OVER (PARTITION BY book_id ORDER BY pos) AS node_no,
 CASE WHEN role = 'list_item' THEN 'list' WHEN role = 'quote' THEN 'quotation' WHEN role = 'verse' THEN 'verse' WHEN (role = 'image' AND region) OR (role = 'caption' AND joins AND pregion) THEN 'figure' WHEN role IN ('paragraph', 'heading', 'footnote', 'attribution') THEN role END AS node_type FROM b4),
nodes AS (SELECT book_id, node_no, node_type, min(pos) AS node_pos, arg_min(block_id, pos) || ':node:' || node_type AS node_id, count(*) AS blocks, arg_min(doc_id, pos) AS doc_id, count(DISTINCT doc_id) AS pages,
 count(DISTINCT tongue) AS tongues, min(tongue) AS tongue, length(trim(regexp_replace(string_agg(text, ' ' ORDER BY pos), '[\\s\\v]+', ' ', 'g'))) AS size FROM b5 WHERE node_type IS NOT NULL GROUP BY book_id, node_no, node_type)"""


def _placed(spark, d):
    ordered = A.ordered_pages(typed_pages(spark, d))
    return ordered, A.positions(A._blocks(ordered))


@query(f"WITH {_PLACED} SELECT book_id, node_id, node_type, blocks FROM nodes")
def q46_analyzed_nodes(spark, d):
    return A.nodes(_placed(spark, d)[1]).select("book_id", "node_id", "node_type", F.size("provenance").cast("long").alias("blocks"))


@query(f"""WITH {_TYPED}, n AS (SELECT book_id, page_id, seq % 3 AS k, count(*) AS c, min(block_id) AS b FROM t WHERE role = 'footnote' GROUP BY ALL HAVING count(*) = 1)
SELECT t.book_id, t.block_id || ':span:0002' AS source_id, n.b || ':node:footnote' AS target_id, 1.0::DOUBLE AS confidence FROM t JOIN n ON n.book_id = t.book_id AND n.page_id = t.page_id AND n.k = t.seq % 3 WHERE role = 'paragraph' AND seq % 2 = 0""")
def q47_footnote_references(spark, d):
    ordered = A.ordered_pages(typed_pages(spark, d))
    return A.footnote_references(A._blocks(ordered).where(~F.col("role").isin(*A.FURNITURE))).select("book_id", "source_id", "target_id", "confidence")


@query(f"""WITH {_PLACED}, m AS (SELECT *, lag(node_type) OVER w AS pt, lead(node_type) OVER w AS nt, lag(node_id) OVER w AS pid, lead(node_id) OVER w AS nid, lag(CASE WHEN pages = 1 THEN doc_id END) OVER w AS pd, lead(CASE WHEN pages = 1 THEN doc_id END) OVER w AS nd,
  lag(CASE WHEN tongues = 1 THEN tongue END) OVER w AS ptg, lag(size) OVER w AS ps, lag(node_type, 2) OVER w AS ppt FROM nodes WINDOW w AS (PARTITION BY book_id ORDER BY node_pos)),
x AS (SELECT *, coalesce(pt IN ('quotation', 'verse') AND pd = doc_id, FALSE) AS a, coalesce(nt IN ('quotation', 'verse') AND nd = doc_id, FALSE) AS b FROM m)
SELECT book_id, 'attribution_of' AS kind, node_id AS source_id, CASE WHEN a THEN pid ELSE nid END AS target_id, 0.95::DOUBLE AS confidence FROM x WHERE node_type = 'attribution' AND a <> b
UNION ALL SELECT book_id, 'translation_of', node_id, pid, CASE WHEN coalesce(ppt = 'attribution', FALSE) OR coalesce(nt = 'attribution', FALSE) THEN 0.90::DOUBLE ELSE 0.80::DOUBLE END FROM m
 WHERE node_type = 'quotation' AND pt = 'quotation' AND pd = doc_id AND tongues = 1 AND ptg <> tongue AND ps > 0 AND size / ps::DOUBLE BETWEEN 0.4::DOUBLE AND 2.5::DOUBLE""")
def q48_neighbour_links(spark, d):
    return A.neighbour_links(A.nodes(_placed(spark, d)[1])).select("book_id", "kind", "source_id", "target_id", "confidence")


_LINKS = _PLACED + r""", e0 AS (SELECT book_id, doc_id, number, arg_max(struct_pack(r := role, t := text, g := tongue, i := CASE WHEN role = 'list_item' THEN block_id || ':node:list-item' ELSE nid END), pos) FILTER (WHERE role <> 'footnote') AS lft, arg_min(struct_pack(r := role, t := text, g := tongue, i := CASE WHEN role = 'list_item' THEN block_id || ':node:list-item' ELSE nid END, v := vertical), pos) AS rgt,
  arg_max(vertical_end, pos) FILTER (WHERE role <> 'footnote') AS ve FROM (SELECT *, CASE WHEN role = 'footnote' THEN 's' ELSE 'b' END AS vertical, CASE WHEN role = 'paragraph' AND seq % 2 = 0 THEN 's' ELSE 'b' END AS vertical_end, first_value(block_id) OVER (PARTITION BY book_id, node_no ORDER BY pos) || ':node:' || node_type AS nid FROM b5) GROUP BY ALL),
e1 AS (SELECT d.source AS book_id, d.doc_id, d.doc_id // 20 + 1 AS number, lft, rgt, ve FROM documents d LEFT JOIN e0 ON e0.book_id = d.source AND e0.doc_id = d.doc_id),
e2 AS (SELECT *, lead(rgt) OVER w AS nx, lead(number) OVER w AS nn FROM e1 WINDOW w AS (PARTITION BY book_id ORDER BY doc_id)),
e AS (SELECT book_id, lft.i AS source_id, nx.i AS target_id, 0.40::DOUBLE + CASE WHEN regexp_matches(lft.t, '[.!?…][\s"''”’)\]}]*$') THEN 0.0::DOUBLE ELSE 0.30::DOUBLE END + CASE WHEN regexp_matches(nx.t, '^[^\p{L}]*\p{Ll}') THEN 0.20::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN lft.g = nx.g THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN ve = nx.v THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END AS c
 FROM e2 WHERE nn = number + 1 AND lft.r IN ('paragraph', 'list_item', 'quote') AND nx.r IN ('paragraph', 'list_item', 'quote') AND (lft.r = nx.r OR (lft.r <> 'quote' AND nx.r <> 'quote')) AND regexp_matches(lft.t, '\S') AND regexp_matches(nx.t, '\S'))"""


@query(f"WITH {_LINKS} SELECT book_id, source_id, target_id, least(c, 0.99::DOUBLE) AS confidence FROM e WHERE c >= 0.65::DOUBLE AND source_id IS NOT NULL AND target_id IS NOT NULL AND source_id <> target_id")
def q49_continuation_links(spark, d):
    return A.continuations(*_placed(spark, d)).select("book_id", "source_id", "target_id", "confidence")


@query(f"""WITH {_PLACED} SELECT book_id, (CASE WHEN h THEN pb ELSE block_id END) || ':candidate:inset' AS candidate_id, CASE WHEN h THEN 0.90::DOUBLE ELSE 0.75::DOUBLE END AS confidence
FROM (SELECT *, coalesce(same AND prole = 'heading', FALSE) AS h, lag(block_id) OVER (PARTITION BY book_id ORDER BY pos) AS pb FROM b1) WHERE role = 'heading' AND {list(HEADINGS)}[(doc_id + seq) % {len(HEADINGS)} + 1] = 'genre_label'""")
def q50_inset_candidates(spark, d):
    return A.inset_candidates(_placed(spark, d)[1]).select("book_id", "candidate_id", "confidence")


@query()
def q51_resolved_nodes(spark, d):
    """The whole analysis; tests hold the chains against a sequential simulation."""
    return A.analyze(typed_pages(spark, d)).nodes.select("book_id", "node_pos", "node_id", "node_type", F.size("provenance").alias("blocks"))


@query("""WITH p AS (SELECT doc_id, lang, text, n_chars FROM documents)
SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN 1 ELSE 0 END + CASE WHEN doc_id % 5 = 0 THEN 1 ELSE 0 END + CASE WHEN doc_id % 7 = 0 THEN 1 ELSE 0 END + CASE WHEN doc_id % 4 = 0 THEN 1 ELSE 0 END AS violations FROM p""")
def q52_normalized_pages(spark, d):
    """Payloads with faults: an unknown kind, a key too many, a span without break, a heading level of a paragraph."""
    doc = F.col("doc_id")
    style = F.lit('{"posture":"roman","weight":"normal","vertical_position":"baseline","caps_style":"normal","decorations":[]}')
    span = F.concat(F.lit('{"text":'), F.to_json(F.array("text")).substr(F.lit(2), F.length(F.to_json(F.array("text"))) - 2), F.lit(',"language":null,"source_typography":'), style, F.when(doc % 7 == 0, "}").otherwise(',"semantic_line_break_after":false}'))
    raw = F.concat(F.lit('{"page_kind_hint":"'), F.when(doc % 9 == 0, "poster").otherwise("text"), F.lit('","dominant_language":null,"printed_page_number":null,"warnings":[],'), F.when(doc % 5 == 0, '"note":1,').otherwise(""), F.lit('"blocks":[{"role_hint":"paragraph","content":['), span, F.lit('],"dominant_language":null,"heading_level_hint":'), F.when(doc % 4 == 0, "2").otherwise("null"), F.lit(',"heading_role_hint":"unknown","marker":null,"region":null,"alignment":null}]}'))
    rows = read(spark, d, "documents").select("doc_id", F.concat(F.lit("p"), doc.cast("string")).alias("page_id"), raw.alias("raw"))
    return E.normalized(rows).select("doc_id", F.size("violations").alias("violations"))


@query("SELECT 'p' || doc_id AS page_id, CASE WHEN doc_id % 6 = 0 THEN 1 ELSE 0 END AS violations, doc_id % 6 <> 0 AS same FROM documents")
def q53_round_trip(spark, d):
    """Stored pages, of which every sixth is given another page's id and so isn't canonical."""
    pages = typed_pages(spark, d).where("size(page.blocks) > 0")
    # A level of 0 isn't allowed; those of the stand-in that are 0 become null.
    fixed = F.col("page").withField("blocks", F.transform("page.blocks", lambda b: b.withField("heading_level_hint", F.when(b["heading_level_hint"] > 0, b["heading_level_hint"]))))
    source = F.struct(F.lit("s").alias("source_id"), F.lit("file:///x").alias("uri"), F.lit(None).cast("string").alias("sha256"), F.lit(None).cast("string").alias("media_type"), F.create_map(F.lit("page_number"), "page_number").alias("metadata"))
    moved = F.when(F.col("page_pos") % 6 == 0, fixed.withField("page_id", F.concat(F.col("page.page_id"), F.lit("x")))).otherwise(fixed)
    rows = pages.select(F.col("page.page_id").alias("page_id"), fixed.alias("before"), E.stored_page(moved, source).alias("stored"))
    out = E.reloaded(rows)
    return out.select("page_id", F.size("violations").alias("violations"), F.coalesce(F.to_json("page") == F.to_json("before"), F.lit(False)).alias("same"))


@query(f"""WITH {_TYPED}, k AS (SELECT doc_id, trim(regexp_replace(string_agg(text, ' ' ORDER BY seq), '[\\s\\v]+', ' ', 'g')) AS x FROM t WHERE role NOT IN ('page_header', 'image') GROUP BY doc_id)
SELECT d.doc_id, md5(coalesce(x, '')) AS text_md5 FROM documents d LEFT JOIN k USING (doc_id)""")
def q54_page_projections(spark, d):
    pages = typed_pages(spark, d)
    return D.projections(pages.withColumn("page_number", F.col("page_pos"))).select(F.col("page_number").alias("doc_id"), F.md5(F.col("text").cast("binary")).alias("text_md5"))


def _plain_projection(spark, d):
    return read(spark, d, "documents").select(F.col("source").alias("book_id"), F.concat(F.lit("p"), "doc_id").alias("page_id"), F.col("doc_id").alias("page_number"), "text", F.array().cast(f"array<{D.RUN_TYPE}>").alias("anchors"))


@query(rf"SELECT doc_id AS page_number, len(regexp_extract_all(text, '\p{{Ll}}\.\p{{Lu}}')) + len(regexp_extract_all(text, '\p{{L}}{D.digit_class()}')) AS findings FROM documents WHERE regexp_matches(text, '\p{{Ll}}\.\p{{Lu}}|\p{{L}}{D.digit_class()}')")
def q55_boundary_findings(spark, d):
    return D.boundary_findings(_plain_projection(spark, d)).groupBy("page_number").agg(F.count("*").alias("findings"))


@query("""WITH c AS (SELECT doc_id, i, doc_id % 10 * i AS s, doc_id % 10 * i + 2 + doc_id % 3 AS e, text FROM documents, (SELECT unnest([1, 2]) AS i)),
p AS (SELECT *, lag(e) OVER (PARTITION BY doc_id ORDER BY s, e, i) AS pe FROM c)
SELECT doc_id, i::INTEGER AS i, CASE WHEN doc_id % 11 = 0 THEN 'unknown span' WHEN s < pe THEN 'overlap' WHEN e > length(text) THEN 'outside the span' WHEN doc_id % 4 = 0 AND i = 1 THEN 'stale' END AS problem FROM p""")
def q56_checked_corrections(spark, d):
    docs = read(spark, d, "documents").select(F.col("source").alias("book_id"), "doc_id", F.col("doc_id").cast("string").alias("span_id"), "text")
    start = (F.col("doc_id") % 10 * F.col("i")).cast("int")
    made = docs.withColumn("i", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("span_start", start).withColumn("span_end", (start + 2 + F.col("doc_id") % 3).cast("int"))
    seen = F.substring("text", F.col("span_start") + 1, F.col("span_end") - F.col("span_start"))
    edits = made.select("book_id", "doc_id", "i", F.when(F.col("doc_id") % 11 == 0, "none").otherwise(F.col("span_id")).alias("span_id"), "span_start", "span_end", F.when((F.col("doc_id") % 4 == 0) & (F.col("i") == 1), F.concat(seen, F.lit("?"))).otherwise(seen).alias("original_text"), F.col("i").cast("string").alias("replacement_text"))
    # Edits of unknown spans are judged for themselves.
    edits = edits.withColumn("span_id", F.when(F.col("span_id") == "none", F.concat(F.lit("none"), "doc_id")).otherwise(F.col("span_id")))
    return D.checked_corrections(docs, edits).select("doc_id", "i", "problem")


def _kind_pairs(spark, d):
    cells = ("a b", "ab", "a,b", "", " ", ",", ";", "ab c", "x", "yz", "longer text", ", .")
    at = lambda k: F.get(F.array(*map(F.lit, cells)), k.cast("int"))
    e = read(spark, d, "events")
    return e.select("event_id", at(F.col("event_id") % 12).alias("mine"), at(F.floor(F.col("event_id") / 12) % 12).alias("other"))


@query("""WITH c AS (SELECT ['a b', 'ab', 'a,b', '', ' ', ',', ';', 'ab c', 'x', 'yz', 'longer text', ', .'] AS l), p AS (SELECT event_id, l[event_id % 12 + 1] AS a, l[event_id // 12 % 12 + 1] AS b FROM events, c),
k AS (SELECT event_id, a, b, CASE WHEN a <> b AND replace(a, ' ', '') = replace(b, ' ', '') THEN 'whitespace' WHEN a = '' THEN 'missing_text' WHEN b = '' THEN 'extra_text' WHEN regexp_full_match(replace(a, ' ', ''), '[,;.]+') AND regexp_full_match(replace(b, ' ', ''), '[,;.]+') THEN 'punctuation' WHEN length(a) <= 2 AND length(b) <= 2 THEN 'character' ELSE 'replacement' END AS kind FROM p)
SELECT event_id, kind, CASE WHEN kind IN ('whitespace', 'punctuation') OR greatest(length(a), length(b)) <= 2 THEN 'minor' ELSE 'major' END AS severity FROM k""")
def q57_difference_kinds(spark, d):
    p = _kind_pairs(spark, d).withColumn("kind", D.difference_kind(F.col("mine"), F.col("other")))
    return p.select("event_id", "kind", D.severity(F.col("kind"), F.col("mine"), F.col("other")).alias("severity"))


@query(f"""WITH r AS (SELECT doc_id, {list(HEADINGS)}[doc_id % {len(HEADINGS)} + 1] AS role, CASE WHEN doc_id % 4 <> 0 THEN doc_id % 9 END AS level FROM documents)
SELECT doc_id, CASE WHEN role IN ('genre_label', 'subtitle') THEN NULL WHEN level BETWEEN 1 AND 6 THEN level WHEN role = 'chapter_title' THEN 1 WHEN role = 'section_title' THEN 2 WHEN role = 'unknown' THEN 2 ELSE 3 END::INTEGER AS level FROM r""")
def q32_heading_level(spark, d):
    role = F.get(F.array(*map(F.lit, HEADINGS)), (F.col("doc_id") % len(HEADINGS)).cast("int"))
    return read(spark, d, "documents").select("doc_id", X.heading_level(role, F.when(F.col("doc_id") % 4 != 0, F.col("doc_id") % 9)).cast("int").alias("level"))


def _semantic(spark, d):
    """Projected nodes of the analysed books, as a table that was written, since several steps read them."""
    nodes, references = A.nodes_and_references(typed_pages(spark, d))
    out = written(X.projected(nodes, references), "semantic")
    dropped(nodes, references)
    return out


@query()
def q58_spine_documents(spark, d):
    """All documents of all books; tests hold the markup against given documents."""
    nodes = _semantic(spark, d)
    books = read(spark, d, "documents").select(F.col("source").alias("book_id")).distinct().select("book_id", F.concat(F.lit("Book "), "book_id").alias("title"), F.lit("en").alias("language"))
    chunks = X.grouped_headings(X.chunked(nodes))
    documents = X.content_documents(chunks, books).unionByName(X.endnotes_documents(nodes, chunks, books))
    return documents.select("book_id", "position", "file", F.sha2("content", 256).alias("sha256"))


@query()
def q59_toc_entries(spark, d):
    return K.toc_entries(X.chunked(_semantic(spark, d))).select("book_id", "target_id", "label", "file", "level", "depth", "parent")


@query("""WITH h AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href FROM pages), u AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/]*(/.*)$', 1) AS file FROM pages)
SELECT page_id, count(*) AS links, count(*) FILTER (WHERE NOT regexp_matches(href, '^(https?|mailto|tel):') AND NOT EXISTS (SELECT 1 FROM u WHERE u.file = href)) AS broken FROM h GROUP BY page_id""")
def q37_link_integrity(spark, d):
    """Links between pages of one site, as link checks of one package whose documents are the pages' paths."""
    pages = read(spark, d, "pages").withColumn("book_id", F.lit("site"))
    path = F.regexp_extract("url", "^[a-z]+://[^/]*/(.*)$", 1)
    links = pages.select("book_id", "page_id", F.posexplode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)).alias("n", "href"))
    asked = links.select("book_id", F.format_string("%d-%d", F.col("page_id"), F.col("n")).alias("source"), F.regexp_replace("href", "^/", "").alias("href"), F.lit(True).alias("navigation")).where(~F.lower("href").rlike("^(https?|mailto|tel):"))
    broken = K.link_problems(asked, asked.select("book_id", F.lit("").alias("file"), F.lit("").alias("id")).limit(0), pages.select("book_id", path.alias("file")))
    bad = broken.groupBy(F.substring_index("source", "-", 1).cast("long").alias("page_id")).agg(F.count("*").alias("broken"))
    return links.groupBy("page_id").agg(F.count("*").alias("links")).join(bad, "page_id", "left").na.fill(0, ["broken"])


@query("""SELECT source AS book_id, count(*) AS selected, count(*) FILTER (WHERE s IN ('extracted', 'reused')) AS completed, count(*) FILTER (WHERE s = 'extracted') AS extracted, count(*) FILTER (WHERE s = 'reused') AS reused, count(*) FILTER (WHERE s = 'failed') AS failed,
 count(*) FILTER (WHERE s IN ('extracted', 'reused') AND doc_id % 3 = 0) AS recovered, count(*) FILTER (WHERE s IS NULL) AS remaining FROM (SELECT *, ['extracted', 'reused', 'failed', NULL][doc_id % 4 + 1] AS s FROM documents) GROUP BY source""")
def q60_extraction_summary(spark, d):
    status = F.get(F.array(F.lit("extracted"), F.lit("reused"), F.lit("failed"), F.lit(None)), (F.col("doc_id") % 4).cast("int"))
    return R.extraction_summary(read(spark, d, "documents").select(F.col("source").alias("book_id"), status.alias("status"), (F.col("doc_id") % 3 == 0).alias("recovered")))


@query("""WITH a AS (SELECT user_id AS page_id, event_id, event_type = 'purchase' AS ok, value FROM events WHERE value IS NOT NULL), f AS (SELECT page_id, arg_min(floor(value)::BIGINT, event_id) AS v FROM a WHERE ok GROUP BY page_id)
SELECT 'tokens' AS key, sum(v)::BIGINT AS total FROM f""")
def q20_usage_totals(spark, d):
    """Users as pages, purchases as attempts that succeeded: the first one's usage counts."""
    attempt = F.struct("event_id", F.when(F.col("event_type") == "purchase", "succeeded").otherwise("failed").alias("status"), F.create_map(F.lit("tokens"), F.floor("value")).alias("usage"))
    pages = read(spark, d, "events").where("value is not null").groupBy(F.lit("b").alias("book_id"), F.col("user_id").alias("page_id")).agg(F.array_sort(F.collect_list(attempt), lambda a, b: F.when(a["event_id"] < b["event_id"], -1).otherwise(1)).alias("attempts"))
    return R.usage_totals(R.first_usage(pages))


@query("""WITH a AS (SELECT user_id, event_id, event_type = 'error' AS bad, CASE WHEN user_id % 4 = 0 THEN NULL ELSE 'p' || user_id % 3 END AS profile FROM events WHERE user_id % 5 <> 0)
SELECT coalesce(profile, 'r' || event_id % 2) AS profile, count(*) FILTER (WHERE NOT bad) AS succeeded, count(*) FILTER (WHERE bad) AS failed FROM a GROUP BY 1""")
def q21_routing_summary(spark, d):
    bad = F.col("event_type") == "error"
    attempt = F.struct(F.when(bad, "failed").otherwise("succeeded").alias("status"), F.when(bad, "transient").alias("reason"), F.when(F.col("user_id") % 4 != 0, F.concat(F.lit("p"), (F.col("user_id") % 3).cast("string"))).alias("profile"), F.concat(F.lit("r"), (F.col("event_id") % 2).cast("string")).alias("route"))
    pages = read(spark, d, "events").groupBy("user_id").agg(F.collect_list(attempt).alias("attempts")).select(F.lit("b").alias("book_id"), F.when(F.col("user_id") % 5 == 0, "reused").otherwise("extracted").alias("status"), "attempts")
    return R.routing_summary(pages)[0].drop("book_id")


@query("""WITH o AS (SELECT user_id AS task_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n, ['rate_limit', 'quota_exhausted', 'transient', 'recitation', 'invalid_output', 'permission'][event_id % 6 + 1] AS kind, event_id % 9 = 0 AS ok FROM events),
s AS (SELECT *, CASE WHEN n <= 3 THEN 'a' ELSE 'b' END AS route, CASE WHEN n <= 3 THEN n ELSE n - 3 END AS attempt FROM o WHERE n <= 5),
l AS (SELECT *, coalesce(bool_or(NOT ok AND kind NOT IN ('rate_limit', 'transient', 'invalid_output')) OVER (PARTITION BY task_id, route ORDER BY attempt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS lft FROM s),
e AS (SELECT *, coalesce(bool_or(ok OR kind = 'recitation') OVER (PARTITION BY task_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS ended FROM l WHERE NOT lft)
SELECT task_id, route, attempt::INTEGER AS attempt, ok FROM e WHERE NOT ended""")
def q61_route_replay(spark, d):
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    kinds = F.array(*map(F.lit, ("rate_limit", "quota_exhausted", "transient", "recitation", "invalid_output", "permission")))
    o = read(spark, d, "events").select(F.col("user_id").alias("task_id"), n.alias("n"), F.get(kinds, (F.col("event_id") % 6).cast("int")).alias("kind"), (F.col("event_id") % 9 == 0).alias("ok")).where("n <= 5")
    outcomes = o.select("task_id", F.when(F.col("n") <= 3, "a").otherwise("b").alias("route"), F.when(F.col("n") <= 3, F.col("n")).otherwise(F.col("n") - 3).alias("attempt"), "ok", "kind")
    allowed = R.checked_routes(R.default_routes(["a"], ["b"]), "free-then-paid")
    routes = spark.createDataFrame([(r["name"], i, r["max_attempts"]) for i, r in enumerate(allowed)], "route string, position int, max_attempts int")
    return R.routed(o.select("task_id").distinct(), outcomes, routes).select("task_id", "route", "attempt", "ok")


@query(r"""WITH p AS (SELECT doc_id, lang, CASE WHEN doc_id % 4 = 0 THEN 1 END AS lost FROM documents), k AS (SELECT source AS b, doc_id, CASE WHEN doc_id % 3 <> 0 THEN lang END AS l FROM documents WHERE doc_id % 4 <> 0),
q AS (SELECT d.source AS b, d.doc_id, (SELECT arg_min(k.l, abs(k.doc_id - d.doc_id) * 2 + CASE WHEN k.doc_id > d.doc_id THEN 1 ELSE 0 END) FROM k WHERE k.b = d.source AND k.l IS NOT NULL) AS language FROM documents d WHERE d.doc_id % 4 = 0)
SELECT doc_id AS page_number, language FROM q""")
def q62_recovered_language(spark, d):
    docs = read(spark, d, "documents").select(F.col("source").alias("book_id"), F.concat(F.lit("p"), "doc_id").alias("page_id"), F.col("doc_id").alias("page_number"), F.when(F.col("doc_id") % 3 != 0, F.col("lang")).alias("language"), "text")
    lost = docs.where("page_number % 4 = 0").select("book_id", "page_id", "page_number", F.lit("recitation").alias("reason"))
    return R.recovered(lost, docs.select("book_id", "page_id", F.col("text").alias("reading")), docs.where("page_number % 4 <> 0")).select("page_number", "language")


@query(r"""WITH s AS (SELECT doc_id, string_split_regex(text, '\n[ \t\v\f\r]*\n\s*') AS l FROM documents), p AS (SELECT doc_id, unnest(l) AS x FROM s)
SELECT doc_id, count(*) FILTER (WHERE regexp_matches(x, '\S')) AS parts FROM p GROUP BY doc_id""")
def q63_reading_paragraphs(spark, d):
    return read(spark, d, "documents").select("doc_id", F.size(R.page_from_reading(F.col("text"))).cast("long").alias("parts"))


@query("""SELECT c_custkey::VARCHAR AS book_id, CASE WHEN c_custkey % 5 <> 0 THEN c_name END AS title, CASE WHEN c_custkey % 3 = 0 THEN [] ELSE [c_mktsegment] END AS authors, CASE WHEN c_custkey % 4 <> 0 THEN (c_custkey % 7)::VARCHAR END AS series_index,
 CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END + CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS violations FROM customer""")
def q64_book_metadata(spark, d):
    """Files with one author, a number for the place in a series, or faults in title or place."""
    k = F.col("c_custkey")
    title = F.when(k % 5 == 0, F.lit('" "')).otherwise(F.concat(F.lit('" '), "c_name", F.lit('"')))
    index = F.when(k % 4 == 0, F.lit("true")).otherwise((k % 7).cast("string"))
    raw = F.concat(F.lit('{"title":'), title, F.lit(',"series_index":'), index, F.when(k % 3 != 0, F.concat(F.lit(',"author":"'), "c_mktsegment", F.lit('"'))).otherwise(""), F.lit("}"))
    out = S.book_metadata(read(spark, d, "customer").select(k.cast("string").alias("book_id"), raw.alias("text")))
    return out.select("book_id", "title", "authors", "series_index", F.size("violations").alias("violations"))


@query("""SELECT l_orderkey, l_linenumber AS word_no, l_shipmode AS word, (l_quantity::INTEGER * 2)::DOUBLE AS confidence, l_linenumber::INTEGER * 10 AS lft
FROM (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS l_linenumber, l_shipmode, l_quantity, l_partkey FROM (SELECT *, l_linestatus AS l_shipmode FROM (SELECT * FROM lineitem))) WHERE l_partkey % 4 <> 0 AND l_quantity * 2 >= 30""")
def q65_recognised_words(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    rows = read(spark, d, "lineitem").withColumn("n", F.row_number().over(w))
    level = F.when(F.col("l_partkey") % 4 == 0, "4").otherwise("5")
    line = F.concat_ws("\t", level, (F.col("n") * 10).cast("string"), F.lit("1"), F.lit("2"), F.lit("3"), (F.col("l_quantity").cast("int") * 2).cast("string"), F.concat(F.lit(" "), "l_linestatus"))
    tsv = rows.groupBy("l_orderkey").agg(F.concat(F.lit("level\tleft\ttop\twidth\theight\tconf\ttext\n"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", line.alias("x")))), lambda x: x["x"]), "\n")).alias("tsv"))
    out = S.recognised_words(tsv.select(F.lit("b").alias("book_id"), F.col("l_orderkey").alias("page_id"), "tsv"), 30.0)
    return out.select(F.col("page_id").alias("l_orderkey"), F.col("word_no").cast("long").alias("word_no"), "word", "confidence", F.col("left").alias("lft"))


@query("SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN NULL ELSE list_sort(list_distinct([doc_id % 50 + 1, doc_id % 9 + 3] || range(doc_id % 9 + 3, doc_id % 9 + 6))) END AS numbers FROM documents")
def q66_page_numbers(spark, d):
    n, m = (F.col("doc_id") % 50 + 1).cast("string"), F.col("doc_id") % 9 + 3
    text = F.when(F.col("doc_id") % 6 == 0, F.concat(F.lit("0,"), n)).otherwise(F.concat(n, F.lit(", "), m.cast("string"), F.lit(" - "), (m + 2).cast("string")))
    return read(spark, d, "documents").select("doc_id", F.transform(S.page_numbers(text), lambda x: x.cast("long")).alias("numbers"))


@query("""SELECT source AS book_id, count(*) FILTER (WHERE s = 'not_reviewed') AS not_reviewed, count(*) FILTER (WHERE s = 'pass') AS pass, count(*) FILTER (WHERE s = 'needs_review') AS needs_review, count(*) FILTER (WHERE s = 'resolved') AS resolved, count(*) FILTER (WHERE s = 'stale') AS stale, bool_and(s IN ('pass', 'resolved')) AS complete
FROM (SELECT source, ['pass', 'resolved', 'needs_review', 'pass', 'stale'][doc_id % 5 + 1] AS s FROM documents) GROUP BY source""")
def q67_state_counts(spark, d):
    state = F.get(F.array(*map(F.lit, ("pass", "resolved", "needs_review", "pass", "stale"))), (F.col("doc_id") % 5).cast("int"))
    return D.state_counts(read(spark, d, "documents").select(F.col("source").alias("book_id"), state.alias("state")), ["book_id"])


@query("""WITH r AS (SELECT p_partkey, (p_size % 10) / 20.0::DOUBLE AS x, (p_size % 7) / 14.0::DOUBLE AS wd FROM part) SELECT p_partkey, least(greatest(floor(x * 1000)::INTEGER, 0), 999) AS lft, greatest(least(ceil((x + wd) * 1000)::INTEGER, 1000), least(greatest(floor(x * 1000)::INTEGER, 0), 999) + 1) AS rgt,
 least(greatest(floor(wd * 500)::INTEGER, 0), 499) AS top, greatest(least(ceil((wd + x) * 500)::INTEGER, 500), least(greatest(floor(wd * 500)::INTEGER, 0), 499) + 1) AS bottom FROM r""")
def q39_pixel_box(spark, d):
    x, wide = (F.col("p_size") % 10) / F.lit(20.0), (F.col("p_size") % 7) / F.lit(14.0)
    box = X.pixel_box(F.struct(x.alias("x"), wide.alias("width"), wide.alias("y"), x.alias("height")), F.lit(1000), F.lit(500))
    return read(spark, d, "part").select("p_partkey", box.alias("b")).select("p_partkey", F.col("b.left").alias("lft"), F.col("b.right").alias("rgt"), "b.top", "b.bottom")


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 1 THEN 'modified' WHEN doc_id % 3 = 2 THEN 'added' END AS change FROM documents WHERE doc_id % 3 <> 0 AND text <> ''")
def q44_proof_changes(spark, d):
    docs = read(spark, d, "documents").where("text <> ''").select(F.lit("b").alias("book_id"), F.col("doc_id").alias("file"), F.col("text"), F.col("doc_id"))
    before = docs.where("doc_id % 3 <> 2").select("book_id", "file", F.col("text").cast("binary").alias("data"))
    now = docs.select("book_id", "file", F.when(F.col("doc_id") % 3 == 1, F.concat("text", F.lit("!"))).otherwise(F.col("text")).cast("binary").alias("data"))
    return K.proof_changes(K.snapshot(before), K.snapshot(now)).select(F.col("file").alias("doc_id"), "change")


@query("""WITH i AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 3 <> 0 THEN l_linenumber + l_partkey % 2 END AS o, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS i FROM lineitem),
k AS (SELECT *, last_value(CASE WHEN o IS NOT NULL THEN o - i END IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS d FROM i)
SELECT l_orderkey, count(*) FILTER (WHERE o IS NOT NULL AND d IS NOT NULL AND o <> d + i) AS stated FROM k GROUP BY l_orderkey""")
def q68_list_values(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    ordinal = F.when(F.col("l_partkey") % 3 != 0, F.col("l_linenumber") + F.col("l_partkey") % 2).cast("int")
    rows = read(spark, d, "lineitem").select("l_orderkey", F.row_number().over(w).alias("i"), ordinal.alias("ordinal"))
    lists = rows.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("i", "ordinal"))).alias("items"))
    return lists.select("l_orderkey", F.size(F.filter(X.list_values(F.col("items")), lambda v: v.isNotNull())).cast("long").alias("stated"))


@query("""WITH f AS (SELECT doc_id, source, n_chars % 3 AS k FROM documents WHERE n_chars % 4 <> 0), s AS (SELECT doc_id, source, n_chars % 3 AS k FROM documents WHERE n_chars % 4 = 0)
SELECT f.source AS book_id, count(*) AS findings, count(*) FILTER (WHERE k <> 0) AS from_ocr, count(*) FILTER (WHERE k = 0) AS from_heuristics, count(DISTINCT doc_id // 3) AS pages_with_findings, coalesce(any_value(x.n), 0) AS suppressed FROM f LEFT JOIN (SELECT source, count(*) AS n FROM s GROUP BY source) x ON x.source = f.source GROUP BY f.source""")
def q69_review_summary(spark, d):
    rows = read(spark, d, "documents").select(F.col("source").alias("book_id"), F.floor(F.col("doc_id") / 3).alias("page_id"), F.when(F.col("n_chars") % 3 == 0, "heuristic").otherwise("local_ocr").alias("source"), (F.col("n_chars") % 3).cast("string").alias("reason"), "n_chars")
    return D.review_summary(rows.where("n_chars % 4 <> 0"), rows.where("n_chars % 4 = 0")).select("book_id", "findings", "from_ocr", "from_heuristics", "pages_with_findings", "suppressed").where("findings > 0")


#: A book is a document, as a book's document is one row.
_OF_DOCUMENTS = _PLACED.replace("SELECT source AS book_id", "SELECT 'p' || doc_id AS book_id")


@query(f"WITH {_OF_DOCUMENTS} SELECT book_id, node_id, node_type, blocks, TRUE AS same FROM nodes")
def q70_document_round_trip(spark, d):
    """Nodes written as the JSON of their book and read again; the format has no text of images.

    The nodes are written once: the check of their types, the documents and the comparison read them.
    """
    pages = typed_pages(spark, d).withColumn("book_id", F.concat(F.lit("p"), F.col("page_pos").cast("string")))
    made = A.nodes(A.positions(A._blocks(A.ordered_pages(pages))))
    made = made.withColumn("children", F.transform("children", lambda c: F.when(c["node_type"] == "image", c.withField("spans", F.slice(c["spans"], 1, 0))).otherwise(c)))
    made = written(made, "typed")
    none = made.where("false").select("book_id", *(F.lit(None).cast(t).alias(k) for k, t in zip(J.RELATIONSHIP, ("string",) * 4 + ("double", "array<string>"), strict=True)))
    text = lambda df: df.select("book_id", "node_id", "node_type", F.size("provenance").cast("long").alias("blocks"), F.to_json(F.struct(*J.NODE[2:]), {"ignoreNullFields": "false"}).alias("j"))
    again = text(J.document_nodes(J.document_json(made, none)))
    return again.join(text(made).select("book_id", "node_id", F.col("j").alias("_j")), ["book_id", "node_id"], "left").select("book_id", "node_id", "node_type", "blocks", F.coalesce(F.col("j") == F.col("_j"), F.lit(False)).alias("same"))


_RANGES = "r AS (SELECT doc_id, length(text) AS n, k, (doc_id * 31 * (k + 1)) % (length(text) + 3) - 1 AS s, (doc_id * 31 * (k + 1)) % (length(text) + 3) - 1 + (doc_id * (k + 3)) % 90 AS e FROM documents, (SELECT unnest(range(4)) AS k) WHERE text IS NOT NULL)"


@query(f"""WITH {_RANGES}, h AS (SELECT doc_id, n, k, greatest(0, least(s, n)) AS s, greatest(greatest(0, least(s, n)), least(e, n)) AS e FROM r),
c AS (SELECT doc_id, s AS p FROM h UNION SELECT doc_id, e FROM h UNION SELECT doc_id, 0 FROM h UNION SELECT doc_id, n FROM h),
g AS (SELECT doc_id, p AS a, lead(p) OVER (PARTITION BY doc_id ORDER BY p) AS b FROM c)
SELECT g.doc_id, a::INTEGER AS start, b::INTEGER AS stop, (SELECT count(*) FROM h WHERE h.doc_id = g.doc_id AND h.s <= g.a AND h.e >= g.b) AS findings FROM g WHERE b IS NOT NULL""")
def q71_report_segments(spark, d):
    """Texts cut by four ranges each that overlap, reach over the ends, or are empty."""
    doc, n = F.col("doc_id"), F.col("n")
    start = lambda k: (doc * 31 * (k + 1)) % (n + 3) - 1
    ranges = F.array(*(F.struct(start(k).cast("int").alias("start"), (start(k) + doc * (k + 3) % 90).cast("int").alias("end"), F.lit(f"f{k}").alias("id")) for k in range(4)))
    sizes = read(spark, d, "documents").where("text is not null").select("doc_id", F.length("text").alias("n"))
    rows = sizes.select("doc_id", F.explode(P.segments(n, ranges)).alias("s"))
    return rows.select("doc_id", "s.start", F.col("s.end").alias("stop"), F.size("s.ids").cast("long").alias("findings"))


@query("SELECT doc_id, md5(replace(replace(lower(text), 'ß', 'ss'), 'ς', 'σ')) AS folded FROM documents")
def q72_folded_texts(spark, d):
    return read(spark, d, "documents").select("doc_id", F.md5(T.fold(F.col("text")).cast("binary")).alias("folded"))


@query("SELECT doc_id, CASE WHEN doc_id % 40 >= doc_id % 51 THEN repeat('d/', (doc_id % 40 - doc_id % 51)::INTEGER) ELSE repeat('../', (doc_id % 51 - doc_id % 40)::INTEGER) END || source AS path FROM documents")
def q73_plain_paths(spark, d):
    """Paths of up to 39 folders that up to 50 steps lead out of, with empty and idle parts."""
    doc = F.col("doc_id")
    raw = F.concat(F.repeat(F.lit("d/"), (doc % 40).cast("int")), F.lit(".//"), F.repeat(F.lit("../"), (doc % 51).cast("int")), F.lit("./"), "source")
    return read(spark, d, "documents").select("doc_id", K.plain_path(F.when(doc % 40 == 0, F.substring(raw, F.lit(4), F.length(raw))).otherwise(raw)).alias("path"))


@query("""SELECT source AS book_id, count(*) AS pages, count(*) FILTER (WHERE n_chars > 900 AND doc_id % 3 = 0) AS text, count(*) FILTER (WHERE n_chars <= 900 AND doc_id % 3 > 0) AS image_only,
count(*) FILTER (WHERE n_chars > 900 AND doc_id % 3 > 0) AS mixed, count(*) FILTER (WHERE n_chars <= 900 AND doc_id % 3 = 0) AS blank FROM documents GROUP BY source""")
def q74_source_composition(spark, d):
    rows = read(spark, d, "documents").select(F.col("source").alias("book_id"), F.greatest(F.col("n_chars") - 900, F.lit(0)).alias("text_length"), (F.col("doc_id") % 3).alias("images"))
    return S.composition(rows, ["book_id"])


@query("""WITH e AS (SELECT doc_id, source, lang, n_chars FROM documents WHERE doc_id % 4 <> 0)
SELECT d.doc_id AS page_id, coalesce(e.doc_id IS NOT NULL AND d.doc_id % 5 <> 0 AND d.doc_id % 6 <> 0 AND (d.doc_id % 7 <> 0 OR d.doc_id % 2 = 1), FALSE) AS reuse FROM documents d LEFT JOIN e USING (doc_id)""")
def q75_same_extraction(spark, d):
    """Pages of which some have no earlier run, another hash, another prompt, another model, or a recovered text."""
    doc = F.col("doc_id")
    rows = read(spark, d, "documents").select(F.col("source").alias("book_id"), doc.alias("page_id"), F.md5(F.col("text").cast("binary")).alias("page_sha256"), F.lit("d").alias("document_sha256"), F.lit("p").alias("prompt_name"), F.lit("5").alias("prompt_version"), F.lit("s").alias("schema_name"), F.lit("5").alias("schema_version"))
    was = rows.where("page_id % 4 <> 0").withColumns({"page_sha256": F.when(F.col("page_id") % 5 == 0, "other").otherwise(F.col("page_sha256")), "prompt_version": F.when(F.col("page_id") % 6 == 0, "4").otherwise("5"), "model": F.when(F.col("page_id") % 7 == 0, "old").otherwise("new"), "recovery": F.when(F.col("page_id") % 2 == 1, "local_ocr_recitation")})
    return R.same_extraction(rows, was, "new").select("page_id", "reuse")


def _tree_sql(levels: int) -> str:
    out = []
    for k in range(levels):
        out.append(f"m{k + 1} AS (SELECT book_id, stage, place // 8 AS place, sha256(string_agg(digest, '' ORDER BY place)) AS digest FROM m{k} WHERE (book_id, stage) IN (SELECT (book_id, stage) FROM m{k} GROUP BY book_id, stage HAVING count(*) > 1) GROUP BY book_id, stage, place // 8)")
    tops = " UNION ALL ".join(f"SELECT book_id, stage, any_value(digest) AS root FROM m{k} GROUP BY book_id, stage HAVING count(*) = 1" for k in range(levels + 1))
    return ", ".join([*out, f"tops AS ({tops})"])


#: For up to 8 ** 7 files of a stage.
@query(f"""WITH f AS (SELECT source AS book_id, lang AS stage, 'd' || doc_id AS file, sha256(text) AS sha256, strlen(text) AS size FROM documents),
m0 AS (SELECT book_id, stage, row_number() OVER (PARTITION BY book_id, stage ORDER BY file, sha256) - 1 AS place, sha256(concat_ws(chr(10), strlen(file)::VARCHAR, file, sha256)) AS digest FROM f), {_tree_sql(7)},
b AS (SELECT book_id, sha256(string_agg(stage || ' ' || root, chr(10) ORDER BY stage)) AS book_root FROM tops GROUP BY book_id),
c AS (SELECT book_id, stage, count(*) AS files, sum(size)::BIGINT AS bytes FROM f GROUP BY book_id, stage)
SELECT c.*, root, book_root FROM c JOIN tops USING (book_id, stage) JOIN b USING (book_id)""")
def q76_build_manifest(spark, d):
    rows = read(spark, d, "documents").select(F.col("source").alias("book_id"), F.col("lang").alias("stage"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("file"), F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("long").alias("size"))
    return B.manifest(rows)


@query("""WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS l, doc_id % 11 AS c FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, least(len(l), 8) AS pages, CASE WHEN c > 0 THEN c END AS cover, l FROM l)
SELECT doc_id, pages::INTEGER AS pages, CASE WHEN cover IS NULL THEN 'not-detected' WHEN cover > pages THEN 'page-not-selected' ELSE 'extracted' END AS cover_status, CASE WHEN cover <= pages THEN md5(l[cover]) END AS cover FROM s""")
def q77_cover_states(spark, d):
    """The cover among the first pages of each book: here a document is a book, and a line a page."""
    rows = read(spark, d, "documents").where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("p", "t"))
    images = rows.select(F.col("doc_id").alias("book_id"), (F.col("p") + 1).alias("page_number"), F.lit("image/jpeg").alias("media_type"), F.col("t").cast("binary").alias("image"))
    named = F.nullif(F.col("book_id") % 11, F.lit(0)).cast("int")
    tasks = M.front_tasks(images).withColumns({"cover_page_number": named, "pages": F.transform("first_pages", lambda p: p["page_number"])})
    return M.cover_states(tasks).select(F.col("book_id").alias("doc_id"), F.size("pages").alias("pages"), "cover_status", F.md5(M.cover_page("image")).alias("cover"))


@query("""WITH a AS (SELECT source AS book_id, 'assets/' || CASE WHEN doc_id % 70 = 3 THEN '../' ELSE '' END || 'd' || (doc_id - doc_id % 9) AS file FROM documents WHERE doc_id % 3 = 0),
c AS (SELECT source AS book_id, 'text/d' || doc_id AS file FROM documents WHERE doc_id % 3 > 0),
n AS (SELECT book_id, file, count(*) AS n FROM (SELECT * FROM a UNION ALL SELECT * FROM c) GROUP BY ALL),
t AS (SELECT DISTINCT source AS book_id, CASE WHEN doc_id % 3 > 0 THEN 'text/d' ELSE 'assets/d' END || doc_id AS file FROM documents WHERE doc_id % 10 > 0),
m AS (SELECT source AS book_id, 'assets/d' || min(doc_id) AS image, 'text/d' || max(doc_id) AS content FROM documents GROUP BY source)
SELECT book_id, file, 'leaves the book' AS problem FROM n WHERE file LIKE '%..%' UNION ALL SELECT book_id, file, 'named twice' FROM n WHERE n > 1
UNION ALL SELECT book_id, file, 'is not there' FROM n ANTI JOIN t USING (book_id, file) WHERE file NOT LIKE '%..%'
UNION ALL SELECT book_id, 'styles/book.css', 'is not there' FROM m UNION ALL SELECT book_id, NULL, 'no contents' FROM m ANTI JOIN c USING (book_id)
UNION ALL SELECT book_id, image, 'cover is no asset' FROM m ANTI JOIN a ON m.book_id = a.book_id AND image = a.file
UNION ALL SELECT book_id, content, 'cover is not in contents' FROM m ANTI JOIN c ON m.book_id = c.book_id AND content = c.file""")
def q78_manifest_problems(spark, d):
    """Manifests of books whose files are documents; of the assets some are named twice, some lie elsewhere, and each tenth file is not there."""
    doc = F.col("doc_id")
    rows = read(spark, d, "documents").select(F.col("source").alias("book_id"), "doc_id")
    asset = F.concat(F.lit("assets/"), F.when(doc % 70 == 3, "../").otherwise(""), F.lit("d"), (doc - doc % 9).cast("string"))
    text = F.concat(F.lit("text/d"), doc.cast("string"))
    names = lambda c, c_if: F.collect_list(F.when(c_if, c))
    cover = F.struct(F.concat(F.lit("assets/d"), F.min("doc_id").cast("string")).alias("image"), F.concat(F.lit("text/d"), F.max("doc_id").cast("string")).alias("content"))
    made = rows.groupBy("book_id").agg(names(text, doc % 3 > 0).alias("contents"), names(asset, doc % 3 == 0).alias("assets"), cover.alias("cover"))
    none = F.lit(None).cast("string")
    manifest = F.struct(none.alias("title"), none.alias("language"), none.alias("content"), "contents", "cover", none.alias("endnotes"), F.lit(Y.STYLESHEET).alias("stylesheet"), "assets")
    there = rows.where(doc % 10 > 0).select("book_id", F.concat(F.when(doc % 3 > 0, "text/d").otherwise("assets/d"), doc.cast("string")).alias("file"))
    return Y.manifest_problems(made.select("book_id", manifest.cast(Y.MANIFEST_TYPE).alias("manifest")), there)


@query("""WITH s AS (SELECT source || '/proof/d' || doc_id AS path, md5(text) AS h FROM documents WHERE doc_id // 20 % 5 > 0 AND doc_id % 20 <> 3 AND source IS NOT NULL),
o AS (SELECT source || CASE WHEN doc_id % 13 = 0 THEN '/notes/d' ELSE '/proof/d' END || doc_id AS path, md5(CASE WHEN doc_id % 11 = 0 THEN text || 'x' ELSE text END) AS h FROM documents WHERE doc_id % 7 > 0 AND source IS NOT NULL)
SELECT path, CASE WHEN o.path IS NULL THEN 'add' WHEN s.path IS NULL THEN 'remove' WHEN s.h = o.h THEN 'keep' ELSE 'replace' END AS action FROM s FULL JOIN o USING (path) WHERE s.path IS NOT NULL OR path LIKE '%/proof/%' AND split_part(path, '/', 1) IN (SELECT split_part(path, '/', 1) FROM s)""")
def q79_backup_actions(spark, d):
    """Backups of books that have lost files, of one that is gone itself, and of files that the backup doesn't manage."""
    doc = F.col("doc_id")
    rows = read(spark, d, "documents").where("source is not null")
    made = rows.where((F.floor(doc / 20) % 5 > 0) & (doc % 20 != 3)).select(F.concat("source", F.lit("/proof/d"), doc.cast("string")).alias("path"), F.md5(F.col("text").cast("binary")).alias("sha256"))
    kept = rows.where(doc % 7 > 0).select(F.concat("source", F.when(doc % 13 == 0, "/notes/d").otherwise("/proof/d"), doc.cast("string")).alias("path"), F.md5(F.when(doc % 11 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text")).cast("binary")).alias("sha256"))
    return U.actions(made, kept)


OUTLINE_ROLES = ("chapter_title", "section_title", "chapter_label", "subsection_title", "subtitle", "scenario_title", "genre_label", "unknown")


def outline(spark: SparkSession, d: str) -> DataFrame:
    """Projected nodes: a document is one, of five four are headings, of seven one is a footnote; headings have a reference in their text."""
    doc, k = F.col("doc_id"), F.floor(F.col("doc_id") / 20)
    kind = F.when(k % 7 == 3, "footnote").when(k % 5 == 0, "paragraph").otherwise("heading")
    role = F.when(kind == "heading", F.get(F.array(*map(F.lit, OUTLINE_ROLES)), ((k * 3 + doc % 3) % len(OUTLINE_ROLES)).cast("int")))
    inline = lambda text, target: F.struct(F.lit(text).alias("text") if isinstance(text, str) else text.alias("text"), F.lit("en").alias("language"), F.array().cast("array<string>").alias("marks"), F.lit(False).alias("italic"), F.lit(target).cast("string").alias("target_id"), F.lit(None).cast("string").alias("source_span_id"))
    content = F.array(inline("Part", None), inline("1", "note"), inline(F.concat(F.lit("d"), doc.cast("string")), None))
    level = F.when((kind == "heading") & ~role.isin(*X.UNRANKED_ROLES), (k % 8).cast("int"))
    return read(spark, d, "documents").select(F.col("source").alias("book_id"), doc.alias("node_pos"), F.concat(F.lit("n"), doc.cast("string")).alias("node_id"), kind.alias("node_type"), role.alias("role"), level.alias("level"), content.cast(f"array<{X.INLINE_TYPE}>").alias("content"))


_OUTLINE = f"""n0 AS (SELECT source AS book_id, doc_id AS node_pos, doc_id // 20 AS k, CASE WHEN doc_id // 20 % 7 = 3 THEN 'footnote' WHEN doc_id // 20 % 5 = 0 THEN 'paragraph' ELSE 'heading' END AS kind, {list(OUTLINE_ROLES)}[(doc_id // 20 * 3 + doc_id % 3) % {len(OUTLINE_ROLES)} + 1] AS r FROM documents),
n AS (SELECT book_id, node_pos, kind, CASE WHEN kind = 'heading' THEN r END AS role, CASE WHEN kind = 'heading' AND r NOT IN ('chapter_label', 'genre_label', 'scenario_label', 'subtitle') THEN (k % 8)::INTEGER END AS level FROM n0),
b AS (SELECT *, coalesce(role IN ('chapter_label', 'genre_label', 'scenario_label'), FALSE) AS label, coalesce(role NOT IN ('chapter_label', 'genre_label', 'scenario_label', 'subtitle'), FALSE) AS starts FROM n WHERE kind <> 'footnote'),
c0 AS (SELECT *, CASE WHEN row_number() OVER w = 1 OR label OR (starts AND NOT lag(label) OVER w) THEN 1 ELSE 0 END AS cut FROM b WINDOW w AS (PARTITION BY book_id ORDER BY node_pos)),
c AS (SELECT *, sum(cut) OVER (PARTITION BY book_id ORDER BY node_pos)::BIGINT AS chunk FROM c0),
f0 AS (SELECT book_id, chunk, arg_min(coalesce(role, ''), node_pos) FILTER (NOT label) AS first FROM c GROUP BY book_id, chunk),
f1 AS (SELECT book_id, chunk, CASE first WHEN 'chapter_title' THEN 'chapter' WHEN 'section_title' THEN 'section' WHEN 'subsection_title' THEN 'subsection' WHEN 'scenario_title' THEN 'scenario' END AS stem, count(*) OVER (PARTITION BY book_id) AS many FROM f0),
f AS (SELECT book_id, chunk, CASE WHEN many = 1 AND stem IS NULL THEN 'content.xhtml' ELSE coalesce(stem, 'section') || '-' || printf('%04d', row_number() OVER (PARTITION BY book_id, coalesce(stem, 'section') ORDER BY chunk)) || '.xhtml' END AS file FROM f1),
chunks AS (SELECT * FROM c JOIN f USING (book_id, chunk))"""


@query(f"""WITH {_OUTLINE},
h0 AS (SELECT *, CASE WHEN kind = 'heading' AND lag(kind) OVER (PARTITION BY book_id, chunk ORDER BY node_pos) = 'heading' THEN 0 ELSE 1 END AS new, CASE WHEN level IS NULL THEN 0 ELSE 1 END AS ranked FROM chunks),
h1 AS (SELECT *, sum(new) OVER (PARTITION BY book_id, chunk ORDER BY node_pos) AS run FROM h0),
h2 AS (SELECT *, kind = 'heading' AND sum(ranked) OVER (PARTITION BY book_id, chunk, run ORDER BY node_pos DESC) <= 1 AS behind FROM h1)
SELECT book_id, node_pos, chunk, file, behind AND count(*) FILTER (behind) OVER w >= 2 AND max(CASE WHEN behind THEN ranked ELSE 0 END) OVER w = 1 AS grouped FROM h2 WINDOW w AS (PARTITION BY book_id, chunk, run)""")
def q80_spine_and_heading_groups(spark, d):
    return X.grouped_headings(X.chunked(outline(spark, d))).select("book_id", "node_pos", "chunk", "file", "grouped")


@query(f"""WITH {_OUTLINE},
e0 AS (SELECT *, CASE role WHEN 'chapter_title' THEN 1 WHEN 'section_title' THEN 2 WHEN 'subsection_title' THEN 3 WHEN 'scenario_title' THEN CASE WHEN level BETWEEN 1 AND 6 THEN level ELSE 3 END END AS l FROM chunks),
e1 AS (SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY node_pos) AS i FROM e0 WHERE l IS NOT NULL),
e AS (SELECT book_id, node_pos, file, l, (i + least(0, min(l - i) OVER (PARTITION BY book_id ORDER BY node_pos)))::INTEGER AS depth FROM e1)
SELECT e.book_id, 'n' || e.node_pos AS target_id, 'Part d' || e.node_pos AS label, e.file, e.l::INTEGER AS level, e.depth, 'n' || p.node_pos AS parent FROM e ASOF LEFT JOIN e p ON e.book_id = p.book_id AND e.depth - 1 = p.depth AND e.node_pos > p.node_pos""")
def q81_toc_entries(spark, d):
    return K.toc_entries(X.chunked(outline(spark, d))).select("book_id", "target_id", "label", "file", "level", "depth", "parent")


@query("""WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents), s AS (SELECT doc_id, unnest(range(len(l))) AS i, unnest(l) AS t FROM l),
n AS (SELECT *, 1 + coalesce(sum(CASE WHEN (doc_id + i) % 3 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS line FROM s)
SELECT doc_id, line::INTEGER AS line, count(*) AS spans, md5(string_agg(t, '|' ORDER BY i)) AS texts FROM n GROUP BY doc_id, line""")
def q82_verse_lines(spark, d):
    """Lines of verse blocks: a document is a block and its lines are spans, of which each third ends a line of verse."""
    style = F.struct(F.lit("roman").alias("posture"), F.lit("normal").alias("weight"), F.lit("baseline").alias("vertical_position"), F.lit("normal").alias("caps_style"), F.array().cast("array<string>").alias("decorations"))
    span = lambda t, i: F.struct(i.cast("string").alias("span_id"), t.alias("text"), F.lit("en").alias("language"), style.alias("source_typography"), ((F.col("doc_id") + i) % 3 == 0).alias("semantic_line_break_after"))
    none = lambda kind: F.lit(None).cast(kind)
    block = F.struct(F.lit("b").alias("block_id"), F.lit(0).alias("sequence_index"), F.lit("verse").alias("role_hint"), F.transform(F.split("text", "\n"), span).alias("content"), none("string").alias("dominant_language"), none("int").alias("heading_level_hint"), none("string").alias("heading_role_hint"), none(E.MARKER_TYPE).alias("marker"), none(E.REGION_TYPE).alias("region"), none("string").alias("alignment"))
    rows = read(spark, d, "documents").where("text is not null").select("doc_id", F.concat(F.lit("p"), F.col("doc_id").cast("string")).alias("page_id"), block.cast(E.BLOCK_TYPE).alias("block"))
    lines = rows.select("doc_id", F.posexplode(A.verse_lines(F.col("block"))).alias("n", "v"))
    return lines.select("doc_id", (F.col("n") + 1).alias("line"), F.size("v.spans").cast("long").alias("spans"), F.md5(F.array_join(F.transform("v.spans", lambda s: s["text"]), "|").cast("binary")).alias("texts"))
