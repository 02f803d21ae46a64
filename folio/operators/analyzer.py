"""Structure of books from their pages' evidence: nodes, relationships, furniture, unresolved blocks, candidates.

Pages are rows (book_id, page_pos, page_number, page), page being evidence.PAGE_TYPE; page_pos orders a book's pages and
page_number is the physical number, null if unknown. Many books are analysed at once: every window and join has book_id
in its key. Sequential rules are stated as windows over the reading order: what may follow what is a condition on
neighbours, runs are running sums of it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.functions.text import collapse, ends_sentence, fold, footnote_label, starts_lower, verse_line_id, without_page_number
from folio.operators.evidence import BLOCK_TYPE, block_text, document_spans, provenance
from folio.sources.outputs import dropped, written

#: The block at one end of a page, with the node that it stands for.
PAIR_END = f"struct<block:{BLOCK_TYPE},role:string,node_id:string>"
FURNITURE = ("page_header", "page_footer", "page_number")
LISTS = ("list", "list_item")
FLOWING = ("paragraph", "list_item", "quote")
SINGLE = ("paragraph", "heading", "footnote", "attribution")
BASE, NO_END, LOWER_START, SAME_LANGUAGE, SAME_TYPE = 0.40, 0.30, 0.20, 0.05, 0.05
LEAST_SCORE, MOST_SCORE, LEXICAL_SCORE = 0.65, 0.99, 0.95
# Fixed texts of the reasons.
ENDS_OPEN = "previous page ends without terminal punctuation"
STARTS_LOW = "next page starts with a lowercase letter"
ONE_LANGUAGE = "adjacent blocks use the same language"
ONE_TYPE = "boundary typography is compatible"
FOOTNOTE_REASON = "superscript reference label matches a unique same-page footnote label"
ATTRIBUTION_REASON = "explicit attribution is adjacent to one attributable same-page container"
TRANSLATION_REASONS = ("adjacent quotation containers use different known languages", "both quotations occur on the same physical page")
SHARED_ATTRIBUTION = "quotation pair shares adjacent attribution context"
INSET_REASONS = ("genre-label heading suggests embedded material", "genre label is immediately preceded by a title-like heading")


@dataclass(frozen=True)
class Analysis:
    """nodes (book_id, node_pos, node_id, node_type, ...), relationships, resolved (continuations used up in nodes), furniture, unresolved, candidates."""

    nodes: DataFrame
    relationships: DataFrame
    resolved: DataFrame
    furniture: DataFrame
    unresolved: DataFrame
    candidates: DataFrame


def require_unique(rows: DataFrame, keys: list[str], what: str) -> DataFrame:
    """rows, after a look that no two agree in keys; raises ValueError with some that do."""
    twice = rows.groupBy(*keys).count().where("count > 1").limit(5).collect()
    if twice:
        raise ValueError(f"{what}: not unique: {[tuple(r[k] for k in keys) for r in twice]}")
    return rows


def physical_number(page_number: Column, printed: Column) -> Column:
    """The page's number where positive, else its printed number in ASCII digits; null if there is neither."""
    read = F.when(printed.rlike(r"^[0-9]{1,9}\z"), printed.cast("int"))
    return F.when(page_number > 0, page_number).otherwise(F.when(read > 0, read))


def ordered_pages(pages: DataFrame) -> DataFrame:
    """pages with page_index, from 0 in each book, physical, and at, by which they are dealt. Only the places go through one window a book."""
    rows = pages.withColumn("at", F.struct("book_id", "page_pos"))
    w = Window.partitionBy("at.book_id").orderBy("at.page_pos").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("at").agg(F.count("*").alias("_n")).select("at", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    index = (F.col("_before") + F.row_number().over(Window.partitionBy("at").orderBy("at")) - 1).cast("int")
    return rows.join(before, "at").select("book_id", "page", F.col("page.page_id").alias("page_id"), index.alias("page_index"), physical_number(F.col("page_number"), F.col("page.printed_page_number")).alias("physical"), "at")


def _blocks(pages: DataFrame) -> DataFrame:
    b = F.col("block")
    rows = pages.select("book_id", "at", "page_id", "page_index", "physical", F.col("page.printed_page_number").alias("printed"), F.posexplode("page.blocks").alias("seq", "block"))
    return rows.select("*", b["block_id"].alias("block_id"), b["role_hint"].alias("role"), b["dominant_language"].alias("language"), block_text(b).alias("text"))


def furniture(blocks: DataFrame) -> DataFrame:
    """Headers, footers and page numbers with normalized_text, which but for page numbers lacks the printed number, and
    repeated: the same text in the same role on two pages of the book. Page numbers and empty texts never repeat."""
    flat = collapse(F.col("text"))
    norm = F.when(F.col("role") == "page_number", flat).otherwise(without_page_number(flat, F.col("printed")))
    rows = blocks.where(F.col("role").isin(*FURNITURE)).withColumn("normalized_text", norm)
    # Texts are compared by their digests, as a line may be as long as a page.
    rows = rows.withColumn("_key", F.sha2(fold(F.col("normalized_text")), 256))
    twice = rows.where("role <> 'page_number' and normalized_text <> ''").groupBy("book_id", "role", "_key").agg((F.count_distinct("page_id") >= 2).alias("_again"))
    out = rows.join(twice, ["book_id", "role", "_key"], "left")
    return out.select("book_id", "page_index", "seq", "page_id", "block_id", "role", F.col("text").alias("raw_text"), "normalized_text", F.coalesce("_again", F.lit(False)).alias("repeated"))


def _list_goes_on(last: Column, first: Column) -> Column:
    """Whether the list of a block (role, ordered, ordinal) goes on in the next."""
    in_turn = F.coalesce(~first["ordered"] | (last["ordinal"] + 1 == first["ordinal"]), F.lit(True))
    return F.coalesce(first["role"].isin(*LISTS) & last["role"].isin(*LISTS) & (last["ordered"] == first["ordered"]) & in_turn, F.lit(False))


def positions(blocks: DataFrame) -> DataFrame:
    """Blocks besides furniture, numbered in reading order, with node_no (the node they belong to), node_type, and resolved.

    Windows over blocks are those of a page; what goes on from page to page is one narrow row a page.
    """
    page = ("at", "page_index")
    w = Window.partitionBy(*page).orderBy("seq")
    ordered = F.coalesce(F.col("block.marker.kind").isin("numeric", "alphabetic"), F.lit(False))
    body = blocks.where(~F.col("role").isin(*FURNITURE)).withColumn("_place", F.row_number().over(w)).withColumn("ordered", ordered).withColumn("ordinal", F.col("block.marker.ordinal"))
    lag = lambda c: F.lag(c).over(w)
    item = F.struct("role", "ordered", "ordinal")
    alike = F.coalesce(lag("role") == F.col("role"), F.lit(False))
    caption = F.coalesce((F.col("role") == "caption") & (lag("role") == "image"), F.lit(False))
    coarse = body.withColumn("_item", item).withColumn("_alike", alike).withColumn("_caption", caption).withColumn("_list", _list_goes_on(lag("_item"), F.col("_item")))
    coarse = coarse.withColumn("_of_region", F.col("_caption") & lag(F.col("block.region").isNotNull()))
    # Quotations: runs of a page, split where two known languages that follow each other differ.
    coarse = coarse.withColumn("_run", F.sum((~F.col("_alike")).cast("int")).over(w))
    # The order of runs is that of blocks: one sort serves all windows.
    known = F.last(F.when(F.col("language").isNotNull(), F.struct("_run", "language")), True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    coarse = coarse.withColumn("_known", known)
    other_language = F.coalesce((F.col("_known._run") == F.col("_run")) & (F.col("_known.language") != F.col("language")), F.lit(False))
    joins = F.col("_list") | F.col("_caption") | ((F.col("role") == "verse") & F.col("_alike")) | ((F.col("role") == "quote") & F.col("_alike") & ~other_language)
    coarse = coarse.withColumn("_new", F.when(F.col("_place") == 1, 0).otherwise((~joins).cast("int"))).withColumn("_in", F.sum("_new").over(w))
    # The first block that a node has on the page.
    coarse = coarse.withColumn("head", F.last(F.when((F.col("_place") == 1) | (F.col("_new") == 1), F.col("block_id")), True).over(w))
    # A page's first block goes on with the list at the end of the page before.
    # With page_id this reads the same columns as the rows it is joined to, and so one exchange serves both.
    ends = coarse.groupBy(*page, "book_id", "page_id").agg(F.count("*").alias("_blocks"), F.sum("_new").alias("_news"), F.min("physical").alias("_physical"), F.min_by("_item", "seq").alias("_first"), F.max_by("_item", "seq").alias("_last"))
    b = Window.partitionBy("book_id").orderBy("page_index")
    follows = F.coalesce(F.lag("_physical").over(b) + 1 == F.col("_physical"), F.lit(False))
    ends = ends.withColumn("_starts", (~(follows & _list_goes_on(F.lag("_last").over(b), F.col("_first")))).cast("int"))
    ends = ends.select("at", F.col("page_index").alias("_index"), "_physical", (F.sum("_blocks").over(b) - F.col("_blocks")).alias("_before"), (F.sum(F.col("_news") + F.col("_starts")).over(b) - F.col("_news")).alias("_node"))
    # Blocks lie by at already; as keys of the join, the others would have them dealt anew. Both sides read the same columns, and so one exchange.
    placed = coarse.join(ends, "at").where("page_index - _index = 0 and coalesce(physical - _physical, 0) = 0").withColumn("pos", (F.col("_before") + F.col("_place")).cast("int"))
    kind = F.when(F.col("role").isin(*LISTS), "list").when(F.col("role") == "quote", "quotation").when(F.col("role") == "verse", "verse").when((F.col("role") == "image") & F.col("block.region").isNotNull() | F.col("_of_region"), "figure").when(F.col("role").isin(*SINGLE), F.col("role"))
    made = placed.withColumn("node_no", F.col("_node") + F.col("_in")).withColumn("node_type", kind)
    return made.drop("_list", "_alike", "_caption", "_of_region", "_run", "_known", "_new", "_in", "_place", "_item", "_index", "_physical", "_before", "_node")


def verse_lines(block: Column) -> Column:
    """A verse block's lines, arrays of spans: one ends behind each span with a break; without spans there is one empty line."""
    spans = document_spans(F.col("page_id"), block)
    breaks = F.transform(block["content"], lambda s: s["semantic_line_break_after"].cast("int"))
    number = F.transform(breaks, lambda _, i: F.aggregate(F.slice(breaks, 1, i), F.lit(1), lambda a, x: a + x))
    numbers = F.when(F.size(spans) == 0, F.array(F.lit(1))).otherwise(F.sequence(F.lit(1), F.element_at(number, -1)))
    pairs = F.zip_with(spans, number, lambda s, n: F.struct(s.alias("s"), n.alias("n")))
    return F.transform(numbers, lambda n: F.struct(verse_line_id(block["block_id"], n).alias("node_id"), F.lit("verse_line").alias("node_type"), F.lit(None).cast("int").alias("ordinal"), block["marker"].alias("marker"), F.transform(F.filter(pairs, lambda p: p["n"] == n), lambda p: p["s"]).alias("spans"), F.array(provenance(F.col("page_id"), block)).alias("provenance")))


def label_of_footnote(block: Column) -> Column:
    """The label of a footnote whose first span that isn't blank is superscript."""
    first = F.get(F.filter(block["content"], lambda s: ~s["text"].rlike(r"(?U)^\s*\z")), F.lit(0))
    return F.when(first["source_typography"]["vertical_position"] == "superscript", footnote_label(first["text"]))


_CHILD_KINDS = {"list": ("list-item", "list_item"), "quotation": ("quote-paragraph", "paragraph")}


def nodes(placed: DataFrame) -> DataFrame:
    """One row for each node: its id comes from its first block. children are list items, quoted paragraphs, verse lines, or
    the image and caption of a figure; other nodes have spans of their own."""
    b, here = F.col("block"), provenance(F.col("page_id"), F.col("block"))
    child_id = F.when(F.col("node_type") == "list", "list-item").when(F.col("node_type") == "quotation", "quote-paragraph").otherwise(F.col("role"))
    child_type = F.when(F.col("node_type") == "list", "list_item").when(F.col("node_type") == "quotation", "paragraph").otherwise(F.col("role"))
    own = F.struct(F.concat("block_id", F.lit(":node:"), child_id).alias("node_id"), child_type.alias("node_type"), F.col("ordinal").alias("ordinal"), b["marker"].alias("marker"), document_spans(F.col("page_id"), b).alias("spans"), F.array(here).alias("provenance"))
    parts = F.when(F.col("node_type") == "verse", verse_lines(b)).otherwise(F.array(own))
    member = F.struct("pos", "block_id", "page_index", parts.alias("parts"), here.alias("from"), F.col("page_id").alias("page_id"), F.col("block.region").alias("region"), F.col("block.heading_level_hint").alias("level"), F.coalesce("block.heading_role_hint", F.lit("unknown")).alias("role"), "ordered", label_of_footnote(b).alias("label"), "block.dominant_language")
    rows = placed.where("node_type is not null").groupBy("book_id", "node_no", "node_type").agg(F.sort_array(F.collect_list(member)).alias("m"))
    first = F.get("m", F.lit(0))
    many = F.col("node_type").isin("list", "quotation", "verse", "figure")
    children = F.when(many, F.flatten(F.transform("m", lambda x: x["parts"])))
    return rows.select(
        "book_id",
        first["pos"].alias("node_pos"),
        F.concat(first["block_id"], F.lit(":node:"), F.col("node_type")).alias("node_id"),
        "node_type",
        F.when(F.col("node_type") == "heading", first["role"]).alias("role"),
        F.when(F.col("node_type") == "heading", first["level"]).alias("level"),
        F.when(F.col("node_type") == "list", F.when(first["ordered"], "ordered").otherwise("unordered")).alias("list_kind"),
        F.when(F.col("node_type") == "footnote", first["label"]).alias("label"),
        F.when(F.col("node_type") == "figure", first["region"]).alias("region"),
        children.alias("children"),
        F.when(~many, first["parts"][0]["spans"]).alias("spans"),
        F.transform("m", lambda x: x["from"]).alias("provenance"),
    )


def _typography_alike(left: Column, right: Column) -> Column:
    a, b = F.get(left["content"], F.size(left["content"]) - 1)["source_typography"], F.get(right["content"], F.lit(0))["source_typography"]
    same = reduce(Column.__and__, (a[k] == b[k] for k in ("posture", "weight", "vertical_position", "caps_style")))
    return F.coalesce(same, F.lit(False))


def continuation_score(left: Column, right: Column) -> tuple[Column, Column]:
    """confidence and reasons that a block goes on in the first of the next page; null confidence below LEAST_SCORE."""
    one_language = F.coalesce(left["dominant_language"] == right["dominant_language"], F.lit(False))
    signs = ((~ends_sentence(block_text(left)), NO_END, ENDS_OPEN), (starts_lower(block_text(right)), LOWER_START, STARTS_LOW), (one_language, SAME_LANGUAGE, ONE_LANGUAGE), (_typography_alike(left, right), SAME_TYPE, ONE_TYPE))
    # Doubles, added in this order.
    total = F.lit(BASE)
    for sign, worth, _ in signs:
        total = F.when(sign, total + F.lit(worth)).otherwise(total)
    reasons = F.array_compact(F.array(*(F.when(sign, F.lit(why)) for sign, _, why in signs)))
    return F.when(total >= LEAST_SCORE, F.least(total, F.lit(MOST_SCORE))), reasons


def _node_of_block(role: Column, block: Column, node_id: Column) -> Column:
    """A list item stands for itself, other blocks for their node."""
    return F.when(role.isin(*LISTS), F.concat(block["block_id"], F.lit(":node:list-item"))).otherwise(node_id)


def linked(pairs: DataFrame, *keep: str) -> DataFrame:
    """Continuations from left to right (PAIR_END) of pages that follow each other, with the columns to keep."""
    flows = lambda c: F.col(f"{c}.role").isin("paragraph", "list_item")
    fits = F.col("left.role").isin(*FLOWING) & F.col("right.role").isin(*FLOWING) & ((F.col("left.role") == F.col("right.role")) | (flows("left") & flows("right")))
    some = lambda c: block_text(F.col(f"{c}.block")).rlike(r"(?U)\S")
    confidence, reasons = continuation_score(F.col("left.block"), F.col("right.block"))
    rows = pairs.where(fits & some("left") & some("right")).select("book_id", *keep, F.col("left.node_id").alias("source_id"), F.col("right.node_id").alias("target_id"), confidence.alias("confidence"), reasons.alias("reasons"))
    found = rows.where("confidence is not null and source_id <> target_id")
    return found.select("book_id", *keep, F.concat("source_id", F.lit(":relationship:continues-to:"), "target_id").alias("relationship_id"), F.lit("continues_to").alias("kind"), "source_id", "target_id", "confidence", "reasons")


def continuations(pages: DataFrame, placed: DataFrame) -> DataFrame:
    """Candidates (book_id, page_index, relationship_id, kind, source_id, target_id, confidence, reasons) from a page's last block
    to the first of the next, where their physical numbers follow."""
    # A node that goes on over pages is a list, whose items stand for themselves. Without a window, tasks send a row a page only.
    named = placed.withColumn("node_id", F.concat("head", F.lit(":node:"), F.col("node_type")))
    edge = F.struct("block", "role", _node_of_block(F.col("role"), F.col("block"), F.col("node_id")).alias("node_id"))
    ends = named.groupBy("at", "book_id", "page_index").agg(F.max_by(edge, F.when(F.col("role") != "footnote", F.col("pos"))).alias("left"), F.min_by(edge, F.col("pos")).alias("right"))
    w = Window.partitionBy("book_id").orderBy("page_index")
    followed = pages.select("book_id", "page_index", (F.lead("physical").over(w) == F.col("physical") + 1).alias("next")).where("next").select("book_id", "page_index")
    nxt = ends.select("book_id", (F.col("page_index") - 1).alias("page_index"), "right")
    pair = ends.select("book_id", "page_index", "left").join(followed, ["book_id", "page_index"]).join(nxt, ["book_id", "page_index"])
    return linked(pair, "page_index")


def _spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: s["text"]), "")


def _stitched(head_id: Column, first: Column, rest: Column) -> Column:
    """Spans of a chain; where a page break took the space between words, a span of its own puts it back."""

    def add(done: Column, part: Column) -> Column:
        left, right = _spans_text(done), _spans_text(part["spans"])
        bare = (left == "") | (right == "") | left.rlike(r"(?U)(\s|[-‐‑­])\z") | right.rlike(r"(?U)^(\s|[,.;:!?)\]}])")
        last, nxt = F.element_at(done, -1), F.get(part["spans"], F.lit(0))
        language = F.when(last["language"].eqNullSafe(nxt["language"]), last["language"])
        none = F.filter(last["provenance"], lambda _: F.lit(False))
        space = F.struct(F.concat(head_id, F.lit(":join:"), part["node_id"]).alias("span_id"), F.lit(" ").alias("text"), language.alias("language"), last["source_typography"].alias("source_typography"), F.filter(last["semantic_marks"], lambda _: F.lit(False)).alias("semantic_marks"), none.alias("provenance"))
        return F.when(bare, F.concat(done, part["spans"])).otherwise(F.concat(done, F.array(space), part["spans"]))

    return F.aggregate(rest, first, add)


def resolved_chains(flow: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """nodes with unambiguous continuations merged, and (book_id, relationship_id) of the links used up.

    A list's last item takes in the paragraphs right behind the list while links are full; a paragraph takes in the
    next one, over footnotes, if its link is full or lacks only the typography. Footnotes stepped over follow the
    merged paragraph. node_pos of the result orders its nodes anew.
    """
    w = Window.partitionBy("book_id").orderBy("node_pos")
    edge = links.select("book_id", F.col("target_id").alias("node_id"), F.struct("source_id", "relationship_id", (F.col("confidence") >= MOST_SCORE).alias("full"), ((F.col("confidence") >= MOST_SCORE) | ((F.col("confidence") >= LEXICAL_SCORE) & (F.size(F.array_except(F.array(*map(F.lit, (ENDS_OPEN, STARTS_LOW, ONE_LANGUAGE))), "reasons")) == 0))).alias("enough")).alias("edge"))
    is_list, is_paragraph = F.col("node_type") == "list", F.col("node_type") == "paragraph"
    tail = F.when(is_list, F.element_at("children", -1)["node_id"]).otherwise(F.col("node_id"))
    # Windows of a book see no content, only what tells where a node belongs.
    rows = flow.select("book_id", "node_pos", "node_id", "node_type", tail.alias("_tail")).join(edge, ["book_id", "node_id"], "left")
    rows = rows.withColumn("_strict", F.coalesce(is_paragraph & F.col("edge.full") & (F.col("edge.source_id") == F.lag("_tail").over(w)), F.lit(False)))
    rows = rows.withColumn("_list_no", F.sum(is_list.cast("int")).over(w))
    unbroken = F.min((is_list | F.col("_strict")).cast("int")).over(Window.partitionBy("book_id", "_list_no").orderBy("node_pos"))
    rows = rows.withColumn("_in_list", is_paragraph & (F.col("_list_no") > 0) & (unbroken == 1))
    # Paragraph chains among what is neither a footnote nor taken in by a list.
    side = (F.col("node_type") == "footnote") | F.col("_in_list")
    v = Window.partitionBy("book_id", "_side").orderBy("node_pos")
    rows = rows.withColumn("_side", side)
    goes_on = ~side & is_paragraph & (F.lag("node_type").over(v) == "paragraph") & F.col("edge.enough") & (F.col("edge.source_id") == F.lag("node_id").over(v))
    rows = rows.withColumn("_on", F.coalesce(goes_on, F.lit(False)))
    # What a row belongs to: its list, the head of its chain, itself; footnotes sort behind the head before them.
    head = F.last(F.when(~F.col("_side") & ~F.col("_on"), F.col("node_pos")), True).over(w)
    rows = rows.withColumn("_head", F.coalesce(head, F.lit(0)))
    used = rows.where(F.col("_in_list") | F.col("_on")).select("book_id", "edge.relationship_id")
    apart = F.col("node_type") == "footnote"
    order = Window.partitionBy("book_id").orderBy("_head", "_apart", "_key")
    rows = rows.withColumn("_apart", apart).withColumn("_key", F.when(apart, F.col("node_pos")).otherwise(F.col("_head")))
    placed = rows.select("book_id", F.struct("book_id", "node_pos").alias("_at"), F.dense_rank().over(order).alias("_place"))
    placed = placed.select("_at", "_place", F.count("*").over(Window.partitionBy("book_id", "_place")).alias("_members"))
    part = F.struct("node_pos", "node_id", "spans", "provenance")
    node, parts = F.struct(*flow.columns), F.sort_array(F.collect_list(part))
    of_place = flow.withColumn("_at", F.struct("book_id", "node_pos")).join(placed, "_at")
    # Nodes that stay as they are need no second exchange.
    alone = of_place.where("_members = 1").select("book_id", "_place", node.alias("n"), F.array(part).alias("parts"))
    gathered = of_place.where("_members > 1").groupBy("book_id", "_place").agg(F.min_by(node, "node_pos").alias("n"), parts.alias("parts")).unionByName(alone)
    rest = F.slice("parts", 2, F.greatest(F.size("parts") - 1, F.lit(0)))
    more = F.flatten(F.transform(rest, lambda p: p["provenance"]))
    kids = F.col("n.children")
    last = F.element_at(kids, -1)
    item = F.struct(last["node_id"].alias("node_id"), last["node_type"].alias("node_type"), last["ordinal"].alias("ordinal"), last["marker"].alias("marker"), _stitched(last["node_id"], last["spans"], rest).alias("spans"), F.concat(last["provenance"], more).alias("provenance"))
    grown = F.when((F.col("n.node_type") == "list") & (F.size(rest) > 0), F.concat(F.slice(kids, 1, F.size(kids) - 1), F.array(item))).otherwise(kids)
    text = F.when(F.col("n.node_type") == "paragraph", _stitched(F.col("n.node_id"), F.col("n.spans"), rest)).otherwise(F.col("n.spans"))
    changed = {"node_pos": F.col("_place"), "children": grown, "spans": text, "provenance": F.concat("n.provenance", more)}
    return gathered.select(*(changed.get(c, F.col(f"n.{c}")).alias(c) for c in flow.columns)), used


def footnote_references(blocks: DataFrame) -> DataFrame:
    """Superscript labels in the body that exactly one footnote of the page bears, upper and lower case alike."""
    notes = blocks.where("role = 'footnote'").select("book_id", "page_id", "block_id", fold(label_of_footnote(F.col("block"))).alias("key")).where("key is not null")
    one = notes.groupBy("book_id", "page_id", "key").agg(F.count("*").alias("n"), F.first("block_id").alias("note")).where("n = 1").select("book_id", "page_id", "key", F.concat("note", F.lit(":node:footnote")).alias("target_id"))
    refs = blocks.where("role <> 'footnote'").select("book_id", "page_id", F.explode("block.content").alias("s")).where("s.source_typography.vertical_position = 'superscript'")
    refs = refs.select("book_id", "page_id", F.col("s.span_id").alias("source_id"), fold(footnote_label(F.col("s.text"))).alias("key")).where("key is not null")
    found = refs.join(one, ["book_id", "page_id", "key"])
    return found.select("book_id", F.concat("source_id", F.lit(":relationship:footnote-ref:"), "target_id").alias("relationship_id"), F.lit("footnote_ref").alias("kind"), "source_id", "target_id", F.lit(1.0).alias("confidence"), F.array(F.lit(FOOTNOTE_REASON)).alias("reasons"))


def _page_of(provenance_: Column) -> Column:
    """The one page a node comes from; null if there are more."""
    pages = F.array_distinct(F.transform(provenance_, lambda p: p["page_id"]))
    return F.when(F.size(pages) == 1, pages[0])


def neighbour_links(flow: DataFrame) -> DataFrame:
    """attribution_of: from an attribution to its one neighbour on the page that is a quotation or verse. translation_of: from
    a quotation to the one before it in another language and of a like length, surer beside an attribution."""
    w = Window.partitionBy("book_id").orderBy("node_pos")
    spans = F.flatten(F.transform("children", lambda c: c["spans"]))
    tongues = F.array_distinct(F.filter(F.transform(spans, lambda s: s["language"]), lambda x: x.isNotNull()))
    quoted = F.col("node_type") == "quotation"
    rows = flow.select("book_id", "node_pos", "node_id", "node_type", _page_of(F.col("provenance")).alias("on"), F.when(quoted & (F.size(tongues) == 1), tongues[0]).alias("tongue"), F.when(quoted, F.length(collapse(F.array_join(F.transform(spans, lambda s: s["text"]), " ")))).alias("size"))
    side = lambda f, n=1: {c: f(c, n).over(w) for c in ("node_id", "node_type", "on", "tongue", "size")}
    before, after = side(F.lag), side(F.lead)
    near = lambda x: F.coalesce(x["node_type"].isin("quotation", "verse", "inset") & (x["on"] == F.col("on")), F.lit(False))
    beside = F.coalesce(F.lag("node_type", 2).over(w) == "attribution", F.lit(False)) | F.coalesce(after["node_type"] == "attribution", F.lit(False))
    likely = (before["node_type"] == "quotation") & (F.col("node_type") == "quotation") & (before["on"] == F.col("on")) & (before["tongue"] != F.col("tongue")) & (before["size"] > 0) & (F.col("size") / before["size"]).between(0.4, 2.5)
    marked = rows.select("book_id", "node_id", "node_type", near(before).alias("a"), near(after).alias("b"), before["node_id"].alias("prev"), after["node_id"].alias("next"), likely.alias("likely"), beside.alias("beside"))
    attributed = marked.where("node_type = 'attribution' and a <> b").select("book_id", F.col("node_id").alias("source_id"), F.when(F.col("a"), F.col("prev")).otherwise(F.col("next")).alias("target_id"), F.lit("attribution_of").alias("kind"), F.lit(0.95).alias("confidence"), F.array(F.lit(ATTRIBUTION_REASON)).alias("reasons"))
    two = F.array(*map(F.lit, TRANSLATION_REASONS))
    translated = marked.where("likely").select("book_id", F.col("node_id").alias("source_id"), F.col("prev").alias("target_id"), F.lit("translation_of").alias("kind"), F.when(F.col("beside"), 0.90).otherwise(0.80).alias("confidence"), F.when(F.col("beside"), F.concat(two, F.array(F.lit(SHARED_ATTRIBUTION)))).otherwise(two).alias("reasons"))
    both = attributed.unionByName(translated)
    name = F.concat("source_id", F.lit(":relationship:"), F.replace(F.col("kind"), F.lit("_"), F.lit("-")), F.lit(":"), "target_id")
    return both.select("book_id", name.alias("relationship_id"), "kind", "source_id", "target_id", "confidence", "reasons")


def inset_candidates(placed: DataFrame) -> DataFrame:
    """Genre labels, which may open embedded material; with the heading before them on the page, if there is one."""
    w = Window.partitionBy("at", "page_index").orderBy("pos")
    headed = F.coalesce(F.lag("role").over(w) == "heading", F.lit(False))
    rows = placed.withColumn("headed", headed).withColumn("prev", F.lag("block_id").over(w)).where("role = 'heading' and block.heading_role_hint = 'genre_label'")
    ids = F.when(F.col("headed"), F.array("prev", "block_id")).otherwise(F.array("block_id"))
    reasons = F.when(F.col("headed"), F.array(*map(F.lit, INSET_REASONS))).otherwise(F.array(F.lit(INSET_REASONS[0])))
    return rows.select("book_id", "pos", F.concat(ids[0], F.lit(":candidate:inset")).alias("candidate_id"), F.lit("inset").alias("kind"), F.lit("unknown").alias("role"), ids.alias("source_block_ids"), F.when(F.col("headed"), 0.90).otherwise(0.75).alias("confidence"), reasons.alias("reasons"))


def nodes_and_references(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """nodes of analyze(), and those of its relationships that refer to footnotes, step by step: each step's table is written, so that its
    shuffle files are gone when the next begins, and removed as soon as it has been read."""
    require_unique(pages.select("book_id", "page.page_id"), ["book_id", "page_id"], "page_id")
    ordered = ordered_pages(pages)
    # What no step reads is left out, so that both sides of a join of positions read the same columns, and one exchange serves them.
    placed = written(positions(_blocks(ordered)).drop("text", "printed"), "placed")
    refs = written(footnote_references(placed), "references")
    links = written(continuations(ordered, placed), "links")
    flow = written(nodes(placed), "flow")
    dropped(placed)
    merged = written(resolved_chains(flow, links)[0], "nodes")
    dropped(flow, links)
    return merged, refs


def analyze(pages: DataFrame) -> Analysis:
    """The structure of every book in pages (book_id, page_pos, page_number, page). Raises ValueError if a page_id occurs
    twice in a book. Pages without blocks count in the order of pages; an empty table gives empty tables."""
    require_unique(pages.select("book_id", "page.page_id"), ["book_id", "page_id"], "page_id")
    ordered = ordered_pages(pages)
    blocks = _blocks(ordered)
    placed = positions(blocks)
    flow = nodes(placed)
    links = continuations(ordered, placed)
    merged, used = resolved_chains(flow, links)
    key = ["book_id", "relationship_id"]
    kept = links.drop("page_index")
    open_links = kept.join(used, key, "left_anti")
    relationships = open_links.unionByName(footnote_references(blocks.where(~F.col("role").isin(*FURNITURE)))).unionByName(neighbour_links(flow))
    unresolved = placed.where("node_type is null").select("book_id", "pos", "page_id", "block_id", "role", "text", "block")
    return Analysis(merged, relationships, kept.join(used, key, "left_semi"), furniture(blocks), unresolved, inset_candidates(placed))
