"""Sequences of blocks as window computations; every window starts with the book, so books are independent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.functions.text import ends_sentence, starts_lower

#: Scores of a continuation, added as doubles in this order.
BASE, NO_END, LOWER_START, SAME_LANGUAGE, SAME_TYPE = 0.40, 0.30, 0.20, 0.05, 0.05
LEAST_SCORE, MOST_SCORE = 0.65, 0.99


def islands(df: DataFrame, by: list[str], order: list[str], breaks: Column, name: str = "run_id") -> DataFrame:
    """Numbers runs from 1; breaks may use lag() over the same window and counts as true for the first row."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_b", F.when(F.row_number().over(w) == 1, 1).otherwise(F.coalesce(breaks, F.lit(True)).cast("int"))).withColumn(name, F.sum("_b").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_b")


def list_runs(items: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Runs of items (kind, page, ordinal): broken by another kind, a page that doesn't follow, or an ordinal that doesn't."""
    w = Window.partitionBy(*by).orderBy(*order)
    lag = lambda c: F.lag(c).over(w)
    ordinal = lag("ordinal").isNotNull() & F.col("ordinal").isNotNull() & (F.col("ordinal") != lag("ordinal") + 1)
    return islands(items, by, order, (F.col("kind") != lag("kind")) | (F.col("page") - lag("page") > 1) | ordinal)


def language_runs(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """A run ends where the last known language and the present one are both known and differ."""
    w = Window.partitionBy(*by).orderBy(*order)
    last = F.last("language", True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return islands(rows, by, order, F.coalesce(last != F.col("language"), F.lit(False)))


def verse_lines(spans: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """line_no of each span: 1 plus the breaks after earlier spans."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return spans.withColumn("line_no", 1 + F.coalesce(F.sum(F.col("break_after").cast("int")).over(w), F.lit(0)))


def figures(blocks: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """state of images and captions: figure, captioned, caption, or unresolved; an image takes the caption right after it."""
    w = Window.partitionBy(*by).orderBy(*order)
    prev, nxt = F.lag("role").over(w), F.lead("role").over(w)
    region = F.col("has_region")
    state = F.when((F.col("role") == "image") & ~region, "unresolved").when((F.col("role") == "image") & (nxt == "caption"), "captioned").when(F.col("role") == "image", "figure")
    state = state.when((F.col("role") == "caption") & (prev == "image") & F.lag("has_region").over(w), "caption").when(F.col("role") == "caption", "unresolved")
    return blocks.withColumn("state", state)


def boundaries(blocks: DataFrame) -> DataFrame:
    """Per (book, page): last block besides footnotes and first block, as structs, from (book, page, seq, role, text, language)."""
    body = F.struct("role", "text", "language", "block_id")
    return blocks.groupBy("book", "page").agg(F.max_by(body, F.when(F.col("role") != "footnote", F.col("seq"))).alias("left"), F.min_by(body, F.col("seq")).alias("right"))


def continuations(pages: DataFrame, same_type: Column | None = None) -> DataFrame:
    """Scored links from the end of a page to the start of the next, from boundaries() with page numbers."""
    w = Window.partitionBy("book").orderBy("page")
    pair = pages.select("book", "page", "left", F.lead("page").over(w).alias("next_page"), F.lead("right").over(w).alias("next")).where("next_page = page + 1")
    flow = lambda c: F.col(f"{c}.role").isin("paragraph", "list_item")
    fits = (F.col("left.role") == F.col("next.role")) & F.col("left.role").isin("paragraph", "list_item", "quote") | (flow("left") & flow("next"))
    a, b = F.col("left.text"), F.col("next.text")
    add = lambda total, when, x: total + F.when(when, F.lit(x)).otherwise(F.lit(0.0))
    score = add(F.lit(BASE), ~ends_sentence(a), NO_END)
    score = add(score, starts_lower(b), LOWER_START)
    score = add(score, F.coalesce(F.col("left.language") == F.col("next.language"), F.lit(False)), SAME_LANGUAGE)
    score = add(score, same_type if same_type is not None else F.lit(True), SAME_TYPE)
    out = pair.where(fits & (F.trim(a) != "") & (F.trim(b) != "")).withColumn("confidence", F.least(score, F.lit(MOST_SCORE)))
    return out.where(F.col("confidence") >= LEAST_SCORE).select("book", "page", F.col("left.block_id").alias("source_id"), F.col("next.block_id").alias("target_id"), "confidence")


def joined_text(parts: DataFrame, by: list[str], order: str) -> DataFrame:
    """Texts of a chain joined by a space, unless white space, a hyphen or closing punctuation makes it needless."""
    w = Window.partitionBy(*by).orderBy(order)
    prev = F.lag("text").over(w)
    bare = prev.isNull() | (prev == "") | (F.col("text") == "") | prev.rlike(r"(\s|[-‐‑\x{AD}])$") | F.col("text").rlike(r"^(\s|[,.;:!?)\]}])")
    piece = parts.withColumn("_p", F.concat(F.when(bare, "").otherwise(" "), "text"))
    sorted_parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("_p").alias("p"))))
    return piece.groupBy(*by).agg(F.count("*").alias("parts"), F.array_join(F.transform(sorted_parts, lambda x: x["p"]), "").alias("text"))


def footnote_links(refs: DataFrame, notes: DataFrame, keys: list[str]) -> DataFrame:
    """References joined to the footnote with their label, where exactly one has it."""
    unique = notes.groupBy(*keys).agg(F.count("*").alias("_n"), F.first("note_id").alias("note_id")).where("_n = 1").drop("_n")
    return refs.join(unique, keys).withColumn("confidence", F.lit(1.0))


def attributions(nodes: DataFrame, by: list[str], order: list[str], what: str, to: tuple[str, ...]) -> DataFrame:
    """Nodes of role what with exactly one neighbour of a role in to: (node_id, target_id)."""
    w = Window.partitionBy(*by).orderBy(*order)
    before, after = (F.coalesce(f("role").over(w).isin(*to), F.lit(False)) for f in (F.lag, F.lead))
    rows = nodes.select("*", before.alias("_a"), after.alias("_b"), F.lag("node_id").over(w).alias("_p"), F.lead("node_id").over(w).alias("_n"))
    return rows.where((F.col("role") == what) & (F.col("_a") != F.col("_b"))).select(*by, "node_id", F.when(F.col("_a"), F.col("_p")).otherwise(F.col("_n")).alias("target_id"), F.lit(0.95).alias("confidence"))


def translations(nodes: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Consecutive nodes in two known languages whose lengths have a ratio from 0.4 to 2.5."""
    w = Window.partitionBy(*by).orderBy(*order)
    rows = nodes.select("node_id", "language", "n", F.lag("node_id").over(w).alias("source_id"), F.lag("language").over(w).alias("_l"), F.lag("n").over(w).alias("_n"), *by)
    fits = (F.col("language") != F.col("_l")) & (F.col("n") > 0) & (F.col("_n") > 0)
    return rows.where(fits & (F.col("n") >= 0.4 * F.col("_n")) & (F.col("n") <= 2.5 * F.col("_n"))).select(*by, "source_id", F.col("node_id").alias("target_id"), F.lit(0.80).alias("confidence"))


def nearest_known(rows: DataFrame, by: list[str], order: str, value: str) -> DataFrame:
    """Fills value from the nearest row that knows it, ties to the lower one."""
    up, down = (Window.partitionBy(*by).orderBy(o).rangeBetween(Window.unboundedPreceding, 0) for o in (F.asc(order), F.desc(order)))
    here = F.when(F.col(value).isNotNull(), F.struct(F.col(order).alias("at"), F.col(value).alias("v")))
    # Both sides are looked up by running from an end: a frame up to the other end is read anew for each row.
    rows = rows.withColumn("_b", F.last(here, True).over(up)).withColumn("_a", F.last(here, True).over(down))
    lower = F.col("_a").isNull() | (F.col(order) - F.col("_b.at") <= F.col("_a.at") - F.col(order))
    near = F.when(F.col("_b").isNotNull() & lower, F.col("_b.v")).otherwise(F.col("_a.v"))
    return rows.withColumn("nearest", F.coalesce(F.col(value), near)).drop("_a", "_b")


def toc_depth(headings: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Depth of entries that may not skip a level: min(max(1, level), depth before + 1)."""
    w = Window.partitionBy(*by).orderBy(*order)
    n = F.row_number().over(w)
    lowest = F.min("_d").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return headings.withColumn("_n", n).withColumn("_d", F.greatest("level", F.lit(1)) - F.col("_n")).withColumn("depth", (F.col("_n") + F.least(F.lit(0), lowest)).cast("int")).drop("_n", "_d")


def spine_cuts(nodes: DataFrame, by: list[str], order: list[str], is_label: Column, starts: Column) -> DataFrame:
    """chunk_id: cut at labels, and at headings that start a document unless a label stands right before."""
    w = Window.partitionBy(*by).orderBy(*order)
    rows = nodes.withColumn("_label", is_label).withColumn("_starts", starts)
    return islands(rows, by, order, F.col("_label") | (F.col("_starts") & ~F.lag("_label").over(w)), "chunk_id").drop("_label", "_starts")


def heading_groups(nodes: DataFrame, by: list[str], order: list[str], primary: Column) -> DataFrame:
    """In runs of headings (run_id): grouped marks the rows from behind the second last primary, if there are two and a primary."""
    w = Window.partitionBy(*by, "run_id").orderBy(*order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = nodes.withColumn("_p", primary.cast("int")).withColumn("_after", F.sum("_p").over(w.rowsBetween(0, Window.unboundedFollowing))).withColumn("_all", F.sum("_p").over(whole))
    rows = rows.withColumn("_in", F.col("_after") <= 1).withColumn("_size", F.sum(F.col("_in").cast("int")).over(whole))
    return rows.withColumn("grouped", (F.col("_all") >= 1) & F.col("_in") & (F.col("_size") >= 2)).drop("_p", "_after", "_all", "_in", "_size")


def list_ordinals(items: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """value: the ordinal where it isn't the one expected from the last known ordinal and the distance to it."""
    w = Window.partitionBy(*by).orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    rows = items.withColumn("_i", F.row_number().over(w))
    known = F.when(F.col("ordinal").isNotNull(), F.struct("ordinal", "_i"))
    rows = rows.withColumn("_k", F.last(known, True).over(before))
    expected = F.col("_k.ordinal") + F.col("_i") - F.col("_k._i")
    return rows.withColumn("value", F.when(F.col("ordinal").isNotNull() & expected.isNotNull() & (F.col("ordinal") != expected), F.col("ordinal"))).drop("_i", "_k")


def number_ranges(numbers: DataFrame, by: list[str], number: str) -> DataFrame:
    """Distinct numbers of a group as text such as 3,7-9."""
    w = Window.partitionBy(*by).orderBy(number)
    runs = numbers.select(*by, number).distinct().withColumn("_g", F.col(number) - F.row_number().over(w)).groupBy(*by, "_g").agg(F.min(number).alias("a"), F.max(number).alias("b"))
    text = F.when(F.col("a") == F.col("b"), F.col("a").cast("string")).otherwise(F.concat(F.col("a").cast("string"), F.lit("-"), F.col("b").cast("string")))
    parts = F.array_sort(F.collect_list(F.struct("a", text.alias("t"))))
    return runs.groupBy(*by).agg(F.array_join(F.transform(parts, lambda x: x["t"]), ",").alias("ranges"))
