"""Evaluation of golden pages: named checks of cases, each a boolean aggregate over a case's blocks or nodes.

Cases are books of one page; all checks of all cases come from one aggregation of blocks and one of nodes. A check whose
blocks aren't there, or are there twice, fails. Cases without checks of their own have one: their page normalises.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.operators.analyzer import analyze
from folio.operators.evidence import block_text

CATEGORIES = ("text", "language", "typography", "structure", "marker", "figure", "role")
TOKENS = ("prompt_token_count", "candidates_token_count", "thoughts_token_count", "total_token_count", "cached_content_token_count")

# Fixed values of the cases.
ENGLISH_LABEL = "Nguyên văn bản tiếng Anh:"
DATE_LINE = "December 13th, 2014"
TRANSITION = "Và đây là cách ứng xử của tôi:"
SCENARIO, TITLE = "TÌNH HUỐNG", "Bật lại!"
CAPTION_START, CAPTION = "Kỷ niệm Minh Khuê", "Tháng 10 năm 1999"
REGION_ORIGINS = ((0.125, 0.080), (0.122, 0.505))


def _one_with(text: str, holds: Column) -> Column:
    """Exactly one block has that text, and it holds."""
    named = F.col("text") == text
    return (F.count_if(named) == 1) & F.coalesce(F.bool_and(F.when(named, F.coalesce(holds, F.lit(False)))), F.lit(False))


def _first_with(role: str, holds: Column) -> Column:
    """The first block of a role holds."""
    return F.coalesce(F.min_by(F.coalesce(holds, F.lit(False)), F.when(F.col("role") == role, F.col("seq"))), F.lit(False))


def _block_checks() -> dict[tuple[str, str], tuple[str, Column]]:
    b = F.col("block")
    first = F.get(b["content"], F.lit(0))
    breaks = F.transform(b["content"], lambda s: s["semantic_line_break_after"])
    th = F.get(F.filter(b["content"], lambda s: s["text"] == "th"), F.lit(0))["source_typography"]
    graphic = b["marker"]["kind"] == "graphic"
    glyphless = ~F.col("text").contains("") & ~F.col("text").contains("☛")
    return {
        ("page-0018", "roman_language_label"): ("typography", _one_with(ENGLISH_LABEL, first["source_typography"]["posture"] == "roman")),
        ("page-0018", "italic_superscript_th"): ("typography", _one_with(DATE_LINE, (th["posture"] == "italic") & (th["vertical_position"] == "superscript"))),
        ("page-0018", "page_number_language_neutral"): ("language", _first_with("page_number", (F.size(b["content"]) > 0) & first["language"].isNull())),
        ("page-0068", "four_semantic_verse_breaks"): ("structure", _first_with("verse", breaks == F.array(*map(F.lit, (True, True, True, False))))),
        ("page-0152", "heading_wrap_collapsed"): ("structure", _first_with("heading", breaks == F.array(F.lit(False)))),
        ("page-0398", "italic_author_transition"): ("typography", _one_with(TRANSITION, first["source_typography"]["posture"] == "italic")),
        ("page-0402", "scenario_label_and_title_roles"): ("role", _one_with(SCENARIO, b["heading_role_hint"] == "scenario_label") & _one_with(TITLE, b["heading_role_hint"] == "scenario_title")),
        ("page-0402", "graphic_marker_not_unicode_text"): ("marker", _one_with(SCENARIO, graphic & b["marker"]["raw_text"].isNull() & glyphless)),
        ("page-0412", "scenario_label_role"): ("role", _one_with(SCENARIO, b["heading_role_hint"] == "scenario_label")),
        ("page-0412", "eight_graphic_marked_dialogue_turns"): ("marker", F.count_if((F.col("role") == "paragraph") & graphic) == 8),
    }


def _node_checks() -> dict[tuple[str, str], tuple[str, Column]]:
    """Over columns that _summed() makes of a case's nodes, in their order."""
    c = F.col
    some = lambda name: F.greatest(F.coalesce(F.size(name), F.lit(0)), F.lit(0))
    no_list = some("lists") == 0
    spanned = lambda i: F.array_join(F.transform(i["spans"], lambda s: s["text"]), "")
    caption = lambda k: F.get(F.transform("figures", lambda f: spanned(F.get(F.filter(f["children"], lambda x: x["node_type"] == "caption"), F.lit(0)))), F.lit(k))
    origin = lambda k, a: F.round(F.get("figures", F.lit(k))["region"][a], 3)
    regions = F.lit(True)
    for k, (x, y) in enumerate(REGION_ORIGINS):
        regions = regions & (origin(k, "x") == x) & (origin(k, "y") == y)
    items = F.get("lists", F.lit(0))["children"]
    marked = F.forall(items, lambda i: F.coalesce(i["marker"]["kind"] == "graphic", F.lit(False)) & ~spanned(i).contains("♥"))
    return {
        ("page-0068", "four_line_verse_node"): ("structure", c("verse_sizes") == F.array(F.lit(4))),
        ("page-0116", "two_figures"): ("figure", F.size("figures") == 2),
        ("page-0116", "figure_regions"): ("figure", (F.size("figures") == 2) & regions),
        ("page-0116", "figure_captions"): ("figure", (F.size("figures") == 2) & caption(0).startswith(CAPTION_START) & (caption(1) == CAPTION)),
        ("page-0152", "two_line_verse"): ("structure", c("verse_sizes") == F.array(F.lit(2))),
        ("page-0152", "graphic_list_markers_separated"): ("marker", (F.size("lists") == 1) & (F.size(items) == 2) & marked),
        ("page-0378", "ordered_list_10_to_17"): ("structure", (F.size("lists") == 1) & (F.transform(items, lambda i: i["ordinal"]) == F.sequence(F.lit(10), F.lit(17)))),
        ("page-0378", "leading_prose_outside_list"): ("structure", c("types") == F.array(F.lit("paragraph"), F.lit("list"))),
        ("page-0397", "dash_dialogue_not_list"): ("structure", no_list),
        ("page-0397", "four_dash_dialogue_paragraphs"): ("structure", c("dashes") == 4),
        ("page-0398", "dialogue_not_list"): ("structure", no_list),
        ("page-0412", "graphic_dialogue_not_list"): ("structure", no_list),
    }


CHECK_NAMES = (("page-0018", "roman_language_label"), ("page-0018", "italic_superscript_th"), ("page-0018", "page_number_language_neutral"), ("page-0068", "four_semantic_verse_breaks"), ("page-0068", "four_line_verse_node"), ("page-0116", "two_figures"), ("page-0116", "figure_regions"), ("page-0116", "figure_captions"), ("page-0152", "heading_wrap_collapsed"), ("page-0152", "two_line_verse"), ("page-0152", "graphic_list_markers_separated"), ("page-0378", "ordered_list_10_to_17"), ("page-0378", "leading_prose_outside_list"), ("page-0397", "dash_dialogue_not_list"), ("page-0397", "four_dash_dialogue_paragraphs"), ("page-0398", "italic_author_transition"), ("page-0398", "dialogue_not_list"), ("page-0402", "scenario_label_and_title_roles"), ("page-0402", "graphic_marker_not_unicode_text"), ("page-0412", "scenario_label_role"), ("page-0412", "eight_graphic_marked_dialogue_turns"), ("page-0412", "graphic_dialogue_not_list"))


def _rows(frame: DataFrame, checks: dict[tuple[str, str], tuple[str, Column]], aggregate: bool) -> DataFrame:
    """(case_id, check, category, passed) of the checks that are a case's own."""
    entries = [F.struct(F.lit(case).alias("case"), F.lit(name).alias("check"), F.lit(kind).alias("category"), F.coalesce(holds, F.lit(False)).alias("passed")) for (case, name), (kind, holds) in checks.items()]
    made = F.array(*entries).alias("all")
    wide = frame.groupBy("case_id").agg(made) if aggregate else frame.select("case_id", made)
    return wide.select("case_id", F.explode(F.filter("all", lambda e: e["case"] == F.col("case_id"))).alias("e")).select("case_id", "e.check", "e.category", "e.passed")


def _summed(nodes: DataFrame) -> DataFrame:
    ordered = F.sort_array(F.collect_list(F.struct("node_pos", "node_type", "children", "spans", "region")))
    rows = nodes.groupBy(F.col("book_id").alias("case_id")).agg(ordered.alias("n"))
    of = lambda kind: F.filter("n", lambda x: x["node_type"] == kind)
    dashed = F.filter(of("paragraph"), lambda x: F.coalesce(F.get(x["spans"], F.lit(0))["text"].startswith("–"), F.lit(False)))
    return rows.select("case_id", F.transform("n", lambda x: x["node_type"]).alias("types"), of("list").alias("lists"), of("figure").alias("figures"), F.transform(of("verse"), lambda x: F.size(x["children"])).alias("verse_sizes"), F.size(dashed).alias("dashes"))


def evaluated(cases: DataFrame) -> DataFrame:
    """(case_id, check, category, passed) of cases (case_id, page), normalised pages; a null page is one that doesn't normalise."""
    pages = cases.where("page is not null").select(F.col("case_id").alias("book_id"), F.lit(1).alias("page_pos"), F.lit(None).cast("int").alias("page_number"), "page")
    blocks = pages.select(F.col("book_id").alias("case_id"), F.posexplode_outer("page.blocks").alias("seq", "block"))
    blocks = blocks.select("case_id", "seq", "block", F.col("block.role_hint").alias("role"), F.coalesce(block_text(F.col("block")), F.lit("")).alias("text"))
    # A case without any node still has its checks.
    none = pages.select(F.col("book_id").alias("case_id"))
    summed = none.join(_summed(analyze(pages).nodes), "case_id", "left")
    found = _rows(blocks, _block_checks(), True).unionByName(_rows(summed, _node_checks(), False))
    known = sorted({case for case, _ in CHECK_NAMES})
    other = cases.where(~F.col("case_id").isin(*known)).select("case_id", F.lit("fixture_normalizes").alias("check"), F.lit("structure").alias("category"), F.col("page").isNotNull().alias("passed"))
    lost = cases.where(F.col("page").isNull() & F.col("case_id").isin(*known)).select("case_id", F.lit("fixture_normalizes").alias("check"), F.lit("structure").alias("category"), F.lit(False).alias("passed"))
    return found.unionByName(other).unionByName(lost)


def by_category(results: DataFrame) -> DataFrame:
    """(position, category, passed, total) of categories that occur, in their order."""
    place = None
    for i, name in enumerate(CATEGORIES):
        place = F.when(F.col("category") == name, i) if place is None else place.when(F.col("category") == name, i)
    return results.groupBy("category").agg(F.count_if("passed").alias("passed"), F.count("*").alias("total")).select(place.alias("position"), "category", "passed", "total").orderBy("position")


def by_case(results: DataFrame) -> DataFrame:
    """(case_id, all_passed, passed, total)."""
    return results.groupBy("case_id").agg(F.bool_and("passed").alias("all_passed"), F.count_if("passed").alias("passed"), F.count("*").alias("total"))


def token_totals(cases: DataFrame) -> DataFrame:
    """Sums of the token counts in usage; a count that is null everywhere stays null."""
    return cases.agg(*(F.sum(F.col(f"usage.{t}")).cast("long").alias(t) for t in TOKENS))


def report(results: DataFrame) -> tuple[str, bool]:
    """The report as text, a line for each check, and whether all passed. It has as many lines as there are checks."""
    lines, ok = [], True
    for r in results.orderBy("case_id", "check").collect():
        ok &= r["passed"]
        lines.append(f"{'pass' if r['passed'] else 'FAIL'}  {r['case_id']}  {r['category']}  {r['check']}")
    for r in by_category(results).collect():
        lines.append(f"{r['category']}: {r['passed']}/{r['total']}")
    return "\n".join(lines), ok


def names(spark: SparkSession) -> DataFrame:
    """(case_id, check) of all checks there are."""
    return spark.createDataFrame(list(CHECK_NAMES), "case_id string, check string")
