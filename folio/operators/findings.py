"""Text review from pages to corrected pages: projections with anchors, findings, decisions, corrections.

A projection is a page's readable text with runs of anchors: which span, from which offset on, stands at which place of
the text. Finding differences is the one step that needs Python (matching.py, whose blocks are those of the standard
library's matcher); it runs in Arrow batches, a page at a time. Joins, states and checks are DataFrame operations.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.functions.text import padded
from folio.operators.evidence import BLOCK_TYPE
from folio.operators.matching import changed
from folio.operators.review import BRIDGE, difference_kind, severity

UNREVIEWED = ("image", "page_header", "page_footer", "page_number")
#: Rows that an Arrow function turns into Python objects at a time.
SLICE = 64
DECISIONS = ("keep_source", "use_ocr", "use_suggestion", "manual")
RUN_TYPE = "struct<start:int,end:int,block_id:string,span_id:string,span_offset:int,block_role:string>"


def _sliced(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        yield from (f.iloc[at : at + SLICE] for at in range(0, len(f), SLICE))


def _projected(page_id: str, blocks: list[dict]) -> tuple[str, list[tuple]]:
    """The text, and (start, end, block_id, span_id, span_offset, block_role) of stretches of one span without a gap."""
    out: list[str] = []
    runs: list[list] = []
    size, pending, space = 0, False, None
    started = False

    def put(text: str, at: tuple | None) -> None:
        nonlocal size
        out.append(text)
        if at is not None:
            bid, sid, offset, role = at
            last = runs[-1] if runs else None
            if last and last[1] == size and last[3] == sid and last[4] + size - last[0] == offset:
                last[1] = size + len(text)
            else:
                runs.append([size, size + len(text), bid, sid, offset, role])
        size += len(text)

    def gap(at: tuple | None) -> None:
        nonlocal pending, space
        if size:
            pending, space = True, space if space is not None else at

    for b in blocks:
        if b["role_hint"] in UNREVIEWED or b["content"] is None or not len(b["content"]):
            continue
        if started:
            gap(None)
        started = True
        for s in b["content"]:
            for offset, c in enumerate(s["text"]):
                at = (b["block_id"], s["span_id"], offset, b["role_hint"])
                if c.isspace():
                    gap(at)
                    continue
                if pending:
                    put(" ", space)
                    pending, space = False, None
                put(c, at)
            if s["semantic_line_break_after"]:
                gap(None)
    return "".join(out), [tuple(r) for r in runs]


def projections(pages: DataFrame) -> DataFrame:
    """(book_id, page_id, page_number, text, anchors) of pages (book_id, page_number, page): readable text without
    furniture and images, white space collapsed; anchors are runs of characters of one span."""

    run_type = pa.struct([(n, pa.string() if n in ("block_id", "span_id", "block_role") else pa.int32()) for n in ("start", "end", "block_id", "span_id", "span_offset", "block_role")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                f = batch.slice(at, SLICE)
                got = [_projected(p, b if b is not None else []) for p, b in zip(f.column(1).to_pylist(), f.column(3).to_pylist(), strict=True)]
                anchors = [[dict(zip(("start", "end", "block_id", "span_id", "span_offset", "block_role"), r, strict=True)) for r in runs] for _, runs in got]
                yield pa.RecordBatch.from_arrays([*f.columns[:3], pa.array([t for t, _ in got], pa.string()), pa.array(anchors, pa.list_(run_type))], ["book_id", "page_id", "page_number", "text", "anchors"])

    rows = pages.select(F.col("book_id").cast("string").alias("book_id"), F.col("page.page_id").alias("page_id"), F.col("page_number").cast("long").alias("page_number"), F.col("page.blocks").cast(f"array<{BLOCK_TYPE}>").alias("blocks"))
    return rows.mapInArrow(run, f"book_id string, page_id string, page_number long, text string, anchors array<{RUN_TYPE}>")


def anchor_of(anchors: Column, start: Column, end: Column) -> Column:
    """The run a range belongs to: the first inside it, else the nearest before, else the nearest behind; null without any."""
    inside = F.get(F.filter(anchors, lambda r: (r["end"] > start) & (r["start"] < end)), F.lit(0))
    before = F.filter(anchors, lambda r: r["end"] <= start)
    behind = F.get(F.filter(anchors, lambda r: r["start"] >= end), F.lit(0))
    return F.coalesce(inside, F.get(before, F.size(before) - 1), behind)


def span_target(anchors: Column, start: Column, end: Column) -> Column:
    """(span_id, span_start, span_end) of a range that lies in one span; null if it doesn't. An empty range stands before
    the character it points at, else behind the one before."""
    at = lambda p: F.get(F.filter(anchors, lambda r: (r["start"] <= p) & (r["end"] > p)), F.lit(0))
    here, prev = at(start), at(start - 1)
    point = lambda sid, o: F.struct(sid.alias("span_id"), o.cast("int").alias("span_start"), o.cast("int").alias("span_end"))
    empty = F.when(here.isNotNull(), point(here["span_id"], here["span_offset"] + start - here["start"])).when(prev.isNotNull(), point(prev["span_id"], prev["span_offset"] + start - prev["start"]))
    inside = F.filter(anchors, lambda r: (r["end"] > start) & (r["start"] < end))
    first, last = F.get(inside, F.lit(0)), F.get(inside, F.size(inside) - 1)
    low = first["span_offset"] + F.greatest(start - first["start"], F.lit(0))
    high = last["span_offset"] + F.least(end, last["end"]) - last["start"]
    # Characters of the span that the projection left out would make the range stand for more than it shows.
    shown = F.aggregate(inside, F.lit(0), lambda n, r: n + F.least(r["end"], end) - F.greatest(r["start"], start))
    one = F.size(F.array_distinct(F.transform(inside, lambda r: r["span_id"]))) == 1
    whole = F.when(one & (high - low == shown), F.struct(first["span_id"].alias("span_id"), low.cast("int").alias("span_start"), high.cast("int").alias("span_end")))
    return F.when(start == end, empty).otherwise(whole)


def _joined(ops: Iterator[tuple[int, int, int, int]], mine: str) -> list[tuple[int, int, int, int]]:
    """Changed ranges, those over short bridges without the end of a sentence joined."""
    out: list[list[int]] = []
    for a, b, c, d in ops:
        bridge = mine[out[-1][1] : a] if out else None
        if bridge is not None and len(bridge) <= BRIDGE and not set(bridge) & set(".!?;\n"):
            out[-1][1], out[-1][3] = b, d
        else:
            out.append([a, b, c, d])
    return [tuple(g) for g in out]


def matched(mine: str, other: str) -> tuple[float, list[tuple[int, int, int, int]]]:
    """Ratio and joined changed ranges of texts of any length."""
    ratio, ops = changed(mine, other)
    return ratio, _joined(iter(ops), mine)


def compared(pairs: DataFrame) -> DataFrame:
    """(id, ratio, groups) of (id, mine, other); null is empty."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in _sliced(frames):
            got = [matched(a or "", b or "") for a, b in zip(f["mine"], f["other"], strict=True)]
            yield pd.DataFrame({"id": f["id"], "ratio": [r for r, _ in got], "groups": [[dict(zip(("start", "end", "other_start", "other_end"), g, strict=True)) for g in gs] for _, gs in got]})

    return pairs.select(F.col("id").cast("string").alias("id"), "mine", "other").mapInPandas(run, "id string, ratio double, groups array<struct<start:int,end:int,other_start:int,other_end:int>>")


FINDING = ("finding_id", "book_id", "page_id", "page_number", "source", "kind", "severity", "start", "end", "reference_start", "reference_end", "text", "reference_text", "suggested_text", "block_id", "span_id", "block_role")


def _finding_id(page: Column, kind: str, n: Column) -> Column:
    return F.concat(F.lit("page-"), padded(page), F.lit(f"-{kind}-"), padded(n))


def difference_findings(projected: DataFrame, readings: DataFrame) -> DataFrame:
    """Findings, numbered in text order on each page, where a page's text and an independent reading (book_id, page_id,
    reading) differ; and ratio, how alike the two are. Pages without a reading have none."""
    key = F.to_json(F.struct("book_id", "page_id"))
    both = projected.join(readings.select("book_id", "page_id", "reading"), ["book_id", "page_id"]).withColumn("id", key)
    found = compared(both.select("id", F.col("text").alias("mine"), F.col("reading").alias("other")))
    rows = both.join(found, "id").select("book_id", "page_id", "page_number", F.col("text").alias("_t"), "reading", "anchors", "ratio", F.posexplode("groups").alias("n", "g"))
    mine = F.substring("_t", F.col("g.start") + 1, F.col("g.end") - F.col("g.start"))
    other = F.substring("reading", F.col("g.other_start") + 1, F.col("g.other_end") - F.col("g.other_start"))
    rows = rows.withColumn("text", mine).withColumn("reference_text", other).withColumn("kind", difference_kind(F.col("text"), F.col("reference_text"))).withColumn("anchor", anchor_of(F.col("anchors"), F.col("g.start"), F.col("g.end")))
    return rows.select(_finding_id(F.col("page_number"), "ocr", F.col("n") + 1).alias("finding_id"), "book_id", "page_id", "page_number", F.lit("local_ocr").alias("source"), "kind", severity(F.col("kind"), F.col("text"), F.col("reference_text")).alias("severity"), F.col("g.start").alias("start"), F.col("g.end").alias("end"), F.col("g.other_start").alias("reference_start"), F.col("g.other_end").alias("reference_end"), "text", "reference_text", F.lit(None).cast("string").alias("suggested_text"), "anchor.block_id", "anchor.span_id", "anchor.block_role", "ratio")


@cache
def digit_class() -> str:
    """A class of what counts as a digit: decimal ones, and those raised, lowered and encircled, as str.isdigit() has them."""
    return "[\\p{Nd}" + "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isdigit() and not c.isdecimal()) + "]"


@cache
def digits() -> str:
    """digit_class() as a group that rejects most characters at their first comparison: ASCII apart, the others in ranges."""
    ranges: list[list[int]] = []
    for c in (c for c in range(sys.maxunicode + 1) if chr(c).isdigit() and not chr(c).isdecimal()):
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "(?:[0-9]|(?![\\x00-\\x7F])[\\p{Nd}" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges) + "])"


def boundary_places(text: Column) -> Column:
    """0-based places where a space may be missing: a digit behind a letter; a capital behind a lower-case letter and a point."""
    # Each match starts anew behind its first character, as lookbehinds take none.
    marked = F.regexp_replace(text, "(?=" + digits() + r")(?<=\p{L})|(?=\p{IsUppercase})(?<=\p{IsLowercase}\.)", "￿")
    pieces = F.split(marked, "￿")
    sizes = F.transform(pieces, lambda p: F.length(p))
    ends = F.transform(sizes, lambda _, i: F.aggregate(F.slice(sizes, 1, i + 1), F.lit(0), lambda a, x: a + x))
    return F.slice(ends, 1, F.size(ends) - 1)


def boundary_findings(projected: DataFrame) -> DataFrame:
    """Findings at boundary_places(): the word around each, and the word with a space put in. Texts with U+FFFF have it as a blank."""
    text = F.replace("text", F.lit("￿"), F.lit(" "))
    rows = projected.withColumn("_t", text).select("book_id", "page_id", "page_number", "anchors", "_t", F.posexplode(boundary_places(F.col("_t"))).alias("n", "at"))
    before, behind = F.substring("_t", F.lit(1), F.col("at")), F.substring("_t", F.col("at") + 1, F.length("_t"))
    # From behind, as a search for the end would try every place of the text.
    head, tail = F.reverse(F.regexp_extract(F.reverse(before), r"(?U)^\S*", 0)), F.regexp_extract(behind, r"(?U)^\S*", 0)
    rows = rows.withColumn("_a", head).withColumn("_b", tail).withColumn("start", (F.col("at") - F.length("_a")).cast("int")).withColumn("end", (F.col("at") + F.length("_b")).cast("int")).withColumn("anchor", anchor_of(F.col("anchors"), F.col("start"), F.col("end")))
    none = F.lit(None).cast("int")
    return rows.select(_finding_id(F.col("page_number"), "heur", F.col("n") + 1).alias("finding_id"), "book_id", "page_id", "page_number", F.lit("heuristic").alias("source"), F.lit("suspicious_boundary").alias("kind"), F.lit("major").alias("severity"), "start", "end", none.alias("reference_start"), none.alias("reference_end"), F.concat("_a", "_b").alias("text"), F.lit("").alias("reference_text"), F.concat("_a", F.lit(" "), "_b").alias("suggested_text"), "anchor.block_id", "anchor.span_id", "anchor.block_role")


def _bare(text: str) -> tuple[str, int]:
    marks = sum(unicodedata.category(c) == "Mn" for c in unicodedata.normalize("NFD", text)) + text.count("đ") + text.count("Đ")
    low = unicodedata.normalize("NFD", text.casefold())
    return "".join(c for c in low if unicodedata.category(c) != "Mn").replace("đ", "d"), marks


def diacritic_loss(rows: DataFrame, mine: str = "text", other: str = "reference_text", name: str = "diacritics_only") -> DataFrame:
    """rows with name: whether both texts are the same but for accents, of which mine has more. Spark has no canonical
    decomposition, so this is an Arrow function."""

    @F.pandas_udf("boolean")
    def lost(a: pd.Series, b: pd.Series) -> pd.Series:
        def one(x: str | None, y: str | None) -> bool:
            if not x or not y:
                return False
            (p, m), (q, n) = _bare(x), _bare(y)
            return p == q and m > n

        return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype=bool)

    return rows.withColumn(name, lost(F.col(mine), F.col(other)))


def _reject(rows: DataFrame, what: str, *columns: str) -> None:
    """Raises ValueError with some of rows, if there are any."""
    some = rows.select(*columns).limit(5).collect()
    if some:
        raise ValueError(f"{what}: {[tuple(r) for r in some]}")


def imported_decisions(decisions: DataFrame, findings: DataFrame, projected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """resolutions and corrections of decisions (book_id, finding_id, decision, replacement_text), which replace all earlier ones.

    Raises ValueError for repeated or unknown findings, unknown decisions, findings of pages that aren't there, texts
    that are no longer what the finding saw, replacements that the decision has none for, and edits outside one span.
    """
    key = ["book_id", "finding_id"]
    _reject(decisions.groupBy(*key).count().where("count > 1"), "decided twice", *key)
    _reject(decisions.where(~F.coalesce(F.col("decision").isin(*DECISIONS), F.lit(False))), "unknown decision", *key, "decision")
    _reject(decisions.join(findings, key, "left_anti"), "unknown finding", *key)
    rows = decisions.select(*key, "decision", F.col("replacement_text").alias("_manual")).join(findings, key)
    _reject(rows.join(projected, ["book_id", "page_id"], "left_anti"), "finding of an unknown page", *key)
    rows = rows.join(projected.select("book_id", "page_id", F.col("text").alias("_page"), "anchors"), ["book_id", "page_id"])
    _reject(rows.where((F.col("end") > F.length("_page")) | (F.substring("_page", F.col("start") + 1, F.col("end") - F.col("start")) != F.col("text"))), "stale finding", *key)
    chosen = F.when(F.col("decision") == "keep_source", F.col("text")).when((F.col("decision") == "use_ocr") & (F.col("source") == "local_ocr"), F.col("reference_text")).when(F.col("decision") == "use_suggestion", F.col("suggested_text")).when(F.col("decision") == "manual", F.col("_manual"))
    rows = rows.withColumn("replacement_text", chosen).withColumn("target", span_target(F.col("anchors"), F.col("start"), F.col("end")))
    _reject(rows.where("replacement_text is null"), "no replacement", *key, "decision")
    edits = rows.where("decision <> 'keep_source'")
    _reject(edits.where("target is null"), "not in one span", *key)
    resolutions = rows.select(*key, "page_id", "page_number", "decision", "start", "end", "text", "replacement_text", "block_id", F.coalesce("target.span_id", "span_id").alias("span_id"))
    return resolutions, edits.select("book_id", "page_id", "finding_id", "decision", "target.*", F.col("text").alias("original_text"), "replacement_text")


def checked_corrections(spans: DataFrame, corrections: DataFrame) -> DataFrame:
    """corrections with problem: unknown span, range outside the text, overlap with another edit, stale text; null if none."""
    w = Window.partitionBy("book_id", "span_id").orderBy("span_start", "span_end", "replacement_text")
    known = spans.select("book_id", "span_id", F.col("text").alias("_text"))
    rows = corrections.join(known, ["book_id", "span_id"], "left").withColumn("_prev", F.max("span_end").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    seen = F.substring("_text", F.col("span_start") + 1, F.col("span_end") - F.col("span_start"))
    problem = F.when(F.col("_text").isNull(), "unknown span").when((F.col("span_start") < 0) | (F.col("span_end") < F.col("span_start")), "no range").when(F.col("span_start") < F.col("_prev"), "overlap").when(F.col("span_end") > F.length("_text"), "outside the span").when(seen != F.col("original_text"), "stale")
    return rows.withColumn("problem", problem).drop("_text", "_prev")


def corrected_spans(spans: DataFrame, corrections: DataFrame) -> DataFrame:
    """spans (book_id, span_id, text, ...) with the corrections put in; raises ValueError if any has a problem."""
    _reject(checked_corrections(spans, corrections).where("problem is not null"), "correction", "book_id", "span_id", "problem")
    edit = F.struct(F.col("span_start").alias("start"), F.col("span_end").alias("end"), F.col("replacement_text").alias("replacement"))
    by_span = corrections.groupBy("book_id", "span_id").agg(F.sort_array(F.collect_list(edit), False).alias("_edits"))
    put = lambda t, e: F.concat(F.substring(t, F.lit(1), e["start"]), e["replacement"], F.substring(t, e["end"] + 1, F.length(t)))
    rows = spans.join(by_span, ["book_id", "span_id"], "left")
    return rows.withColumn("text", F.when(F.col("_edits").isNull(), F.col("text")).otherwise(F.aggregate("_edits", F.col("text"), put))).select(*spans.columns)


def corrected_pages(pages: DataFrame, corrections: DataFrame) -> DataFrame:
    """pages (book_id, page, ...) with corrections of their spans put in; everything else of a page stays as it is."""
    spans = pages.select("book_id", F.explode("page.blocks").alias("b")).select("book_id", F.explode("b.content").alias("s")).select("book_id", "s.span_id", "s.text")
    _reject(checked_corrections(spans, corrections).where("problem is not null"), "correction", "book_id", "span_id", "problem")
    edit = F.struct(F.col("span_start").alias("start"), F.col("span_end").alias("end"), F.col("replacement_text").alias("replacement"))
    by_page = corrections.withColumn("e", edit).groupBy("book_id", F.col("page_id").alias("_p"), "span_id").agg(F.sort_array(F.collect_list("e"), False).alias("edits")).groupBy("book_id", "_p").agg(F.map_from_entries(F.collect_list(F.struct("span_id", "edits"))).alias("_edits"))
    rows = pages.withColumn("_p", F.col("page.page_id")).join(by_page, ["book_id", "_p"], "left")
    put = lambda t, e: F.concat(F.substring(t, F.lit(1), e["start"]), e["replacement"], F.substring(t, e["end"] + 1, F.length(t)))
    fix = lambda s: F.when(F.try_element_at("_edits", s["span_id"]).isNull(), s).otherwise(s.withField("text", F.aggregate(F.try_element_at("_edits", s["span_id"]), s["text"], put)))
    blocks = F.transform("page.blocks", lambda b: b.withField("content", F.transform(b["content"], fix)))
    return rows.withColumn("page", F.when(F.col("_edits").isNull(), F.col("page")).otherwise(F.col("page").withField("blocks", blocks))).select(*pages.columns)


def fingerprint(*parts: Column) -> Column:
    """SHA-256 over parts, each behind its length, so that no two lists of parts look alike; null counts as a part of its own."""
    framed = [F.coalesce(F.concat(F.octet_length(p.cast("string")).cast("string"), F.lit(":"), p.cast("string")), F.lit("-:")) for p in parts]
    return F.sha2(F.concat(*framed), 256)


def reviewed_before(pages: DataFrame, cache: DataFrame) -> DataFrame:
    """pages (book_id, page_id, fingerprint) with cached: whether a review of exactly that input is at hand."""
    have = cache.select("book_id", "page_id", F.col("fingerprint").alias("_f")).distinct()
    joined = pages.join(have.withColumn("_hit", F.lit(True)), (pages["book_id"] == have["book_id"]) & (pages["page_id"] == have["page_id"]) & (pages["fingerprint"] == have["_f"]), "left")
    return joined.select(*(pages[c] for c in pages.columns), F.coalesce("_hit", F.lit(False)).alias("cached"))


def review_summary(findings: DataFrame, suppressed: DataFrame) -> DataFrame:
    """One row a book: findings in all, by source, pages with findings, and a map of suppressed ones by reason."""
    kept = findings.groupBy("book_id").agg(F.count("*").alias("findings"), F.count_if(F.col("source") == "local_ocr").alias("from_ocr"), F.count_if(F.col("source") == "heuristic").alias("from_heuristics"), F.count_distinct("page_id").alias("pages_with_findings"))
    by_reason = suppressed.groupBy("book_id", "reason").count().groupBy("book_id").agg(F.sum("count").alias("suppressed"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("reason", "count")))).alias("suppressed_by_reason"))
    return kept.join(by_reason, "book_id", "full_outer").na.fill(0)


def with_stale(snapshots: DataFrame, projected: DataFrame) -> DataFrame:
    """Findings (book_id, page_id, start, end, _then: the text that they saw) of pages that are there, with stale: whether the page's text
    has another at that place, or none."""
    rows = snapshots.join(projected.select("book_id", "page_id", F.col("text").alias("_now")), ["book_id", "page_id"])
    same = (F.col("start") >= 0) & (F.col("end") >= F.col("start")) & (F.col("end") <= F.length("_now")) & (F.substring("_now", F.col("start") + 1, F.col("end") - F.col("start")) == F.col("_then"))
    return rows.withColumn("stale", ~F.coalesce(same, F.lit(False))).drop("_now")


def state_counts(states: DataFrame, by: list[str], known: tuple[str, ...] = ("not_reviewed", "pass", "needs_review", "resolved", "stale")) -> DataFrame:
    """A column of pages for each state, zero where there are none, and complete: whether all pages pass or are resolved."""
    return states.groupBy(*by).agg(*(F.count_if(F.col("state") == s).alias(s) for s in known), F.bool_and(F.col("state").isin("pass", "resolved")).alias("complete"))


def require_complete(states: DataFrame) -> DataFrame:
    """states, if every page passes or is resolved; else ValueError with the counts."""
    open_ = {r["state"]: r["count"] for r in states.groupBy("state").count().collect()}
    if any(s not in ("pass", "resolved") for s in open_):
        raise ValueError(f"review is not complete: {dict(sorted(open_.items()))}")
    return states


def word_box(words: DataFrame, keys: list[str], width: Column, height: Column) -> DataFrame:
    """The box around words (left, top, right, bottom) with a margin of half its width and its height (20 and 16 at least),
    inside the page."""
    box = words.groupBy(*keys).agg(F.min("left").alias("l"), F.min("top").alias("t"), F.max("right").alias("r"), F.max("bottom").alias("b"), F.first(width).alias("_w"), F.first(height).alias("_h"))
    dx, dy = F.greatest(F.lit(20), F.floor((F.col("r") - F.col("l")) / 2)), F.greatest(F.lit(16), (F.col("b") - F.col("t")) * 2)
    return box.select(*keys, F.greatest(F.lit(0), F.col("l") - dx).alias("left"), F.greatest(F.lit(0), F.col("t") - dy).alias("top"), F.least("_w", F.col("r") + dx).alias("right"), F.least("_h", F.col("b") + dy).alias("bottom"))


def first_words(findings: DataFrame, words: DataFrame) -> DataFrame:
    """Findings with the first word (by word_no) of their page that equals reference_text; those without are left out."""
    w = Window.partitionBy("book_id", "finding_id").orderBy("word_no")
    joined = findings.join(words.withColumnRenamed("word", "reference_text"), ["book_id", "page_id", "reference_text"])
    return joined.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")

