"""The report of a review: a page's text with its findings marked, and for each finding both readings in context.

Ranges that overlap would cross as elements. A sweep over their ends cuts the text into segments, each of which lies in a set of
findings as a whole, so marks never cross; a segment names all findings that cover it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.text import escape_markup

#: Characters around a finding.
CONTEXT = 70
# Fixed texts of the report.
NOTHING, MORE = "∅", "…"
SOURCE_LABELS = {"local_ocr": "Local OCR", "heuristic": "Heuristic suggestion"}
CHOICES = (("keep_source", "Keep source"), ("use_ocr", "Use OCR"), ("use_suggestion", "Use suggestion"), ("manual", "Manual"))
_STYLE = "body{font-family:system-ui,sans-serif;margin:2rem;color:#202124}.finding{border:1px solid #ddd;border-radius:8px;padding:1rem;margin:1rem 0}.meta{color:#666;font-size:.9rem}.compare{display:grid;grid-template-columns:1fr 1fr;gap:1rem}pre{white-space:pre-wrap;background:#f7f7f7;padding:.8rem}"
#: Decisions as import-review reads them are offered for download.
_SCRIPT = """function decisions(){return [...document.querySelectorAll('article.finding')].flatMap(a=>{const c=a.querySelector('input[type=radio]:checked');if(!c)return [];
const d={book_id:document.body.dataset.book,finding_id:a.id,decision:c.value};if(c.value==='manual')d.replacement_text=a.querySelector('input.manual').value;return [d];});}
document.addEventListener('change',()=>{const b=new Blob([JSON.stringify(decisions(),null,2)],{type:'application/json'});document.getElementById('save').href=URL.createObjectURL(b);});"""


def _with(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def segments(size: Column, ranges: Column) -> Column:
    """Segments (start, end, ids) of a text of a size, in order and without gaps, cut wherever a range (start, end, id) begins or ends. Ends
    outside the text are moved to it; an empty range cuts, and covers nothing."""
    inside = lambda c, n: F.greatest(F.lit(0), F.least(c, n))
    held = lambda n: F.transform(ranges, lambda r: F.struct(inside(r["start"], n).alias("start"), F.greatest(inside(r["start"], n), inside(r["end"], n)).alias("end"), r["id"].alias("id")))
    cuts = lambda n, h: F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0), n), F.transform(h, lambda r: r["start"]), F.transform(h, lambda r: r["end"]))))
    between = lambda c: F.zip_with(F.slice(c, F.lit(1), F.greatest(F.size(c) - 1, F.lit(0))), F.slice(c, F.lit(2), F.greatest(F.size(c) - 1, F.lit(0))), lambda a, b: F.struct(a.alias("start"), b.alias("end")))
    covering = lambda h, s: F.array_sort(F.transform(F.filter(h, lambda r: (r["start"] <= s["start"]) & (r["end"] >= s["end"])), lambda r: r["id"]))
    named = lambda c, h: F.transform(between(c), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), covering(h, s).alias("ids")))
    return _with(size, lambda n: _with(held(n), lambda h: _with(cuts(n, h), lambda c: named(c, h))))


def _part(text: Column, start: Column, end: Column) -> Column:
    return F.substring(text, start + 1, end - start)


def marked_text(text: Column, ranges: Column) -> Column:
    """Markup of a text with a mark for each segment that findings cover."""
    one = lambda s: F.when(F.size(s["ids"]) > 0, F.concat(F.lit('<mark title="'), escape_markup(F.array_join(s["ids"], " ")), F.lit('">'), escape_markup(_part(text, s["start"], s["end"])), F.lit("</mark>"))).otherwise(escape_markup(_part(text, s["start"], s["end"])))
    return F.array_join(F.transform(segments(F.length(text), ranges), one), "")


def highlighted(text: Column, start: Column, end: Column, context: int = CONTEXT) -> Column:
    """Markup of a range with what stands around it; null for a null text."""
    size = F.length(text)
    a = F.greatest(F.lit(0), F.least(F.coalesce(start, F.lit(0)), size))
    b = F.greatest(a, F.least(F.coalesce(end, F.lit(0)), size))
    left, right = F.greatest(F.lit(0), a - context), F.least(size, b + context)
    seen = F.when(b > a, escape_markup(_part(text, a, b))).otherwise(F.lit(NOTHING))
    return F.concat(F.when(left > 0, MORE).otherwise(""), escape_markup(_part(text, left, a)), F.lit("<mark>"), seen, F.lit("</mark>"), escape_markup(_part(text, b, right)), F.when(right < size, MORE).otherwise(""))


def _article(f: Column, text: Column, reading: Column) -> Column:
    by_reading = f["source"] == "local_ocr"
    other = F.when(by_reading, highlighted(reading, f["reference_start"], f["reference_end"])).otherwise(escape_markup(F.coalesce(f["suggested_text"], F.lit(""))))
    label = F.when(by_reading, SOURCE_LABELS["local_ocr"]).otherwise(SOURCE_LABELS["heuristic"])
    off = {"use_ocr": ~by_reading, "use_suggestion": f["suggested_text"].isNull()}
    name = escape_markup(f["finding_id"])
    choices = [F.concat(F.lit('<label><input type="radio" name="decision-'), name, F.lit(f'" value="{value}"'), F.when(off[value], " disabled").otherwise("") if value in off else F.lit(""), F.lit(f"/> {said}</label> ")) for value, said in CHOICES]
    role = F.when(f["block_role"].isNotNull(), F.concat(F.lit(" · "), escape_markup(f["block_role"]))).otherwise("")
    sure = F.when(f["confidence"].isNotNull(), F.concat(F.lit(" · OCR confidence "), F.format_number(f["confidence"], 1), F.lit("%"))).otherwise("")
    meta = F.concat(escape_markup(f["source"]), F.lit(" · "), escape_markup(f["kind"]), F.lit(" · "), escape_markup(f["severity"]), role, sure, F.lit(" · "), escape_markup(F.coalesce(f["block_id"], F.lit("unmapped"))))
    return F.concat(
        F.lit('<article class="finding" id="'), name, F.lit('"><div class="meta">'), meta, F.lit('</div><div class="compare"><div><strong>Page</strong><pre>'), highlighted(text, f["start"], f["end"]),
        F.lit("</pre></div><div><strong>"), label, F.lit("</strong><pre>"), F.coalesce(other, F.lit("")), F.lit("</pre></div></div><p>"), *choices, F.lit('<input class="manual" type="text"/></p></article>'),
    )


def page_reports(projected: DataFrame, readings: DataFrame, findings: DataFrame, suppressed: DataFrame) -> DataFrame:
    """(book_id, page_id, page_number, html) of pages with a finding: a document of its own, with nothing to fetch.

    projected (book_id, page_id, page_number, text), readings (book_id, page_id, reading), findings (with confidence), suppressed findings.
    """
    key = ["book_id", "page_id"]
    columns = ("finding_id", "source", "kind", "severity", "start", "end", "reference_start", "reference_end", "suggested_text", "block_id", "block_role", "confidence")
    found = findings.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("start", "finding_id", F.struct(*columns).alias("f")))).alias("_f"))
    hidden = suppressed.groupBy(*key).agg(F.count("*").alias("_hidden"))
    rows = projected.select(*key, "page_number", "text").join(found, key).join(readings.select(*key, "reading"), key, "left").join(hidden, key, "left")
    ranges = F.transform("_f", lambda x: F.struct(x["f"]["start"].alias("start"), x["f"]["end"].alias("end"), x["f"]["finding_id"].alias("id")))
    articles = F.array_join(F.transform("_f", lambda x: _article(x["f"], F.col("text"), F.col("reading"))), "\n")
    number = F.format_string("%04d", "page_number")
    html = F.concat(
        F.lit('<!doctype html>\n<html lang="en"><head><meta charset="utf-8"/><title>Page '), number, F.lit(f"</title><style>{_STYLE}</style></head>\n"),
        F.lit('<body data-book="'), escape_markup(F.col("book_id")), F.lit('"><h1>Page '), number, F.lit('</h1><div class="meta">actionable: '), F.size("_f").cast("string"), F.lit(" · suppressed: "), F.coalesce("_hidden", F.lit(0)).cast("string"),
        F.lit("</div><pre>"), marked_text(F.col("text"), ranges), F.lit("</pre>\n"), articles, F.lit(f'\n<p><a id="save" download="decisions.json">Decisions</a></p><script>{_SCRIPT}</script></body></html>\n'),
    )
    return rows.select(*key, "page_number", html.alias("html"))
