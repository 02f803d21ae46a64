"""Text review: differences to an independent reading, what to suppress, states and corrections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Confidence that a finding needs, by what it is.
THRESHOLDS = {"base": 85.0, "heading": 92.0, "punctuation": 95.0, "short": 97.0}
BRIDGE = 12
# Fixed sets of characters.
CLOSES = r"^[.,;:!?%)\]}»”’]"
OPENS = r"[(\[{«“‘]\z"
PUNCTUATION = r"""^[!"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~“”‘’«»…–— ]*\z"""


def word_offsets(words: DataFrame, by: list[str], order: str) -> DataFrame:
    """start and end of words in their joined text: no space before a word that starts with closing punctuation or behind
    one that ends with opening punctuation."""
    w = Window.partitionBy(*by).orderBy(order)
    prev = F.lag("word").over(w)
    gap = F.when(prev.isNull() | (prev == "") | F.col("word").rlike(CLOSES) | prev.rlike(OPENS), 0).otherwise(1)
    rows = words.withColumn("_g", gap)
    stop = F.sum(F.col("_g") + F.length("word")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("end", stop.cast("int")).withColumn("start", F.col("end") - F.length("word")).drop("_g")


def supported(findings: DataFrame, words: DataFrame) -> DataFrame:
    """confidence of findings (page_id, start, end: of the reading that the words are from): least of the words that overlap, for which a
    range is one wide at least; else of the nearest within 2 characters before its start and behind its end. Null without a word, and
    without a range.

    The join keeps only words in reach, so a page's rows are not all paired with each other.
    """
    f = findings.withColumn("_e", F.greatest("end", F.col("start") + 1))
    w = words.select(F.col("page_id").alias("_p"), F.col("start").alias("ws"), F.col("end").alias("we"), F.col("confidence").alias("wc"))
    pairs = f.join(w, (f["page_id"] == F.col("_p")) & (F.col("we") >= f["start"] - 2) & (F.col("ws") <= f["end"] + 2), "left")
    over = (F.col("we") > F.col("start")) & (F.col("ws") < F.col("_e"))
    near = pairs.groupBy("page_id", "finding_id").agg(
        F.min(F.when(over, F.col("wc"))).alias("c"),
        F.max_by("wc", F.when(F.col("we") <= F.col("start"), F.col("we"))).alias("before"),
        F.min_by("wc", F.when(F.col("ws") >= F.col("end"), F.col("ws"))).alias("after"),
    )
    return findings.join(near.select("page_id", "finding_id", F.coalesce("c", F.least("before", "after")).alias("confidence")), ["page_id", "finding_id"], "left")


def covered(findings: DataFrame, others: DataFrame) -> DataFrame:
    """Findings of a page (page_id, start, end, block_id) whose range, one wide at least, overlaps one of others. Two known blocks that differ keep
    ranges apart."""
    o = others.select("page_id", F.col("start").alias("os"), F.greatest("end", F.col("start") + 1).alias("oe"), F.nullif("block_id", F.lit("")).alias("ob"))
    on = (findings["page_id"] == o["page_id"]) & (findings["start"] < o["oe"]) & (F.greatest(findings["end"], findings["start"] + 1) > o["os"]) & F.coalesce(F.nullif(findings["block_id"], F.lit("")) == o["ob"], F.lit(True))
    return findings.join(o, on, "left_semi")


def difference_kind(mine: Column, other: Column) -> Column:
    """What sets two different texts apart; texts of nothing but spaces are no punctuation."""
    bare = lambda c: F.regexp_replace(c, r"(?U)\s+", "")
    punct = lambda c: c.rlike(PUNCTUATION) & (F.replace(c, F.lit(" "), F.lit("")) != "")
    short = (F.length(mine) <= 2) & (F.length(other) <= 2)
    return F.when((mine != other) & (bare(mine) == bare(other)), "whitespace").when(mine == "", "missing_text").when(other == "", "extra_text").when(punct(mine) & punct(other), "punctuation").when(short, "character").otherwise("replacement")


def severity(kind: Column, mine: Column, other: Column) -> Column:
    return F.when(kind.isin("whitespace", "punctuation") | (F.greatest(F.length(mine), F.length(other)) <= 2), "minor").otherwise("major")


def needed_confidence(kind: Column, role: Column, text: Column) -> Column:
    t = THRESHOLDS
    return F.greatest(F.lit(t["base"]), F.when(role.isin("heading", "other", "unknown"), t["heading"]).otherwise(0.0), F.when(kind == "punctuation", t["punctuation"]).otherwise(0.0), F.when(F.length(F.trim(text)) <= 2, t["short"]).otherwise(0.0))


def suppression(is_covered: Column, diacritics_only: Column, confidence: Column, needed: Column) -> Column:
    """The first reason that holds, null to keep the finding."""
    return F.when(is_covered, "covered_by_heuristic").when(diacritics_only, "ocr_diacritic_loss").when(confidence.isNull(), None).when(confidence < needed, F.concat(F.lit("ocr_confidence_below_"), needed.cast("int").cast("string")))


def review_state(reviewed: Column, fresh: Column, findings: Column, unknown: Column, unresolved: Column) -> Column:
    return F.when(~reviewed, "not_reviewed").when(~fresh, "stale").when(findings == 0, "pass").when(unknown > 0, "stale").when(unresolved == 0, "resolved").otherwise("needs_review")


def with_corrections(text: Column, edits: Column) -> Column:
    """Edits (start, end, replacement; 0-based, half-open, apart) put into a text, from the right."""
    put = lambda t, e: F.concat(F.substring(t, F.lit(1), e["start"]), e["replacement"], F.substring(t, e["end"] + 1, F.length(t)))
    return F.aggregate(F.reverse(F.array_sort(edits)), text, put)
