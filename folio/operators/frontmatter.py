"""Metadata and covers of books from their first pages.

All first pages of a book are one task of a provider plug-in, which the waves of extraction call for all books at once. What it suggests is
checked as a metadata file is; the page that it names as the cover is looked up among those that it was shown.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.text import escape_markup
from folio.operators import extraction
from folio.operators.packaging import METADATA_FIELDS
from folio.sources.files import with_metadata

FIRST, LAST = 1, 8
PAGE_ROLES = ("cover_page_number", "title_page_number", "copyright_page_number")

# States of a cover, endings of cover images.
NOT_DETECTED, NOT_SELECTED, EXTRACTED, NOT_CONVERTED = "not-detected", "page-not-selected", "extracted", "failed"
COVER_ENDINGS = ("gif", "jpeg", "jpg", "png", "svg")

#: Gives an image that is no JPEG as one; raises an exception for what it can't convert. It must be importable on the executors.
Converter = Callable[[bytes], bytes]


def front_tasks(images: DataFrame, first: int = FIRST, last: int = LAST) -> DataFrame:
    """(book_id, first_pages: array of page_number, media_type and image) of images (book_id, page_number, media_type, image): pages first to last, in
    order, at most last - first + 1 of them in a row. A page that is there twice is taken once. ValueError for a range that is none, and for books
    without a page in it."""
    if first < 1 or last < first:
        raise ValueError(f"no range of pages: {first} to {last}")
    chosen = images.where(F.col("page_number").between(first, last)).groupBy("book_id", "page_number").agg(F.min(F.struct("media_type", "image")).alias("p"))
    tasks = chosen.groupBy("book_id").agg(F.sort_array(F.collect_list(F.struct("page_number", "p.media_type", "p.image"))).alias("first_pages"))
    none = images.select("book_id").distinct().join(tasks.select("book_id"), "book_id", "left_anti").limit(5).collect()
    if none:
        raise ValueError(f"books without pages {first} to {last}: {[r['book_id'] for r in none]}")
    return tasks


def judged_suggestions(answers: DataFrame) -> DataFrame:
    """answers (_raw, ...) with suggestion (metadata, PAGE_ROLES, warnings) and violations: page numbers are whole and above 0 or null, warnings a list of
    texts, of which blank ones are left out; else as in metadata files. A suggestion without a title is one."""
    rows = with_metadata(answers, "_raw").withColumn("_v", F.try_parse_json("_raw"))
    at = lambda k: F.try_variant_get("_v", f"$.{k}", "variant")
    given = lambda k: at(k).isNotNull() & ~F.is_variant_null(at(k))
    number = lambda k: F.when(F.schema_of_variant(at(k)) == "BIGINT", F.try_variant_get("_v", f"$.{k}", "int"))
    texts = F.try_variant_get("_v", "$.warnings", "array<variant>")
    fine = ~given("warnings") | (texts.isNotNull() & F.forall(texts, lambda w: F.schema_of_variant(w) == "STRING"))
    bad = [F.when(given(k) & ~F.coalesce(number(k) >= 1, F.lit(False)), F.lit(f"{k}: a whole number above 0")) for k in PAGE_ROLES]
    bad.append(F.when(~F.coalesce(fine, F.lit(False)), F.lit("warnings: a list of texts")))
    said = F.filter(F.transform(F.coalesce(F.when(fine, F.try_variant_get("_v", "$.warnings", "array<string>")), F.array().cast("array<string>")), lambda w: F.trim(w)), lambda w: w != "")
    suggestion = F.struct("metadata", *(number(k).alias(k) for k in PAGE_ROLES), said.alias("warnings"))
    made = rows.withColumns({"violations": F.concat("violations", F.array_compact(F.array(*bad))), "suggestion": suggestion})
    return made.drop("_v", "metadata")


def suggested(tasks: DataFrame, routes: list[dict], extractors: dict, keep: Callable[[DataFrame, str], DataFrame], policy: str = "free-only", base: float = 1.0, most: float = 8.0, **more) -> DataFrame:
    """front_tasks() with outcome, suggestion, raw and attempts, as extraction.extracted; plug-ins get the pages, as dicts, and the task (book_id, route,
    attempt)."""
    return extraction.extracted(tasks, routes, extractors, keep, policy, base, most, judge=judged_suggestions, made="suggestion", keys=("book_id",), asset="first_pages", **more)


def cover_page(field: str) -> Column:
    """What the row's cover page is in first_pages, null without one."""
    return F.get(F.filter("first_pages", lambda p: p["page_number"] == F.col("cover_page_number")), F.lit(0))[field]


def cover_states(books: DataFrame) -> DataFrame:
    """books (cover_page_number, pages: numbers of the pages that were selected, ...) with cover_status."""
    there = F.array_contains("pages", F.col("cover_page_number"))
    return books.withColumn("cover_status", F.when(F.col("cover_page_number").isNull(), NOT_DETECTED).when(there, EXTRACTED).otherwise(NOT_SELECTED))


def _converted(convert: Converter | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for kind, data in zip(batch.column("_kind").to_pylist(), batch.column("_image"), strict=True):
                data = data.as_py()
                if data is None or kind == "image/jpeg":
                    out.append((data, False, None))
                    continue
                try:
                    if convert is None:
                        raise ValueError("no converter")
                    out.append((convert(data), True, None))
                except Exception as e:  # a plug-in may fail in any way; the metadata stays without a cover then
                    out.append((None, False, f"{type(e).__name__}: {e}"))
            columns = [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.binary(), pa.bool_(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column("book_id"), *columns], ["book_id", "cover_image", "transcoded", "reason"])

    return run


def covers(done: DataFrame, convert: Converter | None = None) -> DataFrame:
    """suggested() that succeeded, with pages, cover_status, cover_media_type, cover_image (JPEG), transcoded, reason and all warnings. A JPEG is taken as it
    is, others are given to convert. What can't be had of a cover is a warning, and never fails the metadata."""
    rows = done.where(F.col("outcome") == extraction.SUCCEEDED).withColumns({"pages": F.transform("first_pages", lambda p: p["page_number"]), "cover_page_number": F.col("suggestion.cover_page_number")})
    rows = cover_states(rows)
    made = rows.select("book_id", cover_page("media_type").alias("_kind"), cover_page("image").alias("_image")).mapInArrow(_converted(convert), "book_id string, cover_image binary, transcoded boolean, reason string")
    both = rows.withColumn("cover_media_type", cover_page("media_type")).drop("first_pages").join(made, "book_id")
    state = F.when((F.col("cover_status") == EXTRACTED) & F.col("cover_image").isNull(), NOT_CONVERTED).otherwise(F.col("cover_status"))
    both = both.withColumn("cover_status", state)
    text = F.when(state == NOT_SELECTED, F.concat(F.lit("page "), F.col("cover_page_number").cast("string"), F.lit(" is named as the cover and wasn't among the pages shown"))).when(state == NOT_CONVERTED, F.concat(F.lit("the cover can't be converted: "), F.coalesce("reason", F.lit("no image"))))
    return both.withColumn("warnings", F.concat("suggestion.warnings", F.array_compact(F.array(text))))


def metadata_files(found: DataFrame, folder: str = "covers") -> DataFrame:
    """(path, data) of covers(): <book>.json, a metadata file, which names its cover relative to itself; <folder>/<book>.jpg; and reports/<book>.json, what the
    suggestion was made of."""
    cover = F.when(F.col("cover_image").isNotNull(), F.concat(F.lit(f"{folder}/"), "book_id", F.lit(".jpg"))).otherwise(F.col("suggestion.metadata.cover"))
    kept = {f: (cover if f == "cover" else F.col(f"suggestion.metadata.{f}")) for f in METADATA_FIELDS}
    written = F.to_json(F.struct(*(c.alias(f) for f, c in kept.items())), {"ignoreNullFields": "false"})
    said = F.struct(F.lit("1").alias("schema_version"), F.col("pages").alias("selected_pages"), *(F.col(f"suggestion.{k}").alias(k) for k in PAGE_ROLES), F.struct(F.col("cover_status").alias("status"), F.col("cover_page_number").alias("page_number"), "reason", F.col("cover_media_type").alias("source_media_type"), "transcoded").alias("cover_extraction"), "warnings", F.col("attempts").alias("provider_attempts"), F.col("raw").alias("raw_suggestion"))
    file = lambda path, data: F.struct(path.alias("path"), data.cast("binary").alias("data"))
    files = F.array(file(F.concat("book_id", F.lit(".json")), written), file(F.concat(F.lit("reports/"), "book_id", F.lit(".json")), F.to_json(said, {"ignoreNullFields": "false"})), F.when(F.col("cover_image").isNotNull(), file(F.concat(F.lit(f"{folder}/"), "book_id", F.lit(".jpg")), F.col("cover_image"))))
    return found.select(F.explode(F.array_compact(files)).alias("f")).select("f.path", "f.data")


def cover_ending(path: Column) -> Column:
    """The ending of a cover image in lower case; null if it is none of COVER_ENDINGS."""
    ending = F.lower(F.regexp_extract(path, r"\.([^./]+)\z", 1))
    return F.when(ending.isin(*COVER_ENDINGS), ending)


def cover_documents(books: DataFrame, images: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents (book_id, position, file, content), before all others, and assets (book_id, file, data) of books (book_id, title, language) that have an
    image (book_id, path, data). Raises ValueError for an image that is of no known kind, and for a book with two."""
    odd = images.where(cover_ending(F.col("path")).isNull()).limit(5).collect()
    if odd:
        raise ValueError(f"no cover image: {[r['path'] for r in odd]}")
    twice = images.groupBy("book_id").count().where("count > 1").limit(5).collect()
    if twice:
        raise ValueError(f"books with two covers: {[r['book_id'] for r in twice]}")
    rows = books.select("book_id", "title", "language").join(images, "book_id").withColumn("_name", F.concat(F.lit("cover."), cover_ending(F.col("path"))))
    tongue, title = escape_markup(F.coalesce("language", F.lit("und"))), escape_markup(F.col("title"))
    text = F.concat(
        F.lit('<?xml version="1.0" encoding="utf-8"?>\n<!DOCTYPE html>\n<html xmlns="http://www.w3.org/1999/xhtml" xmlns:epub="http://www.idpf.org/2007/ops" lang="'), tongue, F.lit('" xml:lang="'), tongue,
        F.lit('">\n  <head>\n    <meta charset="utf-8" />\n    <title>'), title, F.lit('</title>\n    <link rel="stylesheet" type="text/css" href="../styles/book.css" />\n  </head>\n  <body epub:type="cover" class="cover-body">\n    <section epub:type="cover" class="cover-page">\n      <img class="book-cover" src="../assets/'),
        "_name", F.lit('" alt="'), title, F.lit('" />\n    </section>\n  </body>\n</html>\n'),
    )
    documents = rows.select("book_id", F.lit(-1).alias("position"), F.lit("cover.xhtml").alias("file"), text.alias("content"))
    return documents, rows.select("book_id", F.concat(F.lit("assets/"), "_name").alias("file"), "data")
