"""Sources of books: page runs, stored reviews, metadata, recognised words, and PDF pages.

Folders follow one layout: <root>/<book>/<run>/manifest.json, normalized/page.json, review/*.json. Files are read whole,
one row each, with explicit schemas; a root may be any path that Spark's readers open, and holds any number of books.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.operators.analyzer import require_unique
from folio.operators.evidence import Field, _of, problems, reloaded
from folio.operators.packaging import METADATA_FIELDS, METADATA_TYPE

_TEXTS = ("authors", "subjects", "contributors")


def whole_files(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """(path, text) of the files under root whose path below it matches a glob; none if there are none."""
    try:
        return spark.read.text(f"{root.rstrip('/')}/{pattern}", wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, text string")


def _below(path: Column, n: int) -> Column:
    """The folder n levels above a file, whose path is that of a URI."""
    return F.url_decode(F.replace(F.element_at(F.split(path, "/"), -1 - n), F.lit("+"), F.lit("%2B")))


def book_of(path: Column) -> Column:
    """The book that a file <book>.json is named after, from the path of its URI."""
    return F.regexp_extract(_below(path, 0), r"(?s)^(.*)\.json\z", 1)


def document_hashes(spark: SparkSession, path: str) -> DataFrame:
    """(uri, sha256, size) of binary files. A file is read by one task and may have up to 2 GB; an empty one gives no row."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("uri"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"))


def page_runs(spark: SparkSession, root: str) -> DataFrame:
    """(book_id, run, path, violations, page, page_number, manifest) of all runs that have a manifest and a stored page.

    page is null where the stored page breaks its contract or isn't canonical; violations say how.
    """
    pages = whole_files(spark, root, "*/*/normalized/page.json").select(_below(F.col("path"), 3).alias("book_id"), _below(F.col("path"), 2).alias("run"), "path", F.col("text").alias("stored"))
    manifests = whole_files(spark, root, "*/*/manifest.json").select(_below(F.col("path"), 2).alias("book_id"), _below(F.col("path"), 1).alias("run"), F.col("text").alias("manifest"))
    judged = reloaded(pages.join(manifests, ["book_id", "run"]))
    number = F.try_variant_get(F.try_parse_json("stored"), "$.source.metadata.page_number", "int")
    return judged.withColumn("page_number", number).drop("stored")


def loaded_pages(runs: DataFrame) -> DataFrame:
    """Pages (book_id, page_pos, page_number, page) of runs, in the order of their numbers. Raises ValueError if a run breaks its
    contract, has no number, or two runs of a book have one number or page."""
    bad = runs.where("size(violations) > 0 or page_number is null").select("path", "violations").limit(5).collect()
    if bad:
        raise ValueError(f"runs that can't be loaded: {[(r['path'], r['violations'] or 'no page number') for r in bad]}")
    rows = runs.select("book_id", "page_number", "page")
    require_unique(rows, ["book_id", "page_number"], "page_number")
    require_unique(rows.select("book_id", "page.page_id"), ["book_id", "page_id"], "page_id")
    return rows.select("book_id", F.row_number().over(Window.partitionBy("book_id").orderBy("page_number")).alias("page_pos"), "page_number", "page")


def without_excluded(pages: DataFrame, excluded: DataFrame) -> DataFrame:
    """pages without those of excluded (book_id, page_number); ValueError for exclusions that aren't there and for books left empty."""
    key = ["book_id", "page_number"]
    unknown = excluded.join(pages, key, "left_anti").limit(5).collect()
    if unknown:
        raise ValueError(f"excluded pages that aren't there: {[tuple(r) for r in unknown]}")
    left = pages.join(excluded, key, "left_anti")
    gone = pages.select("book_id").distinct().join(left.select("book_id").distinct(), "book_id", "left_anti").limit(5).collect()
    if gone:
        raise ValueError(f"books without a page left: {[r['book_id'] for r in gone]}")
    return left


def selected_pages(pages: DataFrame, start: int = 1, end: int | None = None) -> DataFrame:
    """Pages of the range, both ends included. ValueError if it begins before 1 or after its end, or ends behind a book's last page."""
    if start < 1 or (end is not None and end < start):
        raise ValueError(f"no range: {start}-{end}")
    last = pages.groupBy("book_id").agg(F.max("page_number").alias("last"))
    short = last.where((F.col("last") < start) | (F.col("last") < (end or start))).limit(5).collect()
    if short:
        raise ValueError(f"range behind the last page: {[(r['book_id'], r['last']) for r in short]}")
    return pages.where(F.col("page_number") >= start) if end is None else pages.where(F.col("page_number").between(start, end))


def page_numbers(text: Column) -> Column:
    """Sorted distinct numbers of ranges such as 3,7-9; null for text that isn't that, and for ranges that run backwards."""
    parts = F.split(F.regexp_replace(text, r"\s+", ""), ",")
    fine = text.rlike(r"^\s*[1-9][0-9]{0,8}(\s*-\s*[1-9][0-9]{0,8})?(\s*,\s*[1-9][0-9]{0,8}(\s*-\s*[1-9][0-9]{0,8})?)*\s*\z")
    low = lambda p: F.substring_index(p, "-", 1).cast("int")
    high = lambda p: F.substring_index(p, "-", -1).cast("int")
    forward = F.forall(parts, lambda p: low(p) <= high(p))
    return F.when(fine, F.when(forward, F.array_sort(F.array_distinct(F.flatten(F.transform(parts, lambda p: F.sequence(low(p), high(p))))))))


_CASE = _of("object", keys={"case_id": _of("text", filled=True), "model": _of("text", filled=True), "prompt_version": _of("text", filled=True), "schema_version": _of("text", filled=True), "source_page_number": _of("whole", low=1), "tags": _of("list", items=_of("text", filled=True)), "usage": _of("object", keys={t: _of("whole", "null", low=0) if t == "cached_content_token_count" else _of("whole", low=0) for t in ("prompt_token_count", "candidates_token_count", "thoughts_token_count", "total_token_count", "cached_content_token_count")})})
CASE_TYPE = "struct<case_id:string,model:string,prompt_version:string,schema_version:string,source_page_number:int,tags:array<string>,usage:struct<prompt_token_count:long,candidates_token_count:long,thoughts_token_count:long,total_token_count:long,cached_content_token_count:long>>"


def _judged_json(rows: DataFrame, column: str, contract: Field, kind: str, name: str) -> DataFrame:
    """rows with name, column typed as kind, null where it breaks the contract, and name_violations."""

    @F.pandas_udf("array<string>")
    def judge(texts: pd.Series) -> pd.Series:
        def one(t: str | None) -> list[str]:
            try:
                return list(problems(json.loads(t or ""), contract, name))
            except ValueError:
                return [f"{name}: not JSON"]

        return texts.map(one)

    judged = rows.withColumn(f"{name}_violations", judge(F.col(column)))
    return judged.withColumn(name, F.when(F.size(f"{name}_violations") == 0, F.from_json(column, kind)))


def golden_cases(spark: SparkSession, root: str) -> DataFrame:
    """(case_id, case, case_violations, page, violations) of <root>/<case>/case.json and page.json, a stored page. A folder that isn't
    named as its case is a violation."""
    cases = whole_files(spark, root, "*/case.json").select(_below(F.col("path"), 1).alias("case_id"), F.col("text").alias("raw"))
    pages = whole_files(spark, root, "*/page.json").select(_below(F.col("path"), 1).alias("case_id"), F.col("text").alias("stored"))
    judged = _judged_json(cases.join(pages, "case_id", "left"), "raw", _CASE, CASE_TYPE, "case")
    named = F.when(F.col("case.case_id") != F.col("case_id"), F.concat("case_violations", F.array(F.lit("case: another folder")))).otherwise(F.col("case_violations"))
    return reloaded(judged.withColumn("case_violations", named).drop("raw")).drop("stored")


def _metadata_of(text: str | None) -> tuple[dict, list[str]]:
    """The fields of a metadata file, and what is wrong with it."""
    try:
        raw = json.loads(text or "")
    except ValueError:
        return {}, ["not JSON"]
    if not isinstance(raw, dict):
        return {}, ["no object"]
    if raw.get("authors") is None and raw.get("author") is not None:
        raw["authors"] = [raw["author"]]
    out, bad = {}, []
    for k in METADATA_FIELDS:
        v = raw.get(k)
        if k in _TEXTS:
            v = [] if v is None else v
            if not isinstance(v, list) or any(not isinstance(x, str) or not x.strip() for x in v):
                bad.append(f"{k}: a list of texts that aren't empty")
                continue
            out[k] = [x.strip() for x in v]
        elif v is not None:
            if k == "series_index" and isinstance(v, int | float) and not isinstance(v, bool):
                v = str(v)
            if not isinstance(v, str) or not v.strip():
                bad.append(f"{k}: a text that isn't empty")
                continue
            out[k] = v.strip()
    return out, bad


def with_metadata(rows: DataFrame, column: str) -> DataFrame:
    """rows with metadata (METADATA_TYPE), of a column of JSON texts, and violations; as book_metadata."""
    kind = f"struct<metadata: struct<{METADATA_TYPE}>, violations: array<string>>"

    @F.pandas_udf(kind)
    def judge(texts: pd.Series) -> pd.DataFrame:
        got = [_metadata_of(t) for t in texts]
        fields = [{k: m.get(k, [] if k in _TEXTS else None) for k in METADATA_FIELDS} for m, _ in got]
        return pd.DataFrame({"metadata": fields, "violations": [b for _, b in got]})

    return rows.withColumn("_m", judge(F.col(column))).select(*rows.columns, "_m.metadata", "_m.violations")


def book_metadata(files: DataFrame) -> DataFrame:
    """(book_id, METADATA_FIELDS, violations) of (book_id, text), JSON files. author stands for one author, a number for
    series_index for its text; unknown keys are left out. Fields that break a rule are null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [_metadata_of(t) for t in batch.column(1).to_pylist()]
            columns = [pa.array([m.get(k, [] if k in _TEXTS else None) for m, _ in got], pa.list_(pa.string()) if k in _TEXTS else pa.string()) for k in METADATA_FIELDS]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array([b for _, b in got], pa.list_(pa.string()))], ["book_id", *METADATA_FIELDS, "violations"])

    return files.select(F.col("book_id").cast("string").alias("book_id"), "text").mapInArrow(run, f"book_id string, {METADATA_TYPE}, violations array<string>")


def merged_metadata(base: DataFrame, given: DataFrame) -> DataFrame:
    """base metadata with what is given (book_id, title, language, author) over it; a given author replaces all. Raises ValueError
    for given texts that are blank, and for books that have no title after all."""
    blank = given.where(" or ".join(f"trim({c}) = ''" for c in ("title", "language", "author"))).limit(5).collect()
    if blank:
        raise ValueError(f"blank overrides: {[r['book_id'] for r in blank]}")
    g = given.select("book_id", F.trim("title").alias("_t"), F.trim("language").alias("_l"), F.trim("author").alias("_a"))
    rows = base.join(g, "book_id", "full_outer").withColumn("title", F.coalesce("_t", "title")).withColumn("language", F.coalesce("_l", "language")).withColumn("authors", F.when(F.col("_a").isNotNull(), F.array("_a")).otherwise(F.coalesce("authors", F.array().cast("array<string>")))).drop("_t", "_l", "_a")
    none = rows.where("title is null").limit(5).collect()
    if none:
        raise ValueError(f"books without a title: {[r['book_id'] for r in none]}")
    return rows


def recognised_words(rows: DataFrame, least: float = 0.0) -> DataFrame:
    """(book_id, page_id, word_no, word, confidence, left, top, width, height) of (book_id, page_id, tsv): the words, level 5, of
    tab-separated recognition output with a header, of at least that confidence. Numbers that aren't raise an error."""
    lines = rows.select("book_id", "page_id", F.posexplode(F.split("tsv", r"\r?\n")).alias("word_no", "line"), F.split(F.substring_index(F.regexp_replace("tsv", "\r", ""), "\n", 1), "\t").alias("names"))
    cells = F.split("line", "\t", -1)
    cell = lambda c: F.get(F.col("cells"), (F.array_position("names", c) - 1).cast("int"))
    at = lines.where("word_no > 0").withColumn("cells", cells)
    words = at.where(cell("level") == "5").withColumn("word", F.regexp_replace(F.coalesce(cell("text"), F.lit("")), r"(?U)^\s+|\s+\z", "")).where("word <> ''")
    number = lambda c, kind: F.coalesce(F.trim(cell(c)), F.lit("0")).cast(kind)
    out = words.select("book_id", "page_id", "word_no", "word", F.coalesce(F.trim(cell("conf")), F.lit("-1")).cast("double").alias("confidence"), *(number(c, "int").alias(c) for c in ("left", "top", "width", "height")))
    return out.where(F.col("confidence") >= least)


def pdf_pages(spark: SparkSession, path: str) -> DataFrame:
    """A row for each page of PDF files: (uri, page_number, page_id, document_sha256, page_sha256, width, height, text_length, images,
    filters, image_only, image, image_filter). Needs pypdf on every executor; a file is read by one task.

    image is the encoded stream of the page's only image, null if there is none or more; page_sha256 is over the size,
    the content stream and all encoded images, those in nested forms included.
    """
    schema = "uri string, page_number int, page_id string, document_sha256 string, page_sha256 string, width double, height double, text_length int, images int, filters array<string>, image_only boolean, image binary, image_filter string"

    def streams(resources: object, seen: set[int]) -> Iterator[tuple[str, bytes]]:
        """Images of a resource tree, each object once."""
        objects = (resources or {}).get("/XObject") or {}
        for name in sorted(objects):
            x = objects[name].get_object()
            if id(x) in seen:
                continue
            seen.add(id(x))
            if x.get("/Subtype") == "/Image":
                f = x.get("/Filter")
                yield str(f[-1] if isinstance(f, list) else f or ""), x._data
            elif x.get("/Subtype") == "/Form":
                yield from streams(x.get("/Resources"), seen)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io

        import pypdf

        for f in frames:
            for uri, content in zip(f["path"], f["content"], strict=True):
                digest, out = hashlib.sha256(content).hexdigest(), []
                for n, page in enumerate(pypdf.PdfReader(io.BytesIO(content)).pages, 1):
                    w, h = float(page.mediabox.width), float(page.mediabox.height)
                    found = list(streams(page.get("/Resources"), set()))
                    body = page.get_contents()
                    stamp = hashlib.sha256(f"{w:.6f}x{h:.6f}".encode() + (body.get_data() if body is not None else b"") + b"".join(d for _, d in found)).hexdigest()
                    text = len((page.extract_text() or "").strip())
                    out.append((uri, n, f"pdf:{digest[:12]}:page:{n:04d}", digest, stamp, w, h, text, len(found), [k for k, _ in found], text == 0 and bool(found), found[0][1] if len(found) == 1 else None, found[0][0] if len(found) == 1 else None))
                yield pd.DataFrame(out, columns=[c.split(" ")[0] for c in schema.split(", ")])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, schema)


def composition(pages: DataFrame, by: list[str]) -> DataFrame:
    """Pages with text, with images only, with both, and blank, from text_length and images."""
    text, image = F.col("text_length") > 0, F.col("images") > 0
    return pages.groupBy(*by).agg(F.count("*").alias("pages"), F.count_if(text & ~image).alias("text"), F.count_if(~text & image).alias("image_only"), F.count_if(text & image).alias("mixed"), F.count_if(~text & ~image).alias("blank"))


def materialized(pages: DataFrame) -> DataFrame:
    """pdf_pages() with media_type and error: a page can be handed on as its original image if it has no text of its own and
    exactly one image, in JPEG or JPEG 2000."""
    kind = F.when(F.col("image_filter") == "/DCTDecode", "image/jpeg").when(F.col("image_filter") == "/JPXDecode", "image/jp2")
    error = F.when(F.col("text_length") > 0, "has text of its own").when(F.col("images") != 1, "not exactly one image").when(kind.isNull(), "no supported image")
    return pages.withColumn("error", error).withColumn("media_type", F.when(error.isNull(), kind)).withColumn("image", F.when(error.isNull(), F.col("image")))
