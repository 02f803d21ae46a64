"""Command line over the library: each action reads tables or files of many books and writes tables or files.

Roots follow sources.files: <runs>/<book>/<run>/. Actions hand their results on as Parquet folders, so each can be run again
alone. Exit status is 0, 1 if what was asked about isn't as it should be, and 2 for input that can't be used.
"""

from __future__ import annotations

import argparse
import importlib
import json
import sys
from functools import reduce
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.operators import analyzer, backup, buildmanifest, extraction, figures, findings, frontmatter, golden, packaging, ready, rendering, report, review, reviewcache, runtime
from folio.sources import files, outputs, pageruns

TABLES = ("nodes", "relationships", "resolved", "furniture", "unresolved", "candidates")


def _write(df: DataFrame, folder: str, name: str) -> DataFrame:
    df.write.mode("overwrite").parquet(f"{folder}/{name}")
    return df.sparkSession.read.parquet(f"{folder}/{name}")


def _maybe(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _pages(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Pages of all runs, without those excluded, with the corrections of an imported review."""
    pages = files.loaded_pages(files.page_runs(spark, a.runs))
    if getattr(a, "exclude_pages", None):
        excluded = pages.select("book_id").distinct().withColumn("page_number", F.explode(files.page_numbers(F.lit(a.exclude_pages))))
        if excluded.isEmpty():
            raise ValueError(f"no page numbers: {a.exclude_pages}")
        pages = files.without_excluded(pages, excluded)
    edits = _maybe(spark, f"{a.review}/corrections") if getattr(a, "review", None) else None
    return pages if edits is None else findings.corrected_pages(pages, edits)


def _plugin(name: str):
    module, _, function = name.partition(":")
    try:
        return getattr(importlib.import_module(module), function)
    except (ImportError, AttributeError) as e:
        raise ValueError(f"no plug-in {name}: {e}") from e


def page_images(spark: SparkSession, folder: str) -> DataFrame:
    """(book_id, page_number, page_id, uri, image) of <folder>/<book>/<number>.<extension>."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*[0-9].*").load(f"{folder}/*/*")
    part = F.split("path", "/")
    book, number = F.element_at(part, -2), F.regexp_extract(F.element_at(part, -1), r"(\d+)\.[^.]*\z", 1).try_cast("int")
    return rows.select(book.alias("book_id"), number.alias("page_number"), F.concat(book, F.lit(":page:"), F.format_string("%04d", number)).alias("page_id"), F.col("path").alias("uri"), F.col("content").alias("image")).where("page_number > 0")


def _routes(texts: list[str]) -> tuple[list[dict], dict]:
    routes, plugins = [], {}
    for text in texts:
        name, _, rest = text.partition("=")
        tier, _, plugin = rest.partition("=")
        routes.append({"name": name, "tier": tier, "max_attempts": 2 if tier == "paid" else 3})
        plugins[name] = _plugin(plugin)
    return routes, plugins


def _media_type(uri: str):
    return F.when(F.lower(uri).rlike(r"\.jpe?g\z"), "image/jpeg").when(F.lower(uri).endswith(".png"), "image/png")


def extract_metadata(spark: SparkSession, a: argparse.Namespace) -> int:
    """Suggests metadata of books from their first pages, <out>/<book>.json, with covers and reports; 1 if a book has none in the end."""
    routes, plugins = _routes(a.route)
    images = page_images(spark, a.images).withColumn("media_type", _media_type("uri"))
    tasks = frontmatter.front_tasks(images, a.start_page, a.end_page)
    done = frontmatter.suggested(tasks, routes, plugins, lambda df, name: _write(df, a.work, name), a.policy, a.backoff, max(a.backoff, 8.0))
    found = _write(frontmatter.covers(done, _plugin(a.convert) if a.convert else None), a.work, "suggested")
    outputs.write_files(frontmatter.metadata_files(found), str(Path(a.out).resolve()) if "://" not in a.out else a.out).count()
    status = done.select("book_id", "outcome").join(found.select("book_id", "suggestion.metadata.title", "cover_status", "warnings"), "book_id", "left").orderBy("book_id")
    bad = False
    # A line for each book.
    for r in status.toLocalIterator():
        bad |= r["outcome"] != extraction.SUCCEEDED
        print(json.dumps(r.asDict(), ensure_ascii=False))
    return int(bad)


def extract_book(spark: SparkSession, a: argparse.Namespace) -> int:
    """Extracts the page images of books by plug-ins, and publishes their runs; 1 if a page has none in the end."""
    routes, plugins = _routes(a.route)
    tasks = page_images(spark, a.images)
    if a.page:
        wanted = files.page_numbers(F.lit(a.page))
        tasks = tasks.where(F.array_contains(wanted, F.col("page_number")))
    tasks = tasks.withColumn("sha256", F.sha2("image", 256))
    named = {"prompt": ("page-evidence", a.prompt_version), "schema": ("page-evidence", "5")}
    manifest = F.try_parse_json("manifest")
    at = lambda path: F.try_variant_get(manifest, path, "string")
    same = reduce(lambda x, y: x & y, (at(f"$.{k}.{f}") == F.lit(v) for k, pair in named.items() for f, v in zip(("name", "version"), pair, strict=True)))
    there = pageruns.scan(spark, a.runs, ["book_id", "page_number", "manifest"]).where(same).select("book_id", "page_number", at("$.source.sha256").alias("sha256"))
    todo = tasks if a.force else tasks.join(there, ["book_id", "page_number", "sha256"], "left_anti")
    done = extraction.extracted(todo, routes, plugins, lambda df, name: _write(df, a.out, name), a.policy, a.backoff, max(a.backoff, 8.0))
    earlier = pageruns.scan(spark, a.runs, ["book_id", "page_number", "stored"]).select("book_id", "page_number", F.try_variant_get(F.try_parse_json("stored"), "$.dominant_language", "string").alias("language"))
    done = extraction.with_recovery(done, _plugin(a.ocr), earlier) if a.ocr else done.withColumn("recovery_language", F.lit(None).cast("string"))
    done = _write(done, a.out, "extracted")
    text = lambda v: F.lit(v).cast("string")
    kind = _media_type("uri")
    source = F.struct(F.col("page_id").alias("source_id"), "uri", "sha256", kind.alias("media_type"), text(None).alias("document_sha256"))
    info = F.struct(F.element_at(F.split("uri", "/"), -1).alias("file"), kind.alias("media_type"), "sha256", F.length("image").alias("byte_size"), F.lit(True).alias("preserved"))
    pair = lambda k: F.struct(text(named[k][0]).alias("name"), text(named[k][1]).alias("version"))
    records = pageruns.run_records(done.where(F.col("outcome") == extraction.SUCCEEDED).select("book_id", "page_number", "page", source.alias("source"), info.alias("asset_info"), pair("prompt").alias("prompt"), pair("schema").alias("schema"), "attempts", "recovery_language", "raw", F.col("image").alias("asset")))
    pageruns.write_runs(records, a.runs)
    status = tasks.select("book_id", "page_number").join(done.select("book_id", "page_number", "outcome"), ["book_id", "page_number"], "left")
    counts = status.groupBy("book_id").agg(F.count("*").alias("selected"), F.count_if(F.col("outcome").isNull()).alias("reused"), *(F.count_if(F.col("outcome") == o).alias(o) for o in (extraction.SUCCEEDED, extraction.FAILED, extraction.NOT_REACHED))).orderBy("book_id").collect()
    for r in counts:
        print(json.dumps(r.asDict(), ensure_ascii=False))
    return int(not counts or any(r.failed or r.not_reached for r in counts))


def assemble_book(spark: SparkSession, a: argparse.Namespace) -> int:
    if getattr(a, "require_reviewed", False):
        findings.require_complete(spark.read.parquet(f"{a.review}/status"))
    made = analyzer.analyze(_write(_pages(spark, a), a.out, "pages"))
    for name in TABLES:
        _write(getattr(made, name), a.out, name)
    return 0


def crop_figures(spark: SparkSession, a: argparse.Namespace) -> int:
    """Cuts the figures of assembled books out of their page images by plug-ins; <out>/assets is what render-xhtml takes as --assets."""
    made = figures.cropped(spark.read.parquet(f"{a.book}/nodes"), page_images(spark, a.images), _plugin(a.size), _plugin(a.crop))
    made = _write(made, a.out, "figures")
    _write(figures.assets(made), a.out, "assets")
    print(json.dumps({"figures": made.count()}))
    return 0


def _books(spark: SparkSession, a: argparse.Namespace, ids: DataFrame) -> DataFrame:
    """Metadata of the books, from <metadata>/<book>.json, with what the command gives over it."""
    found = files.whole_files(spark, a.metadata, "*.json") if a.metadata else spark.createDataFrame([], "path string, text string")
    base = files.book_metadata(found.select(files.book_of(F.col("path")).alias("book_id"), "text"))
    bad = base.where("size(violations) > 0").limit(5).collect()
    if bad:
        raise ValueError(f"metadata: {[(r['book_id'], r['violations']) for r in bad]}")
    given = ids.select("book_id", F.lit(a.title).cast("string").alias("title"), F.lit(a.language).cast("string").alias("language"), F.lit(a.author).cast("string").alias("author"))
    return files.merged_metadata(base.drop("violations").join(ids, "book_id", "right"), given).select("book_id", *packaging.METADATA_FIELDS)


ASSETS = "book_id string, file string, data binary"


def _cover_images(spark: SparkSession, a: argparse.Namespace, books: DataFrame) -> DataFrame | None:
    """(book_id, path, data) of the covers that metadata name, relative to the folder of the metadata. Raises ValueError for one that isn't there."""
    named = books.where("cover is not null").select("book_id", packaging.plain_path(F.col("cover")).alias("path"))
    if not a.metadata or named.isEmpty():
        return None
    images = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{" + ",".join(x for e in frontmatter.COVER_ENDINGS for x in (e, e.upper())) + "}").load(a.metadata)
    root = _qualified(spark, a.metadata)
    found = images.select(F.substring("path", len(root) + 2, 1 << 20).alias("path"), F.col("content").alias("data"))
    both = named.join(found, "path", "left").select("book_id", "path", "data")
    lost = both.where("data is null").limit(5).collect()
    if lost:
        raise ValueError(f"covers that are not there or of no known kind: {[(r['book_id'], r['path']) for r in lost]}")
    return both


def _qualified(spark: SparkSession, folder: str) -> str:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def render_xhtml(spark: SparkSession, a: argparse.Namespace) -> int:
    nodes = _write(rendering.projected(spark.read.parquet(f"{a.book}/nodes"), spark.read.parquet(f"{a.book}/relationships")), a.out, "semantic")
    books = _write(_books(spark, a, nodes.select("book_id").distinct()), a.out, "books")
    documents, assets = rendering.rendered(nodes, books), _maybe(spark, a.assets) if a.assets else None
    covers = _cover_images(spark, a, books)
    if covers is not None:
        front, image = frontmatter.cover_documents(books, covers)
        documents, assets = documents.unionByName(front), image if assets is None else assets.unionByName(image)
    documents = _write(documents, a.out, "documents")
    assets = _write(spark.createDataFrame([], ASSETS) if assets is None else assets.select("book_id", "file", "data"), a.out, "assets")
    _write(ready.manifests(books, documents, assets), a.out, "manifests")
    _write(packaging.toc_entries(rendering.chunked(nodes)), a.out, "entries")
    for r in rendering.projection_warnings(spark.read.parquet(f"{a.book}/relationships")).limit(100).collect():
        print(f"{r['book_id']}: {r['warning']}")
    return 0


def package_epub(spark: SparkSession, a: argparse.Namespace) -> int:
    read = lambda n: spark.read.parquet(f"{a.ready}/{n}")
    assets = _maybe(spark, f"{a.ready}/assets")
    assets = spark.createDataFrame([], ASSETS) if assets is None else assets
    manifests = _maybe(spark, f"{a.ready}/manifests")
    if manifests is not None:
        there = read("documents").select("book_id", F.concat(F.lit("text/"), "file").alias("file")).unionByName(assets.select("book_id", "file")).unionByName(read("books").select("book_id", F.lit(ready.STYLESHEET).alias("file")))
        bad = ready.manifest_problems(manifests, there).orderBy("book_id", "file", "problem").limit(5).collect()
        if bad:
            raise ValueError(f"manifest: {[(r['book_id'], r['file'], r['problem']) for r in bad]}")
    made = _write(packaging.packaged(read("books"), read("documents"), read("entries"), assets, a.modified), a.out, "epubs")
    out = Path(a.out).resolve()
    # One book at a time reaches the driver.
    for r in made.toLocalIterator():
        path = (out / f"{r['book_id']}.epub").resolve()
        if path.parent != out:
            raise ValueError(f"no file name: {r['book_id']}")
        path.write_bytes(bytes(r["epub"]))
    return 0


def build_epub(spark: SparkSession, a: argparse.Namespace) -> int:
    """assemble-book, render-xhtml and package-epub in folders below one."""
    out = a.out
    for step, where, source in ((assemble_book, "book", {}), (render_xhtml, "ready", {"book": f"{out}/book"}), (package_epub, "epub", {"ready": f"{out}/ready"})):
        step(spark, argparse.Namespace(**(vars(a) | source | {"out": f"{out}/{where}"})))
    return _report(spark, f"{out}/epub") if a.validate else 0


def convert_book(spark: SparkSession, a: argparse.Namespace) -> int:
    """extract-book and build-epub in one: page images to packages; 1, without packages, if a page has no run in the end."""
    state = extract_book(spark, argparse.Namespace(**(vars(a) | {"out": f"{a.out}/extraction"})))
    return state or build_epub(spark, a)


def _report(spark: SparkSession, folder: str) -> int:
    epubs = spark.read.format("binaryFile").option("pathGlobFilter", "*.epub").load(folder).select(F.col("path").alias("book_id"), F.col("content").alias("epub"))
    bad = 0
    for r in packaging.validated(epubs).orderBy("book_id").collect():
        bad += bool(r["problems"])
        print(f"{r['book_id']}: {'; '.join(r['problems']) or 'ok'}")
    return int(bad > 0)


def validate_epub(spark: SparkSession, a: argparse.Namespace) -> int:
    return _report(spark, a.epubs)


def prepare_proof(spark: SparkSession, a: argparse.Namespace) -> int:
    """Freezes the documents of a ready folder; with a baseline there, says what has changed, and freezes anew only with --force."""
    now = packaging.snapshot(spark.read.parquet(f"{a.ready}/documents").select("book_id", "file", F.col("content").cast("binary").alias("data")))
    before = _maybe(spark, f"{a.proof}/baseline")
    changes = [] if before is None else packaging.proof_changes(before, now).orderBy("book_id", "file").limit(1000).collect()
    for r in changes:
        print(f"{r['book_id']}: {r['change']} {r['file']}")
    if before is None or a.force:
        now.write.mode("overwrite").parquet(f"{a.proof}/baseline")
    return int(bool(changes) and not a.force)


def backup_book(spark: SparkSession, a: argparse.Namespace) -> int:
    """Brings a backup of the books of a ready folder into agreement: proofs, metadata, decisions and build; other files there stay."""
    out = a.out if "://" in a.out else str(Path(a.out).absolute())
    sources = [x for x in (a.ready, a.proof, a.review, a.metadata) if x]
    if "://" not in out:
        if Path(out).is_symlink() or (Path(out).exists() and not Path(out).is_dir()):
            raise ValueError(f"no folder of its own: {out}")
        here = Path(out).resolve()
        for x in sources:
            if "://" not in x and (here.is_relative_to(Path(x).resolve()) or Path(x).resolve().is_relative_to(here)):
                raise ValueError(f"the backup {out} and {x} overlap")
    baseline = _maybe(spark, f"{a.proof}/baseline")
    if baseline is None:
        raise ValueError(f"no proof: {a.proof}")
    documents = spark.read.parquet(f"{a.ready}/documents")
    held = documents.select("book_id", "file", F.col("content").cast("binary").alias("data"))
    metadata = files.whole_files(spark, a.metadata, "*.json").select(files.book_of(F.col("path")).alias("book_id"), "text") if a.metadata else None
    build = buildmanifest.manifest(held.select("book_id", F.lit("documents").alias("stage"), "file", F.sha2("data", 256).alias("sha256"), F.octet_length("data").cast("long").alias("size")))
    made = backup.artifacts(documents, packaging.proof_changes(baseline, packaging.snapshot(held)), metadata, _maybe(spark, f"{a.review}/resolutions") if a.review else None, build)
    made = _write(made.withColumn("sha256", F.sha2("data", 256)), a.work, "artifacts")
    there = spark.createDataFrame([], "path string, sha256 string")
    if "://" in out or Path(out).is_dir():
        root = _qualified(spark, out)
        rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(out)
        there = rows.select(F.substring("path", len(root) + 2, 1 << 20).alias("path"), F.sha2("content", 256).alias("sha256"))
    plan = _write(backup.actions(made.select("path", "sha256"), there), a.work, "actions")
    todo = made.join(plan.where("action in ('add', 'replace')"), "path", "left_semi").select("path", "data")
    # What a manifest says is there before it.
    last = F.substring_index("path", "/", -1) == backup.MANIFEST
    outputs.write_files(todo.where(~last), out).count()
    outputs.remove_files(plan.where("action = 'remove'"), out).count()
    outputs.write_files(todo.where(last), out).count()
    print(json.dumps({r["action"]: r["count"] for r in plan.groupBy("action").count().orderBy("action").collect()}))
    return 0


def review_text(spark: SparkSession, a: argparse.Namespace) -> int:
    """Findings of all pages with a reading, <run>/review/ocr.tsv, and of the heuristics; what is suppressed, and why."""
    pages = _pages(spark, a)
    runs = files.page_runs(spark, a.runs).select("book_id", "run", F.col("page.page_id").alias("page_id"))
    tsv = files.whole_files(spark, a.runs, "*/*/review/ocr.tsv").select(F.element_at(F.split("path", "/"), -4).alias("book_id"), F.element_at(F.split("path", "/"), -3).alias("run"), F.col("text").alias("tsv"))
    words = _write(review.word_offsets(files.recognised_words(tsv.join(runs, ["book_id", "run"]), a.min_confidence), ["book_id", "page_id"], "word_no"), a.out, "words")
    piece = F.struct("start", F.concat(F.when(F.col("start") > F.coalesce(F.lag("end").over(_by_page()), F.lit(0)), " ").otherwise(""), "word").alias("t"))
    readings = words.select("book_id", "page_id", piece.alias("p")).groupBy("book_id", "page_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list("p")), lambda p: p["t"]), "").alias("reading"))
    projected = _write(findings.projections(pages), a.out, "projections")
    differences = _differences(spark, a, projected, readings)
    heuristic = _write(findings.boundary_findings(projected), a.out, "heuristic")
    # Ids of findings are a page's; with the book they are one of all.
    keyed = lambda df: df.withColumn("page_id", F.to_json(F.struct("book_id", "page_id")))
    ocr = _write(differences, a.out, "differences")
    # Words have the offsets of the reading, so it is the reading's range that they support.
    of_reading = keyed(ocr).select("book_id", "page_id", "finding_id", F.col("reference_start").alias("start"), F.col("reference_end").alias("end"))
    sure = review.supported(of_reading, keyed(words)).select("book_id", "finding_id", "confidence")
    over = review.covered(keyed(ocr), keyed(heuristic)).select("book_id", "finding_id", F.lit(True).alias("covered"))
    judged = findings.diacritic_loss(ocr.join(sure, ["book_id", "finding_id"], "left").join(over, ["book_id", "finding_id"], "left"))
    longer = F.when(F.length(F.trim("text")) >= F.length(F.trim("reference_text")), F.col("text")).otherwise(F.col("reference_text"))
    reason = review.suppression(F.coalesce("covered", F.lit(False)), F.col("diacritics_only"), F.col("confidence"), review.needed_confidence(F.col("kind"), F.col("block_role"), longer))
    judged = _write(judged.withColumn("reason", reason), a.out, "judged")
    kept = judged.where("reason is null").select(*findings.FINDING).unionByName(heuristic.select(*findings.FINDING))
    _write(kept, a.out, "findings")
    shown = kept.join(judged.select("book_id", "finding_id", "confidence"), ["book_id", "finding_id"], "left")
    _write(report.page_reports(projected, readings, shown, judged.where("reason is not null")), a.out, "reports")
    for r in findings.review_summary(kept, judged.where("reason is not null")).orderBy("book_id").collect():
        print(json.dumps(r.asDict(), ensure_ascii=False))
    return 0


def _differences(spark: SparkSession, a: argparse.Namespace, projected: DataFrame, readings: DataFrame) -> DataFrame:
    """Differences of all pages with a reading: from the cache where neither text nor anchors nor reading have changed, else computed
    and put there."""
    cache = a.cache or f"{a.out}/cache"
    both = projected.join(readings, ["book_id", "page_id"])
    inputs = [F.col("book_id"), F.col("page_id"), F.col("page_number"), F.col("text"), F.to_json("anchors", {"ignoreNullFields": "false"}), F.col("reading")]
    printed = reviewcache.with_fingerprint(both, *inputs)
    kind = findings.difference_findings(projected.limit(0), readings.limit(0)).schema
    names, row = kind.names, f"array<{kind.simpleString()}>"
    pages = _write(reviewcache.found(printed, reviewcache.entries(spark, cache), row), a.out, "inputs")
    todo = pages.where("result is null")
    made = findings.difference_findings(todo.select(*projected.columns), todo.select("book_id", "page_id", "reading"))
    grouped = made.groupBy("book_id", "page_id").agg(F.collect_list(F.struct(*names)).alias("made"))
    results = _write(todo.select("book_id", "page_id", "fingerprint").join(grouped, ["book_id", "page_id"], "left").select("fingerprint", F.coalesce("made", F.array().cast(row)).alias("result")), a.out, "computed")
    reviewcache.store(results, cache)
    print(json.dumps({"pages": pages.count(), "computed": results.count()}))
    every = pages.where("result is not null").select("result").unionByName(results.select("result"))
    return every.select(F.explode("result").alias("f")).select("f.*")


def _by_page():
    from pyspark.sql import Window

    return Window.partitionBy("book_id", "page_id").orderBy("start")


def import_review(spark: SparkSession, a: argparse.Namespace) -> int:
    """Takes decisions, a JSON file of (book_id, finding_id, decision, replacement_text), in place of all earlier ones."""
    decisions = spark.read.schema("book_id string, finding_id string, decision string, replacement_text string").json(a.decisions, multiLine=True)
    resolutions, edits = findings.imported_decisions(decisions, spark.read.parquet(f"{a.review}/findings"), spark.read.parquet(f"{a.review}/projections"))
    _write(resolutions, a.review, "resolutions")
    _write(edits, a.review, "corrections")
    return 0


def review_status(spark: SparkSession, a: argparse.Namespace) -> int:
    """States of all pages and their counts; 1 if a page is open."""
    pages = files.loaded_pages(files.page_runs(spark, a.runs)).select("book_id", F.col("page.page_id").alias("page_id"), "page")
    seen = spark.read.parquet(f"{a.review}/projections").select("book_id", "page_id", F.lit(True).alias("_seen"))
    now = findings.projections(pages.withColumn("page_number", F.lit(0))).select("book_id", "page_id", "text")
    snapshots = spark.read.parquet(f"{a.review}/findings").select("book_id", "page_id", "finding_id", "start", "end", F.col("text").alias("_then"))
    found = findings.with_stale(snapshots, now).groupBy("book_id", "page_id").agg(F.collect_set("finding_id").alias("f"), F.bool_or("stale").alias("_stale"))
    done = _maybe(spark, f"{a.review}/resolutions")
    none = spark.createDataFrame([], "book_id string, page_id string, finding_id string")
    solved = (none if done is None else done).groupBy("book_id", "page_id").agg(F.collect_set("finding_id").alias("r"))
    rows = now.join(seen, ["book_id", "page_id"], "left").join(found, ["book_id", "page_id"], "left").join(solved, ["book_id", "page_id"], "left")
    f, r = (F.coalesce(c, F.array().cast("array<string>")) for c in ("f", "r"))
    state = review.review_state(F.coalesce("_seen", F.lit(False)), ~F.coalesce("_stale", F.lit(False)), F.size(f), F.size(F.array_except(r, f)), F.size(F.array_except(f, r)))
    states = _write(rows.select("book_id", "page_id", state.alias("state")), a.review, "status")
    counts = findings.state_counts(states, ["book_id"]).orderBy("book_id").collect()
    for row in counts:
        print(json.dumps(row.asDict()) if a.format == "json" else f"{row['book_id']}: " + ", ".join(f"{k} {v}" for k, v in row.asDict().items() if k != "book_id"))
    return int(not all(row["complete"] for row in counts))


def evaluate_golden(spark: SparkSession, a: argparse.Namespace) -> int:
    cases = files.golden_cases(spark, a.root).persist()
    results = golden.evaluated(cases.select("case_id", "page"))
    if a.format == "json":
        ok = True
        for r in results.orderBy("case_id", "check").collect():
            ok &= r["passed"]
            print(json.dumps(r.asDict(), ensure_ascii=False))
    else:
        text, ok = golden.report(results)
        print(text)
    print(json.dumps(golden.token_totals(cases.select("case.usage")).first().asDict()))
    return int(not ok or not cases.where("size(case_violations) > 0").isEmpty())


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="folio")
    actions = top.add_subparsers(dest="action", required=True)

    def action(name: str, run, *places: str) -> argparse.ArgumentParser:
        p = actions.add_parser(name, help=(run.__doc__ or "").strip().split("\n")[0])
        p.set_defaults(run=run)
        for place in places:
            p.add_argument(place)
        return p

    extract, metadata = action("extract-book", extract_book, "images", "runs", "out"), action("extract-metadata", extract_metadata, "images", "out", "work")
    convert = action("convert-book", convert_book, "images", "runs", "out")
    for p in (extract, metadata, convert):
        p.add_argument("--route", action="append", required=True, metavar="NAME=TIER=MODULE:FUNCTION", help="in the order in which they are tried")
        p.add_argument("--policy", choices=runtime.POLICIES, default="free-only")
        p.add_argument("--backoff", type=float, default=1.0)
    metadata.add_argument("--start-page", type=int, default=frontmatter.FIRST)
    metadata.add_argument("--end-page", type=int, default=frontmatter.LAST)
    metadata.add_argument("--convert", metavar="MODULE:FUNCTION", help="makes JPEG of covers that are none")
    for p in (extract, convert):
        p.add_argument("--ocr", metavar="MODULE:FUNCTION", help="reads pages that a provider declines to recite")
        p.add_argument("--page", help="numbers such as 3,7-9; all by default")
        p.add_argument("--prompt-version", default="5")
        p.add_argument("--force", action="store_true", help="extract pages again that have a run of this image, prompt and schema")
    assemble, build = action("assemble-book", assemble_book, "runs", "out"), action("build-epub", build_epub, "runs", "out")
    render, package = action("render-xhtml", render_xhtml, "book", "out"), action("package-epub", package_epub, "ready", "out")
    for p in (assemble, build, convert):
        p.add_argument("--exclude-pages")
        p.add_argument("--review", help="folder of a review whose corrections apply")
        p.add_argument("--require-reviewed", action="store_true")
    for p in (render, build, convert):
        for option in ("--title", "--language", "--author", "--metadata", "--assets"):
            p.add_argument(option)
    for p in (package, build, convert):
        p.add_argument("--modified")
    for p in (build, convert):
        p.add_argument("--validate", action="store_true")
    action("validate-epub", validate_epub, "epubs")
    action("prepare-proof", prepare_proof, "ready", "proof").add_argument("--force", action="store_true")
    crop = action("crop-figures", crop_figures, "book", "images", "out")
    crop.add_argument("--size", required=True, metavar="MODULE:FUNCTION", help="gives width and height of an image")
    crop.add_argument("--crop", required=True, metavar="MODULE:FUNCTION", help="gives a part of an image as PNG")
    kept = action("backup-book", backup_book, "ready", "proof", "out", "work")
    kept.add_argument("--metadata")
    kept.add_argument("--review")
    text = action("review-text", review_text, "runs", "out")
    text.add_argument("--min-confidence", type=float, default=0.0)
    text.add_argument("--cache", help="folder of earlier results; that of the review by default")
    action("import-review", import_review, "review", "decisions")
    for p in (action("review-status", review_status, "runs", "review"), action("evaluate-golden", evaluate_golden, "root")):
        p.add_argument("--format", choices=("text", "json"), default="text")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("folio").getOrCreate()
    try:
        return a.run(spark, a)
    except ValueError as e:
        print(f"error: {e}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
