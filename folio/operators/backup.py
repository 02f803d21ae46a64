"""Backups of what people have made of books: proofs, metadata, decisions and what the build was, as files that a version control keeps.

A backup is brought into agreement by digests: only files that differ are written, only managed files of the books backed up are removed, and
files of others stay as they are. A manifest is a file of its book, without times, so that an unchanged book changes nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The managed files below <book>/.
MANAGED = r"^[^/]+/(proof/.+|metadata\.json|review/resolutions\.json|build-info\.json|backup-manifest\.json)\z"
MANIFEST = "backup-manifest.json"
FORMAT = "folio-book-backup-1"


def actions(source: DataFrame, there: DataFrame) -> DataFrame:
    """(path, action) of source and there (path, sha256), paths that begin with the book: add, replace, keep, or remove for managed files that the source
    no longer has. Other files that only the backup has, and books that the source has not, are left out."""
    new, old = source.select("path", F.col("sha256").alias("_new")), there.select("path", F.col("sha256").alias("_old"))
    books = source.select(F.substring_index("path", "/", 1).alias("_book")).distinct()
    both = new.join(old, "path", "full_outer").withColumn("_book", F.substring_index("path", "/", 1))
    action = F.when(F.col("_old").isNull(), "add").when(F.col("_new").isNull(), "remove").when(F.col("_new") == F.col("_old"), "keep").otherwise("replace")
    rows = both.join(books, "_book", "left_semi").select("path", action.alias("action"))
    return rows.where((F.col("action") != "remove") | F.col("path").rlike(MANAGED))


def artifacts(documents: DataFrame, changes: DataFrame, metadata: DataFrame | None = None, decisions: DataFrame | None = None, builds: DataFrame | None = None) -> DataFrame:
    """(path, data) of the files of books with documents (book_id, file, content).

    changes (book_id, file, change) are the proof's against its baseline, metadata is (book_id, text), decisions (book_id, finding_id, ...), builds (book_id,
    stage, files, bytes, root, book_root). Decisions are in the order of their findings.
    """
    books = documents.select("book_id").distinct()
    of = lambda df: df.join(books, "book_id", "left_semi")
    at = lambda name, data: (F.concat("book_id", F.lit(f"/{name}")).alias("path"), data.cast("binary").alias("data"))
    kept = {"ignoreNullFields": "false"}
    parts = [documents.select(F.concat("book_id", F.lit("/proof/text/"), "file").alias("path"), F.col("content").cast("binary").alias("data"))]
    has = {}
    if metadata is not None:
        parts.append(of(metadata).select(*at("metadata.json", F.col("text"))))
        has["metadata"] = of(metadata).select("book_id").distinct()
    if decisions is not None:
        rest = [c for c in decisions.columns if c not in ("book_id", "finding_id")]
        by = of(decisions).groupBy("book_id").agg(F.sort_array(F.collect_list(F.struct("finding_id", *rest))).alias("r"))
        parts.append(by.select(*at("review/resolutions.json", F.to_json("r", kept))))
        has["review_resolutions"] = by.select("book_id")
    if builds is not None:
        by = of(builds).groupBy("book_id", "book_root").agg(F.sort_array(F.collect_list(F.struct("stage", "files", "bytes", "root"))).alias("stages"))
        parts.append(by.select(*at("build-info.json", F.to_json(F.struct("book_root", "stages"), kept))))
        has["build_info"] = by.select("book_id")
    rows = documents.groupBy("book_id").agg(F.count("*").alias("editable_xhtml"))
    edited = of(changes).where("change <> 'removed'").groupBy("book_id").agg(F.sort_array(F.collect_set("file")).alias("modified_xhtml"))
    rows = rows.join(edited, "book_id", "left")
    for name, df in has.items():
        rows = rows.join(df.withColumn(name, F.lit(True)), "book_id", "left")
    held = F.struct(F.lit(True).alias("proof"), *(F.coalesce(F.col(n) if n in has else F.lit(None), F.lit(False)).alias(n) for n in ("metadata", "review_resolutions", "build_info")))
    proof = F.struct("editable_xhtml", F.coalesce("modified_xhtml", F.array().cast("array<string>")).alias("modified_xhtml"))
    parts.append(rows.select(*at(MANIFEST, F.to_json(F.struct(F.lit(FORMAT).alias("format"), held.alias("artifacts"), proof.alias("proof")), kept))))
    return reduce(DataFrame.unionByName, parts)
