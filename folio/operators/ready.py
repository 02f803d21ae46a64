"""What a rendered book consists of: its manifest, and whether the files that it names belong together and are there."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.operators.packaging import plain_path
from folio.operators.rendering import ENDNOTES

STYLESHEET, COVER = "styles/book.css", "text/cover.xhtml"
MANIFEST_TYPE = "struct<title:string,language:string,content:string,contents:array<string>,cover:struct<image:string,content:string>,endnotes:string,stylesheet:string,assets:array<string>>"


def manifests(books: DataFrame, documents: DataFrame, assets: DataFrame) -> DataFrame:
    """(book_id, manifest) of books (book_id, title, language), documents (book_id, position, file), which lie in text/, and assets (book_id, file). Contents
    are in the order of the spine, content is the first that is neither cover nor notes. A book without documents has none."""
    named = F.concat(F.lit("text/"), "file")
    spine = documents.groupBy("book_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("position", named.alias("f")))), lambda x: x["f"]).alias("contents"))
    others = assets.groupBy("book_id").agg(F.sort_array(F.collect_list("file")).alias("assets"))
    rows = books.join(spine, "book_id", "left").join(others, "book_id", "left")
    contents, found = (F.coalesce(c, F.array().cast("array<string>")) for c in ("contents", "assets"))
    first = lambda files, test: F.get(F.filter(files, test), F.lit(0))
    image = first(found, lambda f: f.rlike(r"^assets/cover\.[a-z]+\z"))
    cover = F.when(F.array_contains(contents, COVER), F.struct(image.alias("image"), F.lit(COVER).alias("content")))
    notes = F.when(F.array_contains(contents, f"text/{ENDNOTES}"), f"text/{ENDNOTES}")
    body = first(contents, lambda f: ~f.isin(COVER, f"text/{ENDNOTES}"))
    made = F.struct("title", "language", body.alias("content"), contents.alias("contents"), cover.alias("cover"), notes.alias("endnotes"), F.lit(STYLESHEET).alias("stylesheet"), found.alias("assets"))
    return rows.select("book_id", made.cast(MANIFEST_TYPE).alias("manifest"))


def manifest_problems(rows: DataFrame, files: DataFrame) -> DataFrame:
    """(book_id, file, problem) of manifests (book_id, manifest) against the files (book_id, file) that there are: contents, stylesheet and assets are there,
    each named once, by paths that stay below the book; cover and notes are among them. file is null where it is a manifest as a whole."""
    m = F.col("manifest")
    none = F.array().cast("array<string>")
    contents, assets = F.coalesce(m["contents"], none), F.coalesce(m["assets"], none)
    listed = F.concat(contents, F.array(m["stylesheet"]), assets)
    there = rows.select("book_id", F.explode(listed).alias("file")).groupBy("book_id", "file").agg(F.count("*").alias("n"))
    outside = ~F.coalesce((plain_path(F.col("file")) == F.col("file")) & (F.trim("file") != "") & ~F.col("file").rlike(r"^(/|\.\.(/|\z))"), F.lit(False))
    known = files.select("book_id", "file", F.lit(True).alias("_there")).distinct()
    each = there.join(known, ["book_id", "file"], "left")
    said = [
        each.where(outside).select("book_id", "file", F.lit("leaves the book").alias("problem")),
        each.where("n > 1").select("book_id", "file", F.lit("named twice").alias("problem")),
        each.where(~outside & F.col("_there").isNull()).select("book_id", "file", F.lit("is not there").alias("problem")),
        rows.where(F.size(contents) == 0).select("book_id", F.lit(None).cast("string").alias("file"), F.lit("no contents").alias("problem")),
    ]
    parts = (("image", m["cover"]["image"], assets, "cover is no asset", m["cover"].isNotNull()), ("content", m["cover"]["content"], contents, "cover is not in contents", m["cover"].isNotNull()), ("endnotes", m["endnotes"], contents, "notes are not in contents", m["endnotes"].isNotNull()))
    for _, file, among, problem, asked in parts:
        said.append(rows.where(asked & ~F.coalesce(F.array_contains(among, file), F.lit(False))).select("book_id", file.alias("file"), F.lit(problem).alias("problem")))
    return reduce(DataFrame.unionByName, said)
