"""Incremental ingestion: page files arrive in a folder, are judged, and replace earlier runs of their page.

A file stream with a checkpoint gives the resumption: every file is handled once, and a batch that is repeated after a
failure writes the same rows again. Accepted pages and violations are kept in folders partitioned by batch; readers take
the latest row of each page. Only books that a batch touches have to be analysed again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folio.operators.evidence import normalized


def arriving(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """A stream of (book_id, page_id, page_number, raw, arrived) of <folder>/<book>/<number>.json, payloads as a provider returns them."""
    files = spark.readStream.option("wholetext", "true").option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(folder)
    path = F.col("_metadata.file_path")
    book, number = F.element_at(F.split(path, "/"), -2), F.regexp_extract(path, r"(\d+)\.json$", 1).cast("int")
    return files.select(book.alias("book_id"), F.concat(book, F.lit(":page:"), F.format_string("%04d", number)).alias("page_id"), number.alias("page_number"), F.col("value").alias("raw"), F.col("_metadata.file_modification_time").alias("arrived"))


def take(batch: DataFrame, number: int, out: str) -> None:
    """Judges the pages of a batch and keeps them below out."""
    judged = normalized(batch).withColumn("batch", F.lit(number))
    judged.persist()
    try:
        # A batch writes its own folder, so writing it again replaces it.
        judged.where("size(violations) = 0").select("book_id", "page_id", "page_number", "arrived", "batch", "page").write.mode("overwrite").parquet(f"{out}/pages/run={number:09d}")
        judged.where("size(violations) > 0").select("book_id", "page_id", "page_number", "arrived", "batch", "violations", "raw").write.mode("overwrite").parquet(f"{out}/quarantine/run={number:09d}")
    finally:
        judged.unpersist()


def ingest(pages: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Starts a query that takes in everything that is there and stops; run it again for what came since."""
    return pages.writeStream.foreachBatch(lambda batch, number: take(batch, number, out)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def books_of_batch(spark: SparkSession, out: str, number: int) -> DataFrame:
    """Books with an accepted page of a batch."""
    return spark.read.parquet(f"{out}/pages/run={number:09d}").select("book_id").distinct()


def current_pages(spark: SparkSession, out: str) -> DataFrame:
    """The latest accepted row of each page."""
    w = Window.partitionBy("book_id", "page_number").orderBy(F.col("batch").desc(), F.col("arrived").desc())
    return spark.read.parquet(f"{out}/pages").withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "run")


def touched_books(spark: SparkSession, out: str, since: int) -> DataFrame:
    """Books with a page from a batch after since."""
    return spark.read.parquet(f"{out}/pages").where(F.col("batch") > since).select("book_id").distinct()


def progress(spark: SparkSession, out: str) -> DataFrame:
    """(batch, pages, quarantined): what each batch brought."""
    count = lambda part, name: spark.read.parquet(f"{out}/{part}").groupBy("batch").agg(F.count("*").alias(name))
    return count("pages", "pages").join(count("quarantine", "quarantined"), "batch", "full_outer").na.fill(0)


def windowed_counts(events: DataFrame, lateness: str = "1 hour", width: str = "1 hour") -> DataFrame:
    """(start, event_type, events) over a stream or table of (ts, event_type); late rows beyond lateness are dropped by a stream."""
    w = F.window("ts", width)
    return events.withWatermark("ts", lateness).groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("events")).select(F.col("w.start").alias("start"), "event_type", "events")
