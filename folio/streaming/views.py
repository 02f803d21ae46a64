"""Tables of analysed books that follow arriving pages: a batch analyses the books that it touches, and no others.

<out>/analysis/<table>/version=N/book_id=B holds what batch N made of book B. A version counts once <out>/analysis/versions/version=N says which
books it has, which is written last; a book's rows are those of its last version that counts. A repeated batch overwrites its own version.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from folio.operators import analyzer
from folio.streaming import ingest

TABLES = ("nodes", "relationships", "resolved", "furniture", "unresolved", "candidates")


def book_pages(spark: SparkSession, out: str, books: DataFrame | None = None) -> DataFrame:
    """The current pages of books (all by default), as the analysis takes them."""
    rows = ingest.current_pages(spark, out)
    if books is not None:
        rows = rows.join(books, "book_id", "left_semi")
    w = Window.partitionBy("book_id").orderBy("page_number")
    return rows.select("book_id", F.row_number().over(w).alias("page_pos"), "page_number", "page")


def refresh(spark: SparkSession, out: str, version: int, books: DataFrame) -> None:
    """Analyses books (book_id) anew, as a version of their tables. Without a book there is no version."""
    folder = f"{out}/analysis"
    if books.isEmpty():
        return
    made = analyzer.analyze(book_pages(spark, out, books))
    for name in TABLES:
        table = getattr(made, name)
        # A table without rows has no file that tells its columns.
        spark.createDataFrame([(table.schema.json(),)], "schema string").coalesce(1).write.mode("overwrite").parquet(f"{folder}/schemas/{name}")
        table.write.mode("overwrite").partitionBy("book_id").parquet(f"{folder}/{name}/version={version}")
    books.select("book_id").distinct().write.mode("overwrite").parquet(f"{folder}/versions/version={version}")


def _versions(spark: SparkSession, out: str) -> DataFrame:
    try:
        rows = spark.read.schema("book_id string, version long").parquet(f"{out}/analysis/versions")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], "book_id string, version long")
    return rows.groupBy("book_id").agg(F.max("version").alias("version"))


def view(spark: SparkSession, out: str, name: str) -> DataFrame:
    """A table of the analysis as it stands; AnalysisException where no batch has brought a page yet."""
    columns = StructType.fromJson(json.loads(spark.read.parquet(f"{out}/analysis/schemas/{name}").first().schema))
    columns = StructType([f for f in columns if f.name != "book_id"]).add("version", "long").add("book_id", "string")
    rows = spark.read.schema(columns).parquet(f"{out}/analysis/{name}")
    return rows.join(_versions(spark, out), ["book_id", "version"], "left_semi").drop("version")


def outdated(spark: SparkSession, out: str) -> DataFrame:
    """(book_id, version) that a later version has replaced, whose folders can go."""
    every = spark.read.schema("book_id string, version long").parquet(f"{out}/analysis/versions")
    return every.join(_versions(spark, out), ["book_id", "version"], "left_anti")


def vacuum(spark: SparkSession, out: str) -> int:
    """Removes outdated folders, while nobody reads them; how many. One folder's name at a time reaches the driver."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    gone = 0
    for r in outdated(spark, out).toLocalIterator():
        for name in TABLES:
            path = jvm.org.apache.hadoop.fs.Path(f"{out}/analysis/{name}/version={r.version}", f"book_id={jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(r.book_id)}")
            gone += path.getFileSystem(conf).delete(path, True)
    return gone


def follow(pages: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """ingest.ingest, with the tables of touched books after each batch. Takes in everything that is there and stops."""
    spark = pages.sparkSession

    def take(batch: DataFrame, number: int) -> None:
        ingest.take(batch, number, out)
        refresh(spark, out, number, ingest.books_of_batch(spark, out, number))

    return pages.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
