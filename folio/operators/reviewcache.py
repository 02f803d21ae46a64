"""A store of page reviews by what they were made of, so that only pages whose input has changed are reviewed again.

A row is (fingerprint, version, digest, result): the result of a page as JSON, and its digest. A row of another version, one whose digest isn't
that of its result, and one that has a page's findings in another form count as not there.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.operators.findings import fingerprint

#: Raised when the same input gives other findings.
VERSION = 1
ENTRY = "fingerprint string, version int, digest string, result string"


def with_fingerprint(pages: DataFrame, *inputs: Column) -> DataFrame:
    """pages with the fingerprint of their inputs and of VERSION."""
    return pages.withColumn("fingerprint", fingerprint(F.lit(VERSION), *inputs))


def entries(spark: SparkSession, folder: str) -> DataFrame:
    try:
        return spark.read.schema(ENTRY).parquet(f"{folder}/entries")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ENTRY)


def found(pages: DataFrame, store: DataFrame, kind: str) -> DataFrame:
    """pages (fingerprint, ...) with result (typed as kind) where the store has it, else null. Equal results that are stored twice are one."""
    whole = store.where((F.col("version") == VERSION) & (F.col("digest") == F.sha2("result", 256)))
    # A field that is no such thing makes from_json's result null, and with it the entry.
    typed = whole.select("fingerprint", F.from_json("result", kind, {"mode": "PERMISSIVE"}).alias("result"), F.try_parse_json("result").alias("_v")).where("result is not null and _v is not null and schema_of_variant(_v) like 'ARRAY%'")
    return pages.join(typed.groupBy("fingerprint").agg(F.first("result").alias("result")), "fingerprint", "left")


def store(results: DataFrame, folder: str) -> None:
    """Adds results (fingerprint, result: an array)."""
    text = F.to_json("result", {"ignoreNullFields": "false"})
    rows = results.select("fingerprint", F.lit(VERSION).alias("version"), text.alias("result")).select("fingerprint", "version", F.sha2("result", 256).alias("digest"), "result")
    rows.write.mode("append").parquet(f"{folder}/entries")


def evict(spark: SparkSession, folder: str, live: DataFrame) -> tuple[int, int]:
    """Keeps the entries of live fingerprints, each once; how many there were and are. The new folder takes the place of the old when it is whole."""
    before = entries(spark, folder)
    n = before.count()
    if not n:
        return 0, 0
    kept = before.join(live.select("fingerprint").distinct(), "fingerprint", "left_semi").where(F.col("version") == VERSION).dropDuplicates(["fingerprint"])
    fresh, old = f"{folder}/entries-{uuid.uuid4().hex}", f"{folder}/old-{uuid.uuid4().hex}"
    kept.write.parquet(fresh)
    left = spark.read.schema(ENTRY).parquet(fresh).count()
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.rename(path(f"{folder}/entries"), path(old)) or not fs.rename(path(fresh), path(f"{folder}/entries")):
        raise OSError(f"{folder}: the entries can't be replaced")
    fs.delete(path(old), True)
    return n, left
