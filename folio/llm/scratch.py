"""Intermediate tables in the folder that the whole cluster shares."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.sources.outputs import shared_root


#: Ids of at most so many rows are sent to all executors (8 bytes each); beyond, tables are joined by a shuffle.
BROADCAST_IDS = 500_000
#: A table with lists is sent to all executors if it holds at most so many numbers.
BROADCAST_NUMBERS = 2_000_000


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Short rows of one file, and files that a table may have however short it is.
ROWS_OF_FILE = 100_000
LEAST_FILES = 8


def only(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows of df whose key is in the saved, distinct ids (one column, named like key)."""
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, key, "left_semi")


class Scratch:
    """Cuts lineage: a saved table is read back from the shared folder, so a lost executor costs no more than its own tasks."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.root = f"{shared_root(spark)}/folio-{name}-{uuid.uuid4().hex}"
        self.made = 0

    def save(self, df: DataFrame, rows: int | None = None) -> DataFrame:
        """rows: how many short rows df has at most, which then go to no more files and tasks than they need."""
        if rows is not None:
            df = df.coalesce(max(LEAST_FILES, rows // ROWS_OF_FILE))
        path = f"{self.root}/{self.made}"
        self.made += 1
        # The shuffle files of the job go with it, as the table is read back from its path.
        kept = self.spark.conf.get(_CLEANUP)
        self.spark.conf.set(_CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(_CLEANUP, kept)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._folio_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Removes saved tables that no later step reads."""
        jvm = self.spark._jvm
        for t in tables:
            path = jvm.org.apache.hadoop.fs.Path(t._folio_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def drop_since(self, mark: int, *kept: DataFrame) -> None:
        """Removes the tables that were saved since `made` was mark, but for those."""
        jvm, stay = self.spark._jvm, {t._folio_path for t in kept}
        for path in (f"{self.root}/{n}" for n in range(mark, self.made)):
            if path not in stay:
                path = jvm.org.apache.hadoop.fs.Path(path)
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
