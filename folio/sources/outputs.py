"""Files written and removed by the tasks that hold their rows, so that none passes through the driver."""

from __future__ import annotations

import atexit
import hashlib
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a temporary folder only where it is unset and the master is local."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="folio-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def written(rows: DataFrame, name: str) -> DataFrame:
    """rows, written to a table of its own in the shared folder and read back: for what several steps read whose plan is long. The shuffle
    files of the job go with it."""
    spark = rows.sparkSession
    path = f"{shared_root(spark)}/folio-{name}-{uuid.uuid4().hex}"
    kept = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        rows.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, kept)
    out = spark.read.schema(rows.schema).parquet(path)
    out._folio_path = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Removes written tables that no later step reads."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t._folio_path)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def _folder(root: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(root if "://" in root or root.startswith("file:/") else f"file://{root}")


def _plain(path: str) -> str:
    if not path or any(part in ("", ".", "..") for part in path.split("/")):
        raise ValueError(f"no path below a folder: {path!r}")
    return path


def write_files(rows: DataFrame, root: str) -> DataFrame:
    """Writes (path, data) below a folder, an absolute path or a URI that pyarrow.fs opens on every machine, and gives (path, sha256, size).

    It writes when the result is evaluated. A file takes its place whole, so a task that runs twice leaves the same files. A path with
    empty parts, . or .. raises ValueError; null data is an empty file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _folder(root)
        for batch in batches:
            done = []
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = data.as_py() or b""
                name = f"{base}/{_plain(path or '')}"
                folder, _, last = name.rpartition("/")
                fs.create_dir(folder)
                part = f"{folder}/.{last}.{uuid.uuid4().hex}"
                with fs.open_output_stream(part) as out:
                    out.write(data)
                fs.move(part, name)
                done.append((path, hashlib.sha256(data).hexdigest(), len(data)))
            columns = zip(*done, strict=True) if done else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()), strict=True)], ["path", "sha256", "size"])

    return rows.select(F.col("path").cast("string").alias("path"), F.col("data").cast("binary").alias("data")).mapInArrow(run, "path string, sha256 string, size long")


def remove_files(rows: DataFrame, root: str) -> DataFrame:
    """Removes the files (path) below a folder; gives path. A file that isn't there any more is removed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _folder(root)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                name = f"{base}/{_plain(path or '')}"
                if fs.get_file_info(name).type == pafs.FileType.File:
                    fs.delete_file(name)
            yield batch

    return rows.select(F.col("path").cast("string").alias("path")).mapInArrow(run, "path string")
