"""Page runs as a data source of Spark: ``spark.read.format("page_runs")`` and ``df.write.format("page_runs").mode("append")``.

Reading lists folders and opens only the files that are asked for: filters on book_id and page_number are pushed down, and a schema
with fewer columns leaves the others' files closed. A run named page-N is page N. Folders whose names begin with a dot are no books and no runs.

Writing stages all runs of a job in a hidden folder. When every task has ended, each run is moved to its place, and the run
of the page that was there is kept until all are in place; if that fails, or a task does, every earlier run is as it was. The
folder must be one that the cluster shares and that can rename folders.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.types import StructType

from folio.operators.evidence import reloaded, stored_page

NAME = "page_runs"
#: What can be read. path is that of the stored page; stored and manifest are the texts of the files.
SCHEMA = "book_id string, run string, path string, page_number int, stored string, manifest string"
#: What can be written. raw goes to raw/<raw_file>, asset to assets/<asset_file>, each if there is one.
WRITTEN = "book_id string, page_number int, stored string, manifest string, raw string, raw_file string, asset binary, asset_file string"
PAGE, MANIFEST = "normalized/page.json", "manifest.json"
#: Books that one task reads.
BOOKS_OF_TASK = 8
_STAGING = ".staging-"
_NUMBERED = re.compile(r"page-(\d+)\Z")
_KINDS = {"string": pa.string(), "int": pa.int32()}
#: Threads that move staged runs.
_MOVERS = 16


def run_name(page_number: int) -> str:
    return f"page-{page_number:04d}"


def _plain(name: str) -> str:
    """A name of one visible folder or file."""
    if not name or name.startswith(".") or re.search(r"[/\\\0]", name):
        raise ValueError(f"no plain name: {name!r}")
    return name


def _folders(fs: pafs.FileSystem, path: str) -> list[str]:
    found = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
    return sorted(x.base_name for x in found if x.type == pafs.FileType.Directory and not x.base_name.startswith("."))


@dataclass
class Books(InputPartition):
    names: list[str]


class PageRunReader(DataSourceReader):
    def __init__(self, root: str, schema: StructType, books_of_task: int) -> None:
        self.root, self.columns, self.books_of_task = root, [(f.name, f.dataType.simpleString()) for f in schema], books_of_task
        unknown = [c for c in self.columns if f"{c[0]} {c[1]}" not in SCHEMA.split(", ")]
        if unknown:
            raise ValueError(f"page runs have no {unknown}")
        self.books: set[str] | None = None
        self.numbers: set[int] | None = None
        self.low, self.high = 1, 1 << 62

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes comparisons of book_id with values whole; those of page_number also, for runs that are named by it, and leaves them to be
        applied to the others."""
        for f in filters:
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if getattr(f, "attribute", None) == ("book_id",) and values is not None:
                self.books = values if self.books is None else self.books & values
                continue
            if getattr(f, "attribute", None) == ("page_number",):
                if values is not None:
                    self.numbers = values if self.numbers is None else self.numbers & values
                elif isinstance(f, GreaterThan | GreaterThanOrEqual):
                    self.low = max(self.low, f.value + isinstance(f, GreaterThan))
                elif isinstance(f, LessThan | LessThanOrEqual):
                    self.high = min(self.high, f.value - isinstance(f, LessThan))
            yield f

    def _wanted(self, number: int) -> bool:
        return self.low <= number <= self.high and (self.numbers is None or number in self.numbers)

    def partitions(self) -> list[Books]:
        fs, path = pafs.FileSystem.from_uri(self.root)
        names = _folders(fs, path) if self.books is None else sorted(b for b in self.books if isinstance(b, str))
        return [Books(names[i : i + self.books_of_task]) for i in range(0, len(names), self.books_of_task)] or [Books([])]

    def read(self, partition: Books) -> Iterator[pa.RecordBatch]:
        fs, path = pafs.FileSystem.from_uri(self.root)
        names = [n for n, _ in self.columns]
        for book in partition.names:
            rows = []
            for run in _folders(fs, f"{path}/{book}"):
                m = _NUMBERED.match(run)
                named = int(m[1]) if m else None
                if named is not None and not self._wanted(named):
                    continue
                files = [f"{path}/{book}/{run}/{name}" for name in (PAGE, MANIFEST)]
                if any(x.type != pafs.FileType.File for x in fs.get_file_info(files)):
                    continue
                row = {"book_id": book, "run": run, "path": self._uri(files[0]), "page_number": named}
                if "stored" in names or (named is None and "page_number" in names):
                    row["stored"] = self._text(fs, files[0])
                    row["page_number"] = self._number(row["stored"])
                    if named is not None and row["page_number"] != named:
                        raise ValueError(f"{files[0]}: page {row['page_number']} in a run of page {named}")
                if "manifest" in names:
                    row["manifest"] = self._text(fs, files[1])
                rows.append(row)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], _KINDS[k]) for n, k in self.columns], names=names)

    def _uri(self, file: str) -> str:
        return f"{self.root[: self.root.index('://')]}://{file}" if "://" in self.root and not self.root.startswith("file:") else f"file:{file}"

    @staticmethod
    def _text(fs: pafs.FileSystem, file: str) -> str:
        with fs.open_input_stream(file) as f:
            return f.read().decode("utf-8")

    @staticmethod
    def _number(stored: str) -> int | None:
        try:
            n: Any = json.loads(stored)["source"]["metadata"]["page_number"]
        except (ValueError, KeyError, TypeError):
            return None
        return n if isinstance(n, int) and not isinstance(n, bool) and abs(n) < 1 << 31 else None


@dataclass
class Staged(WriterCommitMessage):
    """Runs that one task has put below staging/<attempt>."""

    attempt: str
    runs: list[tuple[str, str]]


class PageRunWriter(DataSourceWriter):
    def __init__(self, root: str, schema: StructType) -> None:
        missing = [c for c in WRITTEN.split(", ") if c not in {f"{f.name} {f.dataType.simpleString()}" for f in schema}]
        if missing:
            raise ValueError(f"page runs need {missing}")
        self.root, self.staging = root, f"{_STAGING}{uuid.uuid4().hex}"

    def write(self, iterator: Iterator) -> Staged:
        fs, path = pafs.FileSystem.from_uri(self.root)
        attempt = str(TaskContext.get().taskAttemptId())
        runs = []
        for row in iterator:
            if row.page_number is None or row.page_number < 1 or row.stored is None or row.manifest is None:
                raise ValueError(f"no whole run: {row.book_id}, {row.page_number}")
            book, run = _plain(row.book_id or ""), run_name(row.page_number)
            here = f"{path}/{self.staging}/{attempt}/{book}/{run}"
            parts = [(PAGE, row.stored.encode()), (MANIFEST, row.manifest.encode())]
            if row.raw is not None:
                parts.append((f"raw/{_plain(row.raw_file or '')}", row.raw.encode()))
            if row.asset is not None:
                parts.append((f"assets/{_plain(row.asset_file or '')}", bytes(row.asset)))
            for name, data in parts:
                fs.create_dir(f"{here}/{name}".rpartition("/")[0])
                with fs.open_output_stream(f"{here}/{name}") as out:
                    out.write(data)
            runs.append((book, run))
        return Staged(attempt, runs)

    def commit(self, messages: list[Staged | None]) -> None:
        fs, path = pafs.FileSystem.from_uri(self.root)
        staged = [(m.attempt, *r) for m in messages if m for r in m.runs]
        places = [r[1:] for r in staged]
        if len(set(places)) < len(places):
            raise ValueError(f"pages written twice: {sorted({p for p in places if places.count(p) > 1})[:5]}")
        fs.create_dir(f"{path}/{self.staging}/backup")
        for book in {b for b, _ in places}:
            fs.create_dir(f"{path}/{book}")
            fs.create_dir(f"{path}/{self.staging}/backup/{book}")

        def publish(attempt: str, book: str, run: str) -> None:
            place = f"{path}/{book}/{run}"
            if fs.get_file_info(place).type != pafs.FileType.NotFound:
                fs.move(place, f"{path}/{self.staging}/backup/{book}/{run}")
            fs.move(f"{path}/{self.staging}/{attempt}/{book}/{run}", place)

        with ThreadPoolExecutor(_MOVERS) as pool:
            done = [pool.submit(publish, *s) for s in staged]
        failed = [d.exception() for d in done if d.exception()]
        if failed:
            for (_, book, run), d in zip(staged, done, strict=True):
                if not d.exception():
                    fs.delete_dir(f"{path}/{book}/{run}")
            restore(self.root, self.staging)
            raise failed[0]
        fs.delete_dir(f"{path}/{self.staging}")

    def abort(self, messages: list[Staged | None]) -> None:
        restore(self.root, self.staging)


def restore(root: str, staging: str | None = None) -> list[str]:
    """Puts back the runs that unfinished writes have moved aside, and removes what they staged: of one write, or of all, which then must
    not be at work. Returns the places put back."""
    fs, path = pafs.FileSystem.from_uri(root)
    found = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
    back = []
    for name in [staging] if staging else [x.base_name for x in found if x.base_name.startswith(_STAGING)]:
        for book in _folders(fs, f"{path}/{name}/backup"):
            for run in _folders(fs, f"{path}/{name}/backup/{book}"):
                place = f"{path}/{book}/{run}"
                if fs.get_file_info(place).type != pafs.FileType.NotFound:
                    fs.delete_dir(place)
                fs.move(f"{path}/{name}/backup/{book}/{run}", place)
                back.append(f"{book}/{run}")
        if fs.get_file_info(f"{path}/{name}").type != pafs.FileType.NotFound:
            fs.delete_dir(f"{path}/{name}")
    return back


class PageRunSource(DataSource):
    """Options: path (the root of the books) and booksPerTask."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def _root(self) -> str:
        root = (self.options.get("path") or "").rstrip("/")
        if not root:
            raise ValueError("page runs need a path")
        return root

    def reader(self, schema: StructType) -> PageRunReader:
        return PageRunReader(self._root(), schema, int(self.options.get("booksPerTask", BOOKS_OF_TASK)))

    def writer(self, schema: StructType, overwrite: bool) -> PageRunWriter:
        if overwrite:
            raise ValueError("page runs are written page by page: use append, which replaces the pages that are there")
        return PageRunWriter(self._root(), schema)


def register(spark: SparkSession) -> SparkSession:
    """Makes the source known to a session, and lets its filters be pushed down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PageRunSource)
    return spark


def scan(spark: SparkSession, root: str, columns: Iterable[str] = ()) -> DataFrame:
    """Runs under root with some columns of SCHEMA, all by default. Only the files of these are opened."""
    wanted = list(columns)
    schema = ", ".join(c for c in SCHEMA.split(", ") if not wanted or c.split(" ")[0] in wanted)
    return register(spark).read.format(NAME).schema(schema).load(root)


def judged_runs(spark: SparkSession, root: str) -> DataFrame:
    """As files.page_runs, with filters on book_id and page_number that keep files closed."""
    return reloaded(scan(spark, root)).drop("stored").select("book_id", "run", "path", "manifest", "violations", "page", "page_number")


# Fixed values of manifests.
MODEL = "PageExtraction"
RECOVERY = {"normalization": "local_ocr_recitation", "reason": "gemini_recitation", "mechanism": "local_ocr", "provider": "tesseract"}
RESPONSE_FILE, RECOVERED_FILE = "provider-response.json", "local-ocr.txt"


def run_records(pages: DataFrame) -> DataFrame:
    """Rows to write (WRITTEN) of extracted pages: book_id, page_number, page (evidence.PAGE_TYPE), source (source_id, uri, sha256, media_type,
    document_sha256), asset_info (file, media_type, sha256, byte_size, preserved), prompt and schema (name, version), attempts (a list),
    recovery_language (null unless the text was recovered by local recognition), raw, and asset (bytes, or null).

    Nulls are written as such; rows whose page is null have no run and are left out.
    """
    s, a = F.col("source"), F.col("asset_info")
    meta = F.struct(F.col("page_number").alias("page_number"), s["document_sha256"].alias("document_sha256"))
    stored = stored_page(F.col("page"), F.struct(*(s[k].alias(k) for k in ("source_id", "uri", "sha256", "media_type")), meta.alias("metadata")))
    plain = {
        "source": F.struct(*(s[k].alias(k) for k in ("source_id", "uri", "sha256", "media_type")), F.col("page_number").alias("page_number"), s["document_sha256"].alias("document_sha256")),
        "asset": F.struct(F.concat(F.lit("assets/"), a["file"]).alias("path"), *(a[k].alias(k) for k in ("media_type", "sha256", "byte_size")), a["preserved"].alias("preserved_encoded_source")),
        "prompt": F.col("prompt"),
        "schema": F.col("schema"),
    }
    done = F.struct(F.lit(MODEL).alias("model"), F.lit("success").alias("status"))
    mended = F.struct(F.lit(MODEL).alias("model"), F.lit("recovered").alias("status"), F.lit(RECOVERY["normalization"]).alias("recovery"), F.lit(True).alias("needs_review"))
    how = F.struct(*(F.lit(RECOVERY[k]).alias(k) for k in ("reason", "mechanism", "provider")), F.col("recovery_language").alias("language"), F.lit(True).alias("needs_review"))
    text = lambda **more: F.to_json(F.struct(*(c.alias(k) for k, c in (plain | more).items())), {"ignoreNullFields": "false"})
    manifest = F.when(F.col("recovery_language").isNull(), text(normalization=done, attempts=F.col("attempts"))).otherwise(text(normalization=mended, recovery=how, attempts=F.col("attempts")))
    raw_file = F.when(F.col("recovery_language").isNull(), RESPONSE_FILE).otherwise(RECOVERED_FILE)
    return pages.where("page is not null").select("book_id", F.col("page_number").cast("int").alias("page_number"), stored.alias("stored"), manifest.alias("manifest"), "raw", raw_file.alias("raw_file"), "asset", a["file"].alias("asset_file"))


def write_runs(records: DataFrame, root: str) -> None:
    """Publishes runs; those of pages that are there already are replaced."""
    register(records.sparkSession)
    records.write.format(NAME).mode("append").save(root)
