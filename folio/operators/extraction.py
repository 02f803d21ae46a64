"""Extraction of pages by plug-ins: what a provider answers, route after route, in waves over all pages.

A wave calls the plug-in of its route for every page that is open, classifies what failed, and gives each page its next attempt, its next
route or its end. Each wave is written before the next begins, so that a lost executor repeats calls of one wave at most, and pages
that have their answer are not asked again.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from functools import reduce
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.operators import runtime
from folio.operators.evidence import PAGE_TYPE, normalized, page_of_lines

ATTEMPT_TYPE = "struct<mechanism:string,provider:string,status:string,reason:string,metadata:map<string,string>>"
OPEN, SUCCEEDED, FAILED, NOT_REACHED = "open", "succeeded", "failed", "not_reached"
_ANSWER = "_raw string, _model string, _usage map<string,long>, _status int, _message string, _error string, _after double, _called boolean"


class ExtractionError(Exception):
    """A failed call. status: of the request; error: recitation, invalid_response, missing_asset, provider_setup or other, where it wasn't the request;
    retry_after: seconds that the provider asks for."""

    def __init__(self, message: str, status: int | None = None, error: str | None = None, retry_after: float | None = None) -> None:
        super().__init__(message)
        self.status, self.error, self.retry_after = status, error, retry_after


class Extractor(Protocol):
    """A plug-in. Gets the page's image and what is known of it (book_id, page_number, page_id, route, attempt); returns a mapping with raw, the
    answer as JSON text, and maybe model and usage (counts by name); raises ExtractionError. It is sent to the executors, so it must be importable there."""

    def __call__(self, image: bytes | None, task: dict) -> dict: ...


class Recognizer(Protocol):
    """A plug-in for local recognition: plain text of an image."""

    def __call__(self, image: bytes | None, task: dict) -> str: ...


_TASK = ("book_id", "page_number", "page_id")


def _calls(extractors: dict[str, Extractor], keys: tuple[str, ...], asset: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.map_(pa.string(), pa.int64()), pa.int32(), pa.string(), pa.string(), pa.float64(), pa.bool_()]
        names = [c.split(" ")[0] for c in _ANSWER.split(", ")]
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                value = {c: one.column(c)[0].as_py() for c in (*keys, asset, "_name", "_attempt")}
                task = {c: value[c] for c in keys} | {"route": value["_name"], "attempt": value["_attempt"]}
                try:
                    got = extractors[value["_name"]](value[asset], task)
                    row = (got.get("raw"), got.get("model"), list((got.get("usage") or {}).items()), None, None, None, None, True)
                except ExtractionError as e:
                    row = (None, None, None, e.status, str(e), e.error, e.retry_after, False)
                except Exception as e:  # a plug-in may fail in any way; the page then has an attempt that says how
                    row = (None, None, None, None, f"{type(e).__name__}: {e}", "other", None, False)
                yield pa.RecordBatch.from_arrays([*one.columns, *(pa.array([v], k) for v, k in zip(row, kinds, strict=True))], names=[*batch.schema.names, *names])

    return run


def typed_pages(answers: DataFrame) -> DataFrame:
    """answers (_raw, ...) with page and violations."""
    return normalized(answers, raw="_raw")


def extracted(tasks: DataFrame, routes: list[dict], extractors: dict[str, Extractor], keep: Callable[[DataFrame, str], DataFrame], policy: str = "free-only", base: float = 1.0, most: float = 8.0, wait: Callable[[float], None] = time.sleep, judge: Callable[[DataFrame], DataFrame] = typed_pages, made: str = "page", keys: tuple[str, ...] = _TASK, asset: str = "image") -> DataFrame:
    """tasks (book_id, page_number, page_id, image, ...) with outcome, page (evidence.PAGE_TYPE), raw, model, usage and attempts.

    routes: (name, tier, max_attempts) as runtime.checked_routes takes them, each with a plug-in of its name. keep writes a table under a name and reads it
    back. An answer that breaks the contract of a page is a failure like others. Once a page of a book has failed for a reason that
    concerns them all, the book's open pages are not reached. Null images are passed on as such.

    Other tasks than pages: keys are the columns that the plug-in is told, book_id among them, asset is what it gets, and judge gives answers (_raw)
    the column made and violations, empty where the answer will do.
    """
    allowed = runtime.checked_routes(routes, policy, base, most)
    missing = [r["name"] for r in allowed if r["name"] not in extractors]
    if missing:
        raise ValueError(f"routes without a plug-in: {missing}")
    columns = tasks.columns
    number = lambda pick, at: F.get(F.array(*(F.lit(pick(r)) for r in allowed)), at)
    none = F.array().cast(f"array<{ATTEMPT_TYPE}>")
    state = keep(tasks.withColumns({"_route": F.lit(0), "_attempt": F.lit(1), "attempts": none}), "wave-0")
    done = []
    for wave in range(1, sum(r["max_attempts"] for r in allowed) + 1):
        named = state.withColumn("_name", number(lambda r: r["name"], F.col("_route")))
        schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in named.schema), _ANSWER])
        judged = judge(named.mapInArrow(_calls(extractors, keys, asset), schema))
        judged = judged.withColumn("_ok", F.col("_called") & (F.size("violations") == 0)).withColumn("_error", F.when(F.col("_called"), "invalid_response").otherwise(F.col("_error")))
        kind = F.when(~F.col("_ok"), runtime.failure_kind(F.col("_status"), F.col("_message"), F.col("_error")))
        tried = F.struct(F.lit("provider").alias("mechanism"), F.col("_name").alias("provider"), F.when(F.col("_ok"), SUCCEEDED).otherwise(FAILED).alias("status"), F.col("_kind").alias("reason"), F.create_map(F.lit("attempt"), F.col("_attempt").cast("string"), F.lit("tier"), number(lambda r: r["tier"], F.col("_route"))).alias("metadata"))
        again = runtime.retryable(F.col("_kind")) & (F.col("_attempt") < number(lambda r: r["max_attempts"], F.col("_route")))
        onward = runtime.continues_routing(F.col("_kind")) & (F.col("_route") + 1 < len(allowed))
        outcome = F.when(F.col("_ok"), SUCCEEDED).when(again | onward, OPEN).otherwise(FAILED)
        delay = F.when(again, runtime.retry_delay(F.col("_attempt"), base, most, F.col("_after")))
        rows = judged.withColumn("_kind", kind).withColumn("attempts", F.concat("attempts", F.array(tried))).withColumns({"outcome": outcome, "_wait": delay, "_again": again})
        rows = keep(rows.select(*columns, F.when(F.col("_again"), F.col("_route")).otherwise(F.col("_route") + 1).alias("_route"), F.when(F.col("_again"), F.col("_attempt") + 1).otherwise(1).alias("_attempt"), "attempts", "outcome", made, F.col("_raw").alias("raw"), F.col("_model").alias("model"), F.col("_usage").alias("usage"), "_wait"), f"wave-{wave}")
        stopped = rows.where((F.col("outcome") == FAILED) & runtime.stops_run(F.col("attempts"))).select("book_id").distinct()
        still = rows.where(F.col("outcome") == OPEN)
        done += [rows.where(F.col("outcome") != OPEN), still.join(stopped, "book_id", "left_semi").withColumn("outcome", F.lit(NOT_REACHED)).select(rows.columns)]
        state = still.join(stopped, "book_id", "left_anti")
        longest = state.agg(F.count("*").alias("n"), F.max("_wait").alias("s")).first()
        if not longest.n:
            break
        if longest.s:
            wait(longest.s)
        state = state.select(*columns, "_route", "_attempt", "attempts")
    return reduce(DataFrame.unionByName, done).drop("_route", "_attempt", "_wait")


def recognised(failed: DataFrame, recognizer: Recognizer) -> DataFrame:
    """(book_id, page_id, reading) of pages (book_id, page_number, page_id, image)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            texts = [recognizer(r["image"], {c: r[c] for c in _TASK}) for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column("book_id"), batch.column("page_id"), pa.array(texts, pa.string())], names=["book_id", "page_id", "reading"])

    return failed.select(*_TASK, "image").mapInArrow(run, "book_id string, page_id string, reading string")


def _reason(attempts: Column) -> Column:
    return F.get(attempts, F.size(attempts) - 1)["reason"]


def with_recovery(pages: DataFrame, recognizer: Recognizer, languages: DataFrame | None = None) -> DataFrame:
    """extracted() pages, those that the provider declined to recite made of a local reading: outcome is succeeded, recovery_language that of the
    nearest page (und without one), and an attempt more says so. languages (book_id, page_number, language): of pages that were
    extracted earlier."""
    lost = pages.where((F.col("outcome") == FAILED) & (_reason(F.col("attempts")) == "recitation"))
    known = pages.where(F.col("outcome") == SUCCEEDED).select("book_id", "page_number", F.col("page.dominant_language").alias("language"))
    known = known if languages is None else known.unionByName(languages)
    got = runtime.recovered(lost.select("book_id", "page_id", "page_number", F.lit("recitation").alias("reason")), recognised(lost, recognizer), known)
    part = lambda k: F.transform("blocks", lambda b: b[k])
    page = F.struct(F.col("page_id"), F.lit("text").alias("page_kind_hint"), F.col("language").alias("dominant_language"), F.lit(None).cast("string").alias("printed_page_number"), page_of_lines(F.col("page_id"), part("role"), part("text"), F.col("language")).alias("blocks"), F.col("warnings")).cast(PAGE_TYPE)
    text = F.array_join(part("text"), "\n\n")
    mended = got.select("book_id", "page_id", page.alias("_page"), text.alias("_text"), F.coalesce("language", F.lit("und")).alias("_language"))
    tried = F.struct(F.lit("local_ocr").alias("mechanism"), F.lit("local").alias("provider"), F.lit(SUCCEEDED).alias("status"), F.lit(None).cast("string").alias("reason"), F.create_map().cast("map<string,string>").alias("metadata"))
    both = pages.join(mended, ["book_id", "page_id"], "left")
    hit = F.col("_page").isNotNull()
    changed = {"page": F.coalesce("_page", "page"), "raw": F.coalesce("_text", "raw"), "outcome": F.when(hit, SUCCEEDED).otherwise(F.col("outcome")), "attempts": F.when(hit, F.concat("attempts", F.array(tried))).otherwise(F.col("attempts")), "recovery_language": F.col("_language")}
    return both.withColumns(changed).drop("_page", "_text", "_language").select(*pages.columns, "recovery_language")
