"""Extraction runtime: outcomes, retries, routes, usage and reuse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Fixed values of the provider's messages and of the policy.
DAILY_MARKERS = ("per day", "per-day", "daily", "requests_per_day", "requests per day", "requestsperday", "perdayperproject")
TRANSIENT_STATUS = (408, 500, 502, 503, 504)
RETRYABLE = ("rate_limit", "transient", "invalid_output")
FINAL = ("invalid_request", "recitation", "configuration")
STOPS_RUN = ("quota_exhausted", "authentication", "permission", "invalid_request", "configuration")
POLICIES = ("free-only", "free-then-paid")
TIERS = ("free", "paid", "unspecified")


def failure_kind(status: Column, message: Column, error: Column | None = None) -> Column:
    """The kind of a failed attempt. error says what failed where it wasn't the request: missing_asset, provider_setup,
    recitation or invalid_response; null for a request, which its status and message classify, and other for the rest."""
    low = F.lower(F.coalesce(message, F.lit("")))
    daily = F.exists(F.array(*map(F.lit, DAILY_MARKERS)), lambda m: low.contains(m))
    by_status = (
        F.when((status == 429) & daily, "quota_exhausted").when(status == 429, "rate_limit").when(status.isin(*TRANSIENT_STATUS), "transient")
        .when(status == 401, "authentication").when(status == 403, "permission").when(status == 400, "invalid_request").otherwise("unknown")
    )
    if error is None:
        return by_status
    return F.when(error.isNull(), by_status).when(error.isin("missing_asset", "provider_setup"), "configuration").when(error == "recitation", "recitation").when(error == "invalid_response", "invalid_output").otherwise("unknown")


def retryable(kind: Column) -> Column:
    return kind.isin(*RETRYABLE)


def continues_routing(kind: Column) -> Column:
    """Whether a later route may still help."""
    return ~kind.isin(*FINAL)


def stops_run(attempts: Column) -> Column:
    """Whether the last attempt (reason) of a page speaks against going on with the book."""
    return F.coalesce(F.get(attempts, F.size(attempts) - 1)["reason"].isin(*STOPS_RUN), F.lit(False))


def checked_routes(routes: list[dict], policy: str = "free-only", base: float = 1.0, most: float = 8.0) -> list[dict]:
    """The routes (name, tier, max_attempts) that a policy allows, in their order; ValueError for what can't be meant."""
    if policy not in POLICIES or any(r["tier"] not in TIERS for r in routes):
        raise ValueError("unknown policy or tier")
    if not routes:
        raise ValueError("no route")
    if any(not r["name"].strip() or r["max_attempts"] < 1 for r in routes):
        raise ValueError("a route needs a name and an attempt")
    if base < 0 or most < base:
        raise ValueError("backoff needs 0 <= base <= most")
    paid = [i for i, r in enumerate(routes) if r["tier"] == "paid"]
    free = [i for i, r in enumerate(routes) if r["tier"] == "free"]
    if paid and free and free[-1] > paid[0]:
        raise ValueError("a free route stands behind a paid one")
    if policy == "free-only" and not free:
        raise ValueError("free-only without a free route")
    return [r for r in routes if policy != "free-only" or r["tier"] == "free"]


def default_routes(free: list[str], paid: list[str]) -> list[dict]:
    """Routes of credential profiles: three attempts for each free one, then two for each paid one."""
    return [{"name": n, "tier": "free", "max_attempts": 3} for n in free] + [{"name": n, "tier": "paid", "max_attempts": 2} for n in paid]


def retry_delay(attempt: Column, base: float = 1.0, most: float = 8.0, hint: Column | None = None) -> Column:
    """min(base * 2^(attempt-1), most), at least what the provider asks for."""
    d = F.least(F.lit(base) * F.pow(F.lit(2.0), attempt - 1), F.lit(most))
    return F.greatest(d, F.coalesce(hint, F.lit(0.0))) if hint is not None else d


def routed(tasks: DataFrame, outcomes: DataFrame, routes: DataFrame) -> DataFrame:
    """Replays scripted outcomes (task_id, route, attempt, ok, kind) over routes (route, position, max_attempts).

    A task's attempts are in order of position and attempt. A retryable failure is followed by the next attempt of its
    route, another by the next route; a kind of FINAL ends the task, as does a success.
    """
    a = tasks.join(outcomes, "task_id").join(routes, "route").where("attempt <= max_attempts")
    order = ["position", "attempt"]
    w = Window.partitionBy("task_id", "route").orderBy("attempt").rowsBetween(Window.unboundedPreceding, -1)
    left_route = F.coalesce(F.max((~retryable(F.col("kind")) & ~F.col("ok")).cast("int")).over(w), F.lit(0))
    tried = a.withColumn("_left", left_route).where("_left = 0").drop("_left")
    t = Window.partitionBy("task_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ended = F.coalesce(F.max((F.col("ok") | ~continues_routing(F.col("kind"))).cast("int")).over(t), F.lit(0))
    return tried.withColumn("_ended", ended).where("_ended = 0").drop("_ended")


def first_usage(pages: DataFrame) -> DataFrame:
    """(book_id, page_id, usage) of pages (attempts: array of status, usage): the usage of the first attempt that succeeded and has one."""
    good = F.filter("attempts", lambda a: (a["status"] == "succeeded") & a["usage"].isNotNull())
    return pages.select("book_id", "page_id", F.get(good, F.lit(0))["usage"].alias("usage")).where("usage is not null")


def usage_totals(pages: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Sums by key of map column usage."""
    return pages.select(*by, F.explode("usage").alias("key", "value")).groupBy(*by, "key").agg(F.sum("value").alias("total"))


def routing_summary(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(book_id, profile, succeeded, failed) and (book_id, reason, failures) over the attempts (status, reason, profile, route)
    of pages (status, attempts); pages that were reused don't count. An attempt without profile goes by its route."""
    a = pages.where("status <> 'reused'").select("book_id", F.explode("attempts").alias("a")).select("book_id", F.coalesce("a.profile", "a.route", F.lit("unknown")).alias("profile"), "a.status", "a.reason")
    by_profile = a.groupBy("book_id", "profile").agg(F.count_if(F.col("status") == "succeeded").alias("succeeded"), F.count_if(F.col("status") == "failed").alias("failed"))
    return by_profile, a.where("status = 'failed'").groupBy("book_id", F.coalesce("reason", F.lit("unknown")).alias("reason")).agg(F.count("*").alias("failures"))


def extraction_summary(pages: DataFrame) -> DataFrame:
    """One row a book: pages selected, completed, extracted, reused, failed, recovered and remaining; status is null for pages
    not reached yet."""
    n = lambda c: F.count_if(c)
    s = F.col("status")
    return pages.groupBy("book_id").agg(F.count("*").alias("selected"), n(s.isin("extracted", "reused")).alias("completed"), n(s == "extracted").alias("extracted"), n(s == "reused").alias("reused"), n(s == "failed").alias("failed"), n(s.isin("extracted", "reused") & F.coalesce("recovered", F.lit(False))).alias("recovered"), n(s.isNull()).alias("remaining"))


def reusable(pages: DataFrame, earlier: DataFrame, keys: list[str], same: list[str]) -> DataFrame:
    """pages with reuse: whether an earlier run has the page with all of same equal, nulls included."""
    e = earlier.select(*keys, *(F.col(c).alias(f"_{c}") for c in same), F.lit(True).alias("_there"))
    ok = F.col("_there")
    for c in same:
        ok = ok & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return pages.join(e, keys, "left").withColumn("reuse", F.coalesce(ok, F.lit(False))).drop("_there", *(f"_{c}" for c in same))


def same_extraction(pages: DataFrame, earlier: DataFrame, model: str) -> DataFrame:
    """pages with reuse: an earlier run of the page that agrees in page and document hash, prompt and schema with versions,
    and was read by the same model or recovered by local OCR."""
    same = ["page_sha256", "document_sha256", "prompt_name", "prompt_version", "schema_name", "schema_version"]
    judged = reusable(pages, earlier, ["book_id", "page_id"], same)
    by = earlier.select("book_id", "page_id", ((F.col("model") == model) | F.coalesce(F.col("recovery") == "local_ocr_recitation", F.lit(False))).alias("_by"))
    return judged.join(by, ["book_id", "page_id"], "left").withColumn("reuse", F.col("reuse") & F.coalesce("_by", F.lit(False))).drop("_by")


def page_from_reading(text: Column) -> Column:
    """Paragraphs (role, text) of plain recognised text: parts between blank lines, their lines joined by spaces; a part of up
    to four digits is a page number."""
    parts = F.filter(F.transform(F.split(text, r"\n[ \t\x0b\f\r]*\n\s*"), lambda p: F.array_join(F.filter(F.transform(F.split(p, "\n"), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+\z", "")), lambda x: x != ""), " ")), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(F.when(p.rlike(r"^\p{Nd}{1,4}\z"), "page_number").otherwise("paragraph").alias("role"), p.alias("text")))


def recovered(failed: DataFrame, readings: DataFrame, languages: DataFrame) -> DataFrame:
    """Pages that a provider wouldn't recite, made of a local reading: (book_id, page_id, blocks, language, warnings).

    failed (book_id, page_id, page_number, reason); readings (book_id, page_id, reading); languages (book_id, page_number,
    language) of the pages that were read, of which the nearest with a known language stands in, the lower one of two.
    """
    lost = failed.where("reason = 'recitation'").join(readings, ["book_id", "page_id"])
    known = languages.where("language is not null").select("book_id", F.col("page_number").alias("_at"), "language")
    # The nearest on either side: one merged order of both, no pairs of pages.
    both = lost.select("book_id", "page_number", F.lit(None).cast("string").alias("language"), F.lit(1).alias("_ask")).unionByName(known.select("book_id", F.col("_at").alias("page_number"), "language", F.lit(0).alias("_ask")))
    up, down = (Window.partitionBy("book_id").orderBy(o).rangeBetween(Window.unboundedPreceding, 0) for o in (F.asc("page_number"), F.desc("page_number")))
    here = F.when(F.col("language").isNotNull(), F.struct(F.col("page_number").alias("at"), "language"))
    sided = both.withColumn("_b", F.last(here, True).over(up)).withColumn("_a", F.last(here, True).over(down)).where("_ask = 1")
    lower = F.col("_a").isNull() | (F.col("page_number") - F.col("_b.at") <= F.col("_a.at") - F.col("page_number"))
    near = sided.select("book_id", "page_number", F.when(F.col("_b").isNotNull() & lower, F.col("_b.language")).otherwise(F.col("_a.language")).alias("language")).distinct()
    notes = F.array(F.lit("text recovered by local OCR after the provider declined to recite"), F.lit("typography and structure are unknown"))
    return lost.join(near, ["book_id", "page_number"], "left").select("book_id", "page_id", "page_number", page_from_reading(F.col("reading")).alias("blocks"), "language", notes.alias("warnings"))
