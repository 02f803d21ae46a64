"""Queries of the catalogue over the driver's tables, each next to the SQL with the same rows.

Stand-ins: a book is a source, a page a document, its number doc_id div 20 + 1, its blocks the lines of the text; the
first is the header and the last the footer. Events are marks in the order of a user's time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.functions import text as T
from folio.operators import analyzer as A
from folio.operators import contract as C
from folio.operators import findings as D
from folio.operators import review as V
from folio.operators import runtime as R
from folio.operators import windows as W

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.split("text", "\n")
    one = read(spark, sf_dir, "documents").select(F.col("source").alias("book"), F.col("doc_id").alias("page"), (F.floor(F.col("doc_id") / 20) + 1).alias("number"), "lang", F.size(lines).alias("n"), F.posexplode(lines).alias("seq", "text"))
    role = F.when(F.col("seq") == 0, "page_header").when(F.col("seq") == F.col("n") - 1, "page_footer").otherwise("paragraph")
    return one.withColumn("role", role)


_BLOCKS = """b0 AS (SELECT source AS book, doc_id AS page, doc_id // 20 + 1 AS number, lang, split(text, chr(10)) AS l FROM documents),
b AS (SELECT book, page, number, lang, len(l) AS n, unnest(range(len(l)))::INTEGER AS seq, unnest(l) AS text FROM b0),
blk AS (SELECT *, CASE WHEN seq = 0 THEN 'page_header' WHEN seq = n - 1 THEN 'page_footer' ELSE 'paragraph' END AS role FROM b)"""


@query("SELECT source AS book, count(*) AS pages, count(*) FILTER (WHERE length(trim(text)) = 0) AS blank, count(*) FILTER (WHERE n_chars BETWEEN 1 AND 500) AS short, count(*) FILTER (WHERE n_chars > 500) AS long FROM documents GROUP BY source")
def q01_page_composition(spark, d):
    return read(spark, d, "documents").groupBy(F.col("source").alias("book")).agg(F.count("*").alias("pages"), F.count_if(F.length(F.trim("text")) == 0).alias("blank"), F.count_if(F.col("n_chars").between(1, 500)).alias("short"), F.count_if(F.col("n_chars") > 500).alias("long"))


@query(f"WITH {_BLOCKS} SELECT page, seq, 'p' || page || ':block:' || printf('%04d', seq + 1) AS block_id, length(text) AS n_chars FROM blk")
def q02_block_ids(spark, d):
    return blocks(spark, d).select("page", "seq", T.block_id(F.concat(F.lit("p"), F.col("page").cast("string")), F.col("seq")).alias("block_id"), F.length("text").cast("long").alias("n_chars"))


_SQUEEZE = "trim(regexp_replace({0}, '[\\s\\v]+', ' ', 'g'))"
_FURNITURE = _BLOCKS + f""", f0 AS (SELECT book, page, role, {_SQUEEZE.format('text')} AS t, CASE page % 3 WHEN 0 THEN number::VARCHAR WHEN 1 THEN split_part({_SQUEEZE.format('text')}, ' ', 1) END AS printed FROM blk WHERE role <> 'paragraph'),
f1 AS (SELECT *, CASE WHEN coalesce(printed, '') = '' THEN t WHEN t = printed THEN '' WHEN starts_with(t, printed || ' ') THEN substr(t, length(printed) + 2) ELSE t END AS u FROM f0),
f2 AS (SELECT *, CASE WHEN coalesce(printed, '') = '' THEN u WHEN u = printed THEN '' WHEN ends_with(u, ' ' || printed) THEN substr(u, 1, length(u) - length(printed) - 1) ELSE u END AS norm FROM f1)"""


def _furniture(spark, d):
    """Headers and footers; every third page's printed number is the first word of the line, of others its number or none."""
    lines, n = F.split("text", "\n"), F.size(F.split("text", "\n"))
    end = lambda role, seq: F.struct(F.lit(role).alias("role"), seq.alias("seq"), F.get(lines, seq).alias("text"))
    first = end("page_header", F.lit(0))
    ends = F.when(n == 1, F.array(first)).when(n > 1, F.array(first, end("page_footer", n - 1)))
    one = read(spark, d, "documents").select(F.col("source").alias("book"), F.col("doc_id").alias("page"), (F.floor(F.col("doc_id") / 20) + 1).alias("number"), F.explode(ends).alias("e"))
    rows = one.select("book", "page", "number", "e.role", "e.seq", "e.text")
    t = T.collapse(F.col("text"))
    printed = F.when(F.col("page") % 3 == 0, F.col("number").cast("string")).when(F.col("page") % 3 == 1, F.get(F.split(t, " "), F.lit(0)))
    return rows.withColumn("printed", printed)


@query(f"""WITH {_FURNITURE}, r AS (SELECT book, role, replace(replace(lower(norm), 'ß', 'ss'), 'ς', 'σ') AS key FROM f2 WHERE norm <> '' GROUP BY ALL HAVING count(DISTINCT page) >= 2)
SELECT f2.book, f2.page, f2.role, r.key IS NOT NULL AS repeated FROM f2 LEFT JOIN r ON r.book = f2.book AND r.role = f2.role AND r.key = replace(replace(lower(norm), 'ß', 'ss'), 'ς', 'σ')""")
def q03_furniture_repeat(spark, d):
    f = _furniture(spark, d).select(F.col("book").alias("book_id"), F.lit(0).alias("page_index"), "seq", F.col("page").alias("page_id"), F.lit("").alias("block_id"), "role", "text", "printed")
    return A.furniture(f).select(F.col("book_id").alias("book"), F.col("page_id").alias("page"), "role", "repeated")


@query(f"WITH {_FURNITURE} SELECT page, role, norm AS stripped FROM f2")
def q04_strip_page_number(spark, d):
    return _furniture(spark, d).select("page", "role", T.without_page_number(T.collapse(F.col("text")), F.col("printed")).alias("stripped"))


def _edges(spark, d):
    b = blocks(spark, d).select("book", F.col("number").alias("page"), F.lit("paragraph").alias("role"), "text", F.col("lang").alias("language"), "seq", T.block_id(F.concat(F.lit("p"), F.col("page").cast("string")), F.col("seq")).alias("block_id"))
    return W.continuations(W.boundaries(b))


_EDGES = _BLOCKS + r""", e0 AS (SELECT book, number AS page, arg_max(struct_pack(t := text, l := lang, i := 'p' || page || ':block:' || printf('%04d', seq + 1)), seq) AS lft, arg_min(struct_pack(t := text, l := lang, i := 'p' || page || ':block:' || printf('%04d', seq + 1)), seq) AS rgt FROM blk GROUP BY ALL),
e1 AS (SELECT *, lead(page) OVER w AS np, lead(rgt) OVER w AS nx FROM (SELECT book, page, any_value(lft) AS lft, any_value(rgt) AS rgt FROM e0 GROUP BY book, page) WINDOW w AS (PARTITION BY book ORDER BY page)),
e AS (SELECT book, page, lft.i AS source_id, nx.i AS target_id, least(0.99::DOUBLE, 0.40::DOUBLE + CASE WHEN regexp_matches(lft.t, '[.!?…][\s"''”’)\]}]*$') THEN 0.0::DOUBLE ELSE 0.30::DOUBLE END + CASE WHEN regexp_matches(nx.t, '^[^\p{L}]*\p{Ll}') THEN 0.20::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN lft.l = nx.l THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END + 0.05::DOUBLE) AS confidence
  FROM e1 WHERE np = page + 1 AND trim(lft.t) <> '' AND trim(nx.t) <> '')"""


@query(f"WITH {_EDGES} SELECT * FROM e WHERE confidence >= 0.65")
def q05_continuation_candidates(spark, d):
    return _edges(spark, d)


@query(f"""WITH {_BLOCKS}, p AS (SELECT page, seq, text, lag(text) OVER (PARTITION BY page ORDER BY seq) AS pv FROM blk),
q AS (SELECT page, seq, (CASE WHEN pv IS NULL OR pv = '' OR text = '' OR regexp_matches(pv, '(\\s|[-‐‑­])$') OR regexp_matches(text, '^(\\s|[,.;:!?)\\]}}])') THEN '' ELSE ' ' END) || text AS piece FROM p)
SELECT page, count(*) AS parts, md5(string_agg(piece, '' ORDER BY seq)) AS text_md5 FROM q GROUP BY page""")
def q07_joined_text(spark, d):
    out = W.joined_text(blocks(spark, d).select("page", "seq", "text"), ["page"], "seq")
    return out.select("page", "parts", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query("""WITH r AS (SELECT user_id, event_id, ts, event_type, CASE WHEN event_type = lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) THEN 0 ELSE 1 END AS b FROM events),
s AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run_id FROM r)
SELECT user_id, run_id::BIGINT AS run_id, any_value(event_type) AS event_type, count(*) AS n FROM s GROUP BY user_id, run_id""")
def q08_runs_events(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = read(spark, d, "events").select("user_id", "ts", "event_id", "event_type")
    runs = W.islands(e, ["user_id"], ["ts", "event_id"], F.col("event_type") != F.lag("event_type").over(w))
    return runs.groupBy("user_id", "run_id").agg(F.first("event_type").alias("event_type"), F.count("*").alias("n"))


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_linestatus AS kind, CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_linenumber + (CASE WHEN l_partkey % 7 = 0 THEN 1 ELSE 0 END) END AS ordinal FROM lineitem),
r AS (SELECT *, CASE WHEN lag(kind) OVER w IS NULL OR kind <> lag(kind) OVER w OR (ordinal IS NOT NULL AND lag(ordinal) OVER w IS NOT NULL AND ordinal <> lag(ordinal) OVER w + 1) THEN 1 ELSE 0 END AS b FROM l WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice))
SELECT l_orderkey, sum(b)::BIGINT AS runs FROM r GROUP BY l_orderkey""")
def q09_ordinal_lists(spark, d):
    ordinal = F.when(F.col("l_partkey") % 5 != 0, F.col("l_linenumber") + F.when(F.col("l_partkey") % 7 == 0, 1).otherwise(0))
    items = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.col("l_linestatus").alias("kind"), ordinal.alias("ordinal"), F.lit(1).alias("page"))
    return W.list_runs(items, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]).groupBy("l_orderkey").agg(F.max("run_id").alias("runs"))


@query("""WITH r AS (SELECT source AS book, doc_id, CASE WHEN doc_id % 7 <> 0 THEN lang END AS l FROM documents),
s AS (SELECT *, last_value(l IGNORE NULLS) OVER (PARTITION BY book ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p, row_number() OVER (PARTITION BY book ORDER BY doc_id) AS i FROM r)
SELECT book, doc_id, sum(CASE WHEN i = 1 OR (l IS NOT NULL AND p IS NOT NULL AND l <> p) THEN 1 ELSE 0 END) OVER (PARTITION BY book ORDER BY doc_id)::BIGINT AS run_id FROM s""")
def q10_language_runs(spark, d):
    rows = read(spark, d, "documents").select(F.col("source").alias("book"), "doc_id", F.when(F.col("doc_id") % 7 != 0, F.col("lang")).alias("language"))
    return W.language_runs(rows, ["book"], ["doc_id"]).select("book", "doc_id", "run_id")


@query("""WITH r AS (SELECT user_id, event_id, 1 + coalesce(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS line_no FROM events)
SELECT user_id, line_no::BIGINT AS line_no, count(*) AS spans FROM r GROUP BY ALL""")
def q11_verse_lines(spark, d):
    spans = read(spark, d, "events").select("user_id", "ts", "event_id", (F.col("event_type") == "purchase").alias("break_after"))
    return W.verse_lines(spans, ["user_id"], ["ts", "event_id"]).groupBy("user_id", "line_no").agg(F.count("*").alias("spans"))


@query("""WITH r AS (SELECT event_id, CASE event_type WHEN 'view' THEN 'image' WHEN 'click' THEN 'caption' ELSE 'paragraph' END AS role, event_id % 4 <> 0 AS reg, user_id, ts FROM events),
s AS (SELECT *, lag(role) OVER w AS p, lead(role) OVER w AS n, lag(reg) OVER w AS pr FROM r WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, role, CASE WHEN role = 'image' THEN CASE WHEN NOT reg THEN 'unresolved' WHEN n = 'caption' THEN 'captioned' ELSE 'figure' END WHEN p = 'image' AND pr THEN 'caption' ELSE 'unresolved' END AS state FROM s WHERE role <> 'paragraph'""")
def q12_figure_captions(spark, d):
    role = F.when(F.col("event_type") == "view", "image").when(F.col("event_type") == "click", "caption").otherwise("paragraph")
    b = read(spark, d, "events").select("user_id", "ts", "event_id", role.alias("role"), (F.col("event_id") % 4 != 0).alias("has_region"))
    return W.figures(b, ["user_id"], ["ts", "event_id"]).where("role <> 'paragraph'").select("event_id", "role", "state")


@query("""WITH n AS (SELECT o_custkey AS page_id, o_orderkey % 9 AS label, min(o_orderkey) AS note_id FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL HAVING count(*) = 1)
SELECT o_orderkey AS ref_id, note_id, 1.0::DOUBLE AS confidence FROM orders JOIN n ON page_id = o_custkey AND label = o_orderkey % 9 WHERE o_orderstatus <> 'F'""")
def q13_footnote_links(spark, d):
    o = read(spark, d, "orders").select(F.col("o_custkey").alias("page_id"), (F.col("o_orderkey") % 9).alias("label"), "o_orderkey", "o_orderstatus")
    notes = o.where("o_orderstatus = 'F'").select("page_id", "label", F.col("o_orderkey").alias("note_id"))
    refs = o.where("o_orderstatus <> 'F'").select("page_id", "label", F.col("o_orderkey").alias("ref_id"))
    return W.footnote_links(refs, notes, ["page_id", "label"]).select("ref_id", "note_id", "confidence")


@query("""WITH r AS (SELECT conv_id, turn AS node_id, role, coalesce(lag(role) OVER w = 'user', FALSE) AS a, coalesce(lead(role) OVER w = 'user', FALSE) AS b, lag(turn) OVER w AS p, lead(turn) OVER w AS n FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, node_id, CASE WHEN a THEN p ELSE n END AS target_id, 0.95::DOUBLE AS confidence FROM r WHERE role = 'assistant' AND a <> b""")
def q14_attribution_neighbours(spark, d):
    nodes = read(spark, d, "conversations").select("conv_id", F.col("turn").alias("node_id"), "role")
    return W.attributions(nodes, ["conv_id"], ["node_id"], "assistant", ("user",))


@query("""WITH r AS (SELECT doc_id % 4 AS book, doc_id, lang, n_chars AS n, lag(doc_id) OVER w AS s, lag(lang) OVER w AS l, lag(n_chars) OVER w AS m FROM documents WINDOW w AS (PARTITION BY doc_id % 4 ORDER BY doc_id))
SELECT book, s AS source_id, doc_id AS target_id, 0.80::DOUBLE AS confidence FROM r WHERE lang <> l AND n > 0 AND m > 0 AND n >= 0.4::DOUBLE * m AND n <= 2.5::DOUBLE * m""")
def q15_translation_pairs(spark, d):
    nodes = read(spark, d, "documents").select((F.col("doc_id") % 4).alias("book"), F.col("doc_id").alias("node_id"), F.col("lang").alias("language"), F.col("n_chars").alias("n"))
    return W.translations(nodes, ["book"], ["node_id"])


@query("""WITH r AS (SELECT source AS book, doc_id, CASE WHEN doc_id % 3 <> 0 THEN lang END AS l FROM documents),
s AS (SELECT *, last_value(CASE WHEN l IS NOT NULL THEN doc_id END IGNORE NULLS) OVER (PARTITION BY book ORDER BY doc_id) AS bi, last_value(l IGNORE NULLS) OVER (PARTITION BY book ORDER BY doc_id) AS bl,
 first_value(CASE WHEN l IS NOT NULL THEN doc_id END IGNORE NULLS) OVER (PARTITION BY book ORDER BY doc_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ai, first_value(l IGNORE NULLS) OVER (PARTITION BY book ORDER BY doc_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS al FROM r)
SELECT book, doc_id, CASE WHEN bi IS NOT NULL AND (ai IS NULL OR doc_id - bi <= ai - doc_id) THEN bl ELSE al END AS nearest FROM s""")
def q16_nearest_language(spark, d):
    rows = read(spark, d, "documents").select(F.col("source").alias("book"), "doc_id", F.when(F.col("doc_id") % 3 != 0, F.col("lang")).alias("language"))
    return W.nearest_known(rows, ["book"], "doc_id", "language").select("book", "doc_id", "nearest")


@query("""WITH r AS (SELECT user_id, event_id, event_type, lag(event_type) OVER w = 'signup' AND lag(ts::DATE) OVER w = ts::DATE AS h, lag(event_id) OVER w AS p FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, CASE WHEN coalesce(h, FALSE) THEN p ELSE event_id END AS first_id, event_id, CASE WHEN coalesce(h, FALSE) THEN 0.90::DOUBLE ELSE 0.75::DOUBLE END AS confidence FROM r WHERE event_type = 'error'""")
def q17_inset_candidates(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    headed = F.coalesce((F.lag("event_type").over(w) == "signup") & (F.to_date(F.lag("ts").over(w)) == F.to_date("ts")), F.lit(False))
    rows = read(spark, d, "events").withColumn("headed", headed).withColumn("p", F.lag("event_id").over(w)).where("event_type = 'error'")
    return rows.select("user_id", F.when(F.col("headed"), F.col("p")).otherwise(F.col("event_id")).alias("first_id"), "event_id", F.when(F.col("headed"), 0.90).otherwise(0.75).alias("confidence"))


@query("""WITH n AS (SELECT DISTINCT source, doc_id // 20 AS n FROM documents JOIN labels USING (doc_id) WHERE quality = 1), g AS (SELECT *, n - row_number() OVER (PARTITION BY source ORDER BY n) AS g FROM n),
r AS (SELECT source, min(n) AS a, max(n) AS b FROM g GROUP BY source, g) SELECT source, string_agg(CASE WHEN a = b THEN a::VARCHAR ELSE a || '-' || b END, ',' ORDER BY a) AS ranges FROM r GROUP BY source""")
def q18_page_range_format(spark, d):
    n = read(spark, d, "documents").join(read(spark, d, "labels").where("quality = 1"), "doc_id").select("source", F.floor(F.col("doc_id") / 20).alias("n"))
    return W.number_ranges(n, ["source"], "n")


@query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND toxic = 1)")
def q19_page_exclusion(spark, d):
    return read(spark, d, "documents").select("doc_id", "source").join(read(spark, d, "labels").where("toxic = 1").select("doc_id"), "doc_id", "left_anti")


_MESSAGES = ("Daily limit", "limit", "quota PerDayPerProject", "30 requests per minute", "per-day cap", "requests_per_day")
_STATUS = (429, 408, 500, 501, 503, 401, 403, 400, 200, 505, 504)
_ERRORS = (None, None, None, "recitation", "invalid_response", "missing_asset", "provider_setup", "other")


@query(f"""WITH r AS (SELECT event_id, {list(_STATUS)}[event_id % 11 + 1] AS s, {list(_MESSAGES)}[event_id % 6 + 1] AS m, {[e or "" for e in _ERRORS]}[event_id % 8 + 1] AS e FROM events)
SELECT event_id, CASE WHEN e IN ('missing_asset', 'provider_setup') THEN 'configuration' WHEN e = 'recitation' THEN 'recitation' WHEN e = 'invalid_response' THEN 'invalid_output' WHEN e = 'other' THEN 'unknown'
 WHEN s = 429 AND regexp_matches(lower(m), 'daily|per[ -]day|requests_per_day|requestsperday|perdayperproject') THEN 'quota_exhausted' WHEN s = 429 THEN 'rate_limit' WHEN s IN (408, 500, 502, 503, 504) THEN 'transient'
 WHEN s = 401 THEN 'authentication' WHEN s = 403 THEN 'permission' WHEN s = 400 THEN 'invalid_request' ELSE 'unknown' END AS kind FROM r""")
def q22_failure_classifier(spark, d):
    pick = lambda values: F.get(F.array(*map(F.lit, values)), (F.col("event_id") % len(values)).cast("int"))
    return read(spark, d, "events").select("event_id", R.failure_kind(pick(_STATUS), pick(_MESSAGES), pick(_ERRORS)).alias("kind"))


@query("WITH r AS (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events WHERE event_type = 'error') SELECT event_id, k::INTEGER AS attempt, greatest(least(1.0::DOUBLE * pow(2.0, k - 1), 8.0), CASE WHEN event_id % 5 = 0 THEN 5.5::DOUBLE ELSE 0.0 END) AS delay FROM r")
def q23_retry_delay(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = read(spark, d, "events").where("event_type = 'error'").withColumn("attempt", F.row_number().over(w))
    return e.select("event_id", "attempt", R.retry_delay(F.col("attempt"), hint=F.when(F.col("event_id") % 5 == 0, 5.5)).alias("delay"))


@query("""WITH a AS (SELECT doc_id, sha256(text) AS h, CASE WHEN doc_id % 6 <> 0 THEN lang END AS m FROM documents), b AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN sha256(text || '!') ELSE sha256(text) END AS h, CASE WHEN doc_id % 12 <> 0 THEN lang END AS m FROM documents WHERE doc_id % 5 <> 0)
SELECT a.doc_id, coalesce(b.doc_id IS NOT NULL AND a.h IS NOT DISTINCT FROM b.h AND a.m IS NOT DISTINCT FROM b.m, FALSE) AS reuse FROM a LEFT JOIN b ON a.doc_id = b.doc_id""")
def q24_reuse_check(spark, d):
    docs = read(spark, d, "documents")
    a = docs.select("doc_id", F.sha2("text", 256).alias("h"), F.when(F.col("doc_id") % 6 != 0, F.col("lang")).alias("m"))
    b = docs.where("doc_id % 5 <> 0").select("doc_id", F.sha2(F.when(F.col("doc_id") % 4 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")), 256).alias("h"), F.when(F.col("doc_id") % 12 != 0, F.col("lang")).alias("m"))
    return R.reusable(a, b, ["doc_id"], ["h", "m"]).select("doc_id", "reuse")


@query("""SELECT state, count(*) AS pages FROM (SELECT CASE WHEN l.doc_id IS NULL THEN 'not_reviewed' WHEN d.doc_id % 11 = 0 THEN 'stale' WHEN toxic = 0 AND quality = 1 THEN 'pass' WHEN toxic = 1 AND d.doc_id % 3 = 0 THEN 'stale' WHEN quality = 1 THEN 'resolved' ELSE 'needs_review' END AS state FROM documents d LEFT JOIN labels l USING (doc_id)) GROUP BY state""")
def q25_review_status(spark, d):
    r = read(spark, d, "documents").select("doc_id").join(read(spark, d, "labels").select("doc_id", "quality", "toxic", F.lit(True).alias("there")), "doc_id", "left")
    findings = F.when((F.col("toxic") == 0) & (F.col("quality") == 1), 0).otherwise(1)
    unknown = F.when((F.col("toxic") == 1) & (F.col("doc_id") % 3 == 0), 1).otherwise(0)
    state = V.review_state(F.coalesce("there", F.lit(False)), F.col("doc_id") % 11 != 0, findings, unknown, F.when(F.col("quality") == 1, 0).otherwise(1))
    return r.groupBy(state.alias("state")).agg(F.count("*").alias("pages"))


@query(rf"SELECT doc_id, len(regexp_extract_all(text, '\p{{L}}{D.digit_class()}')) AS letter_digit, len(regexp_extract_all(text, '\p{{Ll}}\.\p{{Lu}}')) AS sentence_joint FROM documents")
def q26_suspicious_boundaries(spark, d):
    return read(spark, d, "documents").select("doc_id", F.regexp_count("text", F.lit(r"\p{L}" + D.digits())).cast("long").alias("letter_digit"), F.regexp_count("text", F.lit(r"\p{Ll}\.\p{Lu}")).cast("long").alias("sentence_joint"))


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, ['replacement', 'punctuation', 'character'][l_partkey % 3 + 1] AS kind, ['heading', 'paragraph', 'other'][l_suppkey % 3 + 1] AS role, CASE WHEN l_partkey % 4 = 0 THEN 'ab' ELSE 'abcd' END AS t, CASE WHEN l_suppkey % 10 <> 0 THEN 80 + l_quantity % 20 END AS c, l_partkey % 13 = 0 AS cov, l_partkey % 17 = 0 AS dia FROM lineitem),
s AS (SELECT *, greatest(85, CASE WHEN role IN ('heading', 'other') THEN 92 ELSE 0 END, CASE WHEN kind = 'punctuation' THEN 95 ELSE 0 END, CASE WHEN length(t) <= 2 THEN 97 ELSE 0 END) AS need FROM r)
SELECT kind, role, CASE WHEN cov THEN 'covered_by_heuristic' WHEN dia THEN 'ocr_diacritic_loss' WHEN c IS NULL THEN NULL WHEN c < need THEN 'ocr_confidence_below_' || need END AS reason, count(*) AS n FROM s GROUP BY ALL""")
def q27_filter_cascade(spark, d):
    kind = F.get(F.array(*map(F.lit, ("replacement", "punctuation", "character"))), (F.col("l_partkey") % 3).cast("int"))
    role = F.get(F.array(*map(F.lit, ("heading", "paragraph", "other"))), (F.col("l_suppkey") % 3).cast("int"))
    r = read(spark, d, "lineitem").select(kind.alias("kind"), role.alias("role"), F.when(F.col("l_partkey") % 4 == 0, "ab").otherwise("abcd").alias("t"), F.when(F.col("l_suppkey") % 10 != 0, 80 + F.col("l_quantity") % 20).alias("c"), "l_partkey")
    reason = V.suppression(F.col("l_partkey") % 13 == 0, F.col("l_partkey") % 17 == 0, F.col("c"), V.needed_confidence(F.col("kind"), F.col("role"), F.col("t")))
    return r.groupBy("kind", "role", reason.alias("reason")).agg(F.count("*").alias("n"))


def _words(spark, d):
    w = read(spark, d, "documents").select(F.col("doc_id").alias("page_id"), F.posexplode(F.split("text", r"[ \n]")).alias("word_no", "word")).where("word <> ''")
    return V.word_offsets(w, ["page_id"], "word_no").withColumn("confidence", ((F.col("page_id") + F.col("word_no") * 7) % 100).cast("double"))


_WORDS = r"""w0 AS (SELECT doc_id AS page_id, string_split_regex(text, '[ \n]') AS l FROM documents), w1 AS (SELECT page_id, unnest(range(len(l)))::INTEGER AS word_no, unnest(l) AS word FROM w0),
w2 AS (SELECT *, lag(word) OVER (PARTITION BY page_id ORDER BY word_no) AS p FROM w1 WHERE word <> ''),
w3 AS (SELECT *, sum(length(word) + CASE WHEN p IS NULL OR contains('.,;:!?%)]}»”’', word[1]) OR contains('([{«“‘', p[-1]) THEN 0 ELSE 1 END) OVER (PARTITION BY page_id ORDER BY word_no)::INTEGER AS "end" FROM w2),
w AS (SELECT page_id, word_no, word, "end" - length(word)::INTEGER AS start, "end", ((page_id + word_no * 7) % 100)::DOUBLE AS confidence FROM w3)"""


@query(f'WITH {_WORDS} SELECT page_id, word_no, start::INTEGER AS start, "end" FROM w')
def q28_word_offsets(spark, d):
    return _words(spark, d).select("page_id", "word_no", "start", "end")


#: Places all over the texts; some findings are empty ranges, and some of no known block.
_FIND = "f AS (SELECT doc_id AS page_id, doc_id AS finding_id, (doc_id * 7919 % greatest(length(text), 1))::INTEGER AS start, (doc_id * 7919 % greatest(length(text), 1) + doc_id % 9)::INTEGER AS \"end\", CASE WHEN doc_id % 3 > 0 THEN 'b' || doc_id % 3 END AS block_id FROM documents)"


def _findings(spark, d):
    at = (F.col("doc_id") * 7919 % F.greatest(F.length("text"), F.lit(1))).cast("int")
    block = F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("b"), (F.col("doc_id") % 3).cast("string")))
    return read(spark, d, "documents").select(F.col("doc_id").alias("page_id"), F.col("doc_id").alias("finding_id"), at.alias("start"), (at + F.col("doc_id") % 9).cast("int").alias("end"), block.alias("block_id"))


@query(f"""WITH {_WORDS}, {_FIND}, g AS (SELECT *, greatest("end", start + 1) AS e FROM f),
a AS (SELECT g.page_id, g.finding_id, min(w.confidence) FILTER (WHERE w."end" > g.start AND w.start < g.e) AS c,
 arg_max(w.confidence, w."end") FILTER (WHERE w."end" <= g.start AND g.start - w."end" <= 2) AS b, arg_min(w.confidence, w.start) FILTER (WHERE w.start >= g."end" AND w.start - g."end" <= 2) AS n FROM g LEFT JOIN w ON w.page_id = g.page_id GROUP BY ALL)
SELECT page_id, finding_id, coalesce(c, least(b, n)) AS confidence FROM a""")
def q29_interval_confidence(spark, d):
    return V.supported(_findings(spark, d), _words(spark, d)).select("page_id", "finding_id", "confidence")


@query(f"""WITH {_WORDS}, {_FIND} SELECT f.page_id, f.finding_id FROM f WHERE EXISTS (SELECT 1 FROM w WHERE w.page_id = f.page_id AND f.start < greatest(w."end", w.start + 1) AND greatest(f."end", f.start + 1) > w.start AND coalesce(CASE WHEN w.start % 3 > 0 THEN 'b' || w.start % 3 END = f.block_id, TRUE))""")
def q30_overlap_semijoin(spark, d):
    return V.covered(_findings(spark, d), _words(spark, d).select("page_id", "start", "end", F.when(F.col("start") % 3 > 0, F.concat(F.lit("b"), (F.col("start") % 3).cast("string"))).alias("block_id"))).select("page_id", "finding_id")


@query("""WITH e AS (SELECT doc_id, text, length(text) AS n FROM documents)
SELECT doc_id, md5(CASE WHEN n < 4 THEN text ELSE substr(text, 1, n // 4) || 'X' || substr(text, n // 4 + 2, n // 2 - n // 4 - 1) || substr(text, n - n // 4 + 1) END) AS corrected FROM e""")
def q31_corrections_overlay(spark, d):
    n = F.length("text")
    part = lambda k: F.floor(n / k).cast("int")
    edit = lambda a, b, r: F.struct(a.alias("start"), b.alias("end"), F.lit(r).alias("replacement"))
    edits = F.when(n >= 4, F.array(edit(part(2), (n - part(4)).cast("int"), ""), edit(part(4), part(4) + 1, "X"))).otherwise(F.array().cast("array<struct<start:int,end:int,replacement:string>>"))
    return read(spark, d, "documents").select("doc_id", F.md5(V.with_corrections(F.col("text"), edits).cast("binary")).alias("corrected"))


def _headings(spark, d):
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", (F.col("l_quantity").cast("int") % 6 + 1).alias("level"))


@query("""WITH h AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity::INTEGER % 6 + 1 AS level, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS n FROM lineitem)
SELECT l_orderkey, l_linenumber, level::INTEGER AS level, (n + least(0, min(greatest(level, 1) - n) OVER (PARTITION BY l_orderkey ORDER BY n)))::INTEGER AS depth FROM h""")
def q33_toc_depth(spark, d):
    return W.toc_depth(_headings(spark, d), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]).select("l_orderkey", "l_linenumber", "level", "depth")


@query("""WITH r AS (SELECT user_id, event_id, ts, event_type = 'error' AS lab, event_type IN ('purchase', 'signup') AS st FROM events), s AS (SELECT *, CASE WHEN row_number() OVER w = 1 OR lab OR (st AND NOT lag(lab) OVER w) THEN 1 ELSE 0 END AS cut FROM r WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, event_id, sum(cut) OVER (PARTITION BY user_id ORDER BY ts, event_id)::BIGINT AS chunk_id FROM s""")
def q34_spine_chunks(spark, d):
    e = read(spark, d, "events").select("user_id", "ts", "event_id", "event_type")
    return W.spine_cuts(e, ["user_id"], ["ts", "event_id"], F.col("event_type") == "error", F.col("event_type").isin("purchase", "signup")).select("user_id", "event_id", "chunk_id")


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, l_linestatus, l_partkey, l_partkey % 3 = 0 AS p, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS i, CASE WHEN l_linestatus = lag(l_linestatus) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) THEN 0 ELSE 1 END AS b FROM lineitem),
s AS (SELECT *, sum(b) OVER (PARTITION BY l_orderkey ORDER BY i) AS run FROM r),
t AS (SELECT *, sum(p::INT) OVER (PARTITION BY l_orderkey, run ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) <= 1 AS ins, sum(p::INT) OVER (PARTITION BY l_orderkey, run) AS al FROM s)
SELECT l_orderkey, l_linenumber, al >= 1 AND ins AND sum(ins::INT) OVER (PARTITION BY l_orderkey, run) >= 2 AS grouped FROM t""")
def q35_heading_groups(spark, d):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    rows = W.islands(read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_linestatus"), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], F.col("l_linestatus") != F.lag("l_linestatus").over(w))
    return W.heading_groups(rows, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], F.col("l_partkey") % 3 == 0).select("l_orderkey", "l_linenumber", "grouped")


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 3 <> 0 THEN l_linenumber + l_partkey % 2 END AS o, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS i FROM lineitem),
s AS (SELECT *, last_value(CASE WHEN o IS NOT NULL THEN o - i END IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS k FROM r)
SELECT l_orderkey, l_linenumber, CASE WHEN o IS NOT NULL AND k IS NOT NULL AND o <> k + i THEN o END AS value FROM s""")
def q36_list_ordinals(spark, d):
    items = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.when(F.col("l_partkey") % 3 != 0, F.col("l_linenumber") + F.col("l_partkey") % 2).alias("ordinal"))
    return W.list_ordinals(items, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]).select("l_orderkey", "l_linenumber", "value")


@query("SELECT page_id, replace(replace(replace(replace(replace(t, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), chr(39), '&#x27;') AS title FROM (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS t FROM pages)")
def q38_title_escape(spark, d):
    return read(spark, d, "pages").select("page_id", T.escape_markup(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("title"))


@query("SELECT event_type AS category, count(*) FILTER (WHERE value >= 50) AS passed, count(*) AS total, bool_and(coalesce(value >= 50, FALSE)) AS all_passed FROM events GROUP BY event_type")
def q40_category_counts(spark, d):
    ok = F.coalesce(F.col("value") >= 50, F.lit(False))
    return read(spark, d, "events").groupBy(F.col("event_type").alias("category")).agg(F.count_if(ok).alias("passed"), F.count("*").alias("total"), F.bool_and(ok).alias("all_passed"))


@query("SELECT c_custkey, coalesce(s_name, c_name) AS name, coalesce(CASE WHEN c_custkey % 2 = 0 THEN s_nationkey END, c_nationkey) AS nation FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey")
def q41_metadata_merge(spark, d):
    c, s = read(spark, d, "customer"), read(spark, d, "supplier")
    return c.join(s, c["c_custkey"] == s["s_suppkey"], "left").select("c_custkey", F.coalesce("s_name", "c_name").alias("name"), F.coalesce(F.when(F.col("c_custkey") % 2 == 0, F.col("s_nationkey")), F.col("c_nationkey")).alias("nation"))


@query()
def q42_diff_ratio(spark, d):
    """Each text against itself as if badly read; tests hold the operator against the standard library."""
    misread = F.replace(F.replace("text", F.lit(" the "), F.lit(" tho ")), F.lit(", "), F.lit(" "))
    return D.compared(read(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("mine"), misread.alias("other")))


@query("SELECT sha256(text) AS hash, count(*) AS copies, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1")
def q45_dedup_errors(spark, d):
    return read(spark, d, "documents").groupBy(F.sha2("text", 256).alias("hash")).agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id")).where("copies > 1")


@query("SELECT event_id, CASE WHEN NOT list_contains(json_keys(props), 'k') THEN 1 ELSE 0 END + CASE WHEN len(list_filter(json_keys(props), lambda x: x <> 'k')) > 0 THEN len(list_filter(json_keys(props), lambda x: x <> 'k')) ELSE 0 END + CASE WHEN list_contains(json_keys(props), 'k') AND json_type(props, '$.k') NOT IN ('UBIGINT', 'BIGINT') THEN 1 ELSE 0 END AS violations FROM events")
def q43_contract_violations(spark, d):
    return read(spark, d, "events").select("event_id", F.size(C.violations(F.col("props"), {"k": "BIGINT|INT|SMALLINT|TINYINT"})).cast("long").alias("violations"))
