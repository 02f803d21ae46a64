"""Operators against sequential restatements of their rules."""

import random
from difflib import SequenceMatcher

from pyspark.sql import Row
from pyspark.sql import functions as F

from folio.functions import text as T
from folio.operators import contract as C
from folio.operators import findings as D
from folio.operators import review as V
from folio.operators import runtime as R
from folio.operators import windows as W


def one(spark, column, **values):
    return spark.createDataFrame([Row(**values)]).select(column.alias("x")).first().x


def test_sentence_ends_and_starts(spark):
    assert one(spark, T.ends_sentence(F.col("t")), t="He said “no.” ")
    assert not one(spark, T.ends_sentence(F.col("t")), t="and then,")
    assert one(spark, T.starts_lower(F.col("t")), t="“…and")
    assert not one(spark, T.starts_lower(F.col("t")), t="12 And")


def test_text_functions(spark):
    assert one(spark, T.collapse(F.col("t")), t="  a\n\n b ") == "a b"
    assert one(spark, T.footnote_label(F.col("t")), t=" [12.] ") == "12"
    assert one(spark, T.footnote_label(F.col("t")), t="th") is None
    assert one(spark, T.without_page_number(F.col("t"), F.lit(12)), t="12 The book") == "The book"
    assert one(spark, T.without_page_number(F.col("t"), F.lit(12)), t="The book 112") == "The book 112"
    for text, left in (("12  Title", "Title"), ("12\tTitle", "Title"), ("Title 12", "Title"), ("12", ""), ("12 12", ""), ("Title12", "Title12"), ("A.B 1.2", "A.B 1.2")):
        assert one(spark, T.without_page_number(T.collapse(F.col("t")), F.lit(" 12 ")), t=text) == left
    assert one(spark, T.without_page_number(F.col("t"), F.lit(r"\E.")), t=r"\E. x") == "x" and one(spark, T.without_page_number(F.col("t"), F.lit(None)), t="12 x") == "12 x"
    for text, label in (("{3}", "3"), ("(a).", None), ("(a.)", "a"), (" †† ", "††"), ("1234", None), ("", None), ("É", None)):
        assert one(spark, T.footnote_label(F.col("t")), t=text) == label
    assert one(spark, T.fold(F.col("t")), t="STRAßE ΣΑΣ") == one(spark, T.fold(F.col("t")), t="strasse σας")
    assert one(spark, T.without_markup_stars(F.col("t")), t="**_x_**") == "x"
    for text, left in (("***", "*"), ("**a*", "*a"), ("__", "__"), ("*a\nb*", "a\nb"), ("_*_x_*_", "_x_")):
        assert one(spark, T.without_markup_stars(F.col("t")), t=text) == left
    assert one(spark, T.block_id(F.col("t"), F.lit(12345)), t="p") == "p:block:12346"
    assert one(spark, T.escape_markup(F.col("t")), t='<a b="&">') == "&lt;a b=&quot;&amp;&quot;&gt;"


def test_depth_follows_the_stack_rule(spark):
    rng = random.Random(1)
    rows = [(b, i, rng.randint(-1, 6)) for b in range(40) for i in range(rng.randint(1, 12))]
    got = {(r.b, r.i): r.depth for r in W.toc_depth(spark.createDataFrame(rows, "b int, i int, level int"), ["b"], ["i"]).collect()}
    depth = {}
    for b, i, level in rows:
        before = depth.get((b, i - 1), 0)
        depth[b, i] = min(max(1, level), before + 1)
    assert got == depth


def test_list_runs(spark):
    rng = random.Random(2)
    rows = [(b, i, rng.choice("ou"), 1 + i // 3 * rng.choice([1, 1, 2]), rng.choice([None, i, i + 1])) for b in range(30) for i in range(10)]
    got = {(r.b, r.i): r.run_id for r in W.list_runs(spark.createDataFrame(rows, "b int, i int, kind string, page int, ordinal int"), ["b"], ["i"]).collect()}
    run, before = {}, None
    for b, i, kind, page, ordinal in rows:
        if before is None or before[0] != b:
            run[b, i] = 1
        else:
            cut = kind != before[2] or page - before[3] > 1 or (ordinal is not None and before[4] is not None and ordinal != before[4] + 1)
            run[b, i] = run[b, i - 1] + cut
        before = (b, i, kind, page, ordinal)
    assert got == run


def test_continuation_scores(spark):
    rows = [("b", 1, 0, "paragraph", "and so", "en", "a"), ("b", 2, 0, "paragraph", "it went", "en", "c"), ("b", 3, 0, "paragraph", "It ended.", "en", "d"), ("b", 5, 0, "paragraph", "it", "en", "e"), ("b", 2, 1, "footnote", "note.", "en", "f")]
    got = {(r.source_id, r.target_id): r.confidence for r in W.continuations(W.boundaries(spark.createDataFrame(rows, "book string, page int, seq int, role string, text string, language string, block_id string"))).collect()}
    assert got == {("a", "c"): 0.99, ("c", "d"): 0.40 + 0.30 + 0.0 + 0.05 + 0.05}


def test_joined_text(spark):
    rows = [(1, i, t) for i, t in enumerate(["well-", "known", "fact", ", said"])]
    assert W.joined_text(spark.createDataFrame(rows, "k int, i int, text string"), ["k"], "i").first().text == "well-known fact, said"


def test_number_ranges(spark):
    rows = [(1, n) for n in (9, 3, 7, 8, 8)]
    assert W.number_ranges(spark.createDataFrame(rows, "k int, n int"), ["k"], "n").first().ranges == "3,7-9"


def test_review_rules(spark):
    kind = lambda a, b: one(spark, V.difference_kind(F.col("a"), F.col("b")), a=a, b=b)
    assert [kind("a b", "ab"), kind("", "x"), kind("x", ""), kind(",", "."), kind("ab", "c"), kind("abc", "xyz")] == ["whitespace", "missing_text", "extra_text", "punctuation", "character", "replacement"]
    edits = spark.createDataFrame([("abcdef", [(1, 2, "XY"), (4, 6, "")])], "t string, e array<struct<start:int,end:int,replacement:string>>")
    assert edits.select(V.with_corrections(F.col("t"), F.col("e")).alias("x")).first().x == "aXYcd"


def test_word_separators(spark):
    """A space goes in by the first character of a word and the last of the one before."""
    words = ["foo(", "bar", "50", "%", "«", "oui", "»", "a", "?!", "“b”", "c"]
    rows = [("p", i, w) for i, w in enumerate(words)]
    got = V.word_offsets(spark.createDataFrame(rows, "page_id string, n int, word string"), ["page_id"], "n").orderBy("n").collect()
    text = "foo(bar 50% «oui» a?! “b” c"
    assert [text[r.start : r.end] for r in got] == words and got[-1].end == len(text)


def test_failure_kinds(spark):
    cases = [(429, "Requests PER DAY", None, "quota_exhausted"), (429, "per minute", None, "rate_limit"), (503, "", None, "transient"), (501, "", None, "unknown"), (None, None, "recitation", "recitation"), (None, None, "invalid_response", "invalid_output"), (None, None, "provider_setup", "configuration"), (400, "", None, "invalid_request"), (429, None, None, "rate_limit"), (None, None, None, "unknown")]
    df = spark.createDataFrame([(*c, i) for i, c in enumerate(cases)], "s int, m string, e string, want string, i int")
    assert all(r.want == r.got for r in df.select("want", R.failure_kind(F.col("s"), F.col("m"), F.col("e")).alias("got")).collect())
    ends = spark.createDataFrame([("a", [("timeout",), ("permission",)]), ("b", [("permission",), ("transient",)]), ("c", [])], "k string, a array<struct<reason:string>>")
    assert [r.x for r in ends.orderBy("k").select(R.stops_run(F.col("a")).alias("x")).collect()] == [True, False, False]


def test_kinds_of_spaces(spark):
    kind = lambda a, b: one(spark, V.difference_kind(F.col("a"), F.col("b")), a=a, b=b)
    assert [kind(" ", ","), kind(" ", ""), kind("", "  "), kind(", .", ";")] == ["character", "whitespace", "whitespace", "punctuation"]


def test_compared_is_difflib(spark):
    pairs = [("1", "the quick brown fox", "the quack brown box"), ("2", "", "a"), ("3", "same", "same")]
    got = {r.id: r for r in D.compared(spark.createDataFrame(pairs, "id string, mine string, other string")).collect()}
    for i, a, b in pairs:
        assert got[i].ratio == SequenceMatcher(None, a, b, autojunk=False).ratio()
    assert len(got["1"].groups) == 1 and got["3"].groups == []


def test_routing(spark):
    tasks = spark.createDataFrame([("t",), ("u",), ("v",)], "task_id string")
    routes = spark.createDataFrame([("free", 1, 3), ("paid", 2, 2)], "route string, position int, max_attempts int")
    script = [("t", "free", 1, False, "transient"), ("t", "free", 2, True, None), ("t", "free", 3, True, None), ("u", "free", 1, False, "quota_exhausted"), ("u", "free", 2, True, None), ("u", "paid", 1, True, None), ("v", "free", 1, False, "invalid_request"), ("v", "paid", 1, True, None)]
    got = R.routed(tasks, spark.createDataFrame(script, "task_id string, route string, attempt int, ok boolean, kind string"), routes).orderBy("task_id", "position", "attempt").collect()
    assert [(r.task_id, r.route, r.attempt) for r in got] == [("t", "free", 1), ("t", "free", 2), ("u", "free", 1), ("u", "paid", 1), ("v", "free", 1)]


def test_contract(spark):
    rows = [('{"k": 1}',), ('{"k": true}',), ('{"k": 1, "x": 2}',), ("{}",), ("[1",)]
    got = [r.v for r in spark.createDataFrame(rows, "j string").select(C.violations(F.col("j"), {"k": "BIGINT"}).alias("v")).collect()]
    assert got == [[], ["type k"], ["extra x"], ["missing k"], ["not an object"]]


def test_support_of_ranges(spark):
    """The least of what overlaps, a range being one wide at least; else the nearest within 2 before the start and behind the end."""
    words = spark.createDataFrame([("p", 0, 5, 90.0), ("p", 6, 9, 40.0), ("p", 20, 24, 70.0), ("q", 0, 40, 1.0)], "page_id string, start int, end int, confidence double")
    places = [(3, 7), (5, 5), (9, 9), (11, 12), (12, 12), (17, 17), (18, 18), (18, 19), (22, 22), (26, 30), (27, 30), (None, None), (0, 40)]
    found = spark.createDataFrame([("p", i, a, b) for i, (a, b) in enumerate(places)], "page_id string, finding_id int, start int, end int")
    got = {places[r.finding_id]: r.confidence for r in V.supported(found, words).collect()}
    ws = [(0, 5, 90.0), (6, 9, 40.0), (20, 24, 70.0)]
    for (a, b), c in got.items():
        if a is None:
            assert c is None
            continue
        near = [w[2] for w in ws if w[1] > a and w[0] < max(b, a + 1)]
        if not near:
            before, after = max((w for w in ws if w[1] <= a), key=lambda w: w[1], default=None), min((w for w in ws if w[0] >= b), key=lambda w: w[0], default=None)
            near = [w[2] for w, gap in ((before, a - before[1] if before else 9), (after, after[0] - b if after else 9)) if w and gap <= 2]
        assert c == (min(near) if near else None), (a, b)


def test_cover_needs_one_block(spark):
    rows = lambda *r: spark.createDataFrame([(i, "p", a, b, k) for i, (a, b, k) in enumerate(r)], "finding_id int, page_id string, start int, end int, block_id string")
    mine = rows((0, 4, "a"), (0, 4, "b"), (0, 4, None), (0, 4, ""), (6, 6, "a"), (5, 5, "a"))
    assert sorted(r.finding_id for r in V.covered(mine, rows((3, 5, "a"), (6, 7, ""))).collect()) == [0, 2, 3, 4]


def test_digits_behind_letters(spark):
    texts = {"word¹ x²": [4, 7], "a1 b① c٣ d½ e⅓": [1, 4, 7], "end.Start ok.no": [4], "x": [], "": [], "H₂O": [1]}
    want = lambda t: [i for i in range(1, len(t)) if t[i - 1].isalpha() and t[i].isdigit() or i >= 2 and t[i - 1] == "." and t[i - 2].islower() and t[i].isupper()]
    assert all(want(t) == v for t, v in texts.items())
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: r.p for r in rows.select("t", D.boundary_places(F.col("t")).alias("p")).collect()} == texts


def frames(df):
    return df._jdf.queryExecution().analyzed().toString().lower()


def test_nearest_known_reads_each_row_once(spark):
    data = [("a", 1, None), ("a", 2, "x"), ("a", 4, None), ("a", 6, "y"), ("a", 7, None), ("a", 7, "z"), ("a", 9, None), ("b", 1, None)]
    out = W.nearest_known(spark.createDataFrame(data, "book string, at int, v string"), ["book"], "at", "v")
    # A frame that reaches to the end is read anew for each row, which takes time with the square of a book.
    assert "unboundedfollowing" not in frames(out)
    got = sorted((r.book, r.at, r.v, r.nearest) for r in out.fillna("-", ["v"]).collect())
    assert got == [("a", 1, "-", "x"), ("a", 2, "x", "x"), ("a", 4, "-", "x"), ("a", 6, "y", "y"), ("a", 7, "-", "z"), ("a", 7, "z", "z"), ("a", 9, "-", "z"), ("b", 1, "-", None)]


def test_recovered_language_reads_each_row_once(spark):
    lost = spark.createDataFrame([("a", "p3", 3, "recitation"), ("a", "p6", 6, "recitation"), ("b", "p1", 1, "recitation")], "book_id string, page_id string, page_number long, reason string")
    readings = lost.select("book_id", "page_id", F.lit("x").alias("reading"))
    known = spark.createDataFrame([("a", 1, "en"), ("a", 5, "de"), ("a", 8, "fr")], "book_id string, page_number long, language string")
    out = R.recovered(lost, readings, known)
    assert "unboundedfollowing" not in frames(out)
    assert sorted((r.page_id, r.language) for r in out.fillna("-", ["language"]).collect()) == [("p1", "-"), ("p3", "en"), ("p6", "de")]
