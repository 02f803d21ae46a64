"""Documents as JSON both ways, reports, the review cache, folding and paths."""

import json
import posixpath
import random
import sys

from pyspark.sql import functions as F
from test_books import block, pages, payload, span
from test_cli import runs

from folio import cli
from folio.functions import text as T
from folio.operators import analyzer as A
from folio.operators import buildmanifest as B
from folio.operators import documents as D
from folio.operators import packaging as K
from folio.operators import report as P
from folio.operators import reviewcache as C


def test_documents_there_and_back(spark):
    note = block("footnote", span("1", vertical_position="superscript"), span('é "q" <b>'))
    box = {"x": 0.0, "y": 0.25, "width": 1.0, "height": 0.5}
    book = [
        (1, payload(block("heading", "Title", level=2, heading="chapter_title"), block("paragraph", "One.", span("1", vertical_position="superscript")), note, block("quote", "a"), block("attribution", "by b"))),
        (2, payload(block("image", region=box), block("caption", "under"), block("verse", span("l", br=True), "m"), block("list_item", "x", marker={"kind": "numeric", "raw_text": "1.", "ordinal": 1}), block("list_item", "y"))),
        (3, payload(block("image", region=box), block("heading", "No level"), block("footnote", "no label"))),
    ]
    made = A.analyze(pages(spark, book, [(1, payload(block("paragraph", "only")))]))
    texts = D.document_json(made.nodes, made.relationships).persist()
    docs = {r.book_id: json.loads(r.document) for r in texts.collect()}
    assert [n["type"] for n in docs["b0"]["nodes"]] == ["heading", "paragraph", "footnote", "quotation", "attribution", "figure", "verse", "list", "list", "figure", "heading", "footnote"]
    by = {n["node_id"]: n for n in docs["b0"]["nodes"]}
    figure = next(n for n in docs["b0"]["nodes"] if n["type"] == "figure")
    assert list(figure) == ["type", "node_id", "image", "caption", "provenance"] and figure["image"]["source_region"] == box and figure["image"]["asset_id"] is None and figure["caption"]["spans"][0]["text"] == "under"
    assert docs["b0"]["nodes"][0]["level"] == 2 and docs["b0"]["nodes"][10]["level"] is None and docs["b0"]["nodes"][9]["caption"] is None
    assert by["b0p0:block:0003:node:footnote"]["label"] == "1" and docs["b0"]["nodes"][7]["kind"] == "ordered" and docs["b0"]["nodes"][7]["items"][0]["marker"] == {"kind": "numeric", "raw_text": "1.", "ordinal": 1}
    assert {r["kind"] for r in docs["b0"]["relationships"]} >= {"footnote_ref", "attribution_of"} and docs["b1"]["relationships"] == []
    same = lambda df, columns: sorted(df.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("j")).toPandas()["j"])
    assert same(D.document_nodes(texts), D.NODE) == same(made.nodes, D.NODE)
    columns = ("book_id", *D.RELATIONSHIP)
    assert same(D.document_relationships(texts), columns) == same(made.relationships, columns)
    assert D.document_problems(texts).count() == 0
    out = {r.book_id: r for r in D.indented(texts).withColumn("c", D.canonical(F.col("document"))).collect()}
    assert out["b0"].document == json.dumps(docs["b0"], ensure_ascii=False, indent=2, sort_keys=True) + "\n"
    assert json.loads(out["b0"].c) == docs["b0"]


def test_documents_with_faults(spark):
    good = {"type": "paragraph", "node_id": "n", "spans": [], "provenance": []}
    faults = {"unknown type poem": good | {"type": "poem"}, "unknown type null": {}, "no node_id": {k: v for k, v in good.items() if k != "node_id"}, "no spans": good | {"spans": 3}, "no items": good | {"type": "list", "kind": "ordered"}, "unknown kind of list": good | {"type": "list", "kind": "x", "items": []}, "no role": good | {"type": "heading"}, "no image": good | {"type": "figure", "image": {}}, "no provenance": good | {"provenance": None}}
    rows = [("n", json.dumps({"nodes": [good, *faults.values()], "relationships": [{"kind": "x"}]})), ("t", "{"), ("m", '{"relationships": []}'), ("0", None)]
    df = spark.createDataFrame(rows, "book_id string, document string")
    got = sorted((r.book_id, r.place, r.problem) for r in D.document_problems(df).collect() if r.place is not None)
    assert got == sorted([("n", i + 1, p) for i, p in enumerate(faults)] + [("n", 0, "relationship without an end")])
    assert {(r.book_id, r.problem) for r in D.document_problems(df).where("place is null").collect()} == {("t", "not JSON"), ("m", "no nodes"), ("0", "not JSON")}
    assert [(r.book_id, r.node_id) for r in D.document_nodes(df).collect()] == [("n", "n")]


def test_segments_never_cross(spark):
    rng = random.Random(6)
    rows = []
    for i in range(60):
        n = rng.randint(0, 30)
        rows.append((i, "".join(rng.choice("ab<&é ") for _ in range(n)), [(a := rng.randint(-2, n + 2), a + rng.randint(0, 9), f"f{k}") for k in range(rng.randint(0, 6))]))
    df = spark.createDataFrame(rows, "id int, text string, ranges array<struct<start:int,end:int,id:string>>")
    for r in df.select("*", P.segments(F.length("text"), F.col("ranges")).alias("s"), P.marked_text(F.col("text"), F.col("ranges")).alias("m")).collect():
        n = len(r.text)
        at = [sorted(k for a, b, k in r.ranges if max(0, min(a, n)) <= p < min(b, n)) for p in range(n)]
        assert "".join(r.text[s.start : s.end] for s in r.s) == r.text
        assert all(s.start < s.end and all(at[p] == s.ids for p in range(s.start, s.end)) for s in r.s)
        assert r.m.count("<mark") == r.m.count("</mark>") == sum(bool(s.ids) for s in r.s)


def test_highlights(spark):
    text = "x" * 100 + "<hit>" + "y" * 100
    df = spark.createDataFrame([(text, 100, 105), ("ab", 1, 1), ("ab", 0, 9), ("ab", None, None), ("", 0, 0)], "t string, a int, b int")
    assert [r.h for r in df.select(P.highlighted(F.col("t"), F.col("a"), F.col("b")).alias("h")).collect()] == ["…" + "x" * 70 + "<mark>&lt;hit&gt;</mark>" + "y" * 70 + "…", "a<mark>∅</mark>b", "<mark>ab</mark>", "<mark>∅</mark>ab", "<mark>∅</mark>"]


def test_second_review_computes_only_what_changed(spark, tmp_path, capsys):
    root, review, cache = tmp_path / "runs", str(tmp_path / "review"), str(tmp_path / "cache")
    runs(root)
    go = lambda: cli.main(["review-text", str(root), review, "--cache", cache], spark)
    said = lambda: next(json.loads(x) for x in capsys.readouterr().out.splitlines() if '"computed"' in x)
    everything = lambda: sorted(map(repr, spark.read.parquet(f"{review}/findings").collect()))
    assert go() == 0 and said() == {"pages": 2, "computed": 2}
    first = everything()
    html = {r.page_number: r.html for r in spark.read.parquet(f"{review}/reports").collect()}
    assert set(html) == {1, 2} and "<mark" in html[1] and "http" not in html[1].replace("<!doctype html>", "") and 'id="page-0002-heur-0001"' in html[2]
    assert go() == 0 and said() == {"pages": 2, "computed": 0} and everything() == first
    file = root / "book" / "page-2" / "review" / "ocr.tsv"
    file.write_text(file.read_text().replace("ends", "bends"))
    assert go() == 0 and said() == {"pages": 2, "computed": 1} and everything() != first
    # Entries that are spoiled, of another version or of another form are computed again.
    spoiled = C.entries(spark, cache).withColumn("result", F.concat("result", F.lit(" "))).unionByName(C.entries(spark, cache).withColumn("version", F.lit(0)))
    spoiled = spoiled.unionByName(C.entries(spark, cache).select("fingerprint", "version", F.sha2(F.lit('{"a":1}'), 256).alias("digest"), F.lit('{"a":1}').alias("result")))
    spoiled.write.parquet(f"{tmp_path}/other/entries")
    assert cli.main(["review-text", str(root), review, "--cache", f"{tmp_path}/other"], spark) == 0 and said() == {"pages": 2, "computed": 2}
    live = spark.read.parquet(f"{review}/inputs").select("fingerprint")
    assert C.evict(spark, cache, live) == (3, 2) and C.evict(spark, cache, live.limit(0)) == (2, 0) and C.evict(spark, str(tmp_path / "none"), live) == (0, 0)


def test_folding_is_casefold(spark):
    letters = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF and c]
    rows = ["".join(letters[i : i + 500]) for i in range(0, len(letters), 500)] + ["Straße ΣΑΣ ﬃ ŉ", "", "ABC", "İ"]
    got = spark.createDataFrame([(r,) for r in rows], "t string").select("t", T.fold(F.col("t")).alias("f")).collect()
    assert all(r.f == r.t.casefold() for r in got)


def test_plain_paths(spark):
    deep = [("a/" * n + "../" * m + "x") for n in range(0, 51, 5) for m in range(0, 51, 5)]
    paths = [*deep, "", ".", "..", "/", "/..", "a/./b//c", "../../a", "a/..", "./../x", "/a/../../b"]
    got = {r.p: r.q for r in spark.createDataFrame([(p,) for p in paths], "p string").select("p", K.plain_path(F.col("p")).alias("q")).collect()}
    for p, q in got.items():
        want = posixpath.normpath(p) if p else ""
        assert q == {".": "", "/..": "/.."}.get(want, want) or p.startswith("/")
    assert got["/.."] == "/.." and got["/a/../../b"] == "/../b" and got["a/" * 50 + "../" * 50 + "x"] == "x"


def test_builds_are_compared_from_the_top(spark):
    rng = random.Random(9)
    rows = [(b, s, f"{i:03d}.xhtml", f"{b}{s}{i}", 1) for b, s, n in (("x", "text", 70), ("x", "nav", 1), ("y", "text", 9), ("z", "text", 8)) for i in range(n)]
    kind = "book_id string, stage string, file string, sha256 string, size long"
    before = spark.createDataFrame(rows, kind)
    same = {(r.book_id, r.stage): (r.files, r.root, r.book_root) for r in B.manifest(before).collect()}
    assert {k: v[0] for k, v in same.items()} == {("x", "text"): 70, ("x", "nav"): 1, ("y", "text"): 9, ("z", "text"): 8}
    assert B.differing(before, spark.createDataFrame(rng.sample(rows, len(rows)), kind)).count() == 0
    hit = {("x", "text", "033.xhtml"), ("x", "nav", "000.xhtml"), ("y", "text", "008.xhtml")}
    now = [(*r[:3], r[3] + "!", 1) if r[:3] in hit else r for r in rows if r[:3] != ("x", "text", "050.xhtml")] + [("z", "text", "new", "n", 1), ("v", "text", "first", "n", 1)]
    after = spark.createDataFrame(now, kind)
    assert {tuple(r) for r in B.differing(before, after).collect()} == hit | {("x", "text", "050.xhtml"), ("z", "text", "new"), ("v", "text", "first")}
    changed = {(r.book_id, r.stage): (r.files, r.root, r.book_root) for r in B.manifest(after).collect()}
    assert changed["z", "text"][1] != same["z", "text"][1] and changed["x", "nav"][1] != same["x", "nav"][1] and changed["x", "text"][2] != same["x", "text"][2]
