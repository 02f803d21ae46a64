"""Differences of texts of any length, and functions on files, words and figures that have no query."""

import hashlib
import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from folio.operators import findings as D
from folio.operators import matching as M
from folio.operators import rendering as X
from folio.sources import files as S
from folio.streaming import ingest as I


def library(a, b):
    m = SequenceMatcher(None, a, b, autojunk=False)
    return m.ratio(), [(i, j, k, n) for tag, i, j, k, n in m.get_opcodes() if tag != "equal"]


@pytest.mark.parametrize("small", [0, 150, M.SMALL])
def test_blocks_are_the_librarys(monkeypatch, small):
    monkeypatch.setattr(M, "SMALL", small)
    rng = random.Random(4)
    for _ in range(400):
        letters = rng.choice(["ab", "abc", "abcdefgh é\U0001f600"])
        a = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        b = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) if rng.random() < 0.5 else "".join(c for c in a if rng.random() < 0.8)
        assert M.changed(a, b) == library(a, b), (a, b)


def test_long_texts_are_compared_whole(spark):
    rng = random.Random(1)
    words = ["stone", "water", "the", "of", "bridge", "sing", "over"]
    a = " ".join(rng.choice(words) for _ in range(1300))
    b = "".join(rng.choice("xyz ") if rng.random() < 0.03 else c for c in a.replace(" the ", " tho "))
    assert len(a) > 6000 and M.changed(a, b) == library(a, b)
    row = D.compared(spark.createDataFrame([("1", a, b), ("2", None, None)], "id string, mine string, other string")).orderBy("id").collect()
    assert row[0].ratio == library(a, b)[0] and row[1].ratio == 1.0 and row[1].groups == []
    long = "abc " * 30000
    assert M.changed(long, long[:-1]) == (2 * 119999 / 239999, [(119999, 120000, 119999, 119999)])


def test_files_and_images(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"one")
    (tmp_path / "b.pdf").write_bytes(b"")
    got = {r.uri.rpartition("/")[2]: (r.sha256, r["size"]) for r in S.document_hashes(spark, str(tmp_path)).collect()}
    assert got == {"a.pdf": (hashlib.sha256(b"one").hexdigest(), 3)}
    rows = [(1, 0, 1, "/DCTDecode", b"j"), (2, 0, 1, "/JPXDecode", b"k"), (3, 5, 1, "/DCTDecode", b"t"), (4, 0, 2, None, None), (5, 0, 1, "/FlateDecode", b"f"), (6, 0, 0, None, None)]
    pages = spark.createDataFrame(rows, "n int, text_length int, images int, image_filter string, image binary")
    out = {r.n: (r.media_type, r.error, r.image and bytes(r.image)) for r in S.materialized(pages).collect()}
    assert out[1] == ("image/jpeg", None, b"j") and out[2] == ("image/jp2", None, b"k")
    assert {n: out[n][1] for n in (3, 4, 5, 6)} == {3: "has text of its own", 4: "not exactly one image", 5: "no supported image", 6: "not exactly one image"}
    assert all(out[n][0] is None and out[n][2] is None for n in (3, 4, 5, 6))


def test_words_and_boxes(spark):
    words = spark.createDataFrame([("b", "p", 3, "x", 10, 20, 110, 40), ("b", "p", 1, "y", 300, 25, 340, 45), ("b", "p", 2, "x", 500, 20, 600, 40), ("b", "q", 1, "x", 0, 0, 5, 5)], "book_id string, page_id string, word_no int, word string, left int, top int, right int, bottom int")
    found = spark.createDataFrame([("b", "p", "f", "x"), ("b", "p", "g", "none"), ("b", "q", "h", "x")], "book_id string, page_id string, finding_id string, reference_text string")
    first = D.first_words(found, words)
    assert {(r.finding_id, r.word_no) for r in first.collect()} == {("f", 2), ("h", 1)}
    box = D.word_box(words.where("page_id = 'p' and word_no <> 2"), ["page_id"], F.lit(1000), F.lit(60)).first()
    # Half of the width of 330, twice the height of 25, inside a page of 1000 by 60.
    assert (box.left, box.top, box.right, box.bottom) == (0, 0, 505, 60)


def test_figures_and_windows(spark):
    spot = "struct<x:double,y:double,width:double,height:double>"
    nodes = spark.createDataFrame([("b", "n1", "figure", None, [("p", "k", ["s"])]), ("b", "n2", "figure", None, [("p", "k", ["s"]), ("q", "k", ["s"])]), ("b", "n3", "paragraph", None, [("p", "k", ["s"])])], f"book_id string, node_id string, node_type string, region {spot}, provenance array<struct<page_id:string,block_id:string,span_ids:array<string>>>")
    images = spark.createDataFrame([("b", "p", "file:/p.jpg")], "book_id string, page_id string, uri string")
    assert {(r.node_id, r.uri) for r in X.figure_sources(nodes, images).collect()} == {("n1", "file:/p.jpg"), ("n2", None)}
    events = spark.sql("select timestamp'2024-01-01 00:10:00' as ts, 'a' as event_type union all select timestamp'2024-01-01 00:59:59', 'a' union all select timestamp'2024-01-01 01:00:00', 'a' union all select timestamp'2024-01-01 00:00:00', 'b'")
    assert {(r.start.hour, r.event_type, r.events) for r in I.windowed_counts(events).collect()} == {(0, "a", 2), (1, "a", 1), (0, "b", 1)}


def test_parts_of_long_texts_are_not_read_again_for_each_edit(monkeypatch):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    a = " ".join(rng.choice(words) for _ in range(4000))
    b = a.replace(" a", " ä").replace("bc", "")
    read, whole = [], M.longest
    monkeypatch.setattr(M, "longest", lambda x, y: read.append(len(x)) or whole(x, y))
    assert sum(k for _, _, k in M.matching_blocks(a, b)) > 0.8 * len(a)
    assert sum(read) <= len(a)


def test_runs_agree_with_the_library():
    rng = random.Random(6)
    for _ in range(60):
        letters = rng.choice(("ab", "abc ", "abcdefghij ", "aé😀\udc00 "))
        a = "".join(rng.choice(letters) for _ in range(rng.randint(0, 400)))
        b = a[: rng.randint(0, len(a))] + rng.choice(letters) * rng.randint(0, 5) + a[rng.randint(0, len(a)) :] + a[:50]
        assert M.matching_blocks(a, b) == [tuple(x) for x in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks() if x[2]]
