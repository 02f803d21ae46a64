"""Streams of pages: links in any order of arrival, tables of touched books, progress."""

import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F
from test_books import block, pages, payload, span

from folio.operators import analyzer as A
from folio.streaming import continuity as C
from folio.streaming import ingest as I
from folio.streaming import progress as P
from folio.streaming import views as V


def book(rng, n):
    """Pages with ends of all kinds; some numbers are missing."""
    ends = ["and so", "and so", "It ends.", "der Satz geht", "so on", "", "  "]
    roles = ["paragraph"] * 4 + ["quote"] * 4 + ["list_item", "list_item", "footnote", "heading", "page_header", "page_number"]
    out = []
    for i in range(1, n + 1):
        if rng.random() < 0.9:
            blocks = [block(rng.choice(roles), span(rng.choice(ends), language=rng.choice(["en", "de", None])), language=rng.choice(["en", "en", "de", None])) for _ in range(rng.randint(0, 6))]
            out.append((i, payload(*blocks)))
    return out


def links_of(rows):
    return sorted((r.book_id, r.relationship_id, round(r.confidence, 9), tuple(r.reasons)) for r in rows.collect())


def batch_links(df):
    ordered = A.ordered_pages(df)
    return links_of(A.continuations(ordered, A.positions(A._blocks(ordered))))


def test_links_in_any_order(spark, tmp_path):
    rng = random.Random(5)
    df = pages(spark, book(rng, 70), book(rng, 12), book(rng, 1)).withColumn("page_pos", F.col("page_number")).persist()
    want = batch_links(df)
    assert len(want) > 8
    rows = df.select("book_id", "page_number").collect()
    folder, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    schema = df.schema
    places = [(r.book_id, r.page_number) for r in rows]
    rng.shuffle(places)
    seen = []
    # Three batches in a random order; in the second some pages come again, changed and unchanged; at last as they are.
    for k in range(3):
        part = places[k::3] + (rng.sample(seen, 4) if k else [])
        seen += part
        wanted = spark.createDataFrame(sorted(set(part)), "book_id string, page_number int")
        some = df.join(wanted, ["book_id", "page_number"], "left_semi").select(df.columns)
        if k == 1:
            changed = F.transform("page.blocks", lambda b: b.withField("content", F.transform(b["content"], lambda s: s.withField("text", F.lit("and changed")))))
            some = some.withColumn("page", F.col("page").withField("blocks", changed))
        some.coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        q = C.link_changes(C.pair_changes(C.page_ends(stream))).writeStream.format("parquet").option("path", out).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
    # What changed in the second batch comes back as it was.
    df.coalesce(1).write.mode("append").parquet(folder)
    C.link_changes(C.pair_changes(C.page_ends(spark.readStream.schema(schema).parquet(folder)))).writeStream.format("parquet").option("path", out).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    changes = spark.read.parquet(out)
    assert links_of(C.standing(changes)) == want
    assert changes.where("change = -1").count() > 0
    df.unpersist()


def arrive(folder, name, number, page, at=None):
    (folder / name).mkdir(parents=True, exist_ok=True)
    file = folder / name / f"{number}.json"
    file.write_text(json.dumps(page))
    if at:
        os.utime(file, (at, at))


def files_below(folder):
    return {(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(folder) for f in names if not f.startswith((".", "_"))}


def test_tables_of_touched_books(spark, tmp_path, monkeypatch):
    """Two batches: the second has pages of one of the two books."""
    monkeypatch.setattr(V, "TABLES", ("nodes", "relationships", "furniture", "candidates"))
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    pages_of = lambda name: [(n, payload(block("page_header", "Head"), block("paragraph", f"{name} {n} and so"), block("footnote", span("1", vertical_position="superscript"), "note"))) for n in range(1, 6)]
    kept = None
    for arriving in ({"a": 2, "b=1 é": 5}, {"a": 5}):
        for name, upto in arriving.items():
            for n, p in pages_of(name)[:upto]:
                if not (folder / name / f"{n}.json").exists():
                    arrive(folder, name, n, p)
        V.follow(I.arriving(spark, str(folder)), out, state).awaitTermination()
        now = {k: v for k, v in files_below(f"{out}/analysis").items() if "book_id=b" in k[0]}
        assert now and (kept is None or kept == now)
        kept = now
    full = A.analyze(V.book_pages(spark, out))
    for table in ("nodes", "relationships", "furniture"):
        columns = sorted(getattr(full, table).columns)
        assert sorted(map(repr, V.view(spark, out, table).select(columns).collect())) == sorted(map(repr, getattr(full, table).select(columns).collect())), table
    assert V.view(spark, out, "candidates").count() == 0
    assert {(r.book_id, r.version) for r in V.outdated(spark, out).collect()} == {("a", 0)}
    before = V.view(spark, out, "nodes").count()
    assert V.vacuum(spark, out) >= 1 and V.view(spark, out, "nodes").count() == before
    assert not [d for d, _ in files_below(f"{out}/analysis") if "version=0" in d and d.endswith("book_id=a")]


def test_a_version_counts_when_it_is_whole(spark, tmp_path, monkeypatch):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    head = lambda n: payload(block("page_header", f"Head {n}"), block("paragraph", "One."))
    arrive(folder, "a", 1, head(1))
    monkeypatch.setattr(V, "TABLES", ("furniture",))
    V.follow(I.arriving(spark, str(folder)), out, state).awaitTermination()
    arrive(folder, "a", 2, head(2))
    monkeypatch.setattr(V, "TABLES", ("furniture", "none"))
    with pytest.raises(Exception, match="none"):
        V.follow(I.arriving(spark, str(folder)), out, state).awaitTermination()
    assert [r.raw_text for r in V.view(spark, out, "furniture").collect()] == ["Head 1"]
    monkeypatch.setattr(V, "TABLES", ("furniture",))
    V.follow(I.arriving(spark, str(folder)), out, state).awaitTermination()
    assert V.view(spark, out, "furniture").count() == 2


def test_progress(spark, tmp_path):
    folder = tmp_path / "in"
    for n in range(1, 6):
        arrive(folder, "ab"[n % 2], n, payload(block("paragraph", f"page {n}")))
    told = []
    listener = P.PageProgress(total=6, tell=told.append)
    spark.streams.addListener(listener)
    try:
        I.ingest(P.observed(I.arriving(spark, str(folder), files_per_batch=2)), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
        assert listener.ended.wait(30)
        end = time.time() + 20
        while listener.pages < 5 and time.time() < end:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert [p.pages for p in told] == [2, 4, 5] and told == listener.steps
    assert all(p.per_second > 0 and p.total == 6 for p in told) and told[-1].remaining_s == pytest.approx(1 / told[-1].per_second)
    slow = P.PageProgress(clock=iter([10.0, 12.0, 15.0]).__next__)
    slow.onQueryStarted(None)
    assert slow.step(0, 4, 1) == P.Progress(0, 4, 1, None, 2.0, 2.0, None) and slow.step(1, 0, 0).per_second == 0.8
