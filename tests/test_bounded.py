"""Steps that took time or memory beyond the size of their rows."""

import re

import pyarrow as pa
from pyspark.sql import functions as F

from folio.operators import analyzer as A
from folio.operators import documents as J
from folio.operators import findings as D
from folio.operators import rendering as X
from folio.operators import report as P
from folio.plans import books, catalogue


class Rows:
    """Stands in for a table, and keeps the function that would run on its batches."""

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        self.run = run
        return self


def test_digits_are_those_of_the_class(spark):
    c = spark.range(1, 0x110000).where("id < 55296 or id > 57343").select(F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c"))
    assert c.where(F.col("c").rlike("^" + D.digit_class() + r"\z") != F.col("c").rlike("^" + D.digits() + r"\z")).count() == 0
    assert c.where(F.col("c").rlike("^" + D.digits() + r"\z")).count() > 700


def test_words_around_a_boundary(spark):
    text = "word " * 3000 + "a1 b c² End.Next" + " word" * 3000
    rows = spark.createDataFrame([("b", "p1", 1, text)], "book_id string, page_id string, page_number long, text string").withColumn("anchors", F.array().cast(f"array<{D.RUN_TYPE}>"))
    got = D.boundary_findings(rows).orderBy("start").select("text", "suggested_text", "start").collect()
    assert [tuple(r) for r in got] == [("a1", "a 1", 15000), ("c²", "c ²", 15005), ("End.Next", "End. Next", 15008)]


def test_pages_become_python_objects_a_few_at_a_time(spark):
    batch = pa.RecordBatch.from_arrays([pa.array(["b"] * 300), pa.array([f"p{i}" for i in range(300)]), pa.array(range(300), pa.int64()), pa.array([None] * 300, pa.list_(pa.string()))], ["book_id", "page_id", "page_number", "blocks"])
    sizes = [b.num_rows for b in D.projections(Rows()).run(iter([batch]))]
    assert sum(sizes) == 300 and max(sizes) <= D.SLICE


def test_windows_over_a_book_see_no_content(spark):
    nodes = spark.createDataFrame([("b", i, f"n{i}", "heading" if i % 3 == 0 else "paragraph", "chapter_title", "text" * 9) for i in range(9)], "book_id string, node_pos long, node_id string, node_type string, role string, content string")
    chunks = X.chunked(nodes)
    plan = chunks._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    inputs = re.findall(r"\) Window\nInput \[\d+\]: \[(.*)\]", plan)
    assert inputs and not any("content" in i for i in inputs)
    assert [(r.node_pos, r.chunk, r.file) for r in chunks.orderBy("node_pos").collect()] == [(i, i // 3 + 1, f"chapter-000{i // 3 + 1}.xhtml") for i in range(9)]


def test_segments_take_the_size_of_a_text_once(spark):
    ranges = F.array(*(F.struct(F.lit(a).alias("start"), F.lit(b).alias("end"), F.lit(f"f{a}").alias("id")) for a, b in ((1, 3), (2, 9))))
    rows = spark.createDataFrame([("word",), (None,)], "text string").select("text", P.segments(F.length("text"), ranges).alias("s"))
    assert rows._jdf.queryExecution().analyzed().toString().count("length(text") == 1
    got = {r.text: [tuple(x) for x in r.s] for r in rows.collect() if r.text}
    assert got == {"word": [(0, 1, []), (1, 2, ["f1"]), (2, 3, ["f1", "f2"]), (3, 4, ["f2"])]}


def test_furniture_takes_two_lines_of_a_page(spark, tmp_path):
    rows = [(i, t, "a") for i, t in enumerate([None, "", "one", "\n", "head\nmiddle\n\nfoot", "x\n"])]
    spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("lang", F.lit("en")).write.parquet(f"{tmp_path}/documents.parquet")
    got = catalogue._furniture(spark, str(tmp_path))
    want = catalogue.blocks(spark, str(tmp_path)).where("role <> 'paragraph'")
    columns = ["book", "page", "number", "role", "seq", "text"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))
    assert "posexplode" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_nodes_of_documents_are_made_once(spark, tmp_path):
    rows = [(i, "a", "\n".join(f"line {i} {k}" for k in range(20)), "en") for i in range(6)]
    spark.createDataFrame(rows, "doc_id long, source string, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = books.q70_document_round_trip(spark, str(tmp_path))
    # What is compared and what is written as JSON is read from the nodes, and not made from the pages again.
    assert "documents.parquet" not in " ".join(got.inputFiles())
    assert got.count() > 60 and got.where("not same").count() == 0
    typed = J.document_nodes(spark.createDataFrame([("b", "{}")], "book_id string, document string"))
    assert typed._jdf.queryExecution().optimizedPlan().toString().count("$.spans") == 1


def test_blocks_and_ends_of_pages_share_an_exchange(spark, tmp_path):
    rows = [(i, "a", "one\ntwo\nthree", "en") for i in range(6)]
    spark.createDataFrame(rows, "doc_id long, source string, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    made = A.nodes(A.positions(A._blocks(A.ordered_pages(books.typed_pages(spark, str(tmp_path))))))
    assert made.count() > 6
    made.collect()
    # Documents are read for the places of the pages and once for the pages, not for each side of the join.
    final = made._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan parquet") == 2


def test_analysis_in_steps_leaves_one_table(spark, tmp_path, monkeypatch):
    """Shuffles of a whole analysis were on disk at once; the tables of the steps go as soon as they were read."""
    rows = [(i, "ab"[i % 2], "\n".join(f"line {i} {k} goes on" for k in range(20)), "en") for i in range(6)]
    spark.createDataFrame(rows, "doc_id long, source string, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    pages, shared = books.typed_pages(spark, str(tmp_path)), tmp_path / "shared"
    monkeypatch.setattr("folio.sources.outputs.shared_root", lambda _: str(shared))
    whole = A.analyze(pages)
    nodes, references = A.nodes_and_references(pages)
    assert len(list(shared.iterdir())) == 2
    assert sorted(map(str, nodes.collect())) == sorted(map(str, whole.nodes.collect())) and nodes.count() > 60
    assert sorted(map(str, references.collect())) == sorted(map(str, whole.relationships.where("kind = 'footnote_ref'").collect())) and references.count()
    got = books._semantic(spark, str(tmp_path))
    assert len(list(shared.iterdir())) == 3 and got.count() == nodes.count()


def test_ends_of_pages_are_found_before_the_exchange(spark, tmp_path):
    rows = [(i, "a", "one\ntwo\nthree", "en") for i in range(6)]
    spark.createDataFrame(rows, "doc_id long, source string, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    ordered = A.ordered_pages(books.typed_pages(spark, str(tmp_path)))
    A.positions(A._blocks(ordered)).write.parquet(f"{tmp_path}/placed")
    links = A.continuations(ordered, spark.read.parquet(f"{tmp_path}/placed"))
    plan = links._jdf.queryExecution().executedPlan().toString()
    # The first block of a node comes with its place: no window over a page's blocks, and so no exchange of them.
    assert "first(block_id" not in plan
