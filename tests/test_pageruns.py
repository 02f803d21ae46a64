"""Page runs as a data source: what is read equals the plain loader, filters keep files closed, writes are whole or undone."""

import json
import os

import pytest
from pyspark.sql import functions as F
from test_books import block, payload

from folio.operators import evidence as E
from folio.sources import files, pageruns


def extracted(spark, numbers, text="t", recovered=None, book="b"):
    """Pages as an extraction leaves them."""
    rows = [(book, n, f"{book}:{n}", json.dumps(payload(block("paragraph", f"{text} {n}")))) for n in numbers]
    judged = E.normalized(spark.createDataFrame(rows, "book_id string, page_number int, page_id string, raw string"))
    source = F.struct(F.col("page_id").alias("source_id"), F.lit("file:///b.pdf").alias("uri"), F.sha2("raw", 256).alias("sha256"), F.lit("image/jpeg").alias("media_type"), F.lit("d" * 64).alias("document_sha256"))
    info = F.struct(F.lit("page.jpg").alias("file"), F.lit("image/jpeg").alias("media_type"), F.lit("0" * 64).alias("sha256"), F.lit(3).alias("byte_size"), F.lit(True).alias("preserved"))
    named = lambda n: F.struct(F.lit(n).alias("name"), F.lit("5").alias("version"))
    attempt = F.struct(F.lit("m").alias("mechanism"), F.lit("p").alias("provider"), F.lit("success").alias("status"), F.lit(None).cast("string").alias("reason"), F.create_map(F.lit("k"), F.lit("v")).alias("metadata"))
    return judged.select("book_id", "page_number", "page", source.alias("source"), info.alias("asset_info"), named("prompt").alias("prompt"), named("evidence").alias("schema"), F.array(attempt).alias("attempts"), F.lit(recovered).cast("string").alias("recovery_language"), "raw", F.lit(b"img").alias("asset"))


def texts(spark, root):
    rows = files.page_runs(spark, str(root)).collect()
    assert all(not r.violations for r in rows)
    return {(r.book_id, r.page_number): r.page.blocks[0].content[0].text for r in rows}


def test_written_runs_are_read_again(spark, tmp_path):
    root = str(tmp_path / "runs")
    pageruns.write_runs(pageruns.run_records(extracted(spark, range(1, 6)).unionByName(extracted(spark, [1], book="c é"))), root)
    assert texts(spark, root) == {("b", n): f"t {n}" for n in range(1, 6)} | {("c é", 1): "t 1"}
    columns = ["book_id", "run", "path", "page_number", "manifest", "page", "violations"]
    plain, own = (sorted(map(repr, df.where("book_id = 'b'").select(columns).collect())) for df in (files.page_runs(spark, root), pageruns.judged_runs(spark, root)))
    assert plain == own and len(own) == 5
    manifest = json.loads((tmp_path / "runs/b/page-0002/manifest.json").read_text())
    assert list(manifest) == ["source", "asset", "prompt", "schema", "normalization", "attempts"] and manifest["asset"]["path"] == "assets/page.jpg" and manifest["source"]["page_number"] == 2
    assert manifest["attempts"] == [{"mechanism": "m", "provider": "p", "status": "success", "reason": None, "metadata": {"k": "v"}}] and manifest["normalization"] == {"model": "PageExtraction", "status": "success"}
    assert (tmp_path / "runs/b/page-0002/assets/page.jpg").read_bytes() == b"img" and (tmp_path / "runs/b/page-0002/raw/provider-response.json").exists()
    # A page that is there is replaced, with all that belonged to it; others stay.
    pageruns.write_runs(pageruns.run_records(extracted(spark, [2, 9], "new", "vie")), root)
    assert texts(spark, root) == {("b", n): f"t {n}" for n in (1, 3, 4, 5)} | {("b", 2): "new 2", ("b", 9): "new 9", ("c é", 1): "t 1"}
    manifest = json.loads((tmp_path / "runs/b/page-0002/manifest.json").read_text())
    assert manifest["normalization"]["status"] == "recovered" and manifest["recovery"] == {"reason": "gemini_recitation", "mechanism": "local_ocr", "provider": "tesseract", "language": "vie", "needs_review": True}
    assert sorted(os.listdir(tmp_path / "runs/b/page-0002/raw")) == ["local-ocr.txt"]
    assert not [d for d in os.listdir(root) if d.startswith(".")]
    pageruns.write_runs(pageruns.run_records(extracted(spark, [1]).limit(0)), root)
    assert len(texts(spark, root)) == 7


def test_filters_keep_files_closed(spark, tmp_path):
    root = str(tmp_path / "runs")
    for book in ("a", "b", "c"):
        pageruns.write_runs(pageruns.run_records(extracted(spark, range(1, 8), book=book)), root)
    # What can't be decoded fails when it is opened.
    for place in ("a/page-0007", "b/page-0001", "c/page-0003"):
        (tmp_path / f"runs/{place}/normalized/page.json").write_bytes(b"\xff\xfe")
    runs = pageruns.scan(spark, root)
    with pytest.raises(Exception, match="decode"):
        runs.collect()
    numbers = lambda df: sorted((r.book_id, r.page_number) for r in df.collect())
    assert numbers(runs.where("book_id = 'a' and page_number < 7")) == [("a", n) for n in range(1, 7)]
    assert numbers(runs.where("page_number between 4 and 6")) == [(b, n) for b in "abc" for n in (4, 5, 6)]
    assert numbers(runs.where("book_id in ('a', 'b', 'none') and page_number in (2, 3, 99)")) == [(b, n) for b in "ab" for n in (2, 3)]
    assert numbers(runs.where("book_id = 'b' and page_number > 1 and page_number >= 3")) == [("b", n) for n in range(3, 8)]
    assert numbers(runs.where("book_id = 'a' and book_id = 'b'")) == []
    # Without the column its files stay closed, too.
    assert pageruns.scan(spark, root, ["book_id", "page_number", "manifest"]).count() == 21
    assert pageruns.scan(spark, root, ["book_id", "run"]).columns == ["book_id", "run"]
    # A run that isn't named by its page is opened for its number, and filtered by Spark.
    os.rename(f"{root}/b/page-0004", f"{root}/b/fourth")
    assert numbers(pageruns.scan(spark, root).where("book_id = 'b' and page_number between 3 and 4")) == [("b", 3), ("b", 4)]
    os.rename(f"{root}/b/page-0005", f"{root}/b/page-0004")
    with pytest.raises(Exception, match="in a run of page 4"):
        pageruns.scan(spark, root).where("page_number = 4").collect()
    # Half a run is none.
    os.remove(f"{root}/a/page-0002/manifest.json")
    assert numbers(pageruns.scan(spark, root, ["book_id", "page_number"]).where("book_id = 'a'")) == [("a", n) for n in (1, 3, 4, 5, 6, 7)]
    assert pageruns.scan(spark, str(tmp_path / "none")).count() == 0


def test_failed_writes_leave_what_was(spark, tmp_path):
    root = str(tmp_path / "runs")
    pageruns.write_runs(pageruns.run_records(extracted(spark, range(1, 6))), root)
    before = texts(spark, root)
    records = pageruns.run_records(extracted(spark, range(1, 9), "new")).repartition(4, "page_number")
    # A task fails after others have staged their runs.
    broken = records.withColumn("raw", F.when(F.col("page_number") == 8, F.raise_error(F.lit("lost"))).otherwise(F.col("raw")))
    with pytest.raises(Exception, match="lost"):
        pageruns.write_runs(broken, root)
    for bad in (records.withColumn("book_id", F.lit("../x")), records.withColumn("asset_file", F.lit("a/b")), records.withColumn("page_number", F.lit(0)), records.withColumn("page_number", F.lit(3))):
        with pytest.raises(Exception, match="no plain name|no whole run|written twice"):
            pageruns.write_runs(bad, root)
    assert texts(spark, root) == before and not (tmp_path / "x").exists()
    with pytest.raises(Exception, match="append"):
        records.write.format("page_runs").mode("overwrite").save(root)
    with pytest.raises(Exception, match="need"):
        records.drop("raw").write.format("page_runs").mode("append").save(root)
    # Tasks that were still at work when the write was undone may have staged more.
    assert pageruns.restore(root) == [] and texts(spark, root) == before and not [d for d in os.listdir(root) if d.startswith(".")]


def test_a_commit_that_stops_midway_is_undone(spark, tmp_path):
    """One run can't be moved to its place: all others go back. Backups of a driver that died are put back by restore."""
    root = str(tmp_path / "runs")
    pageruns.write_runs(pageruns.run_records(extracted(spark, range(1, 4))), root)
    before = texts(spark, root)
    writer = pageruns.PageRunWriter(root, spark.createDataFrame([], pageruns.WRITTEN).schema)
    staged = tmp_path / "runs" / writer.staging / "7" / "b"
    for n in (1, 2):
        (staged / f"page-000{n}" / "normalized").mkdir(parents=True)
        (staged / f"page-000{n}" / "normalized" / "page.json").write_text("{}")
    with pytest.raises(OSError):
        writer.commit([pageruns.Staged("7", [("b", "page-0001"), ("b", "page-0002"), ("b", "page-0003")])])
    assert texts(spark, root) == before
    aside = tmp_path / "runs" / ".staging-dead" / "backup" / "b"
    aside.mkdir(parents=True)
    os.rename(f"{root}/b/page-0002", aside / "page-0002")
    assert pageruns.restore(root) == ["b/page-0002"] and texts(spark, root) == before
