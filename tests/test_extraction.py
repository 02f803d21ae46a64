"""Extraction by plug-ins: waves of attempts over routes, recovery, and the action that publishes runs."""

import pytest
from pyspark.sql import functions as F

import plugins
from folio import cli
from folio.operators import extraction as X
from folio.sources import files


@pytest.fixture(autouse=True)
def sent(spark):
    """Plug-ins must be on the executors."""
    spark.sparkContext.addPyFile(plugins.__file__)


ROUTES = [{"name": "f", "tier": "free", "max_attempts": 3}, {"name": "p", "tier": "paid", "max_attempts": 2}]


def test_waves(spark, tmp_path):
    texts = ["fine", "busy", "spent", "bad", "recite", "broken", "crash"]
    rows = [(f"b{i}", 1, f"b{i}:page:0001", t.encode()) for i, t in enumerate(texts)] + [("b3", 2, "b3:page:0002", b"busy")]
    tasks = spark.createDataFrame(rows, "book_id string, page_number int, page_id string, image binary")
    waits = []

    def keep(df, name):
        df.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    out = X.extracted(tasks, ROUTES, {"f": plugins.free, "p": plugins.paid}, keep, "free-then-paid", base=0.0, most=0.0, wait=waits.append)
    got = {(r.book_id, r.page_number): r for r in out.collect()}
    tries = {k: [(a.provider, a.metadata["attempt"], a.status, a.reason) for a in r.attempts] for k, r in got.items()}
    ok = lambda route, n: (route, n, "succeeded", None)
    no = lambda route, n, why: (route, n, "failed", why)
    assert tries["b0", 1] == [ok("f", "1")] and got["b0", 1].usage == {"total": 3} and got["b0", 1].page.blocks[0].content[0].text == "fine"
    assert tries["b1", 1] == [no("f", "1", "rate_limit"), no("f", "2", "rate_limit"), ok("f", "3")]
    assert tries["b2", 1] == [no("f", "1", "quota_exhausted"), ok("p", "1")] and got["b2", 1].page.blocks[0].content[0].text == "paid spent"
    assert tries["b3", 1] == [no("f", "1", "invalid_request")] and got["b3", 1].outcome == "failed"
    # What is wrong with a request concerns its whole book.
    assert got["b3", 2].outcome == "not_reached" and tries["b3", 2] == [no("f", "1", "rate_limit")]
    assert tries["b4", 1] == [no("f", "1", "recitation")]
    assert tries["b5", 1] == [no("f", n, "invalid_output") for n in "123"] + [ok("p", "1")]
    assert tries["b6", 1] == [no("f", "1", "unknown"), ok("p", "1")]
    assert waits and all(w == 0.01 for w in waits)
    with pytest.raises(ValueError):
        X.extracted(tasks, ROUTES, {"f": plugins.free}, keep, "free-then-paid")
    mended = {(r.book_id, r.page_number): r for r in X.with_recovery(out, plugins.read).collect()}
    assert len(mended) == len(got) and mended["b4", 1].outcome == "succeeded" and mended["b4", 1].recovery_language == "und" and mended["b4", 1].attempts[-1].mechanism == "local_ocr"
    assert [(b.role_hint, b.content[0].text) for b in mended["b4", 1].page.blocks] == [("paragraph", "Read line"), ("page_number", "12")]
    assert mended["b0", 1].recovery_language is None and mended["b0", 1].page == got["b0", 1].page


def test_extract_action(spark, tmp_path, capsys):
    images, root = tmp_path / "images", tmp_path / "runs"
    (images / "a b").mkdir(parents=True)
    for n, t in ((1, "one"), (2, "recite"), (3, "busy")):
        (images / "a b" / f"{n:03d}.jpg").write_bytes(t.encode())
    go = lambda *more: cli.main(["extract-book", str(images), str(root), str(tmp_path / "out"), "--route", "f=free=plugins:free", "--backoff", "0", *more], spark)
    assert go() == 1 and '"succeeded": 2, "failed": 1' in capsys.readouterr().out
    assert go("--ocr", "plugins:read") == 0 and '"reused": 2, "succeeded": 1' in capsys.readouterr().out
    assert go() == 0 and '"reused": 3' in capsys.readouterr().out
    rows = {r.page_number: r for r in files.page_runs(spark, str(root)).collect()}
    assert all(not r.violations for r in rows.values()) and {n: r.page.blocks[0].content[0].text for n, r in rows.items()} == {1: "one", 2: "Read line", 3: "busy"}
    assert rows[2].page.dominant_language == "en"
    # Another image of a page has it extracted anew.
    (images / "a b" / "001.jpg").write_bytes(b"other")
    assert go("--page", "1,3") == 0 and '"selected": 2, "reused": 1, "succeeded": 1' in capsys.readouterr().out
    assert files.page_runs(spark, str(root)).where("page_number = 1").first().page.blocks[0].content[0].text == "other"
    assert cli.main(["extract-book", str(images), str(root), str(tmp_path / "out"), "--route", "f=free=plugins:none"], spark) == 2
    assert files.loaded_pages(files.page_runs(spark, str(root))).agg(F.count("*")).first()[0] == 3
