"""Figures cut out of page images, by the operator and by the command line up to the package."""

import io
import json
import zipfile

import plugins
import pytest
from pyspark.sql import functions as F
from test_books import block, payload
from test_cli import runs

from folio import cli
from folio.operators import evidence as E
from folio.operators import figures as G
from folio.operators import rendering as X

NODE = "book_id string, node_id string, node_type string, region struct<x: double, y: double, width: double, height: double>, provenance array<struct<page_id: string>>"


@pytest.fixture(autouse=True)
def sent(spark):
    spark.sparkContext.addPyFile(plugins.__file__)


def test_crops(spark):
    nodes = [("a", "f1", "figure", (0.1, 0.25, 0.5, 0.5), [("p1",), ("p1",)]), ("a", "f2", "figure", (0.999, 0.0, 0.5, 1.0), [("p1",)]), ("a", "t", "paragraph", None, [("p9",)]), ("b", "f1", "figure", (0.0, 0.0, 1.0, 1.0), [("p1",)])]
    images = spark.createDataFrame([("a", "p1", "u", b"101x40"), ("a", "p2", "v", b"no size"), ("b", "p1", "w", b"7x9")], "book_id string, page_id string, uri string, image binary")
    got = {(r.book_id, r.node_id): r for r in G.cropped(spark.createDataFrame(nodes, NODE), images, plugins.size, plugins.crop).collect()}
    assert {k: tuple(r.box) for k, r in got.items()} == {("a", "f1"): (10, 10, 61, 30), ("a", "f2"): (100, 0, 101, 40), ("b", "f1"): (0, 0, 7, 9)}
    assert bytes(got["a", "f1"].data) == b"101x40 (10, 10, 61, 30)" and (got["a", "f1"].width, got["a", "f1"].height) == (51, 20)
    assert G.cropped(spark.createDataFrame(nodes[2:3], NODE), images, plugins.size, plugins.crop).count() == 0
    for lame in (("a", "f", "figure", (0.0, 0.0, 1.0, 1.0), [("p1",), ("p2",)]), ("a", "f", "figure", (0.0, 0.0, 1.0, 1.0), []), ("a", "f", "figure", (0.0, 0.0, 1.0, 1.0), [("p3",)]), ("a", "f", "figure", None, [("p1",)])):
        with pytest.raises(ValueError):
            G.cropped(spark.createDataFrame([lame], NODE), images, plugins.size, plugins.crop)
    with pytest.raises(ValueError):
        G.cropped(spark.createDataFrame(nodes, NODE), images.unionByName(images), plugins.size, plugins.crop)


def test_figures_reach_the_package(spark, tmp_path, capsys):
    runs(tmp_path / "runs")
    picture = block("image") | {"region": {"x": 0.0, "y": 0.5, "width": 1.0, "height": 0.5}}
    page = E.identified("book:page:0003", payload(picture)) | {"source": {"source_id": "s", "uri": "u", "sha256": None, "media_type": None, "metadata": {"page_number": 3}}}
    folder = tmp_path / "runs" / "book" / "page-3"
    (folder / "normalized").mkdir(parents=True)
    (folder / "normalized" / "page.json").write_text(json.dumps(page))
    (folder / "manifest.json").write_text("{}")
    (tmp_path / "images" / "book").mkdir(parents=True)
    (tmp_path / "images" / "book" / "0003.png").write_bytes(b"10x10")
    go = lambda *a: cli.main([str(x) for x in a], spark)
    assert go("assemble-book", tmp_path / "runs", tmp_path / "book") == 0
    assert go("crop-figures", tmp_path / "book", tmp_path / "images", tmp_path / "figures", "--size", "plugins:size", "--crop", "plugins:crop") == 0
    assert '{"figures": 1}' in capsys.readouterr().out
    assert go("render-xhtml", tmp_path / "book", tmp_path / "ready", "--title", "T", "--assets", tmp_path / "figures" / "assets") == 0
    assert go("package-epub", tmp_path / "ready", tmp_path / "epub") == 0 and go("validate-epub", tmp_path / "epub") == 0
    z = zipfile.ZipFile(io.BytesIO((tmp_path / "epub" / "book.epub").read_bytes()))
    node = spark.read.parquet(f"{tmp_path}/book/nodes").where("node_type = 'figure'").select("node_id", X.figure_file(F.col("node_id")).alias("file")).first()
    assert z.read(f"EPUB/assets/{node.file}") == b"10x10 (0, 5, 10, 10)"
    assert any(f'src="../assets/{node.file}"' in z.read(n).decode() for n in z.namelist() if n.endswith(".xhtml"))
