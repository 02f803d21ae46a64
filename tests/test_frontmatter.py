"""Metadata and covers from first pages, manifests of rendered books, files written by tasks, and backups."""

import io
import json
import zipfile

import plugins
import pytest
from pyspark.sql import functions as F

from folio import cli
from folio.operators import backup as B
from folio.operators import frontmatter as M
from folio.operators import ready as Y
from folio.sources import outputs as O


@pytest.fixture(autouse=True)
def sent(spark):
    spark.sparkContext.addPyFile(plugins.__file__)


def test_suggestions_are_judged(spark):
    cases = {
        '{"title":"T","authors":["A"],"cover_page_number":2,"warnings":["x"," "]}': [],
        '{"title":"T","cover_page_number":true}': ["cover_page_number: a whole number above 0"],
        '{"cover_page_number":0,"warnings":[1]}': ["cover_page_number: a whole number above 0", "warnings: a list of texts"],
        '{"title_page_number":1.5,"warnings":null,"cover_page_number":null}': ["title_page_number: a whole number above 0"],
        '{"title":" "}': ["title: a text that isn't empty"],
        '{"warnings":{}}': ["warnings: a list of texts"],
        "[]": ["no object"],
        "x": ["not JSON"],
        "{}": [],
    }
    rows = spark.createDataFrame([*((t,) for t in cases), (None,)], "_raw string")
    got = {r["_raw"]: r for r in M.judged_suggestions(rows).collect()}
    assert {t: r.violations for t, r in got.items()} == cases | {None: ["not JSON"]}
    first = got[next(iter(cases))].suggestion
    assert (first.metadata.title, first.metadata.authors, first.cover_page_number, first.title_page_number, first.warnings) == ("T", ["A"], 2, None, ["x"])


def test_first_pages(spark):
    rows = [("a", n, "image/png", bytes([n])) for n in (9, 3, 1, 8)] + [("a", 3, "image/png", b"\xff")]
    tasks = M.front_tasks(spark.createDataFrame(rows, "book_id string, page_number int, media_type string, image binary"))
    assert [[(p.page_number, bytes(p.image)) for p in r.first_pages] for r in tasks.collect()] == [[(1, b"\x01"), (3, b"\x03"), (8, b"\x08")]]
    for first, last in ((0, 3), (4, 3), (10, 12)):
        with pytest.raises(ValueError):
            M.front_tasks(spark.createDataFrame(rows, "book_id string, page_number int, media_type string, image binary"), first, last)


def images(folder, books):
    for book, pages in books.items():
        (folder / book).mkdir(parents=True)
        for name, text in pages.items():
            (folder / book / name).write_bytes(text.encode())


def test_metadata_to_packages(spark, tmp_path, capsys):
    books = {"a b": {"1.jpg": "cover=1", "2.jpg": "x", "9.jpg": "y"}, "c": {"1.jpg": "cover=2", "2.png": "png"}, "d": {"1.jpg": "cover=7"}, "e": {"1.jpg": "cover=2", "2.png": "spoilt"}, "f": {"1.jpg": "x"}}
    images(tmp_path / "images", books)
    go = lambda *a: cli.main([str(x) for x in a], spark)
    route = ["--route", "f=free=plugins:suggest", "--backoff", "0"]
    out = tmp_path / "metadata"
    assert go("extract-metadata", tmp_path / "images", out, tmp_path / "work", *route, "--convert", "plugins:jpeg") == 0
    capsys.readouterr()
    report = {b: json.loads((out / "reports" / f"{b}.json").read_text()) for b in books}
    assert {b: r["cover_extraction"]["status"] for b, r in report.items()} == {"a b": "extracted", "c": "extracted", "d": "page-not-selected", "e": "failed", "f": "not-detected"}
    assert report["a b"]["selected_pages"] == [1, 2] and report["f"]["warnings"] == ["see"] and len(report["d"]["warnings"]) == 2 and "ValueError: spoilt" in report["e"]["warnings"][1]
    assert (out / "covers" / "a b.jpg").read_bytes() == b"cover=1" and (out / "covers" / "c.jpg").read_bytes() == b"jpeg of png" and not (out / "covers" / "e.jpg").exists()
    assert [report[b]["cover_extraction"]["transcoded"] for b in ("a b", "c")] == [False, True]
    meta = json.loads((out / "a b.json").read_text())
    assert meta["title"] == "T & a b" and meta["cover"] == "covers/a b.jpg" and meta["publisher"] is None and json.loads((out / "f.json").read_text())["cover"] is None
    # What was suggested goes into the packages, each with its cover.
    assert go("convert-book", tmp_path / "images", tmp_path / "runs", tmp_path / "out", "--route", "f=free=plugins:free", "--backoff", "0", "--metadata", out, "--modified", "2020-01-02T03:04:05Z", "--validate") == 0
    z = zipfile.ZipFile(io.BytesIO((tmp_path / "out" / "epub" / "a b.epub").read_bytes()))
    assert z.read("EPUB/assets/cover.jpg") == b"cover=1" and 'src="../assets/cover.jpg" alt="T &amp; a b"' in z.read("EPUB/text/cover.xhtml").decode()
    opf, nav = z.read("EPUB/package.opf").decode(), z.read("EPUB/nav.xhtml").decode()
    assert 'id="cover-image" href="assets/cover.jpg" media-type="image/jpeg" properties="cover-image"' in opf and opf.index('idref="cover"') < opf.index('idref="content') and 'epub:type="cover" href="text/cover.xhtml"' in nav
    assert "EPUB/text/cover.xhtml" not in zipfile.ZipFile(io.BytesIO((tmp_path / "out" / "epub" / "f.epub").read_bytes())).namelist()
    made = {r.book_id: r.manifest for r in spark.read.parquet(f"{tmp_path}/out/ready/manifests").collect()}
    assert made["c"].cover.image == "assets/cover.jpg" and made["c"].contents[0] == "text/cover.xhtml" and made["f"].cover is None and made["c"].content != "text/cover.xhtml"
    (out / "covers" / "c.jpg").unlink()
    assert go("render-xhtml", tmp_path / "out" / "book", tmp_path / "no", "--metadata", out) == 2
    # A book whose first pages no plug-in answers for has no metadata.
    images(tmp_path / "other", {"g": {"1.jpg": "no answer"}})
    assert go("extract-metadata", tmp_path / "other", tmp_path / "m2", tmp_path / "w2", *route) == 1
    assert go("extract-metadata", tmp_path / "other", tmp_path / "m2", tmp_path / "w2", *route, "--start-page", "4") == 2


def test_manifests(spark):
    books = spark.createDataFrame([("a", "A", "en"), ("b", "B", None), ("n", "N", None)], "book_id string, title string, language string")
    documents = spark.createDataFrame([("a", 2, "two.xhtml"), ("a", 1, "one.xhtml"), ("a", 1 << 30, "endnotes.xhtml"), ("a", -1, "cover.xhtml"), ("b", 1, "one.xhtml"), ("b", -1, "cover.xhtml")], "book_id string, position int, file string")
    assets = spark.createDataFrame([("a", "assets/z.png"), ("a", "assets/cover.png")], "book_id string, file string")
    made = Y.manifests(books, documents, assets)
    a, b, n = (r.manifest for r in made.orderBy("book_id").collect())
    assert a.contents == ["text/cover.xhtml", "text/one.xhtml", "text/two.xhtml", "text/endnotes.xhtml"] and (a.content, a.endnotes, a.cover.image, a.assets) == ("text/one.xhtml", "text/endnotes.xhtml", "assets/cover.png", ["assets/cover.png", "assets/z.png"])
    there = documents.select("book_id", F.concat(F.lit("text/"), "file").alias("file")).unionByName(assets).unionByName(books.select("book_id", F.lit(Y.STYLESHEET).alias("file")))
    problems = lambda m, f: {tuple(r) for r in Y.manifest_problems(m, f).collect()}
    assert problems(made, there) == {("b", None, "cover is no asset"), ("n", None, "no contents")}
    one = made.where("book_id = 'a'")
    assert problems(one, there.where("file <> 'assets/z.png'")) == {("a", "assets/z.png", "is not there")}
    put = lambda **fields: one.withColumn("manifest", F.col("manifest").withField(*next(iter(fields.items()))))
    array = lambda *x: F.array(*map(F.lit, x))
    assert problems(put(assets=array("assets/z.png")), there) == {("a", "assets/cover.png", "cover is no asset")}
    assert problems(put(contents=array("text/one.xhtml", "text/one.xhtml")), there) == {("a", "text/one.xhtml", "named twice"), ("a", "text/cover.xhtml", "cover is not in contents"), ("a", "text/endnotes.xhtml", "notes are not in contents")}
    bad = ["../x", "/x", "a//b", "a/./b", "a/../b", " ", ""]
    assert problems(put(assets=array("assets/cover.png", *bad)), there) == {("a", p, "leaves the book") for p in bad}
    assert problems(put(assets=array("assets/cover.png", "styles/book.css")), there) == {("a", "styles/book.css", "named twice")}


def test_files_of_tasks(spark, tmp_path):
    rows = spark.createDataFrame([("a/b c", b"1"), ("d", None)], "path string, data binary")
    for _ in range(2):
        got = {r.path: (r.sha256, r["size"]) for r in O.write_files(rows, str(tmp_path)).collect()}
    assert got["d"][1] == 0 and got["a/b c"][1] == 1 and (tmp_path / "a" / "b c").read_bytes() == b"1"
    assert sorted(p.name for p in tmp_path.rglob("*")) == ["a", "b c", "d"]
    O.remove_files(rows.select("path").unionByName(spark.createDataFrame([("none",)], "path string")), str(tmp_path)).count()
    assert sorted(p.name for p in tmp_path.rglob("*")) == ["a"]
    for bad in ("../x", "a//b", "/x", "", None):
        with pytest.raises(Exception, match="no path below"):
            O.write_files(spark.createDataFrame([(bad, b"")], "path string, data binary"), str(tmp_path)).count()


def test_backup(spark, tmp_path, capsys):
    ready, proof, out, work = (tmp_path / n for n in ("ready", "proof", "out", "work"))
    texts = {("a", "1.xhtml"): "one", ("a", "2.xhtml"): "two", ("b", "1.xhtml"): "b"}

    def render():
        spark.createDataFrame([(*k, v) for k, v in texts.items()], "book_id string, file string, content string").write.mode("overwrite").parquet(f"{ready}/documents")

    (tmp_path / "meta").mkdir()
    (tmp_path / "meta" / "a.json").write_text("{}")
    spark.createDataFrame([("a", "f2", "keep"), ("a", "f1", None)], "book_id string, finding_id string, decision string").write.parquet(f"{tmp_path}/review/resolutions")
    go = lambda *a: cli.main([str(x) for x in a], spark)

    def backed():
        state = go("backup-book", ready, proof, out, work, "--metadata", tmp_path / "meta", "--review", tmp_path / "review")
        return state, json.loads(capsys.readouterr().out.strip().splitlines()[-1]) if state == 0 else None

    render()
    assert backed()[0] == 2
    assert go("prepare-proof", ready, proof) == 0
    capsys.readouterr()
    assert backed() == (0, {"add": 9})
    assert json.loads((out / "a" / "review" / "resolutions.json").read_text()) == [{"finding_id": "f1", "decision": None}, {"finding_id": "f2", "decision": "keep"}]
    manifest = json.loads((out / "a" / "backup-manifest.json").read_text())
    assert manifest["proof"] == {"editable_xhtml": 2, "modified_xhtml": []} and manifest["artifacts"] == {"proof": True, "metadata": True, "review_resolutions": True, "build_info": True}
    assert json.loads((out / "b" / "backup-manifest.json").read_text())["artifacts"]["metadata"] is False
    # Files of others stay, with those of books that aren't there, and an unchanged book changes nothing.
    (out / ".git").mkdir()
    for name in (".git/x", "notes.txt", "a/mine.txt"):
        (out / name).write_text("mine")
    (out / "z" / "proof").mkdir(parents=True)
    (out / "z" / "proof" / "x").write_text("z")
    before = (out / "a" / "proof" / "text" / "1.xhtml").stat().st_mtime_ns
    assert backed() == (0, {"keep": 9}) and (out / "a" / "proof" / "text" / "1.xhtml").stat().st_mtime_ns == before
    texts["a", "1.xhtml"] = "changed"
    del texts["a", "2.xhtml"]
    render()
    (tmp_path / "meta" / "a.json").unlink()
    assert backed() == (0, {"keep": 4, "remove": 2, "replace": 3})
    manifest = json.loads((out / "a" / "backup-manifest.json").read_text())
    assert manifest["proof"] == {"editable_xhtml": 1, "modified_xhtml": ["1.xhtml"]} and not manifest["artifacts"]["metadata"]
    assert sorted(str(p.relative_to(out)) for p in out.rglob("*") if p.is_file()) == sorted([".git/x", "notes.txt", "a/mine.txt", "z/proof/x", "a/proof/text/1.xhtml", "a/review/resolutions.json", "a/build-info.json", "a/backup-manifest.json", "b/proof/text/1.xhtml", "b/build-info.json", "b/backup-manifest.json"])
    (tmp_path / "link").symlink_to(out)
    assert go("backup-book", ready, proof, tmp_path / "link", work) == 2
    assert go("backup-book", ready, proof, ready / "below", work) == 2 and go("backup-book", ready, proof, tmp_path, work) == 2


def test_backup_actions(spark):
    rows = lambda *r: spark.createDataFrame(r, "path string, sha256 string")
    got = B.actions(rows(("a/proof/1", "x"), ("a/metadata.json", "y")), rows(("a/proof/1", "x"), ("a/proof/2", "x"), ("a/metadata.json", "z"), ("a/other", "x"), ("b/proof/1", "x"), ("a/x/metadata.json", "x")))
    assert {tuple(r) for r in got.collect()} == {("a/proof/1", "keep"), ("a/proof/2", "remove"), ("a/metadata.json", "replace")}
