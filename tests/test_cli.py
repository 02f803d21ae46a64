"""The command line from page runs to a package, and through a review."""

import json

from test_books import block, payload, span

from folio import cli
from folio.operators import evidence as E


def runs(root):
    text = {1: "Here it stats", 2: "and it ends x2"}
    for n, t in text.items():
        page = E.identified(f"p{n}", payload(block("heading", f"Part {n}", heading="section_title"), block("paragraph", span(t)))) | {"source": {"source_id": "s", "uri": "u", "sha256": None, "media_type": None, "metadata": {"page_number": n}}}
        folder = root / "book" / f"page-{n}"
        (folder / "normalized").mkdir(parents=True)
        (folder / "review").mkdir()
        (folder / "normalized" / "page.json").write_text(json.dumps(page))
        (folder / "manifest.json").write_text("{}")
        words = f"Part {n} " + t.replace("stats", "starts")
        rows = ["level\tconf\ttext\tleft\ttop\twidth\theight", *(f"5\t99\t{w}\t1\t2\t3\t4" for w in words.split())]
        (folder / "review" / "ocr.tsv").write_text("\n".join(rows))


def test_from_runs_to_package(spark, tmp_path, capsys):
    root, out, review = tmp_path / "runs", tmp_path / "out", tmp_path / "review"
    runs(root)
    go = lambda *a: cli.main([str(x) for x in a], spark)
    assert go("review-text", root, review) == 0 and go("review-status", root, review) == 1
    found = {(r.finding_id, r.reference_text or r.suggested_text) for r in spark.read.parquet(f"{review}/findings").collect()}
    assert found == {("page-0001-ocr-0001", "r"), ("page-0002-heur-0001", "x 2")}
    (tmp_path / "decisions.json").write_text(json.dumps([{"book_id": "book", "finding_id": "page-0001-ocr-0001", "decision": "use_ocr"}, {"book_id": "book", "finding_id": "page-0002-heur-0001", "decision": "keep_source"}]))
    assert go("import-review", review, tmp_path / "decisions.json") == 0 and go("review-status", root, review) == 0
    assert go("build-epub", root, out, "--title", "T", "--review", review, "--require-reviewed", "--modified", "2020-01-02T03:04:05Z", "--validate") == 0
    assert (out / "epub" / "book.epub").stat().st_size > 500
    assert any("Here it starts" in r.content for r in spark.read.parquet(f"{out}/ready/documents").collect())
    assert go("prepare-proof", out / "ready", tmp_path / "proof") == 0 and go("prepare-proof", out / "ready", tmp_path / "proof") == 0
    assert go("build-epub", root, tmp_path / "no") == 2 and go("assemble-book", root, tmp_path / "no", "--exclude-pages", "9") == 2
    assert "ok" in capsys.readouterr().out


def test_golden_action(spark, tmp_path, capsys):
    usage = {t: 1 for t in ("prompt_token_count", "candidates_token_count", "thoughts_token_count", "total_token_count")} | {"cached_content_token_count": None}
    page = E.identified("p", payload(*(block("paragraph", "– a") for _ in range(4)))) | {"source": {"source_id": "s", "uri": "u", "sha256": None, "media_type": None, "metadata": {}}}
    folder = tmp_path / "page-0397"
    folder.mkdir()
    (folder / "page.json").write_text(json.dumps(page))
    (folder / "case.json").write_text(json.dumps({"case_id": "page-0397", "model": "m", "prompt_version": "5", "schema_version": "5", "source_page_number": 397, "tags": [], "usage": usage}))
    assert cli.main(["evaluate-golden", str(tmp_path)], spark) == 0
    text = capsys.readouterr().out
    assert "pass  page-0397" in text and '"total_token_count": 1' in text and '"cached_content_token_count": null' in text
