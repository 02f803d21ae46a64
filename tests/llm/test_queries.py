"""Every registered query of this subpackage, as a query, on tables with nulls, empty and long texts, ties, repeats and clashing names."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from folio.llm import editdistance, graph, lines, mixing, near_dedup, pieces, pseudonyms, quality, queries, repeats, textbytes, toxicity
from folio.llm.scratch import Scratch

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id0 long, _text0 string, _removed0 string, _copies0 long, _host0 long"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Folders of tables: one with rows, one without."""
    rng = random.Random(11)
    words = ["stone", "water", "the", "of", "under", "bridge", "é", "sing"]
    rows = []
    for i in range(80):
        t = "\n".join(" ".join(rng.choice(words) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 3)))
        t = {0: None, 1: "", 2: " \n\t", 3: "word " * 30000, 4: rows[-1][1] if rows else t}.get(i % 20, t)
        rows.append((None if i == 50 else i, t, "en", rng.choice(["a", "a", "b", None]), 0, 1, "x", "y", 2, 3))
    rows += rows[5:9]
    labels = [(i, 1, int(i % 7 == 0)) for i in range(60)]
    vectors = [(i, [float(rng.randint(-3, 3)) / 4 for _ in range(4)]) for i in range(120)] + [(200, None), (201, [float("inf")] * 4)]
    talk = [(None if i % 30 == 7 else i % 13, None if i % 11 == 5 else i % 4, rng.choice(["user", None]), rng.choice(["", "hello", "é", None]), "x") for i in range(150)]
    out = {}
    for name, keep in (("full", 1), ("empty", 0)):
        d = str(tmp_path_factory.mktemp(name))
        for table, data, schema in (("documents", rows, SCHEMA), ("labels", labels, "doc_id long, quality int, toxic int"), ("embeddings", vectors, "vec_id long, embedding array<double>"), ("conversations", talk, "conv_id long, turn long, role string, text string, depth string")):
            spark.createDataFrame(data if keep else [], schema).write.parquet(f"{d}/{table}.parquet")
        out[name] = d
    return rows, out


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query_on_odd_tables(spark, tables, name):
    rows, dirs = tables
    run = queries.queries()[name]
    got = run(spark, dirs["full"])
    n = got.count()
    # A path is one file however often it stands there; vectors and nodes of conversations are not documents.
    assert n == (len({r[0] for r in rows}) if name.startswith("op10") else n if name.startswith(("op4", "op11")) else len(rows))
    assert run(spark, dirs["empty"]).count() == 0
    again = run(spark, dirs["full"])
    assert sorted(map(repr, got.collect())) == sorted(map(repr, again.collect()))


def test_stages_keep_columns(spark, tables):
    docs = spark.read.parquet(f"{tables[1]['full']}/documents.parquet")
    for stage in (quality.kept_documents, lines.without_duplicate_lines, mixing.mixture):
        assert stage(docs).columns == docs.columns and stage(docs).count() >= 0
        assert stage(docs.limit(0)).count() == 0


def thue_morse(n, flip=False):
    return "".join("ab"[bin(i).count("1") % 2 ^ flip] for i in range(n))


def test_patterns_do_not_collide(spark):
    a, b = thue_morse(1024), thue_morse(1024, True)
    buf = np.frombuffer((a + b).encode(), np.uint8)
    h = textbytes.span_hash(buf, np.array([0, 1024]), np.array([1024, 2048]))
    assert h[0] != h[1]
    long = np.frombuffer((a * 3 + a * 2 + b).encode(), np.uint8)
    h = textbytes.span_hash(long, np.array([0, 3072]), np.array([3072, 6144]))
    assert h[0] != h[1]
    df = spark.createDataFrame([(1, a), (2, b), (3, f"{a}\n{b}")], "doc_id long, text string").selectExpr("*", "'s' as source")
    assert {r.doc_id: r.component_id for r in near_dedup.near_duplicates(df, 2).collect()} == {1: 1, 2: 2, 3: 3}
    assert {r.doc_id: r.n_dup_lines for r in quality.quality(df).collect()} == {1: 0, 2: 0, 3: 0}
    got = {r.doc_id: r.n_removed for r in repeats.remove_repeats(df).collect()}
    want = lambda d, text, earlier: sum(any(any(text[i : i + 50] in e for e in earlier) for i in range(max(0, p - 49), min(p, len(text) - 50) + 1)) for p in range(len(text)))
    assert got == {1: 0, 2: want(2, b, [a]), 3: want(3, f"{a}\n{b}", [a, b])}


def test_lines_that_stand_together(spark):
    """Five lines on each of many pages are each counted once a page; copies of a page count once."""
    same = [f"menu entry {k}" for k in range(5)]
    page = lambda i, copies="": "\n".join([*same, *(f"body {i} {j} " + " ".join(f"w{i}{j}{k}" for k in range(9)) for j in range(4))]) + copies
    rows = [(i, page(i), "a") for i in range(12)] + [(100 + i, page(99), "b") for i in range(30)] + [(200 + i, page(i), "c") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: (r.frequent_lines, r.kept) for r in quality.quality(df).collect()}
    assert all(got[i] == ([0, 1, 2, 3, 4], True) for i in range(12))
    assert all(got[100 + i][0] == [] for i in range(30)) and all(got[200 + i][0] == [] for i in range(9))
    assert all("menu" not in r.text for r in quality.kept_documents(df).collect() if r.doc_id < 100)
    only = spark.createDataFrame([(i, "\n".join(same * 5) + f"\nown {i}", "a") for i in range(12)], "doc_id long, text string, source string")
    assert not any(r.kept for r in quality.quality(only).collect())


def test_mixture_takes_what_is_decided(spark):
    rows = [(i // 2, "w " * (i // 2 % 9 + 1), "s", "abc"[i // 2 % 3] if i % 4 else None, 0) for i in range(2000)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    decided = {}
    for r in mixing.mixed(df).collect():
        decided[r.doc_id, r.source] = decided.get((r.doc_id, r.source), 0) + r.copies
    taken = {}
    for r in mixing.mixture(df).collect():
        taken[r.doc_id, r.source] = taken.get((r.doc_id, r.source), 0) + 1
    assert taken == {k: v for k, v in decided.items() if v}


def test_edit_distances():
    rng = random.Random(4)

    def slow(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(new[j] + 1, row[j + 1] + 1, row[j] + (x != y)))
            row = new
        return row[-1]

    text = lambda: "".join(rng.choice("abcé你\U0001f600") for _ in range(rng.choice([0, 1, 5, 63, 64, 65, 128, 130, 300])))
    left = [text() for _ in range(120)]
    right = [text() if i % 2 else a[: rng.randint(0, len(a))] + "x" + a[rng.randint(0, len(a)) :] for i, a in enumerate(left)]
    want = [slow(a, b) for a, b in zip(left, right, strict=True)]
    few, editdistance.FEW = editdistance.FEW, 0
    try:
        assert editdistance.distances(left, right).tolist() == want
    finally:
        editdistance.FEW = few
    assert editdistance.distances(left, right).tolist() == want and editdistance.distances([], []).tolist() == []


def test_tokens_decode(spark):
    p = pieces.load()
    rows = [(1, "hello  world ▁ \n"), (2, None), (3, ""), (4, "x" * 50000), (4, "twice"), (None, "é")]
    out = pieces.encoded(spark.createDataFrame(rows, "doc_id long, text string"), p)
    assert all(r.round_trip for r in out.collect())
    back = sorted((r.doc_id or 0, r.text) for r in pieces.decoded(out, p).collect())
    assert back == sorted((d or 0, t or "") for d, t in rows)
    assert pieces.decoded(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), p).first().text is None


def test_pseudonyms_link_documents(spark):
    rows = [(1, "call +1 988 555 2485 now"), (2, "+19885552485"), (3, None), (4, ""), (1, "card 4111 1111 1111 1111"), (5, "4111111111111111 " * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.n_found, r.text) for r in pseudonyms.pseudonyms(df, b"k").collect()]
    digits = lambda t: "".join(c for c in t or "" if c.isdigit())
    by = {(d, n): t for d, n, t in got}
    assert digits(by[1, 1] if "call" in by[1, 1] else "") == digits(by[2, 1]) or any(digits(t) == digits(by[2, 1]) for d, _, t in got if d == 1)
    assert [t for d, _, t in got if d == 3] == [None] and any(n == 3000 for _, n, _ in got)
    assert pseudonyms.pseudonyms(df, b"other").where("doc_id = 2").first().text != by[2, 1]
    with pytest.raises(ValueError):
        pseudonyms.Feistel(b"")


def test_toxicity_contract(spark):
    rng = random.Random(9)
    plain = ["the", "of", "thing", "water", "stone", "where", "under"]
    docs = [(i, " ".join(rng.choice(plain) for _ in range(40)) + (" wretched vermin" if i % 4 == 0 else "")) for i in range(400)] + [(900, None), (901, ""), (None, "the stone")]
    labels = [(i, int(i % 4 == 0)) for i in range(400)]
    d, lb = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    out = {r.doc_id: r for r in toxicity.score(d, toxicity.train(d, lb)).collect()}
    assert len(out) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out.values())
    assert out[900].score == out[901].score < 0.5
    import zlib

    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(out[i].held_out == (i in held) for i in range(400))
    assert sum(out[i].predicted == int(i % 4 == 0) for i in held) > 0.9 * len(held)
    # Labels of held-out rows are no input.
    turned = spark.createDataFrame([(i, 1 - t if i in held else t) for i, t in labels], "doc_id long, toxic int")
    assert {r.doc_id: r.score for r in toxicity.score(d, toxicity.train(d, turned)).collect()} == {k: r.score for k, r in out.items()}


def test_digest_of_kept_bytes(spark):
    """Repeats across documents with null doc_ids, repeated rows and a very long text."""
    part = "0123456789" * 6
    rows = [(1, "a" * 200000), (2, part), (2, part), (3, "x" + part + "y"), (None, part), (4, None)]
    got = [(r.doc_id, r.n_removed, r.kept_sha256) for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted(got, key=repr) == sorted([(1, 0, sha("a" * 200000)), (2, 0, sha(part)), (2, 0, sha(part)), (3, 60, sha("xy")), (None, 0, sha(part)), (4, 0, sha(""))], key=repr)


def test_edit_distances_up_to_a_bound():
    """Pairs within the bound keep their distance, others get a number over it; few pairs are computed one by one."""
    rng = random.Random(4)
    left = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(0, 200))) for _ in range(300)]
    right = ["".join(c if rng.random() < 0.85 else rng.choice("abcdé") for c in x) if i % 2 else "".join(rng.choice("xyz") for _ in x) for i, x in enumerate(left)]
    want = editdistance.distances(left, right)
    most = np.array([max(len(x), len(y)) // 5 for x, y in zip(left, right, strict=True)])
    assert 50 < (want <= most).sum() < 250
    for take in (range(300), range(3), range(7, 9)):
        got = editdistance.distances([left[i] for i in take], [right[i] for i in take], most[list(take)])
        assert [min(g, m + 1) for g, m in zip(got.tolist(), most[list(take)].tolist(), strict=True)] == [min(w, m + 1) for w, m in zip(want[list(take)].tolist(), most[list(take)].tolist(), strict=True)]
    assert not (lines._may_be_close(left, right, most) < (want <= most)).any() and not lines._may_be_close(left, right, most).all()


def test_lines_of_a_bucket_are_told_apart_by_their_counts():
    """Lines too short for a SimHash that share a passage: before, all their pairs were put out and verified."""
    passage = "some words of a passage here"
    texts = [f"{passage} {c * 12} {c * 9}" for c in "abcdefghijklmnopqrstuvwxyz"] + [f"{passage} {'a' * 12} {'a' * 8}b"]
    _, _, _, _, chars, _, features, sim, more_sim, bag, two, _, _ = lines._signatures(texts)
    table = np.zeros(len(texts), lines._SIG)
    table["chars"], table["bag"], table["two"] = chars, bag, two
    found = [tuple(sorted(p)) for i, j in lines._near([r.tobytes() for r in table], np.arange(len(texts))) for p in zip(i.tolist(), j.tolist(), strict=True)]
    assert found == [(0, 26)]


def test_line_dedup_leaves_one_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("folio.llm.scratch.shared_root", lambda _: str(tmp_path))
    df = spark.createDataFrame([(i, f"a line of several words that is in every text\nand one more of {'xyz'[i % 3]} its own") for i in range(9)], "doc_id long, text string")
    out = lines.dedup_lines(df)
    assert len(list(tmp_path.glob("folio-lines-*/[0-9]*"))) == 1
    assert sorted(r.n_removed for r in out.collect()) == [0, 2, 2, 2, 2, 2, 2, 2, 2]


def test_chunks_of_a_bucket_meet_once(spark, monkeypatch):
    monkeypatch.setattr(graph, "CHUNK_ROWS", 16)
    sizes = [int(4 * 1.04**i) for i in range(120)]
    # A bucket of several chunks and one of a single one.
    rows = [(1, i, i % 50, 120) for i in range(120)] + [(2, i, i % 50, 10) for i in range(60, 70)]
    sigs = spark.createDataFrame([(i, str(n).encode()) for i, n in enumerate(sizes)], "id long, sig binary")

    def tiles(sig, c):
        n = np.array([int(x) for x in sig])
        i, j = np.nonzero((100 * np.minimum(n[:, None], n) >= 80 * np.maximum(n[:, None], n)) & (c[:, None] != c))
        yield i[i < j], j[i < j]

    members = spark.createDataFrame(rows, "bucket long, id long, c long, members long")
    found = [tuple(r) for r in graph._across(members, lambda ids: sigs.join(ids, "id"), None, tiles, Scratch(spark, "test")).collect()]
    want = [(i, j) for i in range(120) for j in range(i + 1, 120) if 100 * sizes[i] >= 80 * sizes[j] and i % 50 != j % 50]
    assert sorted(found) == sorted([*want, *((i, j) for i, j in want if 60 <= i < j < 70)])


def test_large_buckets_are_dealt_in_rounds(spark, monkeypatch):
    """Rows hold texts, one for each bucket of a line: before, those of all buckets were on disk at once."""
    monkeypatch.setattr(graph, "CHUNK_ROWS", 16)
    monkeypatch.setattr(graph, "LEAST_ROUND_BYTES", 1)
    # Every line is in two of four buckets of several chunks.
    rows = [(b, i, i % 20, 40) for i in range(80) for b in (i % 2, 2 + i // 2 % 2)]
    sigs = spark.createDataFrame([(i, str(i).encode()) for i in range(80)], "id long, sig binary")

    def tiles(sig, c, here):
        n = np.array([int(x) for x in sig])
        i, j = np.nonzero((abs(n[:, None] - n) <= 8) & (c[:, None] != c))
        own = here(i, j)
        yield i[own & (i < j)], j[own & (i < j)]

    scratch, saved = Scratch(spark, "test"), []
    save = scratch.save
    monkeypatch.setattr(scratch, "save", lambda df, rows=None: saved.append(save(df, rows)) or saved[-1])
    members = spark.createDataFrame(rows, "bucket long, id long, c long, members long")
    found = sorted(tuple(r) for r in graph._across(members, lambda ids: sigs.join(ids, "id"), None, tiles, scratch, once=True).collect())
    assert found == [(i, j) for i in range(80) for j in range(i + 1, 80) if j - i <= 8 and (j - i) % 20 and ((j - i) % 2 == 0 or i // 2 % 2 == j // 2 % 2)]
    parts = [t.count() for t in saved if t.columns == ["a", "b"]]
    assert len(parts) > 4 and max(parts) < len(found) / 2


def test_pairs_that_do_not_link_are_no_rows(spark, monkeypatch):
    """Near copies below the similarity share their blocks: before, all of their pairs were rows, and each was one again to be verified."""
    monkeypatch.setattr(graph, "JOINED_ROWS", 4)
    monkeypatch.setattr(graph, "CHUNK_ROWS", 16)
    rng = random.Random(3)
    voc = ["".join(rng.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(400)]
    base = [rng.choice(voc) for _ in range(40)]
    texts = []
    for _ in range(40):
        w = list(base)
        for p in rng.sample(range(4, 40), 8):
            w[p] = rng.choice(voc)
        texts.append(" ".join(w))
    texts += [texts[7] + " x", texts[30][:-3]]
    made, across = [], graph._across

    def counted(*a, **k):
        found = across(*a, **k).distinct()
        made.append(found.count())
        return found

    monkeypatch.setattr(graph, "_across", counted)
    out = lines.dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            n = max(len(texts[i]), len(texts[j]))
            if editdistance.distances([texts[i]], [texts[j]])[0] * 5 <= n:
                a, b = sorted((group[i], group[j]))
                group = [a if g == b else g for g in group]
    assert {r.doc_id for r in out.collect() if r.n_removed} == {i for i, g in enumerate(group) if g != i}
    assert len(made) == 1 and made[0] < len(texts)


def test_links_of_a_bucket_are_fewer_than_its_lines():
    texts = ["some words of a line that is near all of the others " + c * 4 for c in "abcdefghijkl"]
    _, _, _, _, chars, _, features, sim, more_sim, bag, two, _, _ = lines._signatures(texts)
    table = np.zeros(len(texts), lines._SIG)
    table["chars"], table["features"], table["sim"], table["more_sim"], table["bag"], table["two"] = chars, features, sim.view(np.int64), more_sim.view(np.int64), bag, two
    sigs = [r.tobytes() + t.encode() for r, t in zip(table, texts, strict=True)]
    every = lambda i, j: np.ones(len(i), bool)
    assert sum(len(i) for i, _ in lines._near([r.tobytes() for r in table], np.arange(12))) == 66
    assert sum(len(i) for i, _ in lines._linking(sigs, np.arange(12), every)) == 11
    assert sum(len(i) for i, _ in lines._linking(sigs, np.arange(12), lambda i, j: ~every(i, j))) == 0
