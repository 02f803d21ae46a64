"""Operators for training text against brute force on small fixtures."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from folio.llm import licenses, lines, mixing, near_dedup, pieces, pseudonyms, quality, repeats, topk, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component_id long"
WORDS = ["the", "of", "and", "thing", "er", "on", "that", "ation", "é", "ß", "ou", "Idiot", "x1"]


def docs(spark, n=60, seed=1):
    """Texts with nulls, empties, repeats, copies and near copies, and a column whose name clashes."""
    rng, rows = random.Random(seed), []
    passage = " ".join(rng.choice(WORDS) for _ in range(30))
    for i in range(n):
        t = "\n".join(" ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(1, 4)))
        r = rng.random()
        if r < 0.1:
            t = None
        elif r < 0.15:
            t = ""
        elif r < 0.3 and rows:
            t = rng.choice(rows)[1]
        elif r < 0.5:
            t += "\n" + passage
        elif r < 0.6 and rows and (o := rng.choice(rows)[1]):
            t = o + " more"
        rows.append((i * 7 % 61, t, "en", rng.choice(["a", "b", None]), 0, 9))
    return rows, spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text, k):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}


def test_near_duplicates(spark):
    rows, df = docs(spark)
    sets = {d: shingles(t, 2) for d, t, *_ in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(df, 2, 80).collect()}
    assert got == {d: (len(sets[d]), find(d), find(d) == d) for d in sets}
    assert near_dedup.near_duplicates(empty(spark), 2, 80).count() == 0


def test_estimate_of_registers():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
    a, b = near_dedup.registers(x[:900]), near_dedup.registers(x[100:])
    assert abs(near_dedup.estimate(a[None], b[None])[0] - 0.8) < 0.15


@pytest.mark.parametrize("hot", [1000, 2])
def test_repeats(spark, hot):
    rows, df = docs(spark, seed=3)
    owner = {}
    for d, t, *_ in rows:
        b = (t or "").encode()
        for i in range(len(b) - 49):
            owner[b[i : i + 50]] = min(owner.get(b[i : i + 50], d), d)
    want = {}
    for d, t, *_ in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - 49):
            if owner[b[i : i + 50]] < d:
                gone[i : i + 50] = [True] * 50
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        want[d] = (len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone, strict=True) if not g)).hexdigest())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(df, 50, hot).collect()}
    assert got == want and any(w[1] for w in want.values())


def test_maximal_repeats():
    rng = random.Random(1)
    for _ in range(60):
        texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(3)]
        found = {}
        for k, t in enumerate(texts):
            for i in range(len(t)):
                for j in range(i + 2, len(t) + 1):
                    found.setdefault(t[i:j], []).append((k, i))
        side = lambda s, k, i: (texts[k][i - 1] if i else (k, i), texts[k][i + len(s)] if i + len(s) < len(texts[k]) else (k, i))
        want = {s: sorted(o) for s, o in found.items() if all(len({side(s, *p)[e] for p in o}) > 1 for e in (0, 1))}
        at = np.cumsum([0, *map(len, texts)])
        buf = np.frombuffer(b"".join(texts), np.uint8)
        got = {}
        for size, places in repeats.maximal_repeats(buf, at, 2):
            k = np.searchsorted(at, places, "right") - 1
            got[bytes(buf[places[0] : places[0] + size])] = sorted(zip(k.tolist(), (places - at[k]).tolist(), strict=True))
        assert got == want


def test_intervals_of_windows(monkeypatch):
    """Sorts of runs to compare don't grow with the length of what repeats, and intervals are those of equal windows."""
    sorts, real = [], repeats._ranks
    monkeypatch.setattr(repeats, "_ranks", lambda keys: sorts.append(len(keys)) or real(keys))
    rng = random.Random(4)
    for text, least in [(bytes(rng.choice(b"ab\0") for _ in range(3000)), 20), (b"ab" * 20000, 50), (b"a" * 199, 32), (b"a" * 200, 100)]:
        sorts.clear()
        at = np.arange(len(text) - least + 1)
        got = repeats.intervals(np.frombuffer(text, np.uint8), at, least)
        of = {}
        assert all(of.setdefault(text[i : i + least], n) == n for i, n in zip(at.tolist(), got.tolist(), strict=True))
        assert len(set(of.values())) == len(of) and len(sorts) <= 5


def test_stretches_by_document():
    """Stretches are joined within their document only."""
    docs, start, end = (np.array(x) for x in ([7, 3, 7, 3, 7, 9], [0, 5, 4, 0, 20, 1], [4, 9, 12, 3, 30, 2]))
    got = {d: np.frombuffer(b, np.int64).reshape(2, -1).tolist() for d, b in repeats._by_doc(docs, start, end)}
    assert got == {3: [[0, 5], [3, 9]], 7: [[0, 20], [12, 30]], 9: [[1], [2]]}


def test_top_k(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)], 0) for i in range(200)] + [(200, None, 0), (201, [float("nan")] * 6, 0), (202, [], 0), (203, [0.5, None], 0)]
    ints = {i: [int(np.floor(x * 256)) for x in v] for i, v, _ in rows if v is not None and all(x is not None and x == x for x in v)}
    want = {}
    for q in ints:
        if q % 50 == 0:
            s = sorted((-sum(a * b for a, b in zip(ints[q], ints[c], strict=False)), c) for c in ints if c != q)[:5]
            want |= {(q, k + 1): (c, -x) for k, (x, c) in enumerate(s)}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(df).collect()} == want
    assert topk.top_k(df.limit(0)).count() == 0


def test_quality_counts(spark):
    rows, df = docs(spark, seed=4)
    for r in quality.quality(df).collect():
        text = next(t for d, t, *_ in rows if d == r.doc_id) or ""
        w = text.encode().split()
        windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        again = {k for k, n in Counter(windows).items() if n > 1}
        covered = {j for i, x in enumerate(windows) if x in again for j in range(i, i + 8)}
        with_word = [x for x in text.split("\n") if x.split()]
        assert (r.n_words, r.n_repeat_words, r.n_dup_lines) == (len(w), len(covered), len(with_word) - len(set(with_word)))
        assert r.word_chars == sum(len(x.decode()) for x in w)
    assert quality.quality(empty(spark)).count() == 0


def test_frequent_lines_go(spark):
    body = lambda i: "\n".join(" ".join(f"w{i}x{k}y{j}" for j in range(15)) for k in range(2))
    rows = [(i, f"Home | About\n{body(i)}\n\n home | about ", "en", "a", 0, 9) for i in range(12)] + [(50, f"Home | About\n{body(50)}", "en", "b", 0, 9), (51, "Home | About", "en", "a", 0, 9)]
    got = {r.doc_id: r.text for r in quality.kept_documents(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: body(i) + "\n" for i in range(12)} | {50: "Home | About\n" + body(50)}


def test_line_dedup(spark):
    a = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
    df = spark.createDataFrame([(2, a + "\nother words stand here"), (1, "start of it\n" + a), (3, None), (4, ""), (5, a.upper() + "\nThat is 12 new"), (6, "that is 99 new")], "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.text) for r in lines.dedup_lines(df).collect()}
    assert got == {1: (0, "start of it\n" + a), 2: (1, "other words stand here"), 3: (0, None), 4: (0, ""), 5: (1, "That is 12 new"), 6: (1, "")}
    assert lines.dedup_lines(df.limit(0)).count() == 0


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(new[j] + 1, row[j + 1] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def test_line_dedup_finds_edited_lines(spark):
    """Groups as by edit distances of all pairs: a word changed, characters changed, short lines, punctuation."""
    rng = random.Random(8)
    voc = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    all_lines = []
    for n in (1, 2, 4, 7, 8, 10, 10, 12, 20, 20, 30, 60, 130):
        w = [rng.choice(voc) for _ in range(n)]
        w[0] += "abcdef"
        changed, typed = list(w), list(" ".join(w))
        changed[n // 2] = rng.choice(voc)
        for _ in range(len(typed) // 15):
            typed[rng.randrange(len(typed))] = "e"
        all_lines += [" ".join(w), " ".join(changed), "".join(typed), ", ".join(w).upper() + "!"]
    norm = [" ".join(x.lower().replace(",", "").replace("!", "").split()) for x in all_lines]
    group = list(range(len(norm)))
    for i in range(len(norm)):
        for j in range(i):
            n = max(len(norm[i]), len(norm[j]))
            if abs(len(norm[i]) - len(norm[j])) * 5 <= n and edit_distance(norm[i], norm[j]) * 5 <= n:
                a, b = sorted((group[i], group[j]))
                group = [a if g == b else g for g in group]
    df = spark.createDataFrame(list(enumerate(all_lines)), "doc_id long, text string")
    gone = {r.doc_id for r in lines.dedup_lines(df).collect() if r.n_removed}
    assert gone == {i for i, g in enumerate(group) if g != i} and len(gone) > 30
    marks = spark.createDataFrame([(1, "-----"), (2, "-----"), (3, "====")], "doc_id long, text string")
    assert {r.doc_id for r in lines.dedup_lines(marks).collect() if r.n_removed} == {2}


def test_mixing(spark):
    rng = random.Random(5)
    rows = [(i, " ".join("w" * 1 for _ in range(rng.randint(0, 40))), "en", rng.choice(["a", "b", "c", None]) if i % 3 else "a", 0, 0) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mixed(df).collect()
    assert len(got) == 3000 and all(r.taken <= 3 * r["size"] for r in got)
    for s in ("a", "b", "c", None):
        part = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in part) - part[0].target) < 0.03 * part[0].target + 60
    assert abs(sum({r.source: r.target for r in got}.values()) - sum(r["size"] for r in got)) < 1e-6
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in mixing.mixed(df.repartition(7)).collect())
    assert mixing.mixed(empty(spark)).count() == 0


def test_pieces_round_trip():
    p = pieces.load()
    for t in ["", " ", "a  b ", "\n\tx é 你好 \U0001f600 ▁ ▁▁", "the " * 50, "\0\0▁"]:
        assert p.decode(p.encode(t)) == t


def test_pieces_best_score():
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    score = {sp.id_to_piece(i): sp.get_score(i) for i in range(259, 32000)}
    p = pieces.load()
    for t in ["hello", "thing", "ations"]:
        s, best = "▁" + t, [0.0]
        for e in range(1, len(s) + 1):
            best.append(max(best[a] + score[s[a:e]] for a in range(e) if s[a:e] in score))
        assert sum(sp.get_score(int(i)) for i in p.encode(t)) == best[-1]


def test_pseudonyms():
    f = pseudonyms.Feistel(b"k")
    for size in (1, 2, 10, 97, 1000):
        seen = [f.permute(x, size, "t") for x in range(size)]
        assert sorted(seen) == list(range(size)) and [f.permute(x, size, "t", True) for x in seen] == list(range(size))
    text = "card 4111 1111 1111 1111, call +1 (988) 555-2485, on 2020-02-29; a.b@x.example.com 10.0.0.1"
    out, spans = pseudonymised = pseudonyms.pseudonymised(text, f)
    assert [k for k, _, _ in spans] == ["card", "phone", "date", "email", "address"] and pseudonymised == pseudonyms.pseudonymised(text, f)
    assert pseudonyms.luhn("".join(c for c in out[5:24] if c.isdigit())) % 10 == 0
    assert pseudonyms.pseudonymised("clean 1234567890123456 and 300.1.1.1 text", f)[1] == []


def test_pseudonyms_leave_nothing_in_clear():
    f = pseudonyms.Feistel(b"k")
    for text in ("4111 1111 1111 1111 12/25", "4111-1111-1111-1111 123", "7 4111 1111 1111 1111", "no 12 4111111111111111 34"):
        out, spans = pseudonyms.pseudonymised(text, f)
        assert [k for k, _, _ in spans] == ["card"] and "1111" not in out and pseudonyms.pseudonymised(out, f, True)[0] == text
    for text in ("password=correcthorse", 'TOKEN = "abcdefghij"', "Api_Key=abcdefghij"):
        assert [k for k, _, _ in pseudonyms.pseudonymised(text, f)[1]] == ["secret"]
    same = {"".join(c for c in pseudonyms.phone(f, s) if c.isdigit()) for s in ("+14155550100", "+1 415 555 0100", "+1 (415) 555-0100")}
    assert len(same) == 1 and same.pop().startswith("1")


def test_toxicity():
    rng = random.Random(6)
    plain = ["the", "of", "thing", "water", "stone", "where", "under"]
    rows = [(" ".join(rng.choice(plain) for _ in range(60)) + (" wretched" if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(400)]
    m = toxicity.fit(rows)
    assert m.count("you wretched thing")[1] == 1 and m.count("the stone")[1] == 0
    hits = np.array([m.count(t) for t, _ in rows])
    assert (((m.scores(hits[:, 1], hits[:, 0]) >= 0.5) == [y for _, y in rows]).mean()) > 0.95
    assert toxicity.fit([]).scores(np.zeros(1), np.zeros(1))[0] < 0.5


def test_licenses(spark):
    rows = [("a/LICENSE", "Released under the MIT License."), ("a/b/x.txt", "plain words here"), ("a/y.txt", "text\nLicensed under CC BY-NC 4.0."), ("c/z.txt", None), (None, "plain")]
    got = {r.path: (r.own_license, r.license, r.inherited_from) for r in licenses.license_scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert got == {"a/LICENSE": ("MIT", "MIT", None), "a/b/x.txt": (None, "MIT", "a"), "a/y.txt": ("CC-BY-NC-4.0", "CC-BY-NC-4.0", None), "c/z.txt": (None, None, None), None: (None, None, None)}


def test_pipeline_stages(spark):
    import corpus_pipeline

    _, df = docs(spark, seed=7)
    cur = df.drop("component_id")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, cur, "")
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert out.columns == cur.columns
            cur = out
    assert out.columns == ["doc_id", "n_tokens", "ids", "round_trip"] and all(r.round_trip for r in out.collect())


def test_pipeline_is_its_stages(spark, tmp_path):
    """run() gives what brute force gives for the stages that are deterministic, and what the later ones make of it."""
    import corpus_pipeline

    # Numbers are all alike to the line dedup, so words are spelt.
    word = lambda i, j: "".join(chr(97 + (i * 7 + j * k) % 26) for k in (1, 3, 5, 11)) + chr(97 + i % 26) + chr(97 + i // 26)
    body = lambda i, n=30: " ".join(word(i, j) for j in range(n))
    rows = [(i, f"{body(i)}\nshared line of some six words here", "en", "ab"[i % 2], 0, 9) for i in range(1, 40)]
    rows += [(100 + i, body(i) + " tail", "en", "a", 0, 9) for i in range(1, 10)] + [(200, "too short", "en", "a", 0, 9), (201, None, "en", None, 0, 9), (202, "", "en", "a", 0, 9)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = corpus_pipeline.quality_rules(spark, docs, "")
    texts = {r.doc_id: r.text for r in kept.collect()}
    # The shared line is frequent in both hosts; short and empty documents fail.
    assert texts == {i: body(i) for i in range(1, 40)} | {100 + i: body(i) + " tail" for i in range(1, 10)}
    lines_left = {r.doc_id for r in corpus_pipeline.line_dedup(spark, kept, "").collect()}
    assert lines_left == set(range(1, 40))
    near = {r.doc_id for r in corpus_pipeline.minhash_near_dedup(spark, kept, "").collect()}
    assert near == set(range(1, 40))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} <= set(range(1, 40)) and all(r.round_trip for r in out)
    assert abs(len(out) - 39) <= 2
