"""The conversation trie, the token files and the manifest against plain versions, on odd tables."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from compare import difference
from pyspark.sql import functions as F

from folio.llm import conversations, manifest, oracle, queries, running, tokenfiles
from folio.llm.perfecthash import PerfectHash, hashes
from folio.llm.scratch import Scratch

SHA = lambda t: hashlib.sha256(t.encode()).hexdigest()
TALK = "conv_id long, turn long, role string, text string, _base long, depth string"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, place string, tree int"


def trie(rows):
    """Nodes from a dictionary of all prefixes."""
    by = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            by.setdefault(c, []).append((turn, role or "", text or ""))
    order = lambda v: (v[0] is not None, v[0] or 0, hashlib.md5(f"{len(v[1].encode())}:{v[1]}{v[2]}".encode()).hexdigest())
    by = {c: [v[1:] for v in sorted(t, key=order)] for c, t in by.items()}
    members, below = {}, {}
    for c in by:
        h, base = zlib.crc32(str(c).encode()) % 9, c - (abs(c) % 5) * (1 if c >= 0 else -1)
        whole = tuple(by.get(base, [])[:h] + by[c][h:])
        for d in range(len(whole) + 1):
            members.setdefault(whole[:d], []).append((c, d == len(whole)))
    for p in members:
        if p:
            below.setdefault(p[:-1], []).append(p)
    leaves, saved, out = {}, {}, {}
    for p in sorted(members, key=len, reverse=True):
        m = [c for c, _ in members[p]]
        leaves[p] = sum(leaves[q] for q in below.get(p, [])) or 1
        saved[p] = sum(saved[q] for q in below.get(p, [])) + ((len(m) - 1) * len(p[-1][1].encode()) if p else 0)
        ends = ",".join(str(c) for c in sorted(c for c, end in members[p] if end))
        out[min(m), len(p)] = (min(c for c, _ in members[p[:-1]]) if p else None, len(m), len(below.get(p, [])), leaves[p], saved[p], SHA(ends))
    assert len(out) == len(members)
    return out


def nodes(df):
    rows = df.collect()
    found = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in rows}
    assert len(found) == len(rows)
    return found


def test_trie_equals_all_prefixes(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, *range(-20, 40), 7, 7, 7, 7]), rng.choice([None, None, *range(6)]), rng.choice(["u", "a", None]), rng.choice(["", "x", "é", None, "yy"]), 0, "d") for _ in range(900)]
    # Copies of conversations, one that goes on where another ends, long ones with a long common part, and the largest ids.
    rows += [(c, t, "u", "s", 0, "d") for c in range(2000, 2040) for t in range(c % 7)]
    rows += [(3000 + 5 * i, t, "u", f"{t}" if t < 150 + i else "x", 0, "d") for i in range(3) for t in range(150 + 40 * i)]
    rows += [(2**63 - 1 - i, t, "u", f"{t}", 0, "d") for i in range(9) for t in range(4)]
    assert nodes(conversations.prefix_trie(spark.createDataFrame(rows, TALK))) == trie(rows)
    assert nodes(conversations.prefix_trie(spark.createDataFrame([], TALK))) == {}
    assert nodes(conversations.prefix_trie(spark.createDataFrame([(None, 0, "u", "x", 0, "d")], TALK))) == {}


def test_ends_of_many_conversations(spark):
    df = spark.createDataFrame([(5, 2, i) for i in range(-3000, 9000, 3)] + [(6, 2, 9)], "conv_id long, depth long, member long")
    got = {r.conv_id: r.ends_sha256 for r in conversations.end_hashes(df).collect()}
    assert got == {5: SHA(",".join(map(str, range(-3000, 9000, 3)))), 6: SHA("9")}


def test_running_totals(spark):
    rng = random.Random(8)
    rows = [(rng.choice("aaaab"), i, rng.randint(-5, 9)) for i in range(4000)] + [("c", 1, 2)]
    df = spark.createDataFrame(rows, "g string, o long, v long").repartition(7)
    for group in ("g", None):
        got = {(r.g, r.o): r.v for r in running.running(df, group, [F.col("o").asc()], ["v"], Scratch(spark, "test")).collect()}
        sums, want = {}, {}
        for g, o, v in sorted(rows, key=lambda r: (r[0] if group else "", r[1])):
            sums[g if group else ""] = want[g, o] = sums.get(g if group else "", 0) + v
        assert {k: v for k, v in got.items() if group or k[1] != 1} == {k: v for k, v in want.items() if group or k[1] != 1} and len(got) == len(rows)


def tree(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([SHA("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


@pytest.mark.parametrize("n", [1, 2, 8, 9, 700])
def test_manifest_equals_levels(spark, n):
    rng = random.Random(n)
    rows = [(i * 3, rng.choice([None, "", "Ab É", "x" * 70000]), rng.choice(["en", "de", "é", None]) if n > 1 else None, rng.choice(["s", None]), rng.choice([0, None]), "p", 1) for i in range(n)]
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, t: SHA("".join(map(field, (r[0], r[3], r[2], r[4], t))))
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    langs = sorted({r[2] for r in rows}, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([leaf(r, r[1]) for r in rows if r[2] == g]) for g in langs}
    top = tree([trees[g][-1][0] for g in langs])
    want = {}
    for j, g in enumerate(langs):
        for i, r in enumerate(x for x in rows if x[2] == g):
            beside, now = [], leaf(r, r[1].translate(lower) if r[1] and zlib.crc32(str(r[0]).encode()) % 3 == 0 else r[1])
            for levels, at in ((trees[g], i), (top, j)):
                for level in levels[:-1]:
                    run, k = level[at // 8 * 8 : at // 8 * 8 + 8], at % 8
                    beside, now, at = beside + run[:k] + run[k + 1 :], SHA("".join([*run[:k], now, *run[k + 1 :]])), at // 8
            want[r[0]] = (leaf(r, r[1]), trees[g][-1][0], top[-1][0], SHA("".join(beside)), now, now == top[-1][0])
    df = spark.createDataFrame(rows, DOCS)
    out = manifest.manifest(manifest.tampered_leaves(df), with_siblings=True).collect()
    assert {r.doc_id: (r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in out} == want
    assert all(manifest.folded(r.leaf, r.siblings) == r.root for r in out)
    # What changes one document changes its leaf, its subroot and the root, and only its own proof fails.
    claimed = manifest.tampered_leaves(df).withColumn("claimed", F.when(F.col("doc_id") == 0, F.sha2(F.lit("other"), 256)).otherwise(F.col("leaf")))
    assert [r.doc_id for r in manifest.manifest(claimed).where("not verified").collect()] == [0]


def test_perfect_hash():
    for n in (0, 1, 2, 1000, 60000):
        a, b, f = hashes([f"{i}#0" for i in range(n)])
        p = PerfectHash.over(a, b)
        assert p.n == n and sorted(p(a, b).tolist()) == list(range(n))
        assert sum(p.sizes) < 6 * n + 500
    a, b, _ = hashes([f"not {i}" for i in range(1000)])
    assert set(p(a, b).tolist()) <= set(range(-1, 60000))
    with pytest.raises(ValueError):
        PerfectHash.over(np.ones(2, np.uint64), np.ones(2, np.uint64))


def test_token_files(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    rng = random.Random(5)
    odd = ["", " ", "a", "it's", "'s", "\n", "  x", "x  ", "\n\n", "\t", "é", "ö z", "1234", "<|endoftext|>", "\0", "　", "don't!!", "word"]
    rows = [(None if i % 50 == 3 else i % 300, None if i % 60 == 7 else rng.choice(["", " ", "\n"]).join(rng.choice(odd) for _ in range(rng.randint(0, 40))), "x", 0) for i in range(400)]
    rows += [(1000, "the long one\n" * 30000, "x", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string, shard int").repartition(5)
    out = tokenfiles.tokenized(df, path).collect()
    assert len(out) == len(rows)
    ids = lambda r: tuple(np.frombuffer(r.ids, "<u4").tolist())
    assert sorted((r.doc_id is not None, r.doc_id or 0, ids(r)) for r in out) == sorted((d is not None, d or 0, (*plain.encode(t or "", add_special_tokens=False).ids, 0)) for d, t, *_ in rows)
    at = 0
    for r in sorted(out, key=lambda r: r.start):
        assert r.start == at and r.n_tokens == len(ids(r))
        at += r.n_tokens
    places = [(r.doc_id is not None, r.doc_id or 0) for r in sorted(out, key=lambda r: r.start)]
    assert places == sorted(places)
    assert tokenfiles.tokenized(df.limit(0), path).count() == 0
    with open(path) as f:
        files = tokenfiles.TokenFiles.write(df, f.read(), str(tmp_path / "files"), Scratch(spark, "test"))
    again = tokenfiles.TokenFiles(spark, files.root)
    found = again.find(spark.createDataFrame([("1000#0",), ("1000#1",), ("nothing",), ("null#0",)], "key string"))
    assert {r.key: r.shard is not None for r in found.collect()} == {"1000#0": True, "1000#1": False, "nothing": False, "null#0": True}
    got = again.read(found).where("key = '1000#0'").first()
    assert plain.decode(list(ids(got))[:-1]) == "the long one\n" * 30000
    assert not [p for p in (tmp_path / "files").iterdir() if p.name.startswith(".shard") and not p.name.endswith(".crc")]


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op13_merkle_manifest"])
def test_equals_sql(spark, name):
    assert difference(spark, "/root/testdata/sf0.001", queries.queries()[name], oracle.oracle_sql()[name]) is None
