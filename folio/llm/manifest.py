"""A Merkle manifest of documents: digests of documents, of each language's tree over them, and of the tree over languages.

A block of BLOCK consecutive nodes is traversed in postorder by one recursive function, which returns the digest of the
block and appends the siblings of each level to the leaves below while it unwinds. The digests of aligned blocks are the
nodes of the next traversal, again dealt over all tasks, until one is left. On the way down each block is traversed with the path
that its own digest has above it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.running import running
from folio.llm.scratch import Scratch

#: Nodes of a run, and the levels that one traversal climbs.
FAN, LEVELS = 8, 3
BLOCK = FAN**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
OUT = "doc_id long, leaf string, subroot string, root string, siblings array<string>, proof_sha256 string, folded_root string, verified boolean"


def digest(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def height(n: int) -> int:
    """Levels from n nodes to one."""
    k = 0
    while n > 1:
        n, k = -(-n // FAN), k + 1
    return k


def traverse(nodes: list[str], levels: int) -> tuple[str, list[list[str]]]:
    """The digest over all nodes, and for each node what stands left and right of it in its run, level by level upwards."""
    paths: list[list[str]] = [[] for _ in nodes]

    def walk(start: int, end: int, level: int) -> str:
        if not level:
            return nodes[start]
        width = FAN ** (level - 1)
        bounds = [(a, min(a + width, end)) for a in range(start, end, width)]
        below = [walk(a, b, level - 1) for a, b in bounds]
        for i, (a, b) in enumerate(bounds):
            beside = ("".join(below[:i]), "".join(below[i + 1 :]))
            for leaf in range(a, b):
                paths[leaf].extend(beside)
        return digest(below)

    return walk(0, len(nodes), levels), paths


def folded(node: str, path: list[str]) -> str:
    """The root that follows from a node and its path."""
    for left, right in zip(path[::2], path[1::2], strict=True):
        node = digest((left, node, right))
    return node


def record_digest(values: Iterable[bytes | None]) -> str:
    h = hashlib.sha256()
    for v in values:
        h.update(b"-" if v is None else b"%d:" % len(v))
        h.update(v or b"")
    return h.hexdigest()


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of documents as they are, and as they are after the change that is to be found out."""
    for b in batches:
        columns = [pc.cast(pc.cast(b.column(f), pa.large_string()), pa.large_binary()).to_pylist() for f in FIELDS]
        own, now = [], []
        for row in zip(*columns, strict=True):
            own.append(record_digest(row))
            changed = row[0] is not None and row[4] is not None and zlib.crc32(row[0]) % 3 == 0
            now.append(record_digest((*row[:4], row[4].lower())) if changed else own[-1])
        yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), b.column("lang"), pa.array(own, pa.string()), pa.array(now, pa.string())], names=["doc_id", "lang", "leaf", "claimed"])


def tampered_leaves(documents: DataFrame) -> DataFrame:
    """doc_id, lang, leaf, and claimed: the digest with A-Z of the text in lower case where 3 divides the checksum of doc_id (never
    where doc_id or text is null)."""
    return documents.select(*FIELDS).mapInArrow(_leaves, "doc_id long, lang string, leaf string, claimed string")


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        roots = [traverse([x["digest"] for x in row["nodes"]], min(LEVELS, height(row["n"])))[0] for row in b.select(["n", "nodes"]).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("tree"), b.column("block"), pa.array(roots, pa.string())], names=["tree", "place", "digest"])


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of the nodes of blocks with their whole paths."""
    for b in batches:
        out = []
        for row in b.to_pylist():
            _, paths = traverse([x["digest"] for x in row["nodes"]], min(LEVELS, height(row["n"])))
            out += [(row["tree"], x["place"], p + row["path"]) for x, p in zip(row["nodes"], paths, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.string()), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.list_(pa.string()))], names=["tree", "place", "path"])


class _Tree:
    """Trees over the nodes (tree, place from 0, digest, ...); ``steps`` are their blocks from the leaves upwards."""

    def __init__(self, nodes: DataFrame, scratch: Scratch) -> None:
        self.scratch, self.steps = scratch, []
        sizes = scratch.save(nodes.groupBy("tree").agg(F.count("*").alias("n")))
        while True:
            block = nodes.groupBy("tree", F.expr(f"place div {BLOCK}").alias("block"))
            blocks = scratch.save(block.agg(F.sort_array(F.collect_list(F.struct("place", *(c for c in nodes.columns if c not in ("tree", "place"))))).alias("nodes")).join(sizes, "tree"))
            self.steps.append(blocks)
            nodes = scratch.save(blocks.select("tree", "block", "n", "nodes").mapInArrow(_roots, "tree string, place long, digest string"))
            sizes = sizes.withColumn("n", F.expr(f"(n + {BLOCK - 1}) div {BLOCK}"))
            if (sizes.agg(F.max("n")).first()[0] or 1) == 1:
                break
        self.roots = nodes.select("tree", "digest")

    def with_paths(self, above: DataFrame) -> DataFrame:
        """Blocks of leaves, with the path of the block's digest. above: the paths (tree, place 0, path) of the roots."""
        for k, blocks in reversed(list(enumerate(self.steps))):
            joined = blocks.join(above.withColumnRenamed("place", "block"), ["tree", "block"])
            if not k:
                return joined
            above = self.scratch.save(joined.mapInArrow(_paths, "tree string, place long, path array<string>"))
        raise AssertionError


def manifest(leaves: DataFrame, with_siblings: bool = False) -> DataFrame:
    """Proofs of all leaves (doc_id, lang, leaf, claimed), and whether the claimed digests agree with them: OUT.

    In a language, leaves ascend by doc_id, null first, repeated ones by their digests. Languages ascend by bytes, null first;
    each leaf's ``siblings`` (null unless asked for) are the digests left and right of its path, two for each level, as hex text joined. A table
    without rows has no root and no rows. No task holds more than a block of nodes and their paths.
    """
    spark = leaves.sparkSession
    scratch = Scratch(spark, "manifest")
    # "" sorts before all others, as null does before all languages.
    keyed = leaves.select(F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("tree"), "doc_id", F.col("leaf").alias("digest"), "claimed", F.lit(1).cast("long").alias("place"))
    ranked = running(keyed, "tree", [F.col("doc_id").asc(), F.col("digest").asc(), F.col("claimed").asc()], ["place"], scratch)
    by_lang = _Tree(ranked.withColumn("place", F.col("place") - 1).select("tree", "place", "digest", "doc_id", "claimed"), scratch)
    langs = running(by_lang.roots.withColumn("place", F.lit(1).cast("long")), None, [F.col("tree").asc()], ["place"], scratch)
    langs = scratch.save(langs.withColumn("place", F.col("place") - 1))
    top = _Tree(langs.select(F.lit("").alias("tree"), "place", "digest", F.col("tree").alias("lang")), scratch)
    found = top.roots.first()
    root = found.digest if found else ""
    # The root has nothing above it.
    over = top.with_paths(spark.createDataFrame([("", 0, [])], "tree string, place long, path array<string>"))
    paths = over.mapInArrow(_paths, "tree string, place long, path array<string>").select("place", "path")
    above = scratch.save(langs.join(paths, "place").select("tree", F.lit(0).cast("long").alias("place"), "path"))

    def proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.string(), pa.bool_()]
        names = ["doc_id", "leaf", "subroot", "root", "siblings", "proof_sha256", "folded_root", "verified"]
        for b in batches:
            for row in b.to_pylist():
                out = []
                _, own = traverse([x["digest"] for x in row["nodes"]], min(LEVELS, height(row["n"])))
                for x, p in zip(row["nodes"], own, strict=True):
                    path = p + row["path"]
                    back = folded(x["claimed"], path)
                    out.append((x["doc_id"], x["digest"], row["subroot"], root, path if with_siblings else None, digest(path), back, back == root))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    down = by_lang.with_paths(above).join(by_lang.roots.withColumnRenamed("digest", "subroot"), "tree")
    return down.mapInArrow(proofs, OUT)
