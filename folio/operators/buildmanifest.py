"""Manifests of builds: a tree of digests over the files of each stage of each book, so that two builds are compared from the top down.

Files of a stage ascend by name. FAN consecutive nodes have one node above them, which is the digest of theirs joined; the last may have
fewer, and the one that is left is the stage's root. A book's root is the digest of its stages' names and roots.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FAN = 8
KEY = ["book_id", "stage"]


def levels(files: DataFrame) -> list[DataFrame]:
    """Nodes (book_id, stage, place from 0, digest, file) of each level from the files (book_id, stage, file, sha256) upwards; file is null above. A stage
    that has its root has no node in higher levels. A null digest counts as the empty text."""
    w = Window.partitionBy(*KEY).orderBy("file", "sha256")
    leaf = F.sha2(F.concat_ws("\n", F.octet_length("file").cast("string"), "file", F.coalesce("sha256", F.lit(""))), 256)
    nodes = files.select(*KEY, "file", (F.row_number().over(w) - 1).alias("place"), leaf.alias("digest"))
    largest = files.groupBy(*KEY).count().agg(F.max("count")).first()[0] or 0
    out = [nodes]
    while largest > 1:
        here = F.count("*").over(Window.partitionBy(*KEY))
        more = out[-1].withColumn("_n", here).where("_n > 1")
        up = more.groupBy(*KEY, F.floor(F.col("place") / FAN).cast("int").alias("place")).agg(F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.col("place").alias("p"), "digest"))), lambda x: x["digest"]), ""), 256).alias("digest"))
        out.append(up.select(*KEY, F.lit(None).cast("string").alias("file"), "place", "digest"))
        largest = -(-largest // FAN)
    return out


def stage_roots(tree: list[DataFrame]) -> DataFrame:
    """(book_id, stage, root)."""
    alone = [n.groupBy(*KEY).agg(F.count("*").alias("n"), F.first("digest").alias("root")).where("n = 1").select(*KEY, "root") for n in tree]
    rows = alone[0]
    for a in alone[1:]:
        rows = rows.unionByName(a)
    return rows


def manifest(files: DataFrame) -> DataFrame:
    """(book_id, stage, files, bytes, root, book_root) of files (book_id, stage, file, sha256, size)."""
    counts = files.groupBy(*KEY).agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))
    roots = stage_roots(levels(files))
    books = roots.groupBy("book_id").agg(F.sort_array(F.collect_list(F.struct("stage", "root"))).alias("r"))
    book_root = F.sha2(F.array_join(F.transform("r", lambda x: F.concat_ws(" ", x["stage"], x["root"])), "\n"), 256)
    return counts.join(roots, KEY).join(books.select("book_id", book_root.alias("book_root")), "book_id")


def differing(before: DataFrame, after: DataFrame) -> DataFrame:
    """(book_id, stage, file) where two builds (files with their digests) differ, found from the roots downwards: of each level only what lies below
    nodes that differ is compared. Files that only one build has shift those behind them, which then differ in place, and are told apart by
    name and digest."""
    old, new = levels(before), levels(after)
    empty = old[0].limit(0)
    top = max(len(old), len(new))
    at = lambda tree, k: (tree[k] if k < len(tree) else empty).select(*KEY, "place", F.col("digest"), "file")
    below = None
    for k in range(top - 1, -1, -1):
        a, b = at(old, k), at(new, k)
        if below is not None:
            # Stages that end below this level have no node above, and are compared from their own root on.
            covered = below.select(*KEY, F.col("place").alias("_up")).distinct()
            ended = at(old, k + 1).select(*KEY).unionByName(at(new, k + 1).select(*KEY)).distinct()
            keep = lambda df: df.withColumn("_up", F.floor(F.col("place") / FAN).cast("int")).join(covered, [*KEY, "_up"], "left_semi").drop("_up").unionByName(df.join(ended, KEY, "left_anti"))  # noqa: B023, E731
            a, b = keep(a), keep(b)
        x = a.select(*KEY, "place", F.col("digest").alias("d"), F.col("file").alias("f"))
        y = b.select(*KEY, "place", F.col("digest").alias("e"), F.col("file").alias("g"))
        below = x.join(y, [*KEY, "place"], "full_outer").where(~F.col("d").eqNullSafe(F.col("e")))
    left = below.where("d is not null").select(*KEY, F.col("f").alias("file"), F.col("d").alias("digest"))
    right = below.where("e is not null").select(*KEY, F.col("g").alias("file"), F.col("e").alias("digest"))
    both = [*KEY, "file", "digest"]
    return left.join(right, both, "left_anti").unionByName(right.join(left, both, "left_anti")).select(*KEY, "file").distinct()
