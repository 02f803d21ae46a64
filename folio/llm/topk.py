"""Exact top-k inner products by MaxScore.

Terms are the dimensions of integer vectors. Vectors lie in shards; a shard's postings of a term are its values, by
document. A query term's least contribution over the shard is taken out as a constant, so contributions are never
negative and each term has an upper bound. Terms in order of bounds split in two: the non-essential ones, which cannot
lift a document over the query's current threshold even together, and the essential ones, whose postings are
traversed. The others are probed, from the largest bound down, for documents that are still competitive. Shards give
their k best, which are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Vectors of a shard and queries of a block; each task holds one of each, whatever the size of the table.
SHARD_ROWS = 4096
BLOCK_QUERIES = 512
#: Documents of a shard that are scored together: the threshold rises from one run to the next.
RUN = 2048


def _matrix(values: pa.Array, dims: int) -> np.ndarray:
    out = np.zeros((len(values), dims), np.int64)
    sizes = np.diff(values.offsets.to_numpy())
    rows = np.repeat(np.arange(len(values)), sizes)
    out[rows, np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values.flatten().to_numpy(zero_copy_only=False)
    return out


def _advance(best: tuple[np.ndarray, np.ndarray], query: np.ndarray, own: int, docs: np.ndarray, columns: np.ndarray, ends: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best (ids, scores) after another run of documents, whose ids are larger than those before."""
    ids, scores = best
    terms = np.flatnonzero(query)
    q = query[terms]
    two = q * ends[:, terms]
    base = two.min(axis=0)
    bound = two.max(axis=0) - base
    order = np.argsort(bound, kind="stable")
    reach = np.cumsum(bound[order])
    full = len(scores) >= k
    # A tie with the threshold has a larger id here, so only more than it counts.
    need = scores[k - 1] - base.sum() if full else -np.inf
    split = int(np.searchsorted(reach, need, "right")) if full else 0
    if full and split == len(order):
        return best
    e = order[split:]
    score = q[e] @ columns[terms[e]] - base[e].sum()
    alive = np.flatnonzero(docs != own)
    for j in range(split - 1, -1, -1):
        alive = alive[score[alive] + reach[j] > need]
        if not len(alive):
            return best
        score[alive] += columns[terms[order[j]], alive] * q[order[j]] - base[order[j]]
    alive = alive[score[alive] > need]
    merged, found = np.concatenate([scores, score[alive] + base.sum()]), np.concatenate([ids, docs[alive]])
    top = np.lexsort((found, -merged))[:k]
    return found[top], merged[top]


def maxscore(queries: np.ndarray, own: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query (ids, scores) of the k best of a shard, ties to smaller ids; ids ascend, and a query's own is left out."""
    # Doubles add integers exactly below 2**53.
    largest = max((float(np.abs(x).max(initial=0)) for x in (queries, vectors)), default=0.0)
    kind = np.float64 if largest * largest * max(1, vectors.shape[1]) < 2**51 else np.int64
    queries, columns = queries.astype(kind), np.ascontiguousarray(vectors.T.astype(kind))
    best = [(np.zeros(0, np.int64), np.zeros(0, kind))] * len(queries)
    for a in range(0, len(ids), RUN):
        run = np.ascontiguousarray(columns[:, a : a + RUN])
        ends = np.stack([run.min(axis=1), run.max(axis=1)])
        best = [_advance(b, q, o, ids[a : a + RUN], run, ends, k) for b, q, o in zip(best, queries, own, strict=True)]
    return [(i, s.astype(np.int64)) for i, s in best]


def top_k(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each row whose vec_id is divisible by every.

    Components x count as floor(256 * x). Rows with a null vec_id, a null vector or a null or non-finite component
    take no part; an empty vector has no terms and scores 0; missing components count 0. Ties go to smaller ids. Rows
    of one vec_id count once, as the greatest of their vectors. Other columns are not read; an empty table gives none.
    """
    x = F.col("embedding").cast("array<double>")
    fine = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where("vec_id is not null and x is not null").where(F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    ints = fine.select("vec_id", F.transform("x", lambda c: F.floor(c * 256).cast("long")).alias("v")).groupBy("vec_id").agg(F.max("v").alias("v"))
    n = ints.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d"), F.count_if(F.col("vec_id") % every == 0).alias("q")).first()
    shards, blocks, dims = max(1, -(-n.n // SHARD_ROWS)), max(1, -(-n.q // BLOCK_QUERIES)), n.d or 1
    spread = lambda c, m: F.pmod(F.xxhash64(c), F.lit(m)).cast("int")
    # Rows meet by (shard, block): a query goes to every shard and a vector to every block of queries.
    queries = ints.where(F.col("vec_id") % every == 0).select(F.lit(True).alias("is_query"), "vec_id", "v", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), spread("vec_id", blocks).alias("block"))
    others = ints.select(F.lit(False).alias("is_query"), "vec_id", "v", spread("vec_id", shards).alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def run(key: tuple, t: pa.Table) -> pa.Table:
        t = t.sort_by("vec_id").combine_chunks()
        ids, m, is_query = t["vec_id"].to_numpy(), _matrix(t["v"].chunk(0), dims), t["is_query"].to_numpy()
        qs, vs = np.flatnonzero(is_query), np.flatnonzero(~is_query)
        out = maxscore(m[qs], ids[qs], ids[vs], m[vs], k)
        sizes = [len(b) for b, _ in out]
        join = lambda parts: np.concatenate([np.zeros(0, np.int64), *parts])
        return pa.table({"query_id": np.repeat(ids[qs], sizes), "vec_id": join([b for b, _ in out]), "score": join([s for _, s in out])})

    found = queries.unionByName(others).groupBy("shard", "block").applyInArrow(run, "query_id long, vec_id long, score long")
    best = found.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("vec_id").alias("i")))), 1, k).alias("b"))
    return best.select("query_id", F.posexplode("b").alias("r", "b")).select("query_id", (F.col("r") + 1).cast("int").alias("rank"), F.col("b.i").alias("vec_id"), (-F.col("b.s")).alias("score"))
