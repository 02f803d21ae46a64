"""Near-duplicate documents by HyperMinHash.

Each distinct set of word shingles gets REGISTERS registers. A shingle's hash names a register and offers it a value;
a register keeps the least value, as a leading-zero count (6 bits) and the MANTISSA bits that follow the leading one.
A register that a round of hashing leaves empty is filled by the next round, and after ROUNDS rounds by the least of
a hash of its own over all shingles, so that registers of two sets agree with probability Jaccard at any set size.
Bands of BAND registers are the buckets; pairs from buckets whose collision-corrected Jaccard estimate is in reach of
the threshold are verified on the full sets of shingles of both texts.

With 128 registers in 32 bands of 4, a pair at Jaccard 0.8 shares no band with probability (1 - 0.8^4)^32 = 5e-8, and
its estimate falls under 0.8 - SLACK with probability below 1e-7.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.graph import bucket_links, components
from folio.llm.scratch import Scratch, only
from folio.llm.textbytes import LOWER, U, mix, sequence_hash, slices, span_hash, word_bounds

REGISTERS = 128
BAND = 4
MANTISSA = 10
ROUNDS = 8
SLACK = 0.22
_BITS = 57
_SEEDS = mix(np.arange(1, ROUNDS + REGISTERS + 1, dtype=np.uint64) * U(0xA24BAED4963EE407))


def _compress(values: np.ndarray, rounds: np.ndarray) -> np.ndarray:
    fraction, exponent = np.frexp(values.astype(np.float64))
    zeros = np.clip(_BITS - exponent, 0, 63).astype(np.uint16)
    mantissa = ((fraction * 2 - 1).clip(0) * (1 << MANTISSA)).astype(np.uint16)
    return ((zeros << np.uint16(MANTISSA)) | mantissa) ^ (rounds * np.uint16(40503))


def registers(shingles: np.ndarray) -> np.ndarray:
    """REGISTERS uint16 of a non-empty set of 64-bit hashes."""
    values, rounds = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64), np.zeros(REGISTERS, np.uint16)
    empty = np.ones(REGISTERS, bool)
    for t in range(ROUNDS):
        x = mix(shingles ^ _SEEDS[t])
        offered = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
        np.minimum.at(offered, (x >> U(_BITS)).astype(np.intp), x & U((1 << _BITS) - 1))
        take = empty & (offered != np.iinfo(np.uint64).max)
        values[take], rounds[take] = offered[take], t
        empty &= ~take
        if not empty.any():
            break
    for j in np.flatnonzero(empty):
        values[j], rounds[j] = (mix(shingles ^ _SEEDS[ROUNDS + j]) >> U(64 - _BITS)).min(), ROUNDS
    return _compress(values, rounds)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard of rows of registers: unequal values agree in count and mantissa with probability
    2/3 * sum over counts z of 4^-z * 2^-MANTISSA, that is about 0.17 * 2^(1 - MANTISSA), or less for unlike sizes."""
    chance = 0.16919 * 2.0 ** (1 - MANTISSA)
    return ((a == b).mean(axis=1) - chance) / (1 - chance)


def shingle_sets(column: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct hashes) of each text with a word."""
    for first, end, buf, offsets in slices(column):
        buf = LOWER[buf]
        starts, ends, at = word_bounds(buf, offsets)
        hashes = span_hash(buf, starts, ends)
        rows = sequence_hash(hashes, words)
        for r in range(end - first):
            a, b = at[r], at[r + 1]
            if b - a >= words:
                yield first + r, np.unique(rows[a : b - words + 1])
            elif b > a:
                yield first + r, mix(sequence_hash(hashes[a:b], int(b - a)) + U(b - a))


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, set_hash, bands) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            sizes, hashes, bands = np.zeros(n, np.int64), [None] * n, [None] * n
            for row, s in shingle_sets(batch.column(1), words):
                sizes[row], hashes[row], bands[row] = len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(), registers(s).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.array(hashes, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "set_hash", "bands"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, set_hash binary, bands array<long>")


def _estimated(pairs: DataFrame, reps: DataFrame, least: float) -> DataFrame:
    """Pairs whose estimate is at least that."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (batch.column(k).flatten().to_numpy().view(np.uint16).reshape(batch.num_rows, -1) for k in (2, 3))
                yield batch.select(["a", "b"]).filter(pa.array(estimate(x, y) >= least))

    side = lambda k: reps.select(F.col("rep").alias(k), F.col("bands").alias(f"bands_{k}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "bands_a", "bands_b").mapInArrow(run, "a long, b long")


def _verified(texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Of (a, b, text_a, text_b), pairs with 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = None, None
        for batch in batches:
            b_ids, take = batch.column(1).to_pylist(), np.zeros(batch.num_rows, bool)
            for row, left in shingle_sets(batch.column(2), words):
                if b_ids[row] != last:
                    last, kept = b_ids[row], next((s for _, s in shingle_sets(batch.column(3).slice(row, 1), words)), np.zeros(0, np.uint64))
                common = len(np.intersect1d(left, kept, assume_unique=True))
                take[row] = 100 * common >= percent * (len(left) + len(kept) - common)
            yield batch.select(["a", "b"]).filter(pa.array(take))

    return texts.mapInArrow(run, "a long, b long")


def _signed(texts: DataFrame, words: int) -> DataFrame:
    """(id, sig): 32 bits of each shingle hash of (id, text), ascending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs: list[bytes] = [b""] * batch.num_rows
            for row, s in shingle_sets(batch.column(1), words):
                sigs[row] = np.unique((s >> U(32)).astype(np.uint32)).tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sigs, pa.binary())], ["id", "sig"])

    return texts.mapInArrow(run, "id long, sig binary")


def _near(percent: int):
    """Which sets reach the threshold with set x. Of the few hashes that agree in 32 bits both sides lose one, so 1 % of slack covers them."""

    def near(sigs: list[bytes], x: int | None = None, state: tuple | None = None):
        if x is None:
            sizes = np.array([len(s) // 4 for s in sigs])
            values, codes = np.unique(np.frombuffer(b"".join(sigs), np.uint32), return_inverse=True)
            return sizes, np.cumsum(sizes) - sizes, codes.ravel(), np.zeros(len(values), bool)
        sizes, starts, codes, mark = state
        own = codes[starts[x] : starts[x] + sizes[x]]
        mark[own] = True
        common = np.add.reduceat(mark[codes].astype(np.int64), starts)
        mark[own] = False
        return 100 * common >= (percent - 1) * (sizes + sizes[x] - common)

    return near


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): documents linked at Jaccard >= percent/100 of their shingle sets.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case. A text with fewer than ``words`` words has one shingle,
    all of them; one without words or null has none and is linked with nothing. component_id is the least doc_id
    reachable, itself included. Rows of one doc_id count as one document when their texts link; rows without doc_id
    are linked with nothing, have no component and are kept. Other columns are not read; an empty table gives none.
    """
    scratch = Scratch(docs.sparkSession, "near")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = scratch.save(sketches(docs, words))
    live = rows.where("doc_id is not null and set_hash is not null")
    reps = scratch.save(live.groupBy("set_hash", "n_shingles").agg(F.min("doc_id").alias("rep"), F.min_by("bands", "doc_id").alias("bands")))
    members = reps.select("rep", "n_shingles", F.posexplode("bands").alias("band", "key")).select(F.xxhash64("band", "key").alias("bucket"), F.col("rep").alias("id"))

    def traits(ids: DataFrame) -> DataFrame:
        return only(reps.select(F.col("rep").alias("id"), F.col("n_shingles").alias("n")), "id", ids)

    def verify(pairs: DataFrame) -> DataFrame:
        near = scratch.save(_estimated(pairs, reps, percent / 100 - SLACK))
        ids = scratch.save(near.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), 2 * near.count())
        needed = scratch.save(only(docs, "doc_id", ids))
        side = lambda k: needed.select(F.col("doc_id").alias(k), F.col("text").alias(f"text_{k}"))
        texts = near.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b")
        return _verified(texts, words, percent).distinct()


    def signed(ids: DataFrame) -> DataFrame:
        texts = only(docs, "doc_id", ids.withColumnRenamed("id", "doc_id"))
        # A doc_id with several texts has several signatures, each of which is compared.
        return _signed(texts.select(F.col("doc_id").alias("id"), "text"), words)

    links = bucket_links(members, traits, verify, scratch, lambda n, other: 100 * F.least(n, other) >= int(percent) * F.greatest(n, other), signed, _near(percent))
    found = components(links, scratch)
    named = scratch.save(reps.select("set_hash", "n_shingles", "rep").join(found.withColumnRenamed("id", "rep"), "rep", "left").select("set_hash", "n_shingles", F.coalesce("component", "rep").alias("component_id")))
    joined = live.select("doc_id", "n_shingles", "set_hash").join(named, ["set_hash", "n_shingles"]).select("doc_id", "n_shingles", "component_id")
    rest = rows.where("doc_id is null or set_hash is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return joined.unionByName(rest).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
