"""Connected components, with DataFrame operations only, and links among members of buckets."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.scratch import BROADCAST_IDS, Scratch
from folio.llm.textbytes import TABLE, mix


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component) of every node of edges (a, b) that is not the least of its component.

    Alternates large and small stars until only stars are left. Each star is a minimum per node, combined
    before the shuffle, joined back to the edges; no step gathers a component's nodes in one task.
    """
    e = scratch.save(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while not _are_stars(e):
        rows = 2 * e.count()
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = scratch.save(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), rows)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e_next = scratch.save(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), rows)
        scratch.drop(e, large)
        e = e_next
    return e.select(F.col("u").alias("id"), F.col("v").alias("component"))


def _are_stars(e: DataFrame) -> bool:
    """Whether each u of e (u, v) has one v, which is no u itself."""
    ends = e.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(e.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up = 1 and down = 1").isEmpty()


#: A task compares two chunks of a bucket with each other, each of about so many members and bytes of their signatures.
CHUNK_ROWS = 4096
CHUNK_BYTES = 8 << 20


#: Members of buckets that a task verifies, more in one large bucket.
ONCE_ROWS = 1024
ORDERS = 8

#: Members of smaller buckets are compared by a join.
JOINED_ROWS = 32

#: A round of large buckets deals out about as many bytes as its lines have, or so many.
LEAST_ROUND_BYTES = 64 << 20


def _by_hubs(many: DataFrame, may_link: Callable[[Column, Column], Column], hubs: int) -> DataFrame:
    """Pairs (a, b) that may link of each member of (bucket, id, c, n) and so many members of its bucket, taken by hash; linear in the members."""
    rows = many.repartition("bucket")
    taken = rows.groupBy("bucket").agg(*(F.min_by(F.struct("id", "c", "n"), F.xxhash64("id", F.lit(k))).alias(f"h{k}") for k in range(hubs)))
    hub = lambda k: F.when((F.col("c") != F.col(f"h{k}.c")) & may_link(F.col("n"), F.col(f"h{k}.n")), F.col(f"h{k}.id"))
    # Only what may link becomes a row.
    near = rows.join(taken.hint("shuffle_merge"), "bucket").select("id", F.array_distinct(F.array_compact(F.array(*(hub(k) for k in range(hubs))))).alias("near"))
    pairs = near.where(F.size("near") > 0).select("id", F.explode("near").alias("other"))
    return pairs.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()


def bucket_links(members: DataFrame, traits: Callable[[DataFrame], DataFrame], verify: Callable[[DataFrame], DataFrame], scratch: Scratch, may_link: Callable[[Column, Column], Column], signed: Callable[[DataFrame], DataFrame], near: Callable[..., np.ndarray] | None = None, tiles: Callable[..., Iterator] | None = None, others: int = 0, done: Callable[[], None] | None = None, passes: int = 1) -> DataFrame:
    """Edges that connect what verified links connect, from members (bucket long, id long; computed anew from a saved table each time).

    First each member is verified against the least member of its buckets. In buckets that these links left in
    different components, members are then compared with all those of other components: in buckets of up to
    JOINED_ROWS by a join, whose rows grow with the members only, in others in chunks and without a row for each pair.
    So no link between components is lost, while a bucket of copies costs one pair a member and not their square.
    traits gives (id, n) of ids, and may_link is what the n of two ids that link fulfil. signed gives (id, sig
    binary) of ids, and near, of the signatures and one of them, which may link; what these let through is verified. tiles,
    in place of near, gives links, as pairs of places, of many signatures and components at once, which join what all links would join; they
    are verified already, so that pairs that don't link are no rows. With others, members of larger buckets are
    first verified against so many others, so that a group of near copies is one component before all of its pairs are looked at.
    done is called when members are not read any more. Buckets are dealt in so many passes, each by hash a part of them, so
    that only one part's shuffle is on disk at a time.
    """
    some = lambda df, n: df.where(F.pmod(F.xxhash64("bucket"), F.lit(passes)) == n) if passes > 1 else df
    parts = []
    for n in range(passes):
        # One exchange serves the ends of the buckets and their members.
        dealt = some(members, n).repartition("bucket")
        ends = dealt.groupBy("bucket").agg(F.min("id").alias("hub"), F.max("id").alias("last")).where("hub <> last").select("bucket", "hub")
        parts.append(scratch.save(dealt.join(ends.hint("shuffle_merge"), "bucket").distinct()))
    held = reduce(DataFrame.unionByName, parts)
    if done:
        done()
    rows = held.count()
    n_of = scratch.save(traits(scratch.save(held.select("id").distinct(), rows)), rows)

    def likely(pairs: DataFrame) -> DataFrame:
        other = n_of.select(F.col("id").alias("b"), F.col("n").alias("other_n"))
        return pairs.join(n_of.withColumnRenamed("id", "a"), "a").join(other, "b").where(may_link(F.col("n"), F.col("other_n"))).select("a", "b")

    star = held.where("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
    mark = scratch.made
    first = scratch.save(verify(scratch.save(likely(star), rows)))
    scratch.drop_since(mark, first)
    found = components(first, scratch)
    scratch.drop(first)
    named = scratch.save(held.join(found, "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("c")), rows)
    mixed = scratch.save(named.groupBy("bucket").agg(F.count("*").alias("members"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("bucket", "members"), rows)
    rest = scratch.save(named.join(F.broadcast(mixed) if mixed.count() <= BROADCAST_IDS else mixed, "bucket").join(n_of, "id"), rows)
    scratch.drop(*parts, named, mixed)
    larger = rest.where(F.col("members") > JOINED_ROWS)
    if others:
        mark = scratch.made
        more = scratch.save(verify(scratch.save(_by_hubs(larger, may_link, others))))
        scratch.drop_since(mark, more)
        found = components(found.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(more), scratch)
        scratch.drop(more)
        # Buckets of all sizes that are now of one component need no more work.
        named = scratch.save(rest.select("bucket", "id", "members").join(found, "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("c"), "members"), rows)
        mixed = named.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("bucket")
        scratch.drop(rest)
        rest = scratch.save(named.join(mixed, "bucket", "left_semi"), rows)
        scratch.drop(named)
        many = rest.where(F.col("members") > JOINED_ROWS)
    else:
        many = larger.select("bucket", "id", "c", "members")
    few = rest.where(F.col("members") <= JOINED_ROWS)
    if others:
        few = few.join(n_of, "id")
    mark = scratch.made
    joined = []
    for n in range(passes):
        one = some(few, n)
        other = one.select("bucket", F.col("id").alias("other"), F.col("n").alias("other_n"), F.col("c").alias("other_c"))
        pairs = one.join(other, "bucket").where("id < other and c <> other_c").where(may_link(F.col("n"), F.col("other_n"))).select(F.col("id").alias("a"), F.col("other").alias("b"))
        # One after the other, so that the shuffles of one are gone when those of the next are written.
        joined.append(scratch.save(pairs.distinct()))
    joined = reduce(DataFrame.unionByName, joined)
    if others:
        scratch.drop(n_of)
    across = scratch.save(_across(many, signed, near, tiles, scratch, once=bool(tiles)).distinct())
    if tiles:
        second = scratch.save(verify(joined.distinct()).unionByName(across))
    else:
        second = scratch.save(verify(scratch.save(joined.unionByName(across).distinct())))
    scratch.drop_since(mark, second)
    scratch.drop(rest, *[n_of][: int(not others)])
    return found.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(second)


def _here(table: pa.Table, two_chunks: bool) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Which pairs of rows (bucket, lo, hi, k, id, c, sig, buckets) of a task are looked at in it: those of both of two chunks that
    have no earlier bucket in common, in the one of ORDERS orders of all buckets that their ids name. So each pair is looked at
    once, and those of a group that shares many buckets in several tasks."""
    k, ids, lists = table.column(3).to_numpy(), table.column(4).to_numpy().view(np.uint64), table.column(7).combine_chunks()
    flat, rows = lists.flatten().to_numpy().view(np.uint64), np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
    own = np.array([table.column(0)[0].as_py()]).view(np.uint64)
    held = []
    for seed in TABLE[40 : 40 + ORDERS]:
        earlier = mix(flat ^ seed) < mix(own ^ seed)
        _, code, count = np.unique(flat[earlier], return_inverse=True, return_counts=True)
        several = count[code] > 1
        owner, code = rows[earlier][several], np.unique(code[several], return_inverse=True)[1]
        bits = np.zeros((len(lists), 1 + int(code.max(initial=0)) // 8), np.uint8)
        np.bitwise_or.at(bits, (owner, code >> 3), (1 << (code & 7)).astype(np.uint8))
        held.append(bits)

    def here(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        order, out = mix(ids[i] ^ ids[j]) % np.uint64(ORDERS), (k[i] != k[j]) | (not two_chunks)
        for n, bits in enumerate(held):
            at = np.flatnonzero(order == n)
            out[at] &= ~(bits[i[at]] & bits[j[at]]).any(axis=1)
        return out

    return here


def _across(rest: DataFrame, signed: Callable[[DataFrame], DataFrame], near: Callable[..., np.ndarray] | None, tiles: Callable[..., Iterator] | None, scratch: Scratch, once: bool = False) -> DataFrame:
    """Pairs (a, b) of different components of a bucket that may link, from (bucket, id, c, members). With once, tiles is also given
    which pairs are looked at here: see _here; buckets are then dealt in rounds, since a row holds its line's signature, text and buckets, and
    lies in each of these buckets."""
    mark = scratch.made
    ids = scratch.save(rest.select("id").distinct())
    sigs = signed(ids)
    if once:
        sigs = sigs.join(rest.groupBy("id").agg(F.sort_array(F.collect_set("bucket")).alias("buckets")), "id").withColumn("held", F.length("sig") + 8 * F.size("buckets").cast("long"))
    sigs = scratch.save(sigs)
    scratch.drop_since(mark, sigs)
    sizes = sigs.select("id", F.length("sig").cast("long").alias("size"), *["held"][: int(once)])
    bytes_of = rest.join(sizes, "id").groupBy("bucket").agg(F.sum("size").alias("bytes"), *[F.sum("held").alias("held")][: int(once)])
    chunks = F.greatest(F.ceil(F.col("members") / CHUNK_ROWS), F.ceil(F.col("bytes") / CHUNK_BYTES), F.lit(1)).cast("int")
    dealt = rest.join(bytes_of, "bucket").withColumn("chunks", chunks).withColumn("k", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
    # What a bucket's rows weigh, as often as they are dealt.
    dealt = scratch.save(dealt.select("bucket", "chunks", "k", "id", "c", *[(F.col("held") * F.col("chunks") / F.col("members")).alias("load")][: int(once)]))

    def placed(n: int, rounds: int) -> DataFrame:
        several = dealt.where("chunks > 1").withColumn("j", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        faced = several.select("bucket", F.least("k", "j").alias("lo"), F.greatest("k", "j").alias("hi"), "k", "id", "c").unionByName(dealt.where("chunks = 1").select("bucket", F.col("k").alias("lo"), F.col("k").alias("hi"), "k", "id", "c"))
        if rounds > 1:
            faced = faced.where(F.pmod(F.xxhash64("bucket", "lo", "hi"), F.lit(rounds)) == n)
        rows = faced.join(sigs, "id")
        # Verification is long work for few bytes.
        rows = rows.repartition(1 + total // rounds // ONCE_ROWS, "bucket", "lo", "hi") if once else rows.repartition("bucket", "lo", "hi")
        return rows.sortWithinPartitions("bucket", "lo", "hi").select("bucket", "lo", "hi", "k", "id", "c", "sig", *["buckets"][: int(once)])

    def compared(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(parts).combine_chunks()
        k, ids, c = (table.column(i).to_numpy() for i in (3, 4, 5))
        names, sizes = np.unique(c, return_counts=True)
        if len(names) < 2:
            return
        sig = table.column(6).to_pylist()
        two_chunks = table.column(1)[0].as_py() != table.column(2)[0].as_py()
        if tiles:
            for i, j in tiles(sig, c, _here(table, two_chunks)) if once else tiles(sig, c):
                if two_chunks:
                    i, j = i[k[i] != k[j]], j[k[i] != k[j]]
                if len(i):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(ids[i], ids[j])), pa.array(np.maximum(ids[i], ids[j]))], ["a", "b"])
            return
        state = near(sig)
        # Two members of the largest component need no comparison.
        for x in np.flatnonzero(c != names[sizes.argmax()]).tolist():
            ok = (c != c[x]) & near(sig, x, state)
            if two_chunks:
                ok &= k != k[x]
            hits = ids[ok]
            if len(hits):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(hits, ids[x])), pa.array(np.maximum(hits, ids[x]))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy() for i in range(3)], 1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if key != (now := tuple(keys[a].tolist())):
                    if parts:
                        yield from compared(parts)
                    key, parts = now, []
                parts.append(batch.slice(a, b - a))
        if parts:
            yield from compared(parts)

    if not once:
        return placed(0, 1).mapInArrow(run, "a long, b long")
    load, total = dealt.agg(F.coalesce(F.sum("load"), F.lit(0.0)), F.count("*")).first()
    rounds = 1 + int(load / max(LEAST_ROUND_BYTES, sigs.agg(F.coalesce(F.sum("held"), F.lit(0))).first()[0]))
    # Each round is saved, so that its shuffles are gone when the next begins.
    found = [scratch.save(placed(n, rounds).mapInArrow(run, "a long, b long")) for n in range(rounds)]
    scratch.drop(sigs, dealt)
    return reduce(DataFrame.unionByName, found)
