"""A trie of conversations by their common first turns, as chains of nodes that conversations own.

The node of a prefix is owned by the smallest conversation that starts with it. As all longer prefixes of that conversation are owned by
no smaller one, each conversation owns one chain of depths from its first owned depth to its end, which a binary search finds: every probe is
one join of all conversations' prefix digests with the least owner of each digest. Chains hang below each other, so sums over subtrees
come from as many rounds as the logarithm of the number of chains above each other, and sums over the rest of a chain from running totals.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.running import running
from folio.llm.scratch import Scratch

#: Depths that one row of the search holds.
BLOCK = 64
#: A conversation's first turns are those of the conversation before that FAMILY divides, below MOST_SHARED of them.
FAMILY, MOST_SHARED = 5, 9
#: Ids of a node's ends that one row holds: at most 2 ** END_BITS.
END_BITS = 12
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
#: A digest is a sum of so many numbers of 32 bits for the turns.
LANES = 4


def _lanes(digest: Column) -> list[Column]:
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"s{i}") for i in range(LANES)]


def turns(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, place (from 1), turn_digest and n_bytes of each row with a conv_id: turns ascend, null first; rows of one turn
    are ordered by the digest of role and text. Null roles and texts are empty."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("turn_digest"), F.octet_length(text).cast("long").alias("n_bytes"))
    # Equal rows are one until their places are known, however many they are.
    once = rows.groupBy("conv_id", "turn", "turn_digest", "n_bytes").agg(F.count("*").alias("copies")).withColumn("place", F.col("copies"))
    placed = running(once, "conv_id", [F.col("turn").asc_nulls_first(), F.col("turn_digest").asc(), F.col("n_bytes").asc()], ["place"], scratch)
    return placed.withColumn("place", F.explode(F.sequence(F.col("place") - F.col("copies") + 1, F.col("place")))).select("conv_id", "place", "turn_digest", "n_bytes")


def shared_turns(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string")) % MOST_SHARED


def base_of(conv_id: Column) -> Column:
    """The conversation whose first turns it takes; for negative ids the remainder has their sign."""
    return conv_id - conv_id % FAMILY


def rebuilt(placed: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, depth, turn_digest, n_bytes) of the rebuilt conversations, and their lengths (conv_id, n_turns)."""
    own = scratch.save(placed.groupBy("conv_id").agg(F.max("place").alias("n_own")))
    first = shared_turns(F.col("conv_id"))
    base = own.select(F.col("conv_id").alias("_base"), F.col("n_own").alias("_n"))
    taken = F.least(first, F.coalesce("_n", F.lit(0)))
    sizes = scratch.save(
        own.withColumn("_base", base_of(F.col("conv_id"))).join(base, "_base", "left").select("conv_id", taken.alias("taken"), (taken + F.greatest(F.lit(0), F.col("n_own") - first)).alias("n_turns"))
    )
    short = sizes.where(F.col("taken") < first).select("conv_id", (F.col("taken") - first).alias("_move"))
    rest = placed.where(F.col("place") > first).join(short, "conv_id", "left").select("conv_id", (F.col("place") + F.coalesce("_move", F.lit(0))).alias("depth"), "turn_digest", "n_bytes")
    # A first turn goes to at most 2 * FAMILY - 1 conversations.
    heads = placed.where((F.col("conv_id") % FAMILY == 0) & (F.col("place") < MOST_SHARED))
    near = F.explode(F.array_compact(F.transform(F.sequence(F.lit(1 - FAMILY), F.lit(FAMILY - 1)), lambda k: F.try_add("conv_id", k.cast("long"))))).alias("_to")
    lent = heads.select("*", near).where((base_of(F.col("_to")) == F.col("conv_id")) & (F.col("place") <= shared_turns(F.col("_to"))))
    lent = lent.join(sizes.select(F.col("conv_id").alias("_to")), "_to", "left_semi").select(F.col("_to").alias("conv_id"), F.col("place").alias("depth"), "turn_digest", "n_bytes")
    return rest.unionByName(lent), sizes.select("conv_id", "n_turns")


def prefixes(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, depth, n_bytes (of the last text), digest: 16 bytes that tell sequences of turns apart. Numbers of each turn with
    its depth are added up, so a conversation need not lie in one task."""
    numbered = rows.select("conv_id", "depth", "n_bytes", F.md5(F.concat_ws(" ", "depth", "turn_digest")).alias("h"))
    sums = [f"s{i}" for i in range(LANES)]
    summed = running(numbered.select("conv_id", "depth", "n_bytes", *_lanes(F.col("h"))), "conv_id", [F.col("depth").asc()], sums, scratch)
    return scratch.save(summed.select("conv_id", "depth", "n_bytes", F.unhex(F.md5(F.concat_ws(" ", "depth", *sums))).alias("digest")))


def first_owned(found: DataFrame, shared: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, above (the greatest depth that a smaller conversation owns) and owner (of that depth), of conversations with one above 0.

    shared: owner and n_convs of digests of more than one conversation. Each row of the search is a block of a conversation, so long
    conversations take no more rounds than the logarithm of BLOCK.
    """
    of_block = found.groupBy("conv_id", F.expr(f"(depth - 1) div {BLOCK}").alias("block")).agg(F.sort_array(F.collect_list(F.struct("depth", "digest"))).alias("at"))
    size = F.size("at")
    # All up to ``low`` belong to smaller conversations, all from ``high`` on to this one; places count from 0 before the block.
    state = scratch.save(of_block.select("conv_id", F.transform("at", lambda x: x["digest"]).alias("digests"), (F.col("block") * BLOCK).alias("before"), F.lit(0).alias("low"), (size + 1).alias("high"), F.lit(None).cast("long").alias("owner")))
    n = shared.agg(F.sum("n_convs")).first()[0] or 0
    # At most 1000 digests stand for over a thousandth of all members: a bounded table that spares their join a hot key.
    hot = scratch.save(shared.where(F.col("n_convs") * 1000 > n).select(F.col("digest").alias("_probe"), F.col("owner").alias("_hot")))
    cold = scratch.save(shared.where(F.col("n_convs") * 1000 <= n).select(F.col("digest").alias("_probe"), F.col("owner").alias("_cold")))
    ended = []
    while True:
        ended.append(state.where("low + 1 = high and owner is not null").select("conv_id", (F.col("before") + F.col("low")).alias("above"), "owner"))
        active = state.where("low + 1 < high")
        if active.isEmpty():
            break
        middle = F.expr("(low + high) div 2").cast("int")
        probes = active.withColumns({"_middle": middle, "_probe": F.element_at("digests", middle)}).join(F.broadcast(hot), "_probe", "left")
        asked = probes.where("_hot is null").join(cold, "_probe", "left").withColumn("_least", F.col("_cold")).drop("_cold")
        both = probes.where("_hot is not null").withColumn("_least", F.col("_hot")).unionByName(asked)
        other = F.coalesce(F.col("_least") != F.col("conv_id"), F.lit(False))
        state = scratch.save(both.select("conv_id", "digests", "before", F.when(other, F.col("_middle")).otherwise(F.col("low")).alias("low"), F.when(other, F.col("high")).otherwise(F.col("_middle")).alias("high"), F.when(other, F.col("_least")).otherwise(F.col("owner")).alias("owner")))
    every = ended[0]
    for e in ended[1:]:
        every = every.unionByName(e)
    return every.groupBy("conv_id").agg(F.max_by(F.struct("above", "owner"), "above").alias("x")).select("conv_id", "x.above", "x.owner")


def subtree_sums(chains: DataFrame, values: list[str], scratch: Scratch) -> DataFrame:
    """chains (conv_id, owner: null at the top, values) with the values of all chains below added.

    A chain that holds the sum over those up to 2 ** k - 1 steps below it adds what the chains 2 ** k below hold.
    """
    state = chains
    while not state.where("owner is not null").isEmpty():
        below = state.where("owner is not null").groupBy(F.col("owner").alias("conv_id")).agg(*(F.sum(v).alias(f"_{v}") for v in values))
        over = state.select(F.col("conv_id").alias("_of"), F.col("owner").alias("_next")).where("_next is not null")
        state = scratch.save(
            state.join(below, "conv_id", "left").join(over, F.col("owner") == F.col("_of"), "left").select("conv_id", F.col("_next").alias("owner"), *((F.col(v) + F.coalesce(F.col(f"_{v}"), F.lit(0))).alias(v) for v in values))
        )
    return state


def _end_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A digest for each run of rows of one node; only its state is held."""
    at, h = None, None
    for b in batches:
        out = []
        for conv_id, depth, ids in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            if (conv_id, depth) != at:
                if h:
                    out.append((*at, h.hexdigest()))
                at, h = (conv_id, depth), hashlib.sha256(ids.encode())
            else:
                h.update(b"," + ids.encode())
        yield _digests(out)
    if h:
        yield _digests([(*at, h.hexdigest())])


def _digests(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.string()))], names=["conv_id", "depth", "ends_sha256"])


def end_hashes(ends: DataFrame) -> DataFrame:
    """ends (conv_id, depth: a node; member) -> conv_id, depth, ends_sha256. A digest is made in the order of its bytes, so one task makes it,
    from rows of up to 2 ** END_BITS ids that other tasks have put together."""
    part = ends.groupBy("conv_id", "depth", F.shiftright("member", END_BITS).alias("part")).agg(F.array_join(F.transform(F.sort_array(F.collect_list("member")), lambda x: x.cast("string")), ",").alias("ids"))
    dealt = part.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "part").select("conv_id", "depth", "ids")
    return dealt.mapInArrow(_end_hashes, "conv_id long, depth long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row for each node of the trie of the rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    Rows without conv_id belong to no conversation; equal rows are as many turns. A conversation without turns ends at
    the root. No conversation, no node: an empty table gives no row. Further columns are not read.
    """
    scratch = Scratch(conversations.sparkSession, "trie")
    rows, sizes = rebuilt(scratch.save(turns(conversations, scratch)), scratch)
    found = prefixes(rows, scratch)
    shared = scratch.save(found.groupBy("digest").agg(F.min("conv_id").alias("owner"), F.count("*").alias("n_convs")).where("n_convs > 1"))
    least, n_all = sizes.agg(F.min("conv_id"), F.count("*")).first()
    top = F.lit(least).cast("long")
    searched = scratch.save(first_owned(found, shared, scratch))
    # The root is the least conversation's; all others have it above them at least.
    every = sizes.join(searched, "conv_id", "left").select("conv_id", "n_turns", F.when(F.col("conv_id") == top, F.lit(-1).cast("long")).otherwise(F.coalesce("above", F.lit(0).cast("long"))).alias("above"), F.when(F.col("conv_id") != top, F.coalesce("owner", top)).alias("owner"))
    every = scratch.save(every)
    chains = every.where("above < n_turns")
    hung = scratch.save(chains.where("owner is not null").groupBy(F.col("owner").alias("conv_id"), F.col("above").alias("depth")).agg(F.count("*").alias("n_hung")))
    # Nodes: the depths of a conversation from its first owned one on, and the root.
    owned = found.join(chains.select("conv_id", "n_turns", "above", "owner"), "conv_id").where("depth > above").join(shared.select("digest", "n_convs"), "digest", "left")
    columns = ["conv_id", "depth", "n_turns", "above", "owner", "n_bytes", "n_convs"]
    owned = owned.withColumn("n_convs", F.coalesce("n_convs", F.lit(1).cast("long"))).select(columns)
    zero = F.lit(0).cast("long")
    root = chains.where(F.col("conv_id") == top).select("conv_id", zero.alias("depth"), "n_turns", "above", "owner", zero.alias("n_bytes"), F.lit(n_all).cast("long").alias("n_convs"))
    nodes = owned.unionByName(root).join(hung, ["conv_id", "depth"], "left").withColumn("n_hung", F.coalesce("n_hung", zero))
    last = F.col("depth") == F.col("n_turns")
    nodes = nodes.withColumns({"n_children": F.col("n_hung") + F.when(last, zero).otherwise(1), "n_leaves": F.when(last & (F.col("n_hung") == 0), 1).otherwise(zero), "saved_tokens": (F.col("n_convs") - 1) * F.col("n_bytes")})
    nodes = scratch.save(nodes)
    sums = ["n_leaves", "saved_tokens"]
    of_chain = scratch.save(nodes.groupBy("conv_id").agg(F.first("owner").alias("owner"), *(F.sum(s).alias(s) for s in sums)))
    below = subtree_sums(of_chain, sums, scratch).select("conv_id", *sums)
    hanging = chains.where("owner is not null").select("conv_id", F.col("owner").alias("_at"), "above").join(below, "conv_id")
    added = hanging.groupBy(F.col("_at").alias("conv_id"), F.col("above").alias("depth")).agg(*(F.sum(s).alias(f"_{s}") for s in sums))
    full = nodes.join(added, ["conv_id", "depth"], "left").withColumns({s: F.col(s) + F.coalesce(F.col(f"_{s}"), zero) for s in sums})
    full = running(full.select("conv_id", "depth", "above", "owner", "n_convs", "n_children", *sums), "conv_id", [F.col("depth").desc()], sums, scratch)
    # A conversation that owns no depth ends at the node above it.
    ends = every.select(F.when(F.col("above") < F.col("n_turns"), F.col("conv_id")).otherwise(F.col("owner")).alias("conv_id"), F.col("n_turns").alias("depth"), F.col("conv_id").alias("member"))
    parent = F.when(F.col("depth") > F.col("above") + 1, F.col("conv_id")).otherwise(F.col("owner"))
    return full.join(end_hashes(ends), ["conv_id", "depth"], "left").select("conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", *sums, F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))
