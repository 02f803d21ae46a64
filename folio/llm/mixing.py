"""Mixing sources to target weights by pivotal dependent rounding, with DataFrame operations only.

A source's documents share its rate, target / source size. A document gets the whole part of the rate in copies; the
fractional parts are rounded together. Two documents with fractions p and q meet: mass moves at random from one to the
other until one of them is integral, with chances that keep both expectations, and the other goes on with the rest.
Documents meet within small blocks of their source and size class, what each block leaves over meets in blocks of
blocks, and so on up a tree; the last one of a size class meets those of other classes, and the last of a source is
rounded alone. So the copies of each size class sum to their expectation within one, and words come near the target.
Chance is a hash of the documents that meet, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.scratch import Scratch
from folio.llm.tables import fresh

WEIGHTS = (5.0, 2.0, 1.0)
MOST_TIMES = 3
BLOCK = 64
_WORD = r"[^\x20\x09-\x0D]+"


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, text_hash) of each row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.regexp_count(text, F.lit(_WORD)).cast("long").alias("size"), F.xxhash64(text).alias("text_hash"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target): the whole by weight, at most MOST_TIMES a source's size, the excess shared anew.

    Sources are in code point order, null last, and take the weights in turn. At the end every source that is not at
    its limit has its weight times one level; the level follows from the sources in order of limit / weight.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = by_source.withColumn("i", (F.row_number().over(order) - 1) % len(weights)).withColumn("w", F.get(F.array(*map(F.lit, weights)), F.col("i")))
    limited = weighed.withColumn("cap", (MOST_TIMES * F.col("source_size")).cast("double"))
    rise = Window.orderBy(F.col("cap") / F.col("w"), "source")
    before = rise.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    left = F.sum(F.col("source_size").cast("double")).over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight_left = F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    levels = limited.withColumn("level", left / weight_left)
    # The first source whose limit isn't reached by the level fixes it; those before it are at their limits.
    fixed = F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct((F.col("cap") / F.col("w")).alias("at"), "level"))).over(whole)["level"]
    return levels.withColumn("fixed", fixed).select("source", "source_size", F.least("cap", F.coalesce(F.col("fixed"), F.lit(0.0)) * F.col("w")).alias("target"))


def _meet(items: Column) -> Column:
    """Folds an array of (doc, p) with 0 < p < 1: done is (doc, up) of those decided, doc and p what is left over."""

    def step(state: Column, item: Column) -> Column:
        p, q, total = state["p"], item["p"], state["p"] + item["p"]
        # In [0, 1), from both documents.
        u = F.pmod(F.xxhash64(F.lit("meet"), state["doc"]["doc_id"], state["doc"]["text_hash"], item["doc"]["doc_id"], item["doc"]["text_hash"], F.size(state["done"])), F.lit(1 << 52)) / F.lit(float(1 << 52))
        # total < 1: one gives all. total >= 1: one is filled.
        first = F.when(total < 1, u < q / total).otherwise(u < (1 - q) / (2 - total))
        decided = F.when(first, state["doc"]).otherwise(item["doc"])
        stays = F.when(first, item["doc"]).otherwise(state["doc"])
        up = F.when(total < 1, F.lit(0)).otherwise(F.lit(1))
        rest = F.when(total < 1, total).otherwise(total - 1)
        return F.struct(stays.alias("doc"), rest.alias("p"), F.concat(state["done"], F.array(F.struct(decided.alias("doc"), up.alias("up")))).alias("done"))

    head = items[0]
    none = F.filter(F.array(F.struct(head["doc"].alias("doc"), F.lit(0).alias("up"))), lambda x: F.lit(False))
    return F.aggregate(F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(0))), F.struct(head["doc"].alias("doc"), head["p"].alias("p"), none.alias("done")), step)


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source, text_hash, copies) of each row.

    copies is how often the mix takes the row, taken its words in the mix. Null text has size 0; a null source is a
    source; a source of size 0 has target 0 and gives nothing. Rows that repeat are rounded apart, as one document each.
    An empty table gives none; other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    sizes = scratch.save(sized(docs))
    goal = scratch.save(targets(sizes, weights))
    key = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("null"))
    rated = sizes.withColumn("k", key(F.col("source"))).join(goal.select(key(F.col("source")).alias("k"), "source_size", "target"), "k")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    doc = F.struct("doc_id", "text_hash", "source", "size", "source_size", "target", F.floor(rate).cast("int").alias("whole"))
    # Classes of sizes, eight to an octave.
    items = rated.select("k", F.floor(8 * F.log2(F.col("size") + 1)).cast("int").alias("class"), doc.alias("doc"), (rate - F.floor(rate)).alias("p"))
    plain = items.where("p <= 0").select("doc", F.lit(0).alias("up"))
    live = items.where("p > 0")
    counts = scratch.save(live.groupBy("k", "class").agg(F.count("*").alias("n")))
    most = counts.agg(F.max("n")).first()[0] or 0
    blocked = live.join(counts, ["k", "class"]).withColumn("block", F.pmod(F.xxhash64("doc"), F.ceil(F.col("n") / BLOCK).cast("long")))

    def level(rows: DataFrame, by: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
        """Decided and left over of blocks."""
        gathered = rows.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(*order, F.xxhash64("doc").alias("h"), "doc", "p"))).alias("items"))
        met = scratch.save(gathered.select(*by, _meet(F.col("items")).alias("m")))
        rest = met.select(*by, F.col("m.doc").alias("doc"), F.col("m.p").alias("p"))
        # A sum of fractions may come out integral.
        end = rest.where("p <= 1e-12 or p >= 1 - 1e-12").select("doc", F.when(F.col("p") > 0.5, 1).otherwise(0).alias("up"))
        return met.select(F.explode("m.done").alias("d")).select("d.doc", "d.up").unionByName(end), rest.where("p > 1e-12 and p < 1 - 1e-12")

    decided, rest = level(blocked, ["k", "class", "block"], [])
    out, blocks = [plain, decided], -(-most // BLOCK)
    while blocks > 1:
        decided, rest = level(rest.withColumn("block", F.floor(F.col("block") / BLOCK)), ["k", "class", "block"], [])
        out.append(decided)
        blocks = -(-blocks // BLOCK)
    decided, rest = level(rest, ["k"], ["class"])
    alone = F.pmod(F.xxhash64(F.lit("alone"), "doc"), F.lit(1 << 52)) / F.lit(float(1 << 52))
    out += [decided, rest.select("doc", F.when(alone < F.col("p"), 1).otherwise(0).alias("up"))]
    all_docs = out[0]
    for d in out[1:]:
        all_docs = all_docs.unionByName(d)
    copies = F.col("doc.whole") + F.col("up")
    return all_docs.select("doc.doc_id", "doc.size", "doc.source_size", "doc.target", (copies * F.col("doc.size")).cast("long").alias("taken"), "doc.source", "doc.text_hash", copies.cast("int").alias("copies"))


def mixture(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """The rows of docs that the mix takes, as often as mixed() takes them, with all their columns.

    Rows equal in doc_id, text and source share the copies that mixed() decides for them: the first of them, in no
    order, take one more where the sum doesn't divide evenly, so the rows of the result are the sum of copies. Rows of
    size 0 (null or empty texts) are taken as often as their source's rate says. Columns may have any names.
    """
    i, t, s, copies, rows, nth = (fresh(docs, n) for n in ("id", "text", "source", "copies", "rows", "nth"))
    decided = mixed(docs, weights).groupBy(F.col("doc_id").alias(i), F.col("text_hash").alias(t), F.col("source").alias(s)).agg(F.sum("copies").alias(copies), F.count("*").alias(rows))
    picked = Scratch(docs.sparkSession, "mixture").save(decided.where(F.col(copies) > 0))
    key = (docs["doc_id"].cast("long"), F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))), docs["source"].cast("string"))
    joined = docs.join(picked, key[0].eqNullSafe(F.col(i)) & (key[1] == F.col(t)) & key[2].eqNullSafe(F.col(s)))
    again = lambda n: F.explode(F.sequence(F.lit(1), n))
    one = joined.where(F.col(rows) == 1).select(*docs.columns, again(F.col(copies).cast("int")).alias(nth))
    # Only rows that repeat are numbered.
    several = joined.where(F.col(rows) > 1).withColumn(nth, F.row_number().over(Window.partitionBy(i, t, s).orderBy(F.lit(1))))
    share = (F.floor(F.col(copies) / F.col(rows)) + F.when(F.col(nth) <= F.col(copies) % F.col(rows), 1).otherwise(0)).cast("int")
    several = several.where(share > 0).select(*docs.columns, again(share).alias(nth))
    return one.unionByName(several).select(*docs.columns)
