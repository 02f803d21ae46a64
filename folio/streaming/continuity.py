"""Continuations across pages that arrive in any order, as a stream of additions and retractions.

What a page contributes is its two ends, which follow from the page alone. For each book a stateful operator keeps the ends by place; a
page that comes in between, or again, takes back the pair that it parts and puts up those that it makes.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import Row

from folio.operators.analyzer import FURNITURE, LISTS, PAIR_END, linked, physical_number

#: A page's ends as the state holds them; left and right are JSON of PAIR_END, null where a page has no such block.
ENDS = "page_pos int, physical int, left string, right string"
CHANGES = "book_id string, change int, page_pos int, left string, right string"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _quotation_head(body: Column) -> Column:
    """The first block of the quotation that the last block besides footnotes belongs to, else that block itself."""
    text = F.lit(None).cast("string")
    start = F.struct(text.alias("role"), text.alias("known"), text.alias("head"), text.alias("found"))

    def step(a: Column, b: Column) -> Column:
        same = F.coalesce(a["role"] == b["role_hint"], F.lit(False))
        parted = F.coalesce(a["known"] != b["dominant_language"], F.lit(False))
        head = F.when(same & (b["role_hint"] == "quote") & ~parted, a["head"]).otherwise(b["block_id"])
        known = F.coalesce(b["dominant_language"], F.when(same, a["known"]))
        return F.struct(b["role_hint"].alias("role"), known.alias("known"), head.alias("head"), F.when(b["role_hint"] == "footnote", a["found"]).otherwise(head).alias("found"))

    return F.aggregate(body, start, step)["found"]


def page_ends(pages: DataFrame) -> DataFrame:
    """(book_id, ENDS) of pages (book_id, page_pos, page_number, page), a table or a stream: one row each, by itself."""
    body = F.filter("page.blocks", lambda b: ~b["role_hint"].isin(*FURNITURE))
    first, last = F.get(body, F.lit(0)), F.element_at(F.filter(body, lambda b: b["role_hint"] != "footnote"), -1)
    filled = F.size(F.filter(body, lambda b: b["role_hint"] != "footnote")) > 0

    def end(block: Column, head: Column) -> Column:
        role = block["role_hint"]
        node = F.when(role.isin(*LISTS), F.concat(block["block_id"], F.lit(":node:list-item"))).otherwise(F.concat(head, F.lit(":node:"), F.when(role == "quote", "quotation").otherwise(role)))
        # Without a block there is no end.
        return F.when(block["block_id"].isNotNull(), F.to_json(F.struct(block.alias("block"), role.alias("role"), node.alias("node_id")), {"ignoreNullFields": "false"}))

    rows = pages.select("book_id", F.col("page_pos").cast("int").alias("page_pos"), physical_number(F.col("page_number"), F.col("page.printed_page_number")).cast("int").alias("physical"), "page")
    return rows.select("book_id", "page_pos", "physical", F.when(filled, end(last, _quotation_head(body))).alias("left"), end(first, first["block_id"]).alias("right"))


class PairKeeper(StatefulProcessor):
    """State: the ends of a book's pages by place. A call handles all pages of a book in a batch, and gives the net change."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.pages = handle.getMapState("pages", "page_pos int", "physical int, left string, right string")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        before = {k[0]: tuple(v) for k, v in self.pages.iterator()}
        after = dict(before)
        for r in rows:
            after[r.page_pos] = (r.physical, r.left, r.right)
        changed = {p for p, v in after.items() if before.get(p) != v}
        for p in changed:
            self.pages.updateValue((p,), after[p])

        def pairs(pages: dict) -> set[tuple]:
            """Pairs that have a changed page, or whose neighbourhood has one."""
            order, found = sorted(pages), set()
            for p in changed:
                i = bisect_left(order, p)
                # The places around p, with it if it is there.
                near = order[max(0, i - 1) : i + (2 if order[i : i + 1] == [p] else 1)]
                for a, b in zip(near, near[1:], strict=False):
                    (n, left, _), (m, _, right) = pages[a], pages[b]
                    if left is not None and right is not None and n is not None and m == n + 1:
                        found.add((a, left, right))
            return found

        old, new = pairs(before), pairs(after)
        for change, some in ((-1, old - new), (1, new - old)):
            for pos, left, right in sorted(some):
                yield Row(book_id=key[0], change=change, page_pos=pos, left=left, right=right)

    def close(self) -> None:
        pass


def pair_changes(ends: DataFrame) -> DataFrame:
    """CHANGES of a stream of page_ends: pairs of ends that follow each other (1), and that do so no longer (-1)."""
    ends.sparkSession.conf.set(PROVIDER, ROCKSDB)
    return ends.groupBy("book_id").transformWithState(PairKeeper(), CHANGES, "Append", "None")


def link_changes(changes: DataFrame) -> DataFrame:
    """Links with the change of their pair; pairs that are no continuation fall out."""
    typed = changes.withColumns({c: F.from_json(c, PAIR_END) for c in ("left", "right")})
    return linked(typed, "change", "page_pos")


def standing(changes: DataFrame) -> DataFrame:
    """Links that have been added and not taken back, of all changes so far."""
    keys = [c for c in changes.columns if c != "change"]
    return changes.groupBy(*keys).agg(F.sum("change").alias("_n")).where("_n > 0").drop("_n")
