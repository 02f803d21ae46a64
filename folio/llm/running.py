"""Running totals inside groups of any size: rows are dealt by ranges of their order, so a group may lie in many tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.scratch import Scratch


def _segments(batches: Iterator[pa.RecordBatch], group: str | None, sums: list[str]) -> Iterator[pa.RecordBatch]:
    """Totals from the start of each group in this task. Marked are the last rows of its first and of its last group."""
    part, first, open_group, carry = TaskContext.get().partitionId(), True, None, [0] * len(sums)

    def keys(b: pa.RecordBatch) -> np.ndarray:
        return b.column(group).to_numpy(zero_copy_only=False) if group else np.zeros(b.num_rows, np.int64)

    later = (b for b in batches if b.num_rows)
    batch = next(later, None)
    while batch is not None:
        follows, g = next(later, None), keys(batch)
        n = len(g)
        starts = np.concatenate([[True], g[1:] != g[:-1]])
        goes_on = open_group is not None and open_group[0] == g[0]
        at = np.flatnonzero(starts)
        segment = np.cumsum(starts) - 1
        ends = np.concatenate([starts[1:], [follows is None or keys(follows)[0] != g[-1]]])
        edge = np.zeros(n, bool)
        edge[-1] = follows is None
        if first and (closing := np.flatnonzero(ends)).size:
            # The first group of the task ends at the first end that is seen.
            edge[closing[0]], first = True, False
        totals = []
        for i, name in enumerate(sums):
            v = batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)
            c = np.cumsum(v)
            own = c - (c[at] - v[at])[segment]
            if goes_on:
                own[segment == 0] += carry[i]
            carry[i] = int(own[-1])
            totals.append(pa.array(own))
        open_group = (g[-1],)
        columns = [c if name not in sums else totals[sums.index(name)] for name, c in zip(batch.schema.names, batch.columns, strict=True)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(n, part, np.int32)), pa.array(edge)], names=[*batch.schema.names, "_part", "_edge"])
        batch = follows


def running(df: DataFrame, group: str | None, order: list[Column], sums: list[str], scratch: Scratch) -> DataFrame:
    """df, its columns ``sums`` (long, not null) replaced by their totals from the first row of the group up to the row.

    group: a column without nulls, by which rows are ordered first; None: all rows are one group. Rows that are equal in group and
    order should be equal, as which of them comes first isn't fixed. A task passes its rows on batch by batch; of each task
    one or two rows reach the driver, which adds up what a group had in earlier tasks.
    """
    by = [F.col(group).asc(), *order] if group else order
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    dealt = df.repartitionByRange(*by).sortWithinPartitions(*by)
    saved = scratch.save(dealt.mapInArrow(lambda batches: _segments(batches, group, sums), f"{names}, _part int, _edge boolean"))
    edges: dict[int, list[tuple]] = {}
    for r in saved.where("_edge").select("_part", (F.col(group) if group else F.lit(0)).alias("_group"), *sums).collect():
        edges.setdefault(r[0], []).append(tuple(r)[1:])
    before, carry = [], None
    for part, found in sorted(edges.items()):
        found.sort(key=lambda r: r[0])
        if carry is not None and carry[0] == found[0][0]:
            before.append((part, *carry))
            if len(found) == 1:
                found = [(found[0][0], *(a + b for a, b in zip(carry[1:], found[0][1:], strict=True)))]
        carry = found[-1]
    out = saved.drop("_edge")
    if before:
        kind = dict(df.dtypes)[group] if group else "int"
        add = df.sparkSession.createDataFrame(before, f"_p int, _g {kind}, " + ", ".join(f"_s{i} long" for i in range(len(sums))))
        on = (F.col("_part") == F.col("_p")) & ((F.col(group) == F.col("_g")) if group else F.lit(True))
        out = out.join(F.broadcast(add), on, "left").withColumns({s: F.col(s) + F.coalesce(F.col(f"_s{i}"), F.lit(0)) for i, s in enumerate(sums)})
    return out.select(*df.columns)
