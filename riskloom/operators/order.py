"""Positions and running totals along a global order, without a single-task sort.

A window without ``partitionBy`` would put the whole table into one task. Here the
rows are range-partitioned by the order key (a run of equal leading keys is split by
the trailing unique column), sorted inside their partitions, numbered, and written
to the checkpoint folder once. What crosses partitions afterwards is one row per
partition and group.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.roles import quoted
from riskloom.session import cut

# tasks need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PID, _IDX = "_pid", "_idx"
# Rows of one partition whose totals are made at once; more rows get more partitions.
TOTAL_ROWS = 1 << 18


def _sort_columns(order: Sequence[str], descending: Sequence[str]) -> list[Column]:
    return [F.col(quoted(c)).desc() if c in descending else F.col(quoted(c)).asc() for c in order]


def ranged(df: DataFrame, order: Sequence[str], descending: Sequence[str] = ()) -> DataFrame:
    """``df`` plus partition number and index inside the partition, along ``order``.

    ``order`` must identify a row, so that numbering does not depend on chance.
    """
    sort = _sort_columns(order, descending)
    numbered = (
        df.repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    # the number holds the partition in its upper bits and the row index in the lower 33
    return cut(numbered).select(
        *[F.col(quoted(c)) for c in df.columns],
        F.shiftright("_mid", 33).cast("int").alias(_PID),
        F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)).alias(_IDX),
    )


def dense_positions(
    df: DataFrame, order: Sequence[str], descending: Sequence[str] = (), name: str = "pos"
) -> DataFrame:
    """The order columns plus a dense 0-based position.

    Only the order columns are moved; join back on the unique one for the rest.
    """
    rows = ranged(df.select(*[F.col(quoted(c)) for c in order]), order, descending)
    # one number per partition: bounded by the partition count
    sizes = {r[0]: r[1] for r in rows.groupBy(_PID).count().collect()}
    starts, total = [], 0
    for pid in range(max(sizes, default=-1) + 1):
        starts.append(total)
        total += sizes.get(pid, 0)
    if not starts:
        return rows.select(*[F.col(quoted(c)) for c in order], F.lit(0).cast("bigint").alias(name))
    offsets = F.expr("array(" + ",".join(f"{s}L" for s in starts) + ")")
    return rows.select(
        *[F.col(quoted(c)) for c in order],
        (F.element_at(offsets, F.col(_PID) + 1) + F.col(_IDX)).alias(name),
    )


def _segments(table: pa.Table, group: Sequence[str]) -> np.ndarray:
    """First rows of the runs of equal group values; null equals null."""
    n = table.num_rows
    new = np.zeros(n, bool)
    if n:
        new[0] = True
    for c in group:
        column = table.column(c).combine_chunks()
        here, before = column.slice(1), column.slice(0, max(0, n - 1))
        same = pc.fill_null(pc.equal(here, before), False)
        nulls = pc.and_(pc.is_null(here), pc.is_null(before))
        new[1:] |= ~pc.or_(same, nulls).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def _totals_inside(group: Sequence[str], values: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Totals of one sorted partition; ``_edge`` says which rows belong to its first (1) or last (2) group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        n = table.num_rows
        starts = _segments(table, group)
        sizes = np.diff(np.append(starts, n))
        at = np.repeat(np.arange(len(starts)), sizes)
        made = {}
        for v in values:
            x = pc.fill_null(table.column(v), 0).to_numpy()
            cum = np.cumsum(x)
            offset = np.append(0, cum[starts[1:] - 1]).astype(cum.dtype)
            made[f"cum_{v}"] = pa.array(cum - offset[at])
            made[f"total_{v}"] = pa.array((cum[starts + sizes - 1] - offset)[at])
        edge = np.zeros(n, np.int32)
        edge[: sizes[0]] = 1
        edge[starts[-1] :] += 2
        end = np.zeros(n, bool)
        end[starts + sizes - 1] = True
        made |= {"_pid": pa.array(np.full(n, TaskContext.get().partitionId(), np.int32)), "_edge": pa.array(edge), "_end": pa.array(end)}
        for name, column in made.items():
            table = table.append_column(name, column)
        yield from table.combine_chunks().to_batches(max_chunksize=1 << 16)

    return run


def _carry(edges: Sequence[Row], group: Sequence[str], values: Sequence[str]) -> list[tuple]:
    """(pid, edge, before..., total...) of the groups that lie in several partitions."""
    out: list[tuple] = []
    run: list[Row] = []

    def close() -> None:
        if len(run) > 1:
            totals = [sum(r[f"total_{v}"] for r in run) for v in values]
            before = [0 * t for t in totals]
            for r in run:
                out.append((r["_pid"], r["_edge"], *before, *totals))
                before = [b + r[f"total_{v}"] for b, v in zip(before, values)]

    for r in sorted(edges, key=lambda r: (r["_pid"], r["_edge"])):
        if not run or [r[c] for c in group] != [run[-1][c] for c in group] or r["_pid"] == run[-1]["_pid"]:
            close()
            run = []
        run.append(r)
    close()
    return out


def running_totals(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    descending: Sequence[str] = (),
) -> DataFrame:
    """Adds ``cum_<v>`` (up to and including the row) and ``total_<v>`` per group.

    ``group + order`` must identify a row: aggregate first. Rows are exchanged once, by range, to as many
    partitions as keep each at about ``TOTAL_ROWS`` rows; totals are made inside a partition before it is written. A group that goes on in the next
    partition meets the sum of its earlier pieces in a broadcast of at most two rows per partition.
    Values are whole numbers or doubles; a null adds nothing.
    """
    keep = [*group, *order, *values]
    kinds = {v: "double" if isinstance(df.schema[v].dataType, (T.DoubleType, T.FloatType)) else "bigint" for v in values}
    sort = _sort_columns([*group, *order], descending)
    # written, as it is counted, sampled and dealt
    slim = cut(df.select(*[F.col(quoted(c)) for c in [*group, *order]], *[F.col(quoted(v)).cast(kinds[v]).alias(v) for v in values]))
    parts = -(-slim.count() // TOTAL_ROWS)
    # a number of partitions keeps Spark from joining small ones to some that a worker could not hold
    dealt = (slim.repartitionByRange(parts, *sort) if parts > 1 else slim.repartitionByRange(*sort)).sortWithinPartitions(*sort)
    schema = T.StructType(list(slim.schema.fields))
    for v in values:
        kind = slim.schema[v].dataType
        schema = schema.add(f"cum_{v}", kind).add(f"total_{v}", kind)
    schema = schema.add("_pid", T.IntegerType()).add("_edge", T.IntegerType()).add("_end", T.BooleanType())
    rows = cut(dealt.mapInArrow(_totals_inside(list(group), list(values)), schema))
    # at most two rows per partition
    edges = rows.where("_edge > 0 and _end").select("_pid", "_edge", *[quoted(c) for c in group], *[quoted(f"total_{v}") for v in values])
    cells = ", ".join([f"`_b_{v}` {kinds[v]}" for v in values] + [f"`_t_{v}` {kinds[v]}" for v in values])
    carry = df.sparkSession.createDataFrame(_carry(edges.collect(), group, values), f"_pid int, _edge int, {cells}")
    return rows.join(F.broadcast(carry), ["_pid", "_edge"], "left").select(
        *[F.col(quoted(c)) for c in keep],
        *[(F.col(quoted(f"cum_{v}")) + F.coalesce(quoted(f"_b_{v}"), F.lit(0))).alias(f"cum_{v}") for v in values],
        *[F.coalesce(quoted(f"_t_{v}"), quoted(f"total_{v}")).alias(f"total_{v}") for v in values],
    )
