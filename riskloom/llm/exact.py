"""Exact deduplication by sorting content.

Sampled splitters range-partition the documents by their normalised bytes (A-Z
lower-cased): by a 64-byte prefix, then, among texts that begin alike, by their SHA-256,
then by the id. The splitters stay small whatever the texts are, equal texts are adjacent,
and a group of copies of any size spreads over as many partitions as it fills. Each
partition is sorted externally; one streaming pass compares every text in full with its
neighbour. A run of equal texts that crosses partitions is stitched from two texts per
partition (its first and its last), never from the rows inside.

Null texts count as empty. Null ids rank behind all others: they are kept only where a
group has no other id. Of rows that repeat text and id, one is kept.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import fresh_worker, partitions, quoted, scratch, text_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PREFIX = 64


def _normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fresh_worker()
    for batch in batches:
        text = pc.ascii_lower(batch.column("text")).cast(pa.binary())
        sha = pa.array([hashlib.sha256(t).digest() for t in text.to_pylist()], pa.binary())
        prefix = pc.binary_slice(text, 0, PREFIX)
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), text, prefix, sha], names=["row", "id", "text", "prefix", "sha"])


def _compare_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the runs of equal texts of one sorted partition.

    ``ends`` marks the last row of a run. One row more per end of the partition (``edge`` 1
    and 2) carries its text.
    """
    pid = TaskContext.get().partitionId()
    run, before, waiting = -1, None, None

    def out(rows: pa.RecordBatch, runs: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
        n = rows.num_rows
        return pa.RecordBatch.from_arrays(
            [rows.column("row"), rows.column("id"), rows.column("sha"), pa.array(np.full(n, pid, np.int32)), pa.array(runs),
             pa.array(ends), pa.array(np.zeros(n, np.int32)), pa.nulls(n, pa.binary())],
            names=["row", "id", "sha", "pid", "run", "ends", "edge", "text"],
        )

    def edge(rows: pa.RecordBatch, which: int, text: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.nulls(1, rows.schema.field("row").type), rows.column("id").slice(0, 1), pa.nulls(1, pa.binary()), pa.array([pid], pa.int32()),
             pa.array([run], pa.int64()), pa.array([False]), pa.array([which], pa.int32()), pa.array([text], pa.binary())],
            names=["row", "id", "sha", "pid", "run", "ends", "edge", "text"],
        )

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        text = batch.column("text")
        new = np.ones(n, bool)
        new[0] = before is None or text[0].as_py() != before
        if n > 1:
            new[1:] = pc.not_equal(text.slice(1), text.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        if waiting is not None:
            yield out(waiting, np.array([run]), np.array([new[0]]))
        else:
            run = 0
            new[0] = False
            yield edge(batch, 1, text[0].as_py())
        runs = run + np.cumsum(new)
        run, before = int(runs[-1]), text[n - 1].as_py()
        if n > 1:
            yield out(batch.slice(0, n - 1), runs[:-1], new[1:])
        waiting = batch.slice(n - 1, 1)
    if waiting is not None:
        yield out(waiting, np.array([run]), np.array([True]))
        yield edge(waiting, 2, before)


def _sorted_runs(docs: DataFrame, key: str, text: str, keep: str) -> tuple[DataFrame, dict[int, tuple[int, int]], dict[int, int]]:
    """Rows with (pid, run, ends); for partitions whose first run began earlier, where; the last runs that go on."""
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is largest or smallest")
    kind = docs.schema[key].dataType.simpleString()
    row = docs.schema.simpleString()
    slim = docs.select(F.struct(*map(quoted, docs.columns)).alias("row"), F.col(quoted(key)).alias("id"), text_of(text).alias("text"))
    known = slim.mapInArrow(_normalise, f"row {row}, id {kind}, text binary, prefix binary, sha binary")
    order = F.col("id").asc_nulls_first() if keep == "largest" else F.col("id").desc_nulls_first()
    dealt = known.repartitionByRange(partitions(docs.sparkSession), F.col("prefix"), F.col("sha"), order)
    dealt = dealt.sortWithinPartitions("prefix", "sha", "text", order)
    runs = dealt.mapInArrow(_compare_neighbours, f"row {row}, id {kind}, sha binary, pid int, run bigint, ends boolean, edge int, text binary")
    runs = scratch(runs, "runs")
    # each partition's first text meets the last text of the one before: a join of two rows per partition
    edges = runs.where("edge > 0").select("pid", "run", "edge", "text")
    place = edges.where("edge = 1").select("pid").collect()  # one number per partition
    follows = dict(zip(sorted(r["pid"] for r in place), sorted(r["pid"] for r in place)[1:]))
    nexts = docs.sparkSession.createDataFrame([*follows.items()] or [(-1, -1)], "pid int, after int")
    firsts = edges.where("edge = 1").select(F.col("pid").alias("after"), F.col("text").alias("first"))
    lasts = edges.where("edge = 2").select("pid", "run", "text")
    same = lasts.join(nexts, "pid").join(firsts, "after").where("text = first").select("pid", "run", "after").collect()
    goes_on = {r["pid"]: (r["after"], r["run"]) for r in same}
    began: dict[int, tuple[int, int]] = {}
    for pid in sorted(goes_on):
        after, run = goes_on[pid]
        began[after] = began[pid] if run == 0 and pid in began else (pid, run)
    return runs.where("edge = 0"), began, {pid: run for pid, (_, run) in goes_on.items()}


def _stitches(runs: DataFrame, pairs: list[tuple], schema: str) -> DataFrame:
    """A left join with at most one row per partition: small enough to broadcast by construction."""
    table = runs.sparkSession.createDataFrame(pairs, schema)
    return runs.join(F.broadcast(table), ["pid", "run"], "left")


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "smallest") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row; the id keeps its name.

    ``keep`` names which id of equal texts stays. Other columns are not returned.
    """
    runs, began, on = _sorted_runs(docs.select(quoted(key), quoted(text)), key, text, keep)
    rows = _stitches(runs, [(p, 0, *b) for p, b in began.items()], "pid int, run bigint, at_pid int, at_run bigint")
    rows = rows.join(F.broadcast(docs.sparkSession.createDataFrame([*on.items()], "pid int, run bigint").withColumn("goes_on", F.lit(True))), ["pid", "run"], "left")
    rows = rows.select(
        "id", "sha", "pid", "run", F.struct(F.coalesce("at_pid", "pid").alias("pid"), F.coalesce("at_run", "run").alias("run")).alias("g"),
        (F.col("ends") & F.col("goes_on").isNull()).alias("kept"),
    )
    best, total = (F.max if keep == "largest" else F.min), F.sum
    # a run lies in one partition: a group that fills many is joined run by run, not in one task
    by_run = rows.groupBy("pid", "run").agg(F.first("g").alias("g"), best("id").alias("best"), F.count(F.lit(1)).alias("n"))
    by_run = scratch(by_run.where((F.col("n") > 1) | F.col("g.pid").isin([b[0] for b in began.values()])), "run-sizes")
    many = by_run.groupBy("g").agg(best("best").alias("keep_id"), total("n").alias("group_size")).where("group_size > 1")
    sizes = by_run.join(many, "g").select("pid", "run", "keep_id", "group_size")
    found = rows.join(sizes, ["pid", "run"], "left")
    return found.select(
        F.col("id").alias(key),
        F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        "kept",
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    runs, _, on = _sorted_runs(docs, key, text, keep)
    runs = runs.where("ends")
    gone = docs.sparkSession.createDataFrame([*on.items()], "pid int, run bigint")
    return runs.join(F.broadcast(gone), ["pid", "run"], "left_anti").select("row.*")
