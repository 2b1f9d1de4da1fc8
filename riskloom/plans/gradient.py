"""Gradient boosting of shallow trees on binned columns, as Spark ML's ``GBTClassifier`` defines it.

Spark ML takes five passes a tree over rows kept as objects, and its time grows with all of them. Here rows are
binned once, a byte a column, and packed in blocks; a level of a tree is one pass in which every task sums
weights and residuals per (node, column, bin). The driver adds these sums, one array a task, and chooses the
splits. The margin of a row is part of its block; trees since it was written are added on the way, and every
``REWRITE`` trees the blocks are written anew, so that a pass never walks all trees.

What is fitted is the same: columns are cut at up to 32 places that a sample of about 10,000 rows gives (the rows
that Spark ML draws), the first tree fits labels of -1 and 1, the others the negative gradient of
2 log(1 + exp(-2 y F)); splits reduce the variance most, ties go to the first column and the smallest place, a leaf
is the mean of its residuals, and the first tree counts fully, the others by the rate.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from riskloom.plans.trees import as_array
from riskloom.session import cut, drop_cut

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Places at which a column is cut, and one more; rows of the sample that gives them.
BINS, SAMPLE = 32, 10_000
# Rows of a block, at most.
BLOCK = 1 << 16
# Trees after which margins are written.
REWRITE = 10
# Deepest trees and most columns: a task's sums are 2^depth x columns x bins numbers.
DEEPEST, WIDEST = 8, 512


@dataclass(frozen=True)
class Tree:
    """A complete tree: inner nodes level by level, those that do not split have place -1 and leaves alike below them."""

    feature: np.ndarray
    place: np.ndarray  # bins up to this one go left
    threshold: np.ndarray
    leaf: np.ndarray
    gain: np.ndarray  # by how much each split reduces the sum of squares

    def walk(self, right, depth: int) -> np.ndarray:
        """The node of each row at ``depth``; ``right(i)`` tells which rows inner node i sends right."""
        at = None
        for level in range(depth):
            first = (1 << level) - 1
            if at is None:
                at = right(0).astype(np.uint8)
                continue
            goes = right(first)
            for i in range(1, 1 << level):
                goes = np.where(at == i, right(first + i), goes)
            at = at * 2 + goes
        return at


def _binned(tree: Tree, bins: np.ndarray, depth: int | None = None) -> np.ndarray:
    def right(i: int) -> np.ndarray:
        return bins[tree.feature[i]] > tree.place[i]

    return tree.walk(right, _depth(tree) if depth is None else depth)


def _depth(tree: Tree) -> int:
    return len(tree.leaf).bit_length() - 1


def places(data: DataFrame, count: int, weight: float, seed: int) -> list[np.ndarray]:
    """The places at which each column is cut; ``data`` has ``count`` rows that weigh ``weight``."""
    spark = data.sparkSession
    most = min(BINS, count)
    share = min(1.0, max(most * most, SAMPLE) / count)
    if share < 1:
        # drawn by place in the partition, like Spark ML's own draw
        draw = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
        rows = DataFrame(spark._jsparkSession.createDataFrame(data._jdf.javaRDD().sample(False, share, draw), data._jdf.schema()), spark)
    else:
        rows = data
    found = rows.select(as_array(rows).alias("x"), "w").toPandas()
    if not len(found):
        return [np.zeros(0)] * len(data.select(as_array(data).alias("x")).first()["x"])
    x, w = np.array(found["x"].tolist(), float), found["w"].to_numpy(float)
    return [_cuts(x[:, f], w, share * weight, most - 1) for f in range(x.shape[1])]


def _cuts(x: np.ndarray, w: np.ndarray, whole: float, splits: int) -> np.ndarray:
    some = x != 0
    value, at = np.unique(x[some], return_inverse=True)
    if not len(value):
        return np.zeros(0)
    n = np.bincount(at, weights=w[some])
    # zeros are what the sample should weigh and the other values do not
    zeros = whole - n.sum()
    if zeros > sys.float_info.epsilon * some.sum() * 100:
        place = int(np.searchsorted(value, 0.0))
        value, n = np.insert(value, place, 0.0), np.insert(n, place, zeros)
    middle = (value[:-1] + value[1:]) / 2
    if len(middle) <= splits:
        return middle
    stride = whole / (splits + 1)
    seen, target, cuts = n[0], stride, []
    for i in range(1, len(value)):
        before, seen = seen, seen + n[i]
        if abs(before - target) < abs(seen - target):
            cuts.append(middle[i - 1])
            target += stride
    return np.array(cuts)


def _bins(cuts: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The bin of each value: places below it. Values next to each other can give one place twice; then a plain binary search tells, as in Spark ML."""
    at = np.searchsorted(cuts, x)
    for twice in np.unique(cuts[1:][cuts[1:] == cuts[:-1]]):
        low, high = 0, len(cuts) - 1
        while cuts[middle := (low + high) // 2] != twice:
            low, high = (middle + 1, high) if cuts[middle] < twice else (low, middle - 1)
        at[x == twice] = middle
    return at.astype(np.uint8)


def _packing(cuts: list[np.ndarray]):
    """Blocks (n, bins, y, w, margin) of rows (label, w, x); ``w`` is empty where all weights are one."""
    p = len(cuts)

    def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        x = np.concatenate([b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, p) for b in parts])
        y = np.concatenate([b.column("label").to_numpy(zero_copy_only=False) for b in parts])
        w = np.concatenate([b.column("w").to_numpy(zero_copy_only=False) for b in parts])
        bins = np.stack([_bins(c, x[:, f]) for f, c in enumerate(cuts)])
        cells = [bins.tobytes(), (2 * y - 1).tobytes(), b"" if (w == 1).all() else w.tobytes(), bytes(8 * len(y))]
        return pa.RecordBatch.from_arrays([pa.array([len(y)], pa.int64()), *[pa.array([c], pa.binary()) for c in cells]], names=["n", "bins", "y", "w", "margin"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if n and n + batch.num_rows > BLOCK:
                yield block(held)
                held, n = [], 0
            held.append(batch)
            n += batch.num_rows
        if held:
            yield block(held)

    return run


BLOCKS = "n bigint, bins binary, y binary, w binary, margin binary"


def _open(batch: pa.RecordBatch, p: int, new: Sequence[tuple[float, Tree]]) -> Iterator[tuple]:
    """(bins, y, w or None, margin) of each block, with ``new`` trees added to its margin."""
    for n, bins, y, w, margin in zip(*[batch.column(c).to_pylist() for c in ("n", "bins", "y", "w", "margin")]):
        bins = np.frombuffer(bins, np.uint8).reshape(p, n)
        margin = np.frombuffer(margin).copy()
        for weight, tree in new:
            margin += (weight * tree.leaf)[_binned(tree, bins)]
        yield bins, np.frombuffer(y), np.frombuffer(w) if w else None, margin


def _summing(p: int, bins_each: int, new: Sequence[tuple[float, Tree]], first: bool, tree: Tree | None, level: int):
    """One row a task: weights and residuals per (node of this level, column, bin)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = (1 << level) * bins_each
        total = np.zeros((2, p, cells))
        for batch in batches:
            for bins, y, w, margin in _open(batch, p, new):
                # the negative gradient; labels at first
                with np.errstate(over="ignore"):
                    r = y if first else 4 * y / (1 + np.exp(2 * y * margin))
                if w is not None:
                    r = r * w
                base = _binned(tree, bins, level).astype(np.int64) * bins_each if level else 0
                for f in range(p):
                    at = base + bins[f] if level else bins[f]
                    total[0, f] += np.bincount(at, weights=w, minlength=cells)
                    total[1, f] += np.bincount(at, weights=r, minlength=cells)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    return run


def _moving(p: int, new: Sequence[tuple[float, Tree]]):
    """The blocks with ``new`` trees in their margins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([m.tobytes() for *_, m in _open(batch, p, new)], pa.binary())
            yield batch.set_column(batch.schema.get_field_index("margin"), "margin", made)

    return run


def _grow(blocks: DataFrame, cuts: list[np.ndarray], new: Sequence[tuple[float, Tree]], first: bool, depth: int) -> Tree:
    p, inner = len(cuts), (1 << depth) - 1
    # strides between places can leave one more of them than asked for
    bins_each = max(map(len, cuts)) + 1
    feature, place, threshold = np.zeros(inner, np.int64), np.full(inner, -1), np.full(inner, -np.inf)
    gain, value, alive = np.zeros(inner), np.zeros(2 * inner + 1), np.zeros(2 * inner + 1, bool)
    alive[0] = True
    for level in range(depth):
        start, nodes = (1 << level) - 1, 1 << level
        if not alive[start : start + nodes].any():
            break
        tree = Tree(feature, place, threshold, np.zeros(1 << depth), gain)
        parts = blocks.mapInArrow(_summing(p, bins_each, new, first, tree, level), "sums binary").collect()
        w, s = sum(np.frombuffer(part["sums"]).reshape(2, p, nodes, bins_each) for part in parts)
        for i in np.flatnonzero(alive[start : start + nodes]):
            at = start + i
            whole_w, whole_s = w[0, i].sum(), s[0, i].sum()
            if level == 0:
                value[0] = whole_s / whole_w
            best = (0.0, -1, -1, 0.0, 0.0)
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                lw, ls = np.cumsum(w[f, i])[: len(c)], np.cumsum(s[f, i])[: len(c)]
                rw, rs = w[f, i].sum() - lw, s[f, i].sum() - ls
                with np.errstate(divide="ignore", invalid="ignore"):
                    won = np.where((lw > 0) & (rw > 0), ls * ls / lw + rs * rs / rw - whole_s * whole_s / whole_w, -np.inf)
                k = int(np.argmax(won))
                if won[k] > best[0]:
                    best = (float(won[k]), f, k, ls[k] / lw[k], rs[k] / rw[k])
            if best[1] >= 0:
                gain[at], feature[at] = best[:2]
                threshold[at] = cuts[best[1]][best[2]]
                # of equal places the last
                place[at] = np.searchsorted(cuts[best[1]], threshold[at], "right") - 1
                value[2 * at + 1], value[2 * at + 2] = best[3:]
                alive[2 * at + 1 : 2 * at + 3] = True
    for at in range(1, len(value)):
        if not alive[at]:
            value[at] = value[(at - 1) // 2]
    return Tree(feature, place, threshold, value[inner:].copy(), gain)


@dataclass
class GradientBoost:
    """Weighted trees; score is 1 / (1 + exp(-2 F)) of their sum F."""

    trees: list[tuple[float, Tree]]
    features: list[str]

    def scores(self, data: DataFrame) -> DataFrame:
        keep = [c for c in data.columns if c != "features"]
        schema = StructType([*[data.schema[c] for c in keep], StructField("score", DoubleType()), StructField("pred", IntegerType())])
        trees, p = self.trees, len(self.features)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = np.ascontiguousarray(batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(-1, p).T)
                total = np.zeros(batch.num_rows)
                for weight, tree in trees:
                    at = tree.walk(lambda i: ~(x[tree.feature[i]] <= tree.threshold[i]), _depth(tree))
                    total += weight * tree.leaf[at]
                with np.errstate(over="ignore"):
                    score = 1 / (1 + np.exp(-2 * total))
                made = [pa.array(score), pa.array((total > 0).astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *made], names=[*keep, "score", "pred"])

        return data.select(*keep, as_array(data).cast("array<double>").alias("_x")).mapInArrow(run, schema)

    def importances(self) -> list[tuple[str, float]]:
        """(feature, share of all that splits reduced the squares by), smallest first."""
        total = np.zeros(len(self.features))
        for _, tree in self.trees:
            np.add.at(total, tree.feature, tree.gain)
        total = total / total.sum() if total.sum() else total
        return sorted(zip(self.features, map(float, total)), key=lambda pair: (pair[1], pair[0]))


def fits(width: int, depth: int) -> bool:
    return 1 <= depth <= DEEPEST and 1 <= width <= WIDEST


def fit_gradient_boost(train: DataFrame, features: Sequence[str], rounds: int = 100, rate: float = 0.1, depth: int = 3, seed: int = 0) -> GradientBoost | None:
    """Boost over a placed table; None where Spark ML has to judge its rows (none of them, odd labels or weights, vectors of other lengths)."""
    x = as_array(train)
    odd = ~F.coalesce(F.col("label").isin(0.0, 1.0) & (F.col("w") >= 0) & (F.size(x) == len(features)), F.lit(False))
    count, weight, none = train.agg(F.count(F.lit(1)), F.sum("w"), F.count_if(odd)).first()
    if not count or none or not weight:
        return None
    cuts = places(train, count, weight, seed)
    rows = train.select("label", "w", x.cast("array<double>").alias("x"))
    blocks = cut(rows.mapInArrow(_packing(cuts), BLOCKS))
    trees: list[tuple[float, Tree]] = []
    new: list[tuple[float, Tree]] = []
    for i in range(rounds):
        made = (rate if i else 1.0, _grow(blocks, cuts, new, not i, depth))
        trees.append(made)
        new.append(made)
        if len(new) == REWRITE and i + 1 < rounds:
            old, blocks, new = blocks, cut(blocks.mapInArrow(_moving(len(cuts), list(new)), BLOCKS)), []
            drop_cut(old)
    drop_cut(blocks)
    return GradientBoost(trees, list(features))
