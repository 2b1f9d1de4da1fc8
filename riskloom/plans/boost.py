"""Real-valued AdaBoost of stumps with exact splits.

Each round takes the best boundary of all features, found as a tree's first split is. Half the
log-odds of its two leaves, times the rate, change the weights; the mean of the log-odds is the
score. The weight of a row follows from its features and the stumps so far, so no round
writes rows: a round reads the same table as the first.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.plans.trees import Growth, Source, _Top, _unpack, as_array, best_splits, packed_rows

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Least probability a leaf is taken to have.
LEAST = 2.0**-52
# Beyond this exponent weights are divided by their largest one.
SAFE = 300.0


@dataclass(frozen=True)
class Stump:
    feature: int
    threshold: float
    left: float
    right: float


def log_odds(n0: float, n1: float) -> float:
    p = n1 / (n0 + n1)
    return math.log(max(p, LEAST)) - math.log(max(1 - p, LEAST))


def vote(stumps: Sequence[Stump], x: str) -> Column:
    """Sum of the log-odds of the leaves a row falls into."""
    if not stumps:
        return F.lit(0.0)
    cells = ",".join(
        f"named_struct('f',{s.feature + 1},'t',double('{s.threshold!r}'),'l',double('{s.left!r}'),'r',double('{s.right!r}'))" for s in stumps
    )
    return F.expr(f"aggregate(array({cells}), 0D, (sum, s) -> sum + if(element_at({x}, s.f) <= s.t, s.l, s.r))")


@dataclass
class RealBoost:
    """Stumps; score is the mean of their log-odds as a probability. Without a stump it is the share of class 1."""

    stumps: list[Stump]
    prior: float = 0.0

    def scores(self, data: DataFrame) -> DataFrame:
        keep = [c for c in data.columns if c != "features"]
        rows = data.select(*keep, as_array(data).alias("_x"))
        mean = vote(self.stumps, "_x") / F.lit(float(len(self.stumps))) if self.stumps else F.lit(self.prior)
        out = rows.select(*keep, mean.alias("_v"))
        return out.select(*keep, (1.0 / (1.0 + F.exp(-F.col("_v")))).alias("score"), (F.col("_v") > 0).cast("int").alias("pred"))


def _powers(stumps: Sequence[Stump], rate: float):
    """The exponent of a row's weight."""

    def power(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for s in stumps:
            total = total + np.where(x[:, s.feature] <= s.threshold, s.left, s.right)
        return -rate / 2 * (2 * y - 1) * total

    return power


def _largest(power, p: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                most = power(_unpack(batch, p), batch.column("y").to_numpy(zero_copy_only=False)).max()
                yield pa.RecordBatch.from_arrays([pa.array([float(most)])], names=["most"])

    return run


def fit_real_boost(train: DataFrame, rounds: int = 50, rate: float = 1.0) -> RealBoost:
    """Boost over an assembled table; ends early after a stump without a miss."""
    rows, p = packed_rows(train)
    n0, n1 = rows.agg(F.sum(F.col("w") * (1 - F.col("y"))), F.sum(F.col("w") * F.col("y"))).first()
    if not n0 or not n1:
        return RealBoost([], log_odds(n0 or 0.0, n1 or 0.0) if n0 or n1 else 0.0)
    stumps: list[Stump] = []
    bound = 0.0
    edges = Source(rows, p, [0]).edges()
    top = _Top()
    top.roots[0] = top.add(0, "", n0, n1)
    for _ in range(rounds):
        power = _powers(list(stumps), rate)
        most = 0.0
        if bound > SAFE:
            most = rows.mapInArrow(_largest(power, p), "most double").agg(F.max("most")).first()[0]
        source = Source(rows, p, [0], lambda x, y, w, power=power, most=most: w * np.exp(power(x, y) - most))
        best = best_splits(source, top, [0], Growth(max_depth=1), edges).get(0)
        if best is None:
            break
        stump = Stump(best.feature, best.threshold, log_odds(best.l0, best.l1), log_odds(best.r0, best.r1))
        stumps.append(stump)
        missed = sum(min(a, b) if a != b else a for a, b in ((best.l0, best.l1), (best.r0, best.r1)))
        if missed <= 0:
            break
        bound += rate / 2 * max(abs(stump.left), abs(stump.right))
    return RealBoost(stumps, log_odds(n0, n1))
