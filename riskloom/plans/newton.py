"""Penalised linear classifiers, many at once, by Newton steps.

All fits of a search - every penalty on every split - share each pass over the rows. A pass sums,
for each fit, the loss, the gradient and the Gram matrix weighted by the loss's curvature:
(p + 1)(p + 2) / 2 numbers a fit, whatever the number of rows, added up in the tasks and then by one
aggregation. The driver solves p equations per fit. A step that raises the loss is halved.

Objective: |b|^2 / 2 + C * sum of w * loss(y b.x), y of -1 and 1. ``logistic`` has log(1 + exp(-m)),
``squared_hinge`` max(0, 1 - m)^2, whose curvature counts the rows inside the margin only. The
intercept is a weight like the others and penalised like them; ``penalise_intercept=False`` frees it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.plans.trees import as_array
from riskloom.roles import quoted
from riskloom.session import cut

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LOSSES = ("logistic", "squared_hinge")
# Rows whose products are formed together.
BLOCK = 8192


def _pass(loss: str, splits: dict[tuple, list[int]], keys: Sequence[str], weights: object, intercept: bool):
    """(fit, place, value): sums of loss, gradient and upper triangle of the Gram matrix of a task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = weights.value
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            if intercept:
                x = np.hstack([x, np.ones((n, 1))])
            y = 2.0 * batch.column("y").to_numpy() - 1.0
            w = batch.column("w").to_numpy()
            cells = list(zip(*[batch.column(k).to_pylist() for k in keys])) if keys else [()] * n
            upper = np.triu_indices(x.shape[1])
            for split, fits in splits.items():
                some = np.flatnonzero([c == split for c in cells]) if keys else np.arange(n)
                for at in range(0, len(some), BLOCK):
                    part = some[at : at + BLOCK]
                    xs, ys, ws = x[part], y[part], w[part]
                    for fit in fits:
                        m = ys * (xs @ known[fit])
                        if loss == "logistic":
                            p = 1.0 / (1.0 + np.exp(np.minimum(m, 700.0)))
                            value, slope, curve = np.logaddexp(0.0, -m), -p, p * (1.0 - p)
                        else:
                            inside = np.maximum(0.0, 1.0 - m)
                            value, slope, curve = inside**2, -2.0 * inside, 2.0 * (m < 1.0)
                        gram = (xs * (ws * curve)[:, None]).T @ xs
                        out = np.concatenate([[ws @ value], xs.T @ (ws * slope * ys), gram[upper]])
                        sums[fit] = sums[fit] + out if fit in sums else out
        for fit, out in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(out), fit, np.int32)), pa.array(np.arange(len(out), dtype=np.int32)), pa.array(out)], names=["fit", "place", "value"]
            )

    return run


@dataclass
class LinearFits:
    """Solutions by (split, cost): weights, the intercept last, and what is known of them."""

    loss: str
    split: list[str]
    costs: list[float]
    features: list[str]
    intercept: bool
    weights: dict[tuple, dict[float, np.ndarray]] = field(default_factory=dict)
    gradient: dict[tuple, dict[float, float]] = field(default_factory=dict)
    passes: int = 0

    def table(self, spark) -> DataFrame:
        """(split..., cost, feature, weight): a row per fit and feature."""
        names = [*self.features, *(["intercept"] if self.intercept else [])]
        rows = [(*s, c, n, float(b)) for s, by in self.weights.items() for c, w in by.items() for n, b in zip(names, w)]
        cells = ", ".join([f"{quoted(k)} int" for k in self.split] + ["cost double", "feature string", "weight double"])
        return spark.createDataFrame(rows, cells)

    def scores(self, data: DataFrame, keep: Sequence[str] = ("row_id", "label", "w")) -> DataFrame:
        """(keep..., split..., cost, score, pred) of assembled rows that name their split: all costs in one projection."""
        rows = data.select(*keep, *[quoted(k) for k in self.split], as_array(data).alias("_x"))
        by_split = None
        for s, by in self.weights.items():
            cells = ",".join(
                f"named_struct('cost', double('{c!r}'), 'b', array({','.join(f'double({float(v)!r})' for v in (w[:-1] if self.intercept else w))}),"
                f" 'i', double({float(w[-1]) if self.intercept else 0.0!r}))"
                for c, w in by.items()
            )
            mine = F.expr(f"array({cells})")
            same = F.lit(True)
            for k, v in zip(self.split, s):
                same &= F.col(quoted(k)) == F.lit(v)
            by_split = F.when(same, mine) if by_split is None else by_split.when(same, mine)
        rows = rows.select(*keep, *[quoted(k) for k in self.split], "_x", F.explode(by_split).alias("_m"))
        margin = F.expr("aggregate(zip_with(_x, _m.b, (x, b) -> x * b), _m.i, (s, v) -> s + v)")
        score = 1.0 / (1.0 + F.exp(-margin)) if self.loss == "logistic" else margin
        return rows.select(*keep, *[quoted(k) for k in self.split], F.col("_m.cost").alias("cost"), score.alias("score"), (margin > 0).cast("int").alias("pred"))


def fit_linear(
    data: DataFrame,
    features: Sequence[str],
    costs: Sequence[float],
    loss: str = "logistic",
    split: Sequence[str] = (),
    intercept: bool = True,
    penalise_intercept: bool = True,
    tolerance: float = 1e-7,
    most: int = 100,
) -> LinearFits:
    """Every cost on every split of an assembled table (split..., label, w, features).

    Splits are whole numbers. A fit is done when no component of its gradient exceeds
    ``tolerance`` per unit of its largest sum, or no step lowers its loss any more.
    """
    if loss not in LOSSES:
        raise ValueError(f"loss is one of {LOSSES}")
    split, costs = list(split), [float(c) for c in costs]
    if not costs or min(costs) <= 0:
        raise ValueError("costs are positive")
    spark = data.sparkSession
    cols = [F.col("label").cast("double").alias("y"), F.col("w").cast("double").alias("w"), as_array(data).alias("x")]
    rows = cut(data.select(*[F.col(quoted(k)).cast("int").alias(k) for k in split], *cols))
    found = sorted(tuple(r) for r in rows.select(*split).distinct().collect()) if split else [()]
    out = LinearFits(loss, split, costs, list(features), intercept)
    width = len(features) + int(intercept)
    fits = [(s, c) for s in found for c in costs]
    penalty = np.ones(width)
    if intercept and not penalise_intercept:
        penalty[-1] = 0.0
    here = [np.zeros(width) for _ in fits]
    best = [np.inf] * len(fits)
    trial, step, length = [b.copy() for b in here], [np.zeros(width) for _ in fits], [1.0] * len(fits)
    slope = [np.inf] * len(fits)
    open_ = set(range(len(fits)))
    upper = np.triu_indices(width)
    while open_ and out.passes < most:
        by_split: dict[tuple, list[int]] = {}
        for i in sorted(open_):
            by_split.setdefault(fits[i][0], []).append(i)
        shared = spark.sparkContext.broadcast({i: trial[i] for i in open_})
        sums = rows.mapInArrow(_pass(loss, by_split, split, shared, intercept), "fit int, place int, value double")
        got: dict[int, np.ndarray] = {i: np.zeros(1 + width + len(upper[0])) for i in open_}
        for r in sums.groupBy("fit", "place").agg(F.sum("value").alias("value")).collect():  # numbers per fit, not rows
            got[r["fit"]][r["place"]] = r["value"]
        out.passes += 1
        for i in sorted(open_):
            cost, at, sums_ = fits[i][1], trial[i], got[i]
            value = cost * sums_[0] + 0.5 * float(penalty @ (at * at))
            if value > best[i] + 1e-12 * abs(best[i]):
                length[i] /= 2
                if length[i] < 1e-6:
                    open_.discard(i)
                trial[i] = here[i] + length[i] * step[i]
                continue
            gradient = cost * sums_[1 : 1 + width] + penalty * at
            curve = np.zeros((width, width))
            curve[upper] = cost * sums_[1 + width :]
            curve = curve + np.triu(curve, 1).T + np.diag(penalty)
            here[i], best[i], slope[i], length[i] = at, value, float(np.abs(gradient).max()), 1.0
            if slope[i] <= tolerance:
                open_.discard(i)
                continue
            step[i] = -np.linalg.lstsq(curve, gradient, rcond=None)[0]
            if float(np.abs(step[i]).max()) <= 1e-15 * (1.0 + float(np.abs(at).max())):
                open_.discard(i)
                continue
            trial[i] = at + step[i]
    for i, (s, c) in enumerate(fits):
        out.weights.setdefault(s, {})[c] = here[i]
        out.gradient.setdefault(s, {})[c] = slope[i]
    return out
