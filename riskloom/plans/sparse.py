"""Logistic regression on a few plain columns and one very wide one-hot vector, solved exactly by Newton steps.

A row sets at most one place of the vector, so the Hessian is an arrow: the places do not meet each other,
only the plain columns. Eliminating them leaves a system as small as the plain columns, which the driver solves;
every place then follows from its own sums. Rows and coefficients are partitioned by the place alike, once, so
a step joins and sums without a shuffle, and no task and no driver holds a vector as long as the categories.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.relational import salt_parts
from riskloom.session import checkpoint

# Rows that set no place are dealt over so many pretended ones, whose value is 0.
NO_PLACE = 4096
# What a step may still gain (in the summed loss) when it is the last one; it is taken, too.
GAIN = 1e-9
HALVINGS = 30


def wide_column(df: DataFrame, features: Sequence[str]) -> str | None:
    """The one vector among plain features, if there is just one."""
    found = [f for f in features if isinstance(df.schema[f].dataType, VectorUDT)]
    return found[0] if len(found) == 1 else None


def one_place(df: DataFrame, wide: str) -> bool:
    """Whether all vectors are sparse and set one place at most."""
    v = F.unwrap_udt(wide)
    many = F.coalesce((v["type"] != 0) | (F.size(v["indices"]) > 1), F.lit(True))
    return not df.where(many).limit(1).count()


def _plain(name: str) -> Column:
    x = F.col(f"`{name}`").cast("double")
    return F.when(x.isNull() | F.isnan(x), F.raise_error(F.lit(f"{name} is null or NaN")).cast("double")).otherwise(x)


def _slim(df: DataFrame, plain: Sequence[str], wide: str) -> DataFrame:
    """(row_id, label, w, x0.., at, v): at is the place a row sets, v its value."""
    at, v = F.get(F.unwrap_udt(wide)["indices"], F.lit(0)), F.get(F.unwrap_udt(wide)["values"], F.lit(0))
    none = (-1 - F.pmod(F.xxhash64("row_id"), F.lit(NO_PLACE))).cast("int")
    xs = [_plain(c).alias(f"x{i}") for i, c in enumerate(plain)]
    return df.select("row_id", F.col("label").cast("double").alias("label"), F.lit(1.0).alias("w"), *xs, F.coalesce(at, none).alias("at"), F.coalesce(v, F.lit(0.0)).alias("v"))


def _dot(beta: Sequence[float], xs: Sequence[Column]) -> Column:
    return sum((F.lit(float(b)) * x for b, x in zip(beta, xs)), F.lit(0.0))


@dataclass
class SparseLogistic:
    """Coefficients of the plain columns, and a table (at, b) of those of the places."""

    plain: list[str]
    wide: str
    intercept: float
    beta: list[float]
    places: DataFrame | None

    def scores(self, test: DataFrame) -> DataFrame:
        """(row_id, label, w, score, pred); a place that was not fitted weighs nothing."""
        rows = _slim(test, self.plain, self.wide)
        xs = [F.col(f"x{i}") for i in range(len(self.plain))]
        rows = rows.join(self.places, "at", "left") if self.places is not None else rows.withColumn("b", F.lit(0.0))
        z = F.lit(float(self.intercept)) + _dot(self.beta, xs) + F.coalesce("b", F.lit(0.0)) * F.col("v")
        out = rows.select("row_id", "label", "w", (1.0 / (1.0 + F.exp(-z))).alias("score"))
        return out.withColumn("pred", (F.col("score") > 0.5).cast("int"))


def _sums(rows: DataFrame, state: DataFrame, beta: np.ndarray, design: Sequence[Column], penalty: float) -> DataFrame:
    """Per place: its coefficient, gradient g, curvature h and cross terms c, and its rows' share of the plain columns' sums."""
    z = _dot(beta, design) + F.col("b") * F.col("v")
    p = 1.0 / (1.0 + F.exp(-z))
    met = rows.join(state, "at").withColumns({"r": F.col("w") * (p - F.col("label")), "q": F.col("w") * p * (1.0 - p), "z": z})
    loss = F.col("w") * (F.greatest(F.col("z"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("z"))) - F.col("label") * F.col("z"))
    r, q, v = F.col("r"), F.col("q"), F.col("v")
    n = len(design)
    cells = {"_g": r * v, "_h": q * v * v, "_loss": loss, **{f"c{i}": q * v * x for i, x in enumerate(design)}, **{f"d{i}": r * x for i, x in enumerate(design)}}
    cells |= {f"m{i}_{j}": q * design[i] * design[j] for i in range(n) for j in range(i, n)}
    made = met.groupBy("at", "b").agg(*[F.sum(c).alias(k) for k, c in cells.items()])
    b = F.col("b")
    return made.withColumns({"g": F.col("_g") + penalty * b, "h": F.col("_h") + penalty, "loss": F.col("_loss") + penalty / 2 * b * b}).drop("_g", "_h", "_loss")


def _total(made: DataFrame, n: int) -> dict[str, Any]:
    cells = {"loss": F.sum("loss"), "own": F.sum(F.col("g") * F.col("g") / F.col("h"))}
    cells |= {f"d{i}": F.sum(f"d{i}") for i in range(n)} | {f"e{i}": F.sum(F.col(f"c{i}") * F.col("g") / F.col("h")) for i in range(n)}
    for i in range(n):
        for j in range(i, n):
            cells |= {f"m{i}_{j}": F.sum(f"m{i}_{j}"), f"s{i}_{j}": F.sum(F.col(f"c{i}") * F.col(f"c{j}") / F.col("h"))}
    return made.agg(*[c.alias(k) for k, c in cells.items()]).first().asDict()


def fit_sparse_logistic(train: DataFrame, features: Sequence[str], cost: float = 1.0, intercept: bool = True, steps: int = 100) -> SparseLogistic | None:
    """The minimum of the summed log loss plus squared coefficients over 2 ``cost`` (the intercept is free). None without rows."""
    wide = wide_column(train, features)
    plain = [f for f in features if f != wide]
    parts = salt_parts(train)
    rows = checkpoint(_slim(train, plain, wide).drop("row_id").repartition(parts, "at"))
    total, ones = rows.agg(F.sum("w"), F.sum(F.col("w") * F.col("label"))).first()
    if not total:
        return None
    if intercept and ones in (0.0, total):
        return SparseLogistic(plain, wide, math.inf if ones else -math.inf, [0.0] * len(plain), None)
    penalty = 1.0 / cost
    design = [F.lit(1.0)] * intercept + [F.col(f"x{i}") for i in range(len(plain))]
    n = len(design)
    ridge = np.diag([0.0] * intercept + [penalty] * len(plain))
    state = checkpoint(rows.groupBy("at").agg(F.lit(0.0).alias("b")))
    beta, move, share = np.zeros(n), np.zeros(n), 1.0
    made, least = None, math.inf

    def stepped(share: float) -> DataFrame:
        if made is None:
            return state
        return made.select("at", (F.col("b") - share * (F.col("g") + _dot(move, [F.col(f"c{i}") for i in range(n)])) / F.col("h")).alias("b"))

    halved = 0
    for _ in range(steps):
        tried = beta + share * move
        new = checkpoint(_sums(rows, stepped(share), tried, design, penalty))
        t = _total(new, n)
        loss = t["loss"] + tried @ ridge @ tried / 2
        if loss > least + 1e-12 * abs(least) and halved < HALVINGS:
            share, halved = share / 2, halved + 1
            continue
        made, beta, least, share, halved = new, tried, loss, 1.0, 0
        pairs = {(i, j): (t[f"m{i}_{j}"], t[f"s{i}_{j}"]) for i in range(n) for j in range(i, n)}
        both = lambda k: np.array([[pairs[min(i, j), max(i, j)][k] for j in range(n)] for i in range(n)]).reshape(n, n)
        left = both(0) + ridge - both(1)
        right = np.array([t[f"d{i}"] for i in range(n)]) + ridge @ beta - np.array([t[f"e{i}"] for i in range(n)])
        move = -np.linalg.lstsq(left, right, rcond=None)[0] if n else np.zeros(0)
        if t["own"] - right @ move <= GAIN:
            break
    places = checkpoint(stepped(1.0).where("at >= 0"))
    beta = (beta + move).tolist()
    return SparseLogistic(plain, wide, beta[0] if intercept else 0.0, beta[1:] if intercept else beta, places)
