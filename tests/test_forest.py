"""Forests at size: what the driver is sent, how draws travel, what a task finishes."""

import random

import numpy as np
from pyspark.sql import functions as F

from riskloom.operators import split as SP
from riskloom.plans import trees as T

NAMES = ["a", "b", "c"]


def frame(spark, n=300):
    rnd = random.Random(4)
    rows = [(i, [rnd.random(), float(rnd.randrange(3)), round(rnd.random(), 1)]) for i in range(n)]
    return spark.createDataFrame([(i, int(x[0] + x[1] / 3 + rnd.random() > 1.2), 1.0, x) for i, x in rows], "row_id long, label int, w double, features array<double>")


def test_no_row_objects_of_sums_or_subtrees_come_to_the_driver(spark, monkeypatch):
    """Sums, samples and subtrees arrive as columns; only a row per node or tree is an object."""
    data = frame(spark)
    kind, sizes = type(data), []
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: sizes.append(collect(self)) or sizes[-1])
    passes = T.grow(data, NAMES, T.Growth(max_depth=3, local_rows=0, max_features=2, seed=1), trees=2)
    local = T.grow(data, NAMES, T.Growth(max_depth=3, max_features=2, seed=1), trees=2)
    got = passes.scores(data), local.scores(data)
    assert max(map(len, sizes)) <= 8 and not any("feature" in r.asDict() and isinstance(r["feature"], list) for rows in sizes for r in rows)
    one, two = ({r.row_id: r.score for r in collect(g)} for g in got)
    assert one == two and len(one) == 300


def test_maps_of_draws_are_the_draws_of_groups(spark, monkeypatch):
    """The same draws, sent as one number each and counted where their position is."""
    monkeypatch.setattr(SP, "DRAWS", 100)
    ids = spark.range(200).select((F.col("id") * 7).alias("row_id"))
    groups = SP.bootstrap_groups(ids.select(F.lit("bag").alias("grp"), "row_id"), ["grp"], "row_id", 0.8, 5, 3)
    want = {}
    for r in groups.collect():
        want.setdefault(r["row_id"], {})[r["replicate"]] = r["mult"]
    made = SP.bootstrap_maps(ids, "row_id", 0.8, 5, 3, "bag")
    assert {r["row_id"]: r["drawn"] for r in made.collect()} == want
    assert SP.bootstrap_maps(ids.limit(0), "row_id", 0.8, 5, 3).count() == 0
    assert dict(made.dtypes)["drawn"] == "map<int,bigint>"


def test_a_task_finishes_what_it_can_hold():
    assert T.Growth().rows_of_a_task(20) == 200_000 and T.Growth().rows_of_a_task(500) == T.LOCAL_ROWS
    assert T.Growth(local_rows=0).rows_of_a_task(20) == 0


def test_values_of_a_node_that_are_no_numbers(spark):
    """A feature with one of them is not split where it is; the others are, as by plain search."""
    rnd = np.random.default_rng(1)
    x = [rnd.integers(0, 12, 60).astype(float), rnd.integers(0, 2, 60).astype(float)]
    y = (x[0] + 3 * x[1] > 7).astype(float)
    x[0][5] = np.nan
    made = T._subtree(T.Growth(max_depth=1), 0, "", x, 1 - y, y)
    assert made["feature"] == [1, None, None] and made["threshold"][0] == 0.5
    left = x[1] <= 0.5
    assert made["n1"] == [y.sum(), y[left].sum(), y[~left].sum()] and made["kid"] == [1, -1, -1]
