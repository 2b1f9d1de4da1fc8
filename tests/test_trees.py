"""Exact trees against brute force: both ways of growing, ties, weights, depth without limit."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.plans import models as M
from riskloom.plans import trees as T


def score(criterion, l0, l1, r0, r1):
    if criterion == "gini":
        return (l0 * l0 + l1 * l1) / (l0 + l1) + (r0 * r0 + r1 * r1) / (r0 + r1)
    return sum(a * np.log2(a / n) for a, n in ((l0, l0 + l1), (l1, l0 + l1), (r0, r0 + r1), (r1, r0 + r1)) if a)


def brute(rows, depth=None, criterion="gini", node=""):
    """{node: (feature, threshold, n0, n1)} by trying every boundary."""
    n0 = sum(w for _, y, w in rows if y == 0)
    n1 = sum(w for _, y, w in rows if y == 1)
    best = None
    if n0 and n1 and (depth is None or len(node) < depth):
        for f in range(len(rows[0][0])):
            values = sorted({x[f] for x, _, _ in rows})
            for v, after in zip(values, values[1:]):
                left = [r for r in rows if r[0][f] <= v]
                l0, l1 = sum(w for _, y, w in left if y == 0), sum(w for _, y, w in left if y == 1)
                s = score(criterion, l0, l1, n0 - l0, n1 - l1)
                if best is None or s > best[0] + 1e-12:
                    best = (s, f, (v + after) / 2)
    out = {node: ((best[1], best[2]) if best else (None, None)) + (float(n0), float(n1))}
    if best:
        out |= brute([r for r in rows if r[0][best[1]] <= best[2]], depth, criterion, node + "L")
        out |= brute([r for r in rows if r[0][best[1]] > best[2]], depth, criterion, node + "R")
    return out


def sample(n=150, seed=1):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        x = [float(rnd.randrange(4)), rnd.choice([0.0, 1.0]), round(rnd.random(), 2), 7.0]
        rows.append((x, int(x[0] + x[2] + rnd.random() > 2.5), float(rnd.choice([1, 1, 2]))))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, y, w, x) for i, (x, y, w) in enumerate(rows)], "row_id long, label int, w double, features array<double>")


def table(trees):
    return {r.node: (r.feature, r.threshold, r.n0, r.n1) for r in trees.nodes.collect()}


NAMES = ["a", "b", "c", "d"]


@pytest.mark.parametrize("local,depth,criterion", [(0, 2, "gini"), (1000, None, "gini"), (40, 4, "entropy")])
def test_every_boundary_is_tried(spark, local, depth, criterion):
    rows = sample()
    got = table(T.grow(frame(spark, rows), NAMES, T.Growth(max_depth=depth, criterion=criterion, local_rows=local)))
    assert got == brute(rows, depth, criterion)


def test_without_a_limit_each_row_finds_its_label(spark):
    rows = [([float(i), float(i % 3)], (i * 7919 % 13) % 2, 1.0) for i in range(12)]
    grown = T.grow(frame(spark, rows), ["a", "b"], T.Growth(local_rows=0))
    assert table(grown) == brute(rows)
    data = frame(spark, rows)
    assert all(r.score == r.label == r.pred for r in grown.scores(data).collect())
    rules = {r.node: r for r in grown.rules().collect()}
    assert rules[""].feature in ("a", "b") and rules[""].depth == 0 and rules[""].n0 + rules[""].n1 == 12


def test_few_rows(spark):
    one = T.grow(frame(spark, [([1.0], 1, 1.0)]), ["a"], T.Growth(local_rows=0))
    assert table(one) == {"": (None, None, 0.0, 1.0)}
    same = T.grow(frame(spark, [([1.0], 1, 1.0), ([1.0], 0, 1.0)]), ["a"], T.Growth(local_rows=0))
    assert table(same) == {"": (None, None, 1.0, 1.0)}
    assert [r.score for r in same.scores(frame(spark, [([5.0], 1, 1.0)])).collect()] == [0.5]
    assert T.grow(frame(spark, []), ["a"]).nodes.count() == 0
    with pytest.raises(ValueError):
        T.Growth(criterion="mse")


@pytest.mark.parametrize("random_splits", [False, True])
def test_both_ways_of_growing_agree(spark, random_splits, monkeypatch):
    """Several trees with drawn rows and features: by passes, in one task, and scored in both ways."""
    rows = sample(60, 3)
    data = frame(spark, rows)
    rnd = random.Random(2)
    drawn = spark.createDataFrame([(i, {t: rnd.randrange(1, 3) for t in range(3) if rnd.random() < 0.7}) for i in range(60)], "row_id long, drawn map<int,int>")
    made = {}
    for local in (0, 1000):
        g = T.Growth(max_depth=3, max_features=2, seed=5, random=random_splits, local_rows=local)
        made[local] = T.grow(data, NAMES, g, drawn=drawn)
    sets = [sorted((r.tree, r.node, r.feature, r.threshold and round(r.threshold, 9), r.n0, r.n1) for r in m.nodes.collect()) for m in made.values()]
    assert str(sets[0]) == str(sets[1])
    assert {t for t, *_ in sets[0]} == {0, 1, 2}
    total = {r.feature: r.importance for r in made[0].importances().collect()}
    assert abs(sum(total.values()) - 1) < 1e-9 and total["d"] == 0 and max(total, key=total.get) in ("a", "c")
    quick = {r.row_id: r.score for r in made[0].scores(data).collect()}
    monkeypatch.setattr(T, "MOST_NODES", 0)
    slow = {r.row_id: r.score for r in made[0].scores(data).collect()}
    assert quick.keys() == slow.keys() and all(abs(quick[i] - slow[i]) < 1e-12 for i in quick)


def test_drawn_thresholds_lie_inside_their_node(spark):
    rows = sample(100, 8)
    grown = T.grow(frame(spark, rows), NAMES, T.Growth(random=True, seed=1, local_rows=0, max_depth=2), trees=4)
    nodes = {(r.tree, r.node): r for r in grown.nodes.collect()}
    for (t, node), r in nodes.items():
        if r.feature is not None:
            left, right = nodes[t, node + "L"], nodes[t, node + "R"]
            assert left.n0 + left.n1 > 0 and right.n0 + right.n1 > 0
            assert (left.n0 + right.n0, left.n1 + right.n1) == (r.n0, r.n1)
    assert len({nodes[t, ""].threshold for t in range(4)}) > 1
    again = T.grow(frame(spark, rows).repartition(7), NAMES, T.Growth(random=True, seed=1, local_rows=0, max_depth=2), trees=4)
    key = lambda t: sorted(map(str, ((r.tree, r.node, r.feature, r.threshold) for r in t.nodes.collect())))
    assert key(grown) == key(again)
    assert grown.nodes.select(F.max(F.length("node"))).first()[0] <= 2


def test_rows_are_written_once_and_the_driver_keeps_large_nodes_only(spark, monkeypatch):
    """Passes leave the rows where they are; nodes that one task finishes never come to the driver."""
    rows = [([float(i * 37 % 400), float(i % 3)], i * 7919 % 13 % 2, 1.0) for i in range(400)]
    data, written, keep = frame(spark, rows), [], T.cut
    monkeypatch.setattr(T, "cut", lambda df: written.append(1) or keep(df))
    grown = T.grow(data, ["a", "b"], T.Growth(local_rows=60))
    assert len(written) == 2
    assert table(grown) == brute(rows)
    large = sum(r.n0 + r.n1 > 60 for r in grown.nodes.collect())
    assert len(grown.top.tree) <= 2 * large + 1 < grown.nodes.count() / 3


@pytest.mark.parametrize("bins", [2, 3, 1024])
def test_bins_bracket_and_do_not_cut(spark, monkeypatch, bins):
    """Whatever the edges, the split is the best of all boundaries."""
    monkeypatch.setattr(T, "BINS", bins)
    rows = sample(300, 4)
    got = table(T.grow(frame(spark, rows), NAMES, T.Growth(max_depth=2, criterion="entropy" if bins == 3 else "gini", local_rows=0)))
    assert got == brute(rows, 2, "entropy" if bins == 3 else "gini")


@pytest.mark.parametrize("kind,params", [("forest", {"n_estimators": 3, "max_depth": None}), ("bagging", {"n_estimators": 3, "max_features": 0.5, "base_estimator": ("tree", {"max_depth": None})})])
def test_forests_without_a_limit_of_depth_are_not_held_by_the_driver(spark, monkeypatch, kind, params):
    """Grown here, subtrees in a table; a bagged tree uses its own half of the features."""
    monkeypatch.setattr(T.Growth, "__init__", _small_nodes(T.Growth.__init__))
    rows = sample(200, 6)
    model = M.fit(kind, frame(spark, rows), params, NAMES, seed=3)
    assert isinstance(model, T.Trees)
    used = {}
    for r in model.nodes.where("feature is not null").collect():
        used.setdefault(r.tree, set()).add(r.feature)
    assert set(used) == {0, 1, 2} and (kind == "forest" or all(len(f) <= 2 for f in used.values()))
    scored = model.scores(frame(spark, rows)).collect()
    assert len(scored) == 200 and all(0 <= r.score <= 1 for r in scored)


def _small_nodes(made):
    def init(self, *args, **named):
        made(self, *args, **{**named, "local_rows": 30})

    return init
