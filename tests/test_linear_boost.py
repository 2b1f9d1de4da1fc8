"""Batched Newton fits and real-valued boosting against plain numpy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.plans import models as M
from riskloom.plans.boost import LEAST, fit_real_boost
from riskloom.plans.newton import fit_linear

COSTS = [0.01, 1.0, 100.0]


def sample(n=400, seed=0, noise=1.0):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        x = [rnd.gauss(0, 1), rnd.gauss(3, 10), float(rnd.randrange(2)), 0.0]
        y = int(x[0] + x[1] / 10 + noise * rnd.gauss(0, 1) > 0.4)
        rows.append((i, i % 3, y, float(rnd.choice([1, 1, 2])), x))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "row_id long, part int, label int, w double, features array<double>")


def gradient(loss, rows, cost, beta, free=False):
    x = np.array([[*r[4], 1.0] for r in rows])
    y, w = np.array([2 * r[2] - 1 for r in rows]), np.array([r[3] for r in rows])
    m = y * (x @ beta)
    slope = -1 / (1 + np.exp(m)) if loss == "logistic" else -2 * np.maximum(0, 1 - m)
    penalty = np.ones(len(beta))
    penalty[-1] = 0 if free else 1
    return penalty * beta + cost * x.T @ (w * slope * y)


@pytest.mark.parametrize("loss", ["logistic", "squared_hinge"])
def test_all_fits_share_each_pass(spark, loss):
    rows = sample()
    names = list("abcd")
    found = fit_linear(frame(spark, rows), names, COSTS, loss, ["part"])
    assert sorted(found.weights) == [(0,), (1,), (2,)]
    alone = 0
    for part in range(3):
        mine = [r for r in rows if r[1] == part]
        for cost in COSTS:
            beta = found.weights[part,][cost]
            assert np.abs(gradient(loss, mine, cost, beta)).max() < 1e-6
            assert abs(beta[3]) < 1e-12
        single = fit_linear(frame(spark, mine), names, [1.0], loss)
        assert np.allclose(single.weights[()][1.0], found.weights[part,][1.0], atol=1e-8)
        alone = max(alone, single.passes)
    # as many passes as the slowest fit, not as many as all fits
    assert alone <= found.passes <= 25
    table = found.table(spark)
    assert table.count() == 9 * 5 and table.where("feature = 'intercept'").count() == 9
    scored = found.scores(frame(spark, rows), ["row_id", "label"])
    assert scored.count() == len(rows) * 3
    for r in scored.where("row_id < 6").collect():
        margin = float(np.array([*rows[r.row_id][4], 1.0]) @ found.weights[r.part,][r.cost])
        want = 1 / (1 + math.exp(-margin)) if loss == "logistic" else margin
        assert abs(r.score - want) < 1e-9 and r.pred == int(margin > 0)


def test_intercept_free_or_absent(spark):
    rows = sample(200, 4)
    free = fit_linear(frame(spark, rows), list("abcd"), [0.1], penalise_intercept=False)
    assert np.abs(gradient("logistic", rows, 0.1, free.weights[()][0.1], True)).max() < 1e-6
    bare = fit_linear(frame(spark, rows), list("abcd"), [0.1], intercept=False)
    assert len(bare.weights[()][0.1]) == 4


def test_linear_edges(spark):
    apart = fit_linear(frame(spark, sample(100, 1, 0.0)), list("abcd"), [1000.0], "squared_hinge")
    assert apart.gradient[()][1000.0] < 1e-3
    one_class = [(i, 0, 1, 1.0, [float(i), 0.0, 0.0, 0.0]) for i in range(5)]
    assert all(r.pred == 1 for r in fit_linear(frame(spark, one_class), list("abcd"), [1.0]).scores(frame(spark, one_class)).collect())
    empty = fit_linear(frame(spark, []), list("abcd"), [1.0])
    assert not empty.weights[()][1.0].any()
    for bad in ({"loss": "hinge"}, {"costs": [0.0]}, {"costs": []}):
        with pytest.raises(ValueError):
            fit_linear(frame(spark, sample(5)), list("abcd"), **{"costs": [1.0], **bad})


def test_linear_kinds_of_models(spark):
    rows = frame(spark, sample(150, 2))
    for kind in ("linear_logistic", "linear_squared_hinge"):
        out = M.fit(kind, rows, {"C": 1.0}, list("abcd")).scores(rows)
        assert out.columns == ["row_id", "part", "label", "w", "score", "pred"]
        assert out.where(F.col("pred") == F.col("label")).count() > 90


def brute_boost(rows, rounds, rate):
    x, y, w = np.array([r[4] for r in rows]), np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
    votes, total = [], np.zeros(len(rows))
    for _ in range(rounds):
        best = None
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for v, after in zip(values, values[1:]):
                left = x[:, f] <= v
                a, b, c, d = (w[m & (y == k)].sum() for m in (left, ~left) for k in (0, 1))
                s = (a * a + b * b) / (a + b) + (c * c + d * d) / (c + d)
                if best is None or s > best[0] + 1e-9:
                    best = (s, f, (v + after) / 2, a, b, c, d)
        _, f, t, a, b, c, d = best
        odds = [math.log(max(q / (p + q), LEAST)) - math.log(max(p / (p + q), LEAST)) for p, q in ((a, b), (c, d))]
        vote = np.where(x[:, f] <= t, odds[0], odds[1])
        votes.append((f, t))
        total += vote
        w = w * np.exp(-rate / 2 * (2 * y - 1) * vote)
        w /= w.sum()
    return votes, 1 / (1 + np.exp(-total / rounds))


def test_real_boosting(spark):
    rows = [(i, p, y, w, [round(v, 1) for v in x]) for i, p, y, w, x in sample(120, 6)]
    model = fit_real_boost(frame(spark, rows), 4, 0.5)
    votes, scores = brute_boost(rows, 4, 0.5)
    assert [(s.feature, pytest.approx(s.threshold)) for s in model.stumps] == votes
    got = {r.row_id: r.score for r in model.scores(frame(spark, rows)).collect()}
    assert np.allclose([got[i] for i in range(len(rows))], scores, atol=1e-9)


def test_boosting_ends_early(spark):
    clean = [(i, 0, int(i >= 10), 1.0, [float(i)]) for i in range(20)]
    model = fit_real_boost(frame(spark, clean), 50)
    assert len(model.stumps) == 1 and all(r.pred == r.label for r in model.scores(frame(spark, clean)).collect())
    one = [(i, 0, 1, 1.0, [float(i)]) for i in range(3)]
    assert all(r.score > 0.99 for r in fit_real_boost(frame(spark, one)).scores(frame(spark, one)).collect())
    flat = [(i, 0, i % 2, 1.0, [1.0]) for i in range(4)]
    assert all(r.score == 0.5 for r in fit_real_boost(frame(spark, flat)).scores(frame(spark, flat)).collect())
    assert fit_real_boost(frame(spark, [])).stumps == []
