"""Gradient boosting on packed blocks against Spark ML's."""

import random

import numpy as np
import pytest
from riskloom.plans import models as M
from riskloom.plans.gradient import GradientBoost


def frame(spark, n, seed=0, weights=(1.0,)):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        x = [rnd.gauss(0, 1), rnd.gauss(3, 10), float(rnd.randrange(2)), 0.0, float(rnd.choice([0, 0, 0, 1, 2]))]
        y = int(x[0] + x[1] / 10 + x[4] * x[2] + rnd.gauss(0, 1) > 0.9)
        rows.append((i, y, rnd.choice(weights), x))
    wide = spark.createDataFrame([(i, y, w, *x) for i, y, w, x in rows], "row_id long, label int, w double, a double, b double, c double, d double, e double")
    return M.placed(M.assemble(wide, list("abcde"), weight="w")), list("abcde")


@pytest.mark.parametrize(("n", "weights", "depth", "rounds"), [(700, (1.0,), 3, 14), (700, (1.0, 2.0, 3.0), 2, 5), (24_000, (1.0,), 3, 3), (12, (1.0,), 3, 2)])
def test_the_same_scores_as_spark_ml(spark, n, weights, depth, rounds):
    data, features = frame(spark, n, n, weights)
    params = {"n_estimators": rounds, "learning_rate": 0.3, "max_depth": depth}
    made = M.fit("gbt", data, params, features, seed=3)
    # Spark ML's model walks its rows five times a tree
    assert isinstance(made, GradientBoost) and len(made.trees) == rounds
    theirs = M.Fitted("gbt", M.estimator("gbt", params, n, 3).fit(data), features)
    a = {r["row_id"]: (r["score"], r["pred"]) for r in made.scores(data).collect()}
    b = {r["row_id"]: (r["score"], r["pred"]) for r in theirs.scores(data).collect()}
    assert a.keys() == b.keys()
    assert max(abs(a[i][0] - b[i][0]) for i in a) < 1e-9
    assert all(a[i][1] == b[i][1] for i in a)
    if n > 100:  # columns that divide few rows alike tie
        _alike(made, theirs, features)


def _alike(made, theirs, features):
    ours, spark_ml = dict(made.importances()), dict(theirs.importances())
    assert np.allclose([ours[f] for f in features], [spark_ml[f] for f in features], atol=1e-6)


def test_one_class_and_odd_rows(spark):
    data, features = frame(spark, 40)
    ones = data.where("label = 1")
    made = M.fit("gbt", ones, {"n_estimators": 2}, features, seed=1)
    theirs = M.Fitted("gbt", M.estimator("gbt", {"n_estimators": 2}, 1, 1).fit(ones), features)
    assert np.allclose([r["score"] for r in made.scores(ones).collect()], [r["score"] for r in theirs.scores(ones).collect()])
    # too deep for the sums of one task: Spark ML's
    deep = M.fit("gbt", data, {"n_estimators": 1, "max_depth": 9}, features, seed=1)
    assert isinstance(deep, M.Fitted)


def test_values_next_to_each_other(spark):
    # three neighbouring numbers give one place twice
    values = [0.06]
    for _ in range(4):
        values.append(float(np.nextafter(values[-1], 1)))
    rnd = random.Random(5)
    rows = [(i, v := rnd.randrange(5), rnd.gauss(0, 1)) for i in range(600)]
    wide = spark.createDataFrame([(i, int(v + z > 2.2), values[v], z) for i, v, z in rows], "row_id long, label int, a double, b double")
    data = M.placed(M.assemble(wide, ["a", "b"]))
    made = M.fit("gbt", data, {"n_estimators": 4}, ["a", "b"], seed=1)
    theirs = M.Fitted("gbt", M.estimator("gbt", {"n_estimators": 4}, 1, 1).fit(data), ["a", "b"])
    a, b = ({r["row_id"]: r["score"] for r in m.scores(data).collect()} for m in (made, theirs))
    assert max(abs(a[i] - b[i]) for i in a) < 1e-9
