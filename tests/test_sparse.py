"""Logistic regression with a category per row: the exact minimum, without vectors as long as the categories."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators.features import SparseOneHot
from riskloom.plans import models as M


def _rows(spark, n=600, names=40):
    rng = np.random.default_rng(3)
    x, c = rng.normal(size=n), rng.integers(0, names, n)
    y = (rng.random(n) < 1 / (1 + np.exp(-x - (c % 5 - 2)))).astype(int)
    # every 25th row has no category
    rows = [(i, int(y[i]), float(x[i]), None if i % 25 == 0 else f"k{c[i]}") for i in range(n)]
    return rows, spark.createDataFrame(rows, "row_id long, label int, x double, client string")


def _solved(rows, names, cost):
    a = np.array([[1.0, r[2], *[float(r[3] == k) for k in names]] for r in rows])
    y, ridge = np.array([r[1] for r in rows]), np.diag([0.0, *[1 / cost] * (1 + len(names))])
    beta = np.zeros(a.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-a @ beta))
        beta -= np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + ridge, a.T @ (p - y) + ridge @ beta)
    return 1 / (1 + np.exp(-a @ beta))


@pytest.mark.parametrize("cost", [1.0, 100.0])
def test_sparse_logistic_reaches_the_minimum(spark, cost):
    rows, df = _rows(spark)
    made = SparseOneHot(["client"], "row_id").fit(df).transform(df)
    got = {r["row_id"]: r for r in M.fit_predict("logistic", made, made, ["x", "one_hot"], {"C": cost}).collect()}
    want = _solved(rows, sorted({r[3] for r in rows if r[3]}), cost)
    assert len(got) == len(rows)
    assert max(abs(got[r[0]]["score"] - p) for r, p in zip(rows, want)) < 1e-8
    assert all(got[i]["pred"] == int(p > 0.5) for i, p in enumerate(want))


def test_sparse_logistic_of_one_class_says_that_class(spark):
    _, df = _rows(spark, 50)
    made = SparseOneHot(["client"], "row_id").fit(df).transform(df.withColumn("label", F.lit(1)))
    assert {(r["score"], r["pred"]) for r in M.fit_predict("logistic", made, made, ["x", "one_hot"]).collect()} == {(1.0, 1)}
