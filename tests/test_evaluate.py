"""Metrics and curves against hand-computed values and identities."""

import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators import evaluate as E


def preds(spark, rows, extra=""):
    return spark.createDataFrame(rows, "label int, score double" + extra)


def test_no_predicted_positives(spark):
    row = E.evaluate(preds(spark, [(1, 0.1), (0, 0.2)]), [0.5]).first()
    assert (row["precision"], row["recall"], row["f1"], row["accuracy"]) == (0, 0, 0, 0.5)


def test_tied_scores_have_half_area(spark):
    assert E.areas(preds(spark, [(1, 0.3), (0, 0.3), (1, 0.3)])).first()["auc_roc"] == 0.5


def test_one_class_has_no_area_but_has_cells(spark):
    row = E.evaluate(preds(spark, [(0, 0.3), (0, 0.6)]), [0.5]).first()
    assert row["auc_roc"] is None and (row["fp"], row["tn"], row["accuracy"]) == (1, 1, 0.5)


def test_confusion_keeps_empty_cells(spark):
    cells = {(r["truth"], r["pred"]): r["count"] for r in E.confusion_matrix(preds(spark, [(1, 0.9), (0, 0.1)]), 0.5).collect()}
    assert cells == {(0, 0): 1, (0, 1): 0, (1, 0): 0, (1, 1): 1}


def test_areas_by_hand(spark):
    row = E.areas(preds(spark, [(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1)])).first()
    assert row["auc_roc"] == 0.75
    assert row["average_precision"] == pytest.approx(0.5 * 1 + 0.5 * 2 / 3)
    # points (0,1) (.5,1) (.5,.5) (1,2/3)
    assert row["auc_prc"] == pytest.approx(0.5 + 0.5 * (0.5 + 2 / 3) / 2)


def test_pr_curve_stops_at_full_recall_and_ends_at_zero(spark):
    pts = E.pr_curve(preds(spark, [(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1)])).collect()
    assert sorted((round(p["precision"], 6), p["recall"]) for p in pts) == [(0.5, 0.5), (0.666667, 1.0), (1.0, 0.0), (1.0, 0.5)]
    pop = E.pr_population_curve(preds(spark, [(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1)])).collect()
    assert sorted(p["population"] for p in pop) == [0.25, 0.5, 0.75]


def test_roc_starts_at_origin(spark):
    pts = sorted((p["fpr"], p["tpr"]) for p in E.roc_curve(preds(spark, [(1, 0.9), (0, 0.1)])).collect())
    assert pts == [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0)]


def rank_area(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_area_equals_rank_formula_per_key_with_hot_scores(spark):
    rnd = random.Random(1)
    rows = [(rnd.randint(0, 1), 0.5 if rnd.random() < 1 / 3 else round(rnd.random(), 2), "ab"[i % 4 == 0]) for i in range(600)]
    got = {r["k"]: r["auc_roc"] for r in E.areas(preds(spark, rows, ", k string"), ["k"]).collect()}
    for k in "ab":
        assert got[k] == pytest.approx(rank_area([(y, s) for y, s, kk in rows if kk == k]))


def test_shifting_scores_keeps_the_area(spark):
    df = preds(spark, [(i % 2, (i * 37 % 101) / 8) for i in range(200)])
    a = E.areas(df).first()["auc_roc"]
    assert E.areas(df.withColumn("score", F.col("score") + 4)).first()["auc_roc"] == a


def test_weights_equal_copies(spark):
    rows = [(1, 0.9, 2), (0, 0.6, 3), (1, 0.4, 1), (0, 0.2, 4)]
    weighted = E.evaluate(preds(spark, rows, ", w int"), [0.5], weight="w").first()
    copied = E.evaluate(preds(spark, [(y, s) for y, s, w in rows for _ in range(w)]), [0.5]).first()
    assert weighted == copied


def test_baseline_row_and_table(spark):
    rows = [(1, 0.9, "m"), (0, 0.1, "m"), (0, 0.3, "m"), (1, 0.2, "n"), (0, 0.8, "n")]
    table = E.metrics_table(preds(spark, rows, ", model string"), {"m": 0.5, "n": 0.25})
    assert {r["model"]: (r["threshold"], r["accuracy"]) for r in table.collect()} == {"m": (0.5, 1.0), "n": (0.25, 0.0)}
    full = E.with_baseline(table, spark.createDataFrame([(0,), (0,), (1,), (0,)], "label int"))
    base = full.where("model = 'baseline'").first()
    assert (base["accuracy"], base["recall"]) == (0.75, 0)


def test_report_and_missed_positives(spark):
    df = preds(spark, [(1, 0.9), (1, 0.2), (0, 0.1)])
    report = {r["class"]: r for r in E.classification_report(df, 0.5).collect()}
    assert report["1"]["recall"] == 0.5 and report["0"]["precision"] == 0.5 and report["avg"]["support"] == 3
    assert E.false_negatives(df, 0.5).where("missed = 1").count() == 1


def test_only_per_partition_sums_meet_in_one_task(spark):
    rows = preds(spark, [(i % 2, i / 100) for i in range(100)])
    lines = E.score_curve(rows)._jdf.queryExecution().executedPlan().toString().splitlines()
    single = [i for i, text in enumerate(lines) if "SinglePartition" in text]
    assert all("keys=[_pid" in lines[i + 1] for i in single)
