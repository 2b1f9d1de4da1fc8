"""Evaluation tables from a long prediction table.

A prediction table has one row per scored row: any key columns (model, combination,
fold, ...), ``label`` (0/1), ``score`` and optionally a weight. It is first reduced to
one row per key and distinct score; every curve and metric is a running total over
those, exact with ties.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.order import running_totals

METRICS = ("accuracy", "precision", "recall", "f1", "auc_roc", "average_precision", "auc_prc")


def ratio(a: Column, b: Column) -> Column:
    """a / b as double; 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def score_counts(pred: DataFrame, keys: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """(keys..., score, pos, neg): equal scores combine before anything is ordered."""
    w = F.col(weight) if weight else F.lit(1)
    return (
        pred.where(F.col("score").isNotNull() & F.col("label").isNotNull())
        .groupBy(*keys, F.col("score").cast("double").alias("score"))
        .agg(
            F.sum(F.when(F.col("label") == 1, w).otherwise(0)).cast("bigint").alias("pos"),
            F.sum(F.when(F.col("label") == 1, 0).otherwise(w)).cast("bigint").alias("neg"),
        )
    )


def unscored(pred: DataFrame, keys: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """(keys..., rows, no_score, no_label): how many rows metrics leave out, as those lack a score or a label."""
    w = F.col(weight) if weight else F.lit(1)
    total = lambda c: F.coalesce(F.sum(F.when(c, w)), F.lit(0)).cast("bigint")
    return pred.groupBy(*keys).agg(
        total(F.lit(True)).alias("rows"), total(F.col("score").isNull()).alias("no_score"), total(F.col("label").isNull()).alias("no_label")
    )


def score_curve(pred: DataFrame, keys: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """score_counts plus ``tp``/``fp`` at threshold = score and the totals ``p``/``n``."""
    keys = list(keys)
    out = running_totals(score_counts(pred, keys, weight), keys, ["score"], ["pos", "neg"], descending=["score"])
    return out.select(
        *keys,
        "score",
        "pos",
        "neg",
        F.col("cum_pos").alias("tp"),
        F.col("cum_neg").alias("fp"),
        F.col("total_pos").alias("p"),
        F.col("total_neg").alias("n"),
    )


def _key_rows(curve: DataFrame, keys: Sequence[str]) -> DataFrame:
    return curve.select(*keys).distinct() if keys else curve.sparkSession.range(1).select()


def roc_curve(pred: DataFrame, keys: Sequence[str] = (), curve: DataFrame | None = None) -> DataFrame:
    """(keys..., fpr, tpr, threshold), from the origin through every distinct score."""
    keys = list(keys)
    curve = score_curve(pred, keys) if curve is None else curve
    points = curve.select(
        *keys,
        ratio(F.col("fp"), F.col("n")).alias("fpr"),
        ratio(F.col("tp"), F.col("p")).alias("tpr"),
        F.col("score").alias("threshold"),
    )
    origin = _key_rows(curve, keys).select(
        *keys, F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(None).cast("double").alias("threshold")
    )
    return points.unionByName(origin)


def _pr_points(curve: DataFrame, keys: Sequence[str]) -> DataFrame:
    # points go down to the first threshold that reaches all positives
    reached = (F.col("tp") - F.col("pos")) < F.col("p")
    return curve.where(reached).select(
        *keys,
        ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        ratio(F.col("tp"), F.col("p")).alias("recall"),
        F.col("score").alias("threshold"),
        ratio(F.col("tp") + F.col("fp"), F.col("p") + F.col("n")).alias("population"),
    )


def pr_curve(pred: DataFrame, keys: Sequence[str] = (), curve: DataFrame | None = None) -> DataFrame:
    """(keys..., precision, recall, threshold) and the end point (1, 0)."""
    keys = list(keys)
    curve = score_curve(pred, keys) if curve is None else curve
    end = _key_rows(curve, keys).select(
        *keys, F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"), F.lit(None).cast("double").alias("threshold")
    )
    return _pr_points(curve, keys).drop("population").unionByName(end)


def pr_population_curve(pred: DataFrame, keys: Sequence[str] = (), curve: DataFrame | None = None) -> DataFrame:
    """(keys..., population, precision, recall): by share of rows at or above the threshold."""
    keys = list(keys)
    curve = score_curve(pred, keys) if curve is None else curve
    return _pr_points(curve, keys).drop("threshold")


def pr_threshold_curve(pred: DataFrame, keys: Sequence[str] = (), curve: DataFrame | None = None) -> DataFrame:
    """(keys..., threshold, precision, recall)."""
    keys = list(keys)
    curve = score_curve(pred, keys) if curve is None else curve
    return _pr_points(curve, keys).drop("population")


def _area_aggregates() -> list[Column]:
    pos, neg, tp, fp, p, n = (F.col(c).cast("double") for c in ("pos", "neg", "tp", "fp", "p", "n"))
    # pairs (positive, negative) ranked right, ties counting half
    auc = F.sum(neg * (tp - pos / 2)) / F.first(p * n)
    step = F.sum(pos * tp / (tp + fp)) / F.first(p)
    before = tp - pos + fp - neg
    precision_before = F.when(before > 0, (tp - pos) / before).otherwise(1.0)
    trapezoid = F.sum(pos * (tp / (tp + fp) + precision_before) / 2) / F.first(p)
    return [auc.alias("auc_roc"), step.alias("average_precision"), trapezoid.alias("auc_prc")]


def _safe(curve: DataFrame) -> DataFrame:
    # a key with one class only has no area
    return curve.withColumns(
        {c: F.when(F.col(c) > 0, F.col(c)) for c in ("p", "n")}
    )


def areas(pred: DataFrame, keys: Sequence[str] = (), curve: DataFrame | None = None) -> DataFrame:
    """(keys..., auc_roc, average_precision, auc_prc).

    ``average_precision`` is the step sum, ``auc_prc`` the trapezoid area.
    """
    keys = list(keys)
    curve = score_curve(pred, keys) if curve is None else curve
    return _safe(curve).groupBy(*keys).agg(*_area_aggregates())


def auc_roc_hard(pred: DataFrame, threshold: float, keys: Sequence[str] = ()) -> DataFrame:
    """ROC area of the 0/1 predictions at a threshold."""
    cells = _cells(score_counts(pred, keys), [threshold], keys)
    tpr, fpr = ratio(F.col("tp"), F.col("tp") + F.col("fn")), ratio(F.col("fp"), F.col("fp") + F.col("tn"))
    return cells.select(*keys, "threshold", ((F.lit(1.0) + tpr - fpr) / 2).alias("auc_roc_hard"))


def _cell_array(thresholds: Sequence[float]) -> Column:
    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))  # an empty table has zero cells

    def cell(t: float) -> Column:
        hit = F.col("score") >= F.lit(float(t))
        return F.struct(
            F.lit(float(t)).alias("threshold"),
            total(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
            total(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"),
            total(F.when(hit, 0).otherwise(F.col("pos"))).alias("fn"),
            total(F.when(hit, 0).otherwise(F.col("neg"))).alias("tn"),
        )

    return F.array(*[cell(t) for t in thresholds])


def _cells(counts: DataFrame, thresholds: Sequence[float], keys: Sequence[str], *more: Column) -> DataFrame:
    """(keys..., threshold, tp, fp, fn, tn): all thresholds in one aggregation."""
    agg = counts.groupBy(*keys).agg(_cell_array(thresholds).alias("cells"), *more)
    rest = [c for c in agg.columns if c not in ("cells", *keys)]
    return agg.select(*keys, F.explode("cells").alias("c"), *rest).select(*keys, "c.*", *rest)


def _hard_metrics() -> list[Column]:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return [
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    ]


def evaluate(
    pred: DataFrame,
    thresholds: Sequence[float],
    keys: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """All metrics for every key and threshold from one pass over the predictions.

    Rows without a score or a label take no part; ``unscored`` counts them.
    """
    keys = list(keys)
    curve = _safe(score_curve(pred, keys, weight))
    cells = _cells(curve, thresholds, keys, *_area_aggregates())
    return cells.select(
        *keys,
        "threshold",
        *_hard_metrics(),
        "auc_roc",
        "average_precision",
        "auc_prc",
        "tp",
        "fp",
        "fn",
        "tn",
    )


def threshold_metrics(
    pred: DataFrame, thresholds: Sequence[float], keys: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Confusion cells, accuracy, precision, recall and F1 only: needs no order at all."""
    cells = _cells(score_counts(pred, keys, weight), thresholds, keys)
    return cells.select(*keys, "threshold", *_hard_metrics(), "tp", "fp", "fn", "tn")


def confusion_matrix(pred: DataFrame, threshold: float, keys: Sequence[str] = ()) -> DataFrame:
    """(keys..., truth, pred, count) with all four cells."""
    cells = _cells(score_counts(pred, keys), [threshold], keys)
    rows = F.array(
        *[
            F.struct(F.lit(t).alias("truth"), F.lit(p).alias("pred"), F.col(c).alias("count"))
            for t, p, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
        ]
    )
    return cells.select(*keys, F.explode(rows).alias("r")).select(*keys, "r.*")


def classification_report(pred: DataFrame, threshold: float, keys: Sequence[str] = ()) -> DataFrame:
    """(keys..., class, precision, recall, f1, support) per class and the support-weighted mean."""
    cells = _cells(score_counts(pred, keys), [threshold], keys)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def row(name: str, hit: Column, false_hit: Column, miss: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            ratio(hit, hit + false_hit).alias("precision"),
            ratio(hit, hit + miss).alias("recall"),
            ratio(2 * hit, 2 * hit + false_hit + miss).alias("f1"),
            (hit + miss).alias("support"),
        )

    both = cells.select(*keys, row("0", tn, fn, fp).alias("a"), row("1", tp, fp, fn).alias("b"))
    total = F.col("a.support") + F.col("b.support")
    mean = F.struct(
        F.lit("avg").alias("class"),
        *[
            ratio(
                F.col(f"a.{m}") * F.col("a.support") + F.col(f"b.{m}") * F.col("b.support"), total
            ).alias(m)
            for m in ("precision", "recall", "f1")
        ],
        total.alias("support"),
    )
    return both.select(*keys, F.explode(F.array("a", "b", mean)).alias("r")).select(*keys, "r.*")


def baseline_accuracy(df: DataFrame, label: str = "label") -> DataFrame:
    """Accuracy of always saying 0."""
    return df.agg((F.lit(1.0) - F.avg(F.col(label).cast("double"))).alias("accuracy"))


def with_baseline(results: DataFrame, df: DataFrame, label: str = "label", model: str = "model") -> DataFrame:
    """Result table plus the majority baseline; its other metrics are 0."""
    base = baseline_accuracy(df, label).withColumn(model, F.lit("baseline"))
    for f in results.schema.fields:
        if f.name not in base.columns:
            base = base.withColumn(f.name, F.lit(0).cast(f.dataType))
    return results.unionByName(base.select(*results.columns))


def metrics_table(
    pred: DataFrame, thresholds: dict[str, float], model: str = "model", weight: str | None = None
) -> DataFrame:
    """One row per model, each at its own threshold."""
    wide = evaluate(pred, sorted(set(thresholds.values())), [model], weight)
    wanted = None
    for name, t in thresholds.items():
        one = (F.col(model) == F.lit(name)) & (F.col("threshold") == F.lit(float(t)))
        wanted = one if wanted is None else wanted | one
    return wide.where(wanted)


def false_negatives(pred: DataFrame, threshold: float) -> DataFrame:
    """``missed`` = 1 for positives the model leaves below the threshold."""
    miss = (F.col("label") == 1) & ~(F.col("score") >= F.lit(float(threshold)))
    return pred.withColumn("missed", F.coalesce(miss, F.lit(False)).cast("int"))


def weighted_fold_mean(
    metrics: DataFrame, sizes: DataFrame, group: Sequence[str], fold: str, names: Sequence[str]
) -> DataFrame:
    """Mean over the replicates of a fold, then over folds by their share of train rows.

    ``sizes`` holds (fold, train_rows), one row per fold.
    """
    per_fold = metrics.groupBy(*group, fold).agg(*[F.avg(m).alias(m) for m in names])
    weighted = per_fold.join(F.broadcast(sizes), fold)
    total = sizes.agg(F.sum("train_rows")).first()[0]
    return weighted.groupBy(*group).agg(
        *[F.sum(F.col(m) * F.col("train_rows") / F.lit(float(total))).alias(m) for m in names]
    )
