"""Parameter x fold x threshold searches.

The driver only loops over fits, each of which is a Spark job. What a fit predicts is
reduced to one row per distinct score and label and written to a table in the shared
folder; all candidates are then evaluated from that table in one aggregation.
"""

from __future__ import annotations

import json
import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators import evaluate as E
from riskloom.operators.clean import fit_median
from riskloom.operators.features import Standardize
from riskloom.operators.relational import rank_results, value_combinations
from riskloom.operators.split import bootstrap_time_cv, kfold_shuffled
from riskloom.plans import models as M
from riskloom.plans.newton import fit_linear
from riskloom.plans.recipe import FeatureRecipe, feature_columns
from riskloom.roles import quoted
from riskloom.session import cut, fresh_path

# Fits that run at the same time; each one is itself spread over the cluster.
PARALLEL_FITS = 4
KEYS = ["model", "comb", "fold", "replicate"]
_SCHEMA = "score double, label double, w double, model string, comb int, fold int, replicate int"


@dataclass(frozen=True)
class Candidate:
    model: str
    kind: str
    comb: int
    params: tuple[tuple[str, Any], ...]

    def name(self) -> str:
        return f"{self.model}_{json.dumps(dict(self.params), sort_keys=True)}"


@dataclass(frozen=True)
class Timing:
    """Seconds one candidate took on one split: run metadata, never compared."""

    model: str
    comb: int
    train: float
    test: float


def candidates(grids: Mapping[str, tuple[str, Mapping[str, Sequence[Any]]]]) -> list[Candidate]:
    """All parameter combinations of each model: ``{model: (kind, {param: values})}``."""
    return [
        Candidate(model, kind, i, tuple(combo.items()))
        for model, (kind, grid) in grids.items()
        for i, combo in enumerate(value_combinations(grid))
    ]


def candidate_table(spark, cands: Sequence[Candidate]) -> DataFrame:
    rows = [(c.model, c.comb, c.name(), {k: str(v) for k, v in c.params}) for c in cands]
    return spark.createDataFrame(rows, "model string, comb int, name string, params map<string,string>")


def _predict_all(
    path: str,
    cands: Sequence[Candidate],
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    fold: int,
    replicate: int,
    seed: int,
    parallel: int,
) -> list[Timing]:
    """Fit every candidate on one split and write its scores."""
    train, test = M.placed(train), cut(test)

    def one(c: Candidate) -> Timing:
        start = time.monotonic()
        model = M.fit(c.kind, train, dict(c.params), features, seed)
        fitted = time.monotonic()
        scores = model.scores(test).groupBy("score", "label").agg(F.sum("w").alias("w"))
        target = f"{path}/model={c.model}/comb={c.comb}/fold={fold}/replicate={replicate}"
        scores.write.mode("overwrite").parquet(target)
        return Timing(c.model, c.comb, fitted - start, time.monotonic() - fitted)

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return list(pool.map(one, cands))


def _describe(metrics: DataFrame, cands: Sequence[Candidate], timings: Sequence[Timing]) -> DataFrame:
    """Metrics plus each candidate's name, parameters and mean times over its splits."""
    spark = metrics.sparkSession
    schema = "model string, comb int, train_time double, test_time double"
    times = spark.createDataFrame([(t.model, t.comb, t.train, t.test) for t in timings], schema)
    mean = times.groupBy("model", "comb").agg(F.avg("train_time").alias("train_time"), F.avg("test_time").alias("test_time"))
    # one row per candidate
    known = candidate_table(spark, cands).join(F.broadcast(mean), ["model", "comb"])
    return metrics.join(F.broadcast(known), ["model", "comb"])


def _read(spark, path: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).option("basePath", path).parquet(path)


def grid_search(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    grids: Mapping[str, tuple[str, Mapping[str, Sequence[Any]]]],
    thresholds: Sequence[float],
    criterion: str = "f1",
    seed: int = 0,
    parallel: int = PARALLEL_FITS,
) -> DataFrame:
    """Every combination at every threshold on one split, best first."""
    spark = train.sparkSession
    cands = candidates(grids)
    path = fresh_path(spark, "grid")
    timings = _predict_all(
        path, cands, M.assemble(train, features), M.assemble(test, features), features, 0, 0, seed, parallel
    )
    metrics = E.evaluate(_read(spark, path), thresholds, ["model", "comb"], weight="w")
    return rank_results(_describe(metrics, cands, timings), criterion)


def _with_draws(df: DataFrame, draws: DataFrame, key: str, replicates: int) -> DataFrame:
    """Rows of ``df`` that were drawn, with all their draws: one join serves every split, which then reads its rows by a scan."""
    slot = (F.col("fold") * replicates + F.col("replicate")).alias("slot")
    mine = draws.groupBy(key).agg(F.collect_list(F.struct(slot, "role", "mult")).alias("_drawn"))
    return cut(df.join(mine, key))


def _drawn(wide: DataFrame, slot: int, role: str) -> DataFrame:
    """Rows of one split with ``mult``, how often each was drawn."""
    cells = F.filter("_drawn", lambda d: (d["slot"] == slot) & (d["role"] == role))
    return wide.withColumn("_drawn", F.explode(cells)).select(*[F.col(quoted(c)) for c in wide.columns if c != "_drawn"], "_drawn.mult")


def _copies(rows: DataFrame) -> DataFrame:
    """A row as often as it was drawn."""
    return rows.withColumn("mult", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("mult")))).drop("mult")


def bootstrap_grid_search(
    df: DataFrame,
    time_col: str,
    folds: Sequence[tuple[int, int]],
    recipe: FeatureRecipe,
    skip: Sequence[str],
    grids: Mapping[str, tuple[str, Mapping[str, Sequence[Any]]]],
    thresholds: Sequence[float],
    criterion: str = "f1",
    pct: float = 0.8,
    replicates: int = 3,
    seed: int = 0,
    parallel: int = PARALLEL_FITS,
) -> DataFrame:
    """Grid search over bootstrapped time folds, the recipe fitted per split on train rows.

    Metrics are averaged over the replicates of a fold, then over folds by train rows.
    """
    spark = df.sparkSession
    cands = candidates(grids)
    path = fresh_path(spark, "bootgrid")
    df = cut(df)
    timings: list[Timing] = []
    draws = cut(bootstrap_time_cv(df, time_col, folds, "row_id", pct, replicates, seed))
    wide = _with_draws(df, draws, "row_id", replicates)
    for fold in range(len(folds)):
        for rep in range(replicates):
            train, test = (_drawn(wide, fold * replicates + rep, role) for role in ("train", "test"))
            # statistics count a row as often as it was drawn; fits take that as a weight
            step = FeatureRecipe(**{**recipe.__dict__, "fills": None, "encoder": None})
            step.fit(_copies(train))
            train, test = step.transform(train), step.transform(test)
            features = feature_columns(train, ["row_id", "label", "mult", time_col, *skip])
            timings += _predict_all(
                path,
                cands,
                M.assemble(train, features, "mult"),
                M.assemble(test, features, "mult"),
                features,
                fold,
                rep,
                seed,
                parallel,
            )
    metrics = E.evaluate(_read(spark, path), thresholds, KEYS, weight="w")
    sizes = draws.where("role = 'train'").groupBy("fold").agg(F.sum("mult").alias("train_rows"))
    names = list(E.METRICS)
    mean = E.weighted_fold_mean(metrics, sizes, ["model", "comb", "threshold"], "fold", names)
    return rank_results(_describe(mean, cands, timings), criterion)


def linear_bootstrap_search(
    df: DataFrame,
    time_col: str,
    folds: Sequence[tuple[int, int]],
    recipe: FeatureRecipe,
    skip: Sequence[str],
    costs: Sequence[float],
    thresholds: Sequence[float],
    criterion: str = "f1",
    loss: str = "logistic",
    pct: float = 0.8,
    replicates: int = 3,
    seed: int = 0,
) -> DataFrame:
    """The search over bootstrapped time folds for penalised linear models, all fits made together.

    As ``bootstrap_grid_search``, but each pass over the rows serves every cost on every split. A
    column that a split lacks (a category it has not drawn) is zero there and gets no weight.
    """
    df = cut(df)
    draws = cut(bootstrap_time_cv(df, time_col, folds, "row_id", pct, replicates, seed))
    wide = _with_draws(df, draws, "row_id", replicates)
    frames = []
    for fold in range(len(folds)):
        for rep in range(replicates):
            train, test = (_drawn(wide, fold * replicates + rep, role) for role in ("train", "test"))
            step = FeatureRecipe(**{**recipe.__dict__, "fills": None, "encoder": None})
            step.fit(_copies(train))
            frames.append((fold, rep, step.transform(train), step.transform(test)))
    outside = ["row_id", "label", "mult", time_col, *skip]
    features = list(dict.fromkeys(c for _, _, train, _ in frames for c in feature_columns(train, outside)))

    def together(which: int) -> DataFrame:
        out = None
        for frame in frames:
            rows = frame[which].withColumns({c: F.lit(0.0) for c in features if c not in frame[which].columns})
            rows = rows.withColumns({"fold": F.lit(frame[0]), "replicate": F.lit(frame[1])})
            rows = M.assemble(rows, features, "mult", ["fold", "replicate"])
            out = rows if out is None else out.unionByName(rows)
        return out

    fits = fit_linear(together(2), features, costs, loss, ["fold", "replicate"])
    pred = fits.scores(together(3), ["row_id", "label", "w"])
    metrics = E.evaluate(cut(pred.groupBy("cost", "fold", "replicate", "score", "label").agg(F.sum("w").alias("w"))), thresholds, ["cost", "fold", "replicate"], weight="w")
    sizes = draws.where("role = 'train'").groupBy("fold").agg(F.sum("mult").alias("train_rows"))
    mean = E.weighted_fold_mean(metrics, sizes, ["cost", "threshold"], "fold", list(E.METRICS))
    return rank_results(mean, criterion, "cost")


def cross_predict(
    df: DataFrame,
    features: Sequence[str],
    kind: str,
    params: Mapping[str, Any] | None = None,
    folds: int = 5,
    impute: bool = True,
    scale: bool = True,
    seed: int = 0,
) -> DataFrame:
    """(row_id, label, fold, score, pred): every row predicted by a model that never saw it.

    Medians come from the train part of each fold; scaling is fitted on the whole frame.
    """
    data = cut(df.join(kfold_shuffled(df, "row_id", folds, seed), "row_id"))
    out = None
    for fold in range(folds):
        one = _fold_frame(data, features, fold, impute, scale)
        train = one.where(F.col("fold") != fold)
        test = one.where(F.col("fold") == fold)
        model = M.fit(kind, M.placed(M.assemble(train, features)), dict(params or {}), features, seed)
        scored = model.scores(M.assemble(test, features, keep=["fold"]))
        out = scored if out is None else out.unionByName(scored)
    return out.select("row_id", "label", "fold", "score", "pred")


def _fold_frame(data: DataFrame, features: Sequence[str], fold: int, impute: bool, scale: bool) -> DataFrame:
    if impute:
        data = fit_median(data.where(F.col("fold") != fold), features).transform(data)
    return Standardize(list(features)).fit(data).transform(data) if scale else data


def kfold_search(
    df: DataFrame,
    features: Sequence[str],
    grids: Mapping[str, tuple[str, Mapping[str, Sequence[Any]]]],
    threshold: float = 0.5,
    folds: int = 5,
    seed: int = 0,
    parallel: int = PARALLEL_FITS,
) -> DataFrame:
    """Out-of-fold metrics of every combination: the predictions of all folds evaluated together."""
    spark = df.sparkSession
    cands = candidates(grids)
    path = fresh_path(spark, "kfold")
    data = cut(df.join(kfold_shuffled(df, "row_id", folds, seed), "row_id"))
    timings: list[Timing] = []
    for fold in range(folds):
        one = _fold_frame(data, features, fold, True, True)
        train, test = one.where(F.col("fold") != fold), one.where(F.col("fold") == fold)
        timings += _predict_all(
            path, cands, M.assemble(train, features), M.assemble(test, features), features, fold, 0, seed, parallel
        )
    metrics = E.evaluate(_read(spark, path), [threshold], ["model", "comb"], weight="w")
    return _describe(metrics, cands, timings)


def compare_models(
    df: DataFrame,
    features: Sequence[str],
    grids: Mapping[str, tuple[str, Mapping[str, Sequence[Any]]]],
    criterion: str = "auc_prc",
    **options: Any,
) -> DataFrame:
    """The best combination of each model by the criterion, plus the majority baseline."""
    found = cut(kfold_search(df, features, grids, **options))
    best = found.groupBy("model").agg(F.min_by("comb", F.struct(-F.col(criterion), "comb")).alias("comb"))
    table = found.join(F.broadcast(best), ["model", "comb"]).select("model", "name", *E.METRICS)
    base = E.with_baseline(table.drop("name"), df)
    return base.join(table.select("model", "name"), "model", "left")


def final_comparison(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    chosen: Mapping[str, tuple[str, Mapping[str, Any], float]],
    seed: int = 0,
    parallel: int = PARALLEL_FITS,
) -> DataFrame:
    """Chosen models on the final split, ``{model: (kind, params, threshold)}``, and the baseline."""
    cands = [Candidate(m, kind, 0, tuple(params.items())) for m, (kind, params, _) in chosen.items()]
    path = fresh_path(train.sparkSession, "final")
    _predict_all(
        path, cands, M.assemble(train, features), M.assemble(test, features), features, 0, 0, seed, parallel
    )
    wide = E.metrics_table(_read(train.sparkSession, path), {m: t for m, (*_, t) in chosen.items()}, weight="w")
    return E.with_baseline(wide.select("model", "threshold", *E.METRICS), test)
