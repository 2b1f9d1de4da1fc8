"""Classifiers, named and parameterised the way the searches name them.

Most are Spark ML's, or its model fitted here (``gbt``). Exact trees, extra trees, real-valued boosting and the linear classifiers with a
penalised intercept are grown or solved in Spark aggregations here. Spark's own trees (``tree``,
``forest``, ``bagging``, ``gbt``) cut each column at 32 sketched places. A forest, or bagged trees, asked for
with ``max_depth`` None are exact and have no limit of depth: their nodes would not fit the driver.

``fit`` takes a table with ``row_id``, ``label`` (0/1) and feature columns, optionally a
row weight (a bootstrap multiplicity, so that drawn-twice rows are not copied). A fitted
model gives (row_id, label, score, pred).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.neighbors import neighbour_labels
from riskloom.operators.split import bootstrap_maps
from riskloom.plans.boost import fit_real_boost
from riskloom.plans.gradient import fit_gradient_boost, fits
from riskloom.plans.newton import LinearFits, fit_linear
from riskloom.plans.sparse import fit_sparse_logistic, one_place, wide_column
from riskloom.plans.trees import Growth, Trees, grow, subset_size
from riskloom.session import checkpoint, cut

# Spark's deepest tree; stands for "no limit".
MAX_DEPTH = 30
# Rows of one part of a training table.
PART_ROWS = 1_000_000
# Rounds of boosting after which the lineage is cut.
CUT_EVERY = 5

KINDS = (
    "logistic",
    "knn",
    "linear_svc",
    "tree",
    "forest",
    "bagging",
    "gbt",
    "adaboost",
    "adaboost_discrete",
    "exact_tree",
    "exact_forest",
    "extra_trees",
    "linear_logistic",
    "linear_squared_hinge",
    "constant",
)


def assemble(df: DataFrame, features: Sequence[str], weight: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """(row_id, label, keep..., w, features): the table all fits read. A feature may be a vector."""
    cells = [F.col(f"`{c}`") if isinstance(df.schema[c].dataType, VectorUDT) else F.col(f"`{c}`").cast("double") for c in features]
    cols = [x.alias(f"_x{i}") for i, x in enumerate(cells)]
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    wide = df.select("row_id", F.col("label").cast("double").alias("label"), *keep, w.alias("w"), *cols)
    maker = VectorAssembler(inputCols=[f"_x{i}" for i in range(len(features))], outputCol="features")
    return maker.transform(wide).select("row_id", "label", *keep, "w", "features")


def _subset(max_features: Any) -> str:
    if max_features is None:
        return "all"
    if max_features in ("auto", "sqrt"):
        return "sqrt"
    return str(max_features)


def _depth(max_depth: int | None) -> int:
    if max_depth is None:
        return MAX_DEPTH
    if int(max_depth) > MAX_DEPTH:
        raise ValueError(f"trees reach depth {MAX_DEPTH} at most; None means no limit of one's own")
    return int(max_depth)


# Parameters of each kind that a search may set.
PARAMETERS = {
    "logistic": {"C", "fit_intercept", "max_iter"},
    "knn": {"n_neighbors"},
    "linear_svc": {"C", "fit_intercept", "max_iter"},
    "tree": {"criterion", "max_depth", "max_features"},
    "forest": {"criterion", "max_depth", "max_features", "n_estimators"},
    "bagging": {"n_estimators", "base_estimator", "max_features", "max_samples"},
    "gbt": {"n_estimators", "learning_rate", "max_depth"},
    "adaboost": {"n_estimators", "learning_rate"},
    "adaboost_discrete": {"n_estimators", "learning_rate"},
    "exact_tree": {"criterion", "max_depth", "max_features"},
    "exact_forest": {"criterion", "max_depth", "max_features", "n_estimators"},
    "extra_trees": {"criterion", "max_depth", "max_features", "n_estimators"},
    "linear_logistic": {"C", "fit_intercept"},
    "linear_squared_hinge": {"C", "fit_intercept"},
    "constant": set(),
}


def check_parameters(kind: str, params: dict[str, Any]) -> None:
    """A misspelt or unsupported parameter must not pass for its default."""
    if kind not in PARAMETERS:
        raise ValueError(f"unknown kind of model: {kind}")
    unknown = sorted(set(params) - PARAMETERS[kind])
    if unknown:
        raise ValueError(f"{kind} has no parameter {', '.join(unknown)}")


def estimator(kind: str, params: dict[str, Any], rows: float, seed: int):
    """The Spark ML estimator of a kind; ``rows`` scales the penalty to a mean loss."""
    check_parameters(kind, params)
    common = {"featuresCol": "features", "labelCol": "label", "weightCol": "w"}
    if kind == "logistic":
        return LogisticRegression(
            **common,
            regParam=1.0 / (params.get("C", 1.0) * rows),
            elasticNetParam=0.0,
            fitIntercept=params.get("fit_intercept", True),
            standardization=False,
            maxIter=params.get("max_iter", 100),
        )
    if kind == "linear_svc":
        return LinearSVC(
            **common,
            regParam=1.0 / (params.get("C", 1.0) * rows),
            fitIntercept=params.get("fit_intercept", True),
            standardization=False,
            maxIter=params.get("max_iter", 100),
        )
    if kind == "tree":
        if params.get("max_features") is None:
            return DecisionTreeClassifier(
                **common,
                impurity=params.get("criterion", "gini"),
                maxDepth=_depth(params.get("max_depth")),
                seed=seed,
            )
        # a tree that looks at a random part of the features at each split
        return RandomForestClassifier(
            **common,
            numTrees=1,
            bootstrap=False,
            subsamplingRate=1.0,
            impurity=params.get("criterion", "gini"),
            maxDepth=_depth(params.get("max_depth")),
            featureSubsetStrategy=_subset(params["max_features"]),
            seed=seed,
        )
    if kind == "forest":
        return RandomForestClassifier(
            **common,
            numTrees=params.get("n_estimators", 10),
            impurity=params.get("criterion", "gini"),
            maxDepth=_depth(params.get("max_depth")),
            featureSubsetStrategy=_subset(params.get("max_features", "auto")),
            seed=seed,
        )
    if kind == "gbt":
        return GBTClassifier(
            **common,
            maxIter=params.get("n_estimators", 100),
            stepSize=params.get("learning_rate", 0.1),
            maxDepth=_depth(params.get("max_depth", 3)),
            lossType="logistic",
            seed=seed,
        )
    raise ValueError(f"unknown kind of model: {kind}")


def positive_score(model, kind: str) -> Column:
    """Probability of class 1; the signed margin where a model has no probability."""
    return vector_to_array("rawPrediction")[1] if kind == "linear_svc" else vector_to_array("probability")[1]


@dataclass
class Fitted:
    """A fitted model; ``scores`` appends score and pred to an assembled table."""

    kind: str
    model: Any
    features: list[str] = field(default_factory=list)

    def scores(self, data: DataFrame) -> DataFrame:
        out = self.model.transform(data)
        keep = [c for c in data.columns if c != "features"]
        return out.select(
            *keep,
            positive_score(self.model, self.kind).alias("score"),
            F.col("prediction").cast("int").alias("pred"),
        )

    def importances(self) -> list[tuple[str, float]]:
        values = self.model.featureImportances.toArray()
        return sorted(zip(self.features, map(float, values)), key=lambda p: (p[1], p[0]))


@dataclass
class FittedConstant:
    """Says 0 for every row."""

    def scores(self, data: DataFrame) -> DataFrame:
        keep = [F.col(c) for c in data.columns if c != "features"]
        return data.select(*keep, F.lit(0.0).alias("score"), F.lit(0).alias("pred"))


@dataclass
class FittedKnn:
    """Share of the k nearest train rows with label 1; nothing is fitted but the rows kept.

    A weight w counts a train row w times.
    """

    train: DataFrame
    k: int

    def scores(self, data: DataFrame) -> DataFrame:
        as_array = vector_to_array("features").alias("x")
        train = self.train.select("row_id", F.struct("label", "w").alias("vote"), as_array)
        test = data.select("row_id", as_array)
        # k distinct rows always hold k draws, as every weight is at least 1
        found = neighbour_labels(train, test, "x", "vote", "row_id", self.k)
        near = Window.partitionBy("row_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
        used = F.coalesce(F.sum("neighbour_label.w").over(near), F.lit(0.0))
        counted = found.withColumn(
            "c", F.greatest(F.lit(0.0), F.least(F.col("neighbour_label.w"), F.lit(float(self.k)) - used))
        )
        share = counted.groupBy("row_id").agg(
            (F.sum(F.col("c") * F.col("neighbour_label.label")) / F.sum("c")).alias("score")
        )
        keep = [c for c in data.columns if c != "features"]
        return data.join(share, "row_id").select(*keep, "score", (F.col("score") > 0.5).cast("int").alias("pred"))


@dataclass
class FittedBagging:
    """Mean probability of members fitted on bootstrap rows and feature subsets."""

    members: list[tuple[list[int], Any, str]]

    def scores(self, data: DataFrame) -> DataFrame:
        out = data
        names = []
        for i, (keep, model, kind) in enumerate(self.members):
            sliced = VectorSlicer(inputCol="features", outputCol="_f", indices=keep).transform(out)
            scored = model.transform(sliced)
            names.append(f"_p{i}")
            out = scored.select(*out.columns, positive_score(model, kind).alias(names[-1]))
        total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
        keep = [c for c in data.columns if c != "features"]
        score = (total / F.lit(float(len(names)))).alias("score")
        return out.select(*keep, score).withColumn("pred", (F.col("score") > 0.5).cast("int"))


@dataclass
class FittedBoost:
    """Weighted vote of stumps; score is the vote mapped to (0, 1)."""

    members: list[tuple[float, Any]]

    def scores(self, data: DataFrame) -> DataFrame:
        out = data.withColumn("_vote", F.lit(0.0))
        for alpha, model in self.members:
            scored = model.transform(out)
            vote = F.col("_vote") + F.when(F.col("prediction") == 1, F.lit(alpha)).otherwise(F.lit(-alpha))
            out = scored.select(*data.columns, vote.alias("_vote"))
        total = sum(a for a, _ in self.members) or 1.0
        keep = [c for c in data.columns if c != "features"]
        share = F.col("_vote") / F.lit(total)
        return out.select(
            *keep,
            (F.lit(1.0) / (F.lit(1.0) + F.exp(-share))).alias("score"),
            (F.col("_vote") > 0).cast("int").alias("pred"),
        )


def _drawn(train: DataFrame, share: float, count: int, seed: int) -> DataFrame:
    """(row_id, drawn): how often each of ``count`` bootstrap samples drew a row, one join for all of them."""
    return bootstrap_maps(train, "row_id", share, count, seed, "bag")


def _fit_exact(kind: str, train: DataFrame, params: dict[str, Any], features: Sequence[str], seed: int):
    """Trees whose splits are exact (or drawn, for extra trees); no limit of depth unless one is given."""
    many = kind != "exact_tree"
    asked = params.get("max_features", "auto" if many else None)
    growth = Growth(params.get("max_depth"), params.get("criterion", "gini"), subset_size(asked, len(features)), kind == "extra_trees", seed)
    count = params.get("n_estimators", 10) if many else 1
    drawn = _drawn(train, 1.0, count, seed) if kind == "exact_forest" else None
    return grow(train, features, growth, count, drawn)


@dataclass
class FittedLinear:
    """One of the fits that are made together, by itself."""

    fits: LinearFits

    def scores(self, data: DataFrame) -> DataFrame:
        return self.fits.scores(data, [c for c in data.columns if c != "features"]).drop("cost")


def _unlimited(kind: str, params: dict[str, Any]) -> bool:
    """Forests without a limit of depth: Spark ML would hold all their nodes on the driver, so they are grown here."""
    return kind == "forest" and "max_depth" in params and params["max_depth"] is None


def _fit_bagging(train: DataFrame, params: dict[str, Any], rows: float, width: int, seed: int) -> FittedBagging | Trees:
    count = params.get("n_estimators", 10)
    base, base_params = params.get("base_estimator") or ("tree", {})
    share = params.get("max_features", 1.0)
    picked = max(1, int(share * width))
    if base == "tree" and "max_depth" in base_params and base_params["max_depth"] is None:
        check_parameters(base, base_params)
        columns = {i: tuple(sorted(sorted(range(width), key=lambda j: _mix(seed, i, j))[:picked])) for i in range(count)}
        growth = Growth(None, base_params.get("criterion", "gini"), subset_size(base_params.get("max_features"), picked), seed=seed, columns=columns)
        return grow(train, [str(i) for i in range(width)], growth, count, _drawn(train, params.get("max_samples", 1.0), count, seed))
    # drawn and joined once: placing counts the rows before it deals them
    bag = placed(cut(train.join(_drawn(train, params.get("max_samples", 1.0), count, seed), "row_id")))
    members = []
    for i in range(count):
        # a seeded choice of feature positions, kept in order
        ranked = sorted(range(width), key=lambda j: _mix(seed, i, j))
        keep = sorted(ranked[:picked])
        times = F.try_element_at("drawn", F.lit(i))
        sample = bag.where(times.isNotNull()).withColumn("w", F.col("w") * times).drop("drawn")
        sample = VectorSlicer(inputCol="features", outputCol="_f", indices=keep).transform(sample)
        est = estimator(base, base_params, rows * params.get("max_samples", 1.0), seed + i).setFeaturesCol("_f")
        members.append((keep, est.fit(sample), base))
    return FittedBagging(members)


def _mix(*parts: int) -> str:
    return hashlib.md5("-".join(map(str, parts)).encode()).hexdigest()


def _fit_discrete(train: DataFrame, params: dict[str, Any], seed: int) -> FittedBoost:
    """Discrete two-class boosting of depth-1 trees.

    The weight of a row is a column; the lineage is cut every few rounds, from which a
    lost executor's partitions are read back instead of being boosted again.
    """
    rounds, rate = params.get("n_estimators", 50), params.get("learning_rate", 1.0)
    total = train.agg(F.sum("w")).first()[0]
    data = checkpoint(train.select("label", "features", (F.col("w") / F.lit(total)).alias("w")))
    stump = DecisionTreeClassifier(
        featuresCol="features", labelCol="label", weightCol="w", maxDepth=1, impurity="gini", seed=seed
    )
    members: list[tuple[float, Any]] = []
    for i in range(rounds):
        # only the prediction is read, by this round and by those that follow it
        model = stump.fit(data).setRawPredictionCol("").setProbabilityCol("")
        miss = F.when(F.col("prediction") != F.col("label"), F.col("w")).otherwise(0.0)
        scored = model.transform(data).select("label", "features", "w", miss.alias("miss"))
        err, mass = scored.agg(F.sum("miss"), F.sum("w")).first()
        err = err / mass
        if err <= 0:
            return FittedBoost([*members, (1.0, model)] if not members else members)
        if err >= 0.5:
            break
        alpha = rate * math.log((1 - err) / err)
        members.append((alpha, model))
        new = F.col("w") * F.when(F.col("miss") > 0, F.lit(math.exp(alpha))).otherwise(1.0)
        scale = mass + err * mass * (math.exp(alpha) - 1)
        data = scored.select("label", "features", (new / F.lit(scale)).alias("w"))
        if (i + 1) % CUT_EVERY == 0 and i + 1 < rounds:
            data = checkpoint(data)
    if not members:
        members = [(1.0, model)]
    return FittedBoost(members)


def fit(kind: str, train: DataFrame, params: dict[str, Any], features: Sequence[str], seed: int = 0):
    """Fit on an assembled table. Rows are placed by key first, so that a seed fixes the result."""
    check_parameters(kind, params)
    if kind == "constant":
        return FittedConstant()
    if kind == "knn":
        return FittedKnn(train, params.get("n_neighbors", 5))
    rows = train.agg(F.sum("w")).first()[0] or 1.0
    if kind == "bagging":
        return _fit_bagging(train, params, rows, len(features), seed)
    if kind == "adaboost":
        return fit_real_boost(train, params.get("n_estimators", 50), params.get("learning_rate", 1.0))
    if kind == "adaboost_discrete":
        return _fit_discrete(train, params, seed)
    if _unlimited(kind, params):
        return _fit_exact("exact_forest", train, params, features, seed)
    if kind in ("exact_tree", "exact_forest", "extra_trees"):
        return _fit_exact(kind, train, params, features, seed)
    if kind in ("linear_logistic", "linear_squared_hinge"):
        loss = kind.removeprefix("linear_")
        return FittedLinear(fit_linear(train, features, [params.get("C", 1.0)], loss, intercept=params.get("fit_intercept", True)))
    if kind == "gbt" and fits(len(features), depth := _depth(params.get("max_depth", 3))):
        boosted = fit_gradient_boost(train, features, params.get("n_estimators", 100), params.get("learning_rate", 0.1), depth, seed)
        if boosted is not None:
            return boosted
    return Fitted(kind, estimator(kind, params, rows, seed).fit(train), list(features))


def placed(data: DataFrame) -> DataFrame:
    """Rows in an order that depends on their key only, then written once.

    Tree bins and samples look at rows in order; without this a seed would not fix them.
    Every core gets a part, however small the table, and no part exceeds a fixed row count.
    """
    cores = data.sparkSession.sparkContext.defaultParallelism
    parts = max(cores, -(-data.count() // PART_ROWS))
    return checkpoint(data.repartition(parts, F.col("row_id")).sortWithinPartitions("row_id"))


def fit_predict(
    kind: str,
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    params: dict[str, Any] | None = None,
    seed: int = 0,
) -> DataFrame:
    """(row_id, label, w, score, pred) of the test rows."""
    params = params or {}
    wide = wide_column(train, features) if kind == "logistic" else None
    if wide and one_place(train, wide) and one_place(test, wide):
        # dense vectors as long as the categories, and a name for each place, would cost rows times categories
        check_parameters(kind, params)
        fitted = fit_sparse_logistic(train, features, params.get("C", 1.0), params.get("fit_intercept", True), params.get("max_iter", 100))
        if fitted is not None:
            return fitted.scores(test)
    model = fit(kind, placed(assemble(train, features)), params, features, seed)
    return model.scores(assemble(test, features))


def importance_table(spark, fitted: Fitted) -> DataFrame:
    """(feature, importance), ascending: one row per feature."""
    return spark.createDataFrame(fitted.importances(), "feature string, importance double").orderBy(
        "importance", "feature"
    )


def tree_rules(spark, model, features: Sequence[str]) -> DataFrame:
    """The rules of one tree as (line, depth, rule)."""
    rows = []
    for i, text in enumerate(model.toDebugString.splitlines()[1:]):
        rule = text.strip()
        for j in range(len(features) - 1, -1, -1):
            rule = rule.replace(f"(feature {j} ", f"({features[j]} ")
        rows.append((i, (len(text) - len(text.lstrip())) // 1 - 2, rule))
    return spark.createDataFrame(rows, "line int, depth int, rule string")
