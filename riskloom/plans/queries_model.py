"""Model training, searches and comparisons as registered queries.

Training has no SQL counterpart; tests check what must hold for its results.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import evaluate as E
from riskloom.operators import relational as R
from riskloom.operators import split as SP
from riskloom.operators.features import SparseOneHot
from riskloom.plans import models as M
from riskloom.plans import search
from riskloom.plans.recipe import FeatureRecipe, feature_columns
from riskloom.plans.registry import query
from riskloom.session import cut
from riskloom.sources.tables import cohort, table

SKIP = ["row_id", "label", "role"]


def recipe() -> FeatureRecipe:
    return FeatureRecipe(
        flag_missing=["acctbal", "segment", "flag_a"],
        mode_cols=["segment", "priority", "flag_a"],
        median_cols=["acctbal", "qty", "disc", "total"],
        one_hot_cols=["segment", "priority"],
        boolean_cols=["flag_a", "flag_b"],
        matches=[("flag_a", "flag_b", "flags_match")],
        drop_cols=["enrolled", "first_ship", "last_ship"],
    )


def clients(spark, folder):
    """Labelled clients with the amounts scaled to similar sizes."""
    rows = cohort(spark, folder).where("label is not null")
    return rows.withColumns({"total": F.col("total") / 100000, "acctbal": F.col("acctbal") / 1000, "qty": F.col("qty") / 50})


def prepared(spark, folder):
    """Train and test frames after the recipe, and the feature names."""
    rows = cut(SP.time_split(clients(spark, folder), "enrolled_yr", 1999).drop("enrolled_yr"))
    step = recipe().fit(rows.where("role = 'train'"))
    train, test = SP.role_frames(step.transform(rows))
    return train, test, feature_columns(train, SKIP)


def _scores(spark, folder, kind, params):
    train, test, features = prepared(spark, folder)
    return M.fit_predict(kind, train, test, features, params, seed=1)


@query()
def fit_logistic(spark, folder):
    return _scores(spark, folder, "logistic", {"C": 10.0})


@query()
def fit_sparse_logistic(spark, folder):
    """A column with a category per customer, as a sparse vector that train and test share."""
    known = clients(spark, folder).select("row_id", "label", "enrolled_yr", "qty", "total")
    names = table(spark, folder, "orders").select(F.col("o_orderkey").alias("row_id"), F.col("o_custkey").cast("string").alias("client"))
    rows = cut(SP.time_split(R.index_join(known, names, "row_id").na.drop(subset=["qty", "total"]), "enrolled_yr", 1999).drop("enrolled_yr"))
    made = SparseOneHot(["client"], "row_id").fit(rows.where("role = 'train'")).transform(rows)
    train, test = SP.role_frames(made)
    return M.fit_predict("logistic", train, test, ["qty", "total", "one_hot"], {"C": 1.0})


@query()
def fit_linear_svc(spark, folder):
    return _scores(spark, folder, "linear_svc", {"C": 1.0, "max_iter": 30})


@query()
def fit_tree(spark, folder):
    return _scores(spark, folder, "tree", {"criterion": "gini", "max_features": "log2", "max_depth": 10})


@query()
def fit_forest(spark, folder):
    return _scores(spark, folder, "forest", {"n_estimators": 25, "max_features": "auto", "max_depth": 8})


@query()
def fit_bagging(spark, folder):
    params = {"n_estimators": 5, "max_samples": 0.5, "max_features": 0.5, "base_estimator": ("tree", {"max_depth": 6})}
    return _scores(spark, folder, "bagging", params)


@query()
def fit_gbt(spark, folder):
    return _scores(spark, folder, "gbt", {"n_estimators": 15, "learning_rate": 0.3})


@query()
def fit_adaboost(spark, folder):
    return _scores(spark, folder, "adaboost", {"n_estimators": 10, "learning_rate": 0.5})


@query()
def fit_knn(spark, folder):
    train, test, _ = prepared(spark, folder)
    return M.fit_predict("knn", train, test, ["qty", "total", "acctbal"], {"n_neighbors": 15})


@query()
def fit_predict(spark, folder):
    """A forest's scores on the test rows, evaluated at its threshold."""
    train, test, features = prepared(spark, folder)
    pred = M.fit_predict("forest", train, test, features, {"n_estimators": 10, "max_depth": 6}, seed=1)
    return E.evaluate(cut(pred), [0.25])


@query()
def feature_importance(spark, folder):
    train, _, features = prepared(spark, folder)
    data = M.placed(M.assemble(train, features))
    fitted = M.fit("forest", data, {"n_estimators": 10, "max_depth": 6}, features, seed=1)
    return M.importance_table(spark, fitted)


@query()
def oof_logistic(spark, folder):
    rows = clients(spark, folder).select("row_id", "label", "qty", "disc", "total", "acctbal")
    return search.cross_predict(rows, ["qty", "disc", "total", "acctbal"], "logistic", {"fit_intercept": False}, seed=1)


@query()
def grid_search(spark, folder):
    train, test, features = prepared(spark, folder)
    grids = {"LR": ("logistic", {"C": [0.01, 1.0]}), "DT": ("tree", {"criterion": ["gini", "entropy"], "max_depth": [3, 6]})}
    found = search.grid_search(train, test, features, grids, [0.3, 0.35, 0.4], "f1", seed=1)
    return found.drop("params", "train_time", "test_time")


@query()
def bootstrap_grid_search(spark, folder):
    rows = clients(spark, folder)
    grids = {"DT": ("tree", {"max_depth": [3, 5]})}
    found = search.bootstrap_grid_search(
        rows, "enrolled_yr", [(1997, 1998), (1998, 1999)], recipe(), [], grids, [0.3, 0.35], "auc_roc", replicates=2, seed=1
    )
    return found.drop("params", "train_time", "test_time")


@query()
def model_comparison(spark, folder):
    rows = clients(spark, folder).select("row_id", "label", "qty", "disc", "total", "acctbal")
    grids = {
        "LR": ("logistic", {"C": [0.1, 10.0]}),
        "DT": ("tree", {"max_depth": [3, 6]}),
        "RF": ("forest", {"n_estimators": [5], "max_depth": [4]}),
    }
    return search.compare_models(rows, ["qty", "disc", "total", "acctbal"], grids, folds=3, seed=1)


@query()
def final_comparison(spark, folder):
    """Forest, bagging and boosting on the final split, each at its own threshold, and the baseline."""
    train, test, features = prepared(spark, folder)
    chosen = {
        "Random Forest": ("forest", {"n_estimators": 25, "max_depth": 8}, 0.25),
        "Bagging": ("bagging", {"n_estimators": 5, "max_features": 0.5, "base_estimator": ("tree", {"max_depth": 6})}, 0.3),
        "Boosting": ("gbt", {"n_estimators": 10, "learning_rate": 0.1}, 0.2),
    }
    return search.final_comparison(train, test, features, chosen, seed=1)


@query()
def error_tree(spark, folder):
    """Rules of a shallow tree over the positives that a forest misses."""
    train, test, features = prepared(spark, folder)
    pred = M.fit_predict("forest", train, test, features, {"n_estimators": 10, "max_depth": 6}, seed=1)
    missed = E.false_negatives(pred, 0.75).select("row_id", "missed")
    rows = test.drop("label").join(missed.withColumnRenamed("missed", "label"), "row_id")
    fitted = M.fit("tree", M.placed(M.assemble(rows, features)), {"max_depth": 3}, features, seed=1)
    return M.tree_rules(spark, fitted.model, features)


# The final models at the original study's sizes: (kind, parameters, threshold). Trees without a limit
# of their own go to Spark's depth 30.
FINAL = {
    "Random Forest": ("forest", {"n_estimators": 25, "max_features": "auto", "max_depth": None}, 0.25),
    "Bagging": ("bagging", {"n_estimators": 15, "max_samples": 1.0, "max_features": 0.5, "base_estimator": ("tree", {"max_depth": None})}, 0.3),
    "Boosting": ("gbt", {"n_estimators": 200, "learning_rate": 0.1, "max_depth": 3}, 0.2),
    "bagging": ("bagging", {"n_estimators": 5, "max_samples": 0.5, "max_features": 0.5, "base_estimator": ("tree", {"max_depth": None})}, 0.45),
}


@query()
def fit_forest_full(spark, folder):
    return _scores(spark, folder, *FINAL["Random Forest"][:2])


@query()
def fit_bagging_full(spark, folder):
    return _scores(spark, folder, *FINAL["Bagging"][:2])


@query()
def fit_gbt_full(spark, folder):
    return _scores(spark, folder, *FINAL["Boosting"][:2])


@query()
def fit_knn_full(spark, folder):
    return _scores(spark, folder, "knn", {"n_neighbors": 15})


@query()
def final_comparison_full(spark, folder):
    """All four final models, each at its own threshold, and the baseline."""
    train, test, features = prepared(spark, folder)
    return search.final_comparison(train, test, features, FINAL, seed=1)


@query()
def error_tree_full(spark, folder):
    """Rules of a shallow tree over the positives that boosting misses at 0.3."""
    train, test, features = prepared(spark, folder)
    pred = M.fit_predict("gbt", train, test, features, FINAL["Boosting"][1], seed=1)
    missed = E.false_negatives(pred, 0.3).select("row_id", "missed")
    rows = test.drop("label").join(missed.withColumnRenamed("missed", "label"), "row_id")
    params = {"criterion": "gini", "max_features": "log2", "max_depth": 3}
    fitted = M.fit("tree", M.placed(M.assemble(rows, features)), params, features, seed=1)
    return M.tree_rules(spark, fitted.model.trees[0], features)
