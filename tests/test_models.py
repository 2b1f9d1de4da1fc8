"""What must hold for trained models, whatever their exact numbers."""

import pytest
from pyspark.sql import functions as F

from riskloom.operators import evaluate as E
from riskloom.plans import models as M
from riskloom.plans import search
from riskloom.plans.recipe import FeatureRecipe


@pytest.fixture(scope="module")
def planted(spark):
    """Label 1 where a + noise is large; b tells nothing."""
    a, b = F.rand(1), F.rand(2)
    df = spark.range(0, 400, 1, 2).select(F.col("id").alias("row_id"), a.alias("a"), b.alias("b"), F.rand(3).alias("e"))
    df = df.withColumn("label", (F.col("a") + 0.2 * F.col("e") > 0.6).cast("int")).drop("e")
    rows = [tuple(r) for r in df.collect()]
    data = spark.createDataFrame(rows, "row_id bigint, a double, b double, label int")
    return data.where("row_id % 4 <> 0"), data.where("row_id % 4 = 0")


PARAMS = {
    "logistic": {"C": 10.0},
    "knn": {"n_neighbors": 5},
    "linear_svc": {"C": 1.0, "max_iter": 20},
    "tree": {"max_depth": 4, "criterion": "entropy"},
    "forest": {"n_estimators": 5, "max_depth": 4, "max_features": "log2"},
    "bagging": {"n_estimators": 3, "max_samples": 0.8, "max_features": 1.0, "base_estimator": ("tree", {"max_depth": 3})},
    "gbt": {"n_estimators": 4, "learning_rate": 0.3},
    "adaboost": {"n_estimators": 4, "learning_rate": 0.5},
}


@pytest.mark.parametrize("kind", list(PARAMS))
def test_model_finds_planted_signal(planted, kind):
    train, test = planted
    out = M.fit_predict(kind, train, test, ["a", "b"], PARAMS[kind], seed=3)
    assert out.select("row_id").distinct().count() == out.count() == test.count()
    if kind != "linear_svc":
        assert out.where("score < 0 or score > 1").count() == 0
    assert E.areas(out).first()["auc_roc"] > 0.85


def test_a_seed_fixes_the_result(planted):
    train, test = planted
    runs = [
        sorted(map(tuple, M.fit_predict("forest", t, test, ["a", "b"], PARAMS["forest"], seed=5).collect()))
        for t in (train, train.repartition(6))
    ]
    assert runs[0] == runs[1]


def test_constant_says_no(planted):
    out = M.fit_predict("constant", *planted, ["a", "b"])
    assert out.agg(F.max("score"), F.max("pred")).first()[:] == (0.0, 0)


def test_knn_weight_equals_copies(spark):
    schema = "row_id bigint, label int, x double, w int"
    train = spark.createDataFrame([(1, 1, 0.0, 3), (2, 0, 1.0, 1), (3, 0, 2.0, 1)], schema)
    model = M.fit("knn", M.assemble(train, ["x"], "w"), {"n_neighbors": 4}, ["x"])
    test = spark.createDataFrame([(9, 0, 0.1, 1)], schema)
    assert model.scores(M.assemble(test, ["x"])).first()["score"] == 0.75


def test_importances_and_rules(spark, planted):
    train, _ = planted
    data = M.placed(M.assemble(train, ["a", "b"]))
    fitted = M.fit("forest", data, PARAMS["forest"], ["a", "b"])
    table = M.importance_table(spark, fitted).collect()
    assert [r["feature"] for r in table] == ["b", "a"]
    assert sum(r["importance"] for r in table) == pytest.approx(1.0)
    tree = M.fit("tree", data, {"max_depth": 1}, ["a", "b"])
    rules = [r["rule"] for r in M.tree_rules(spark, tree.model, ["a", "b"]).orderBy("line").collect()]
    assert rules[0].startswith("If (a <= ")


def test_grid_search_covers_combinations_and_thresholds(planted):
    train, test = planted
    grids = {"DT": ("tree", {"max_depth": [1, 3], "criterion": ["gini", "entropy"]}), "LR": ("logistic", {"C": [1.0]})}
    out = search.grid_search(train, test, ["a", "b"], grids, [0.3, 0.5], "f1").collect()
    assert len(out) == 5 * 2
    assert [r["f1"] for r in out] == sorted((r["f1"] for r in out), reverse=True)


def test_cross_predictions_cover_every_row_once(planted):
    data = planted[0].unionByName(planted[1])
    out = search.cross_predict(data, ["a", "b"], "logistic", folds=4)
    assert out.count() == out.select("row_id").distinct().count() == 400
    assert E.areas(out).first()["auc_roc"] > 0.9


def test_bootstrap_search_and_comparison(planted):
    data = planted[0].unionByName(planted[1]).withColumn("yr", (2000 + F.col("row_id") % 3).cast("int"))
    recipe = FeatureRecipe(median_cols=["a", "b"])
    grids = {"DT": ("tree", {"max_depth": [2]}), "LR": ("logistic", {"C": [1.0]})}
    out = search.bootstrap_grid_search(data, "yr", [(2000, 2001), (2001, 2002)], recipe, [], grids, [0.5], replicates=2).collect()
    assert len(out) == 2 and all(0.8 < r["auc_roc"] <= 1 for r in out)
    table = search.compare_models(data.drop("yr"), ["a", "b"], grids, folds=2).collect()
    assert {r["model"] for r in table} == {"DT", "LR", "baseline"}


def test_full_final_comparison_takes_the_studys_four_models(spark, sf, monkeypatch):
    from riskloom.plans import queries_model, registry

    seen = {}

    def compare(train, test, features, chosen, seed):
        seen.update(chosen)
        return spark.range(1)

    monkeypatch.setattr(queries_model, "prepared", lambda *_: (None, None, []))
    monkeypatch.setattr(search, "final_comparison", compare)
    registry.QUERIES["final_comparison_full"](spark, sf).collect()
    assert {m: (kind, p.get("n_estimators"), p.get("max_depth", p.get("base_estimator", (0, {}))[1].get("max_depth")), t) for m, (kind, p, t) in seen.items()} == {
        "Random Forest": ("forest", 25, None, 0.25),
        "Bagging": ("bagging", 15, None, 0.3),
        "Boosting": ("gbt", 200, 3, 0.2),
        "bagging": ("bagging", 5, None, 0.45),
    }
