"""Golden edge cases of cleaning and row features."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import scalars as S
from riskloom.operators import clean as C
from riskloom.operators import features as X
from riskloom.plans.recipe import FeatureRecipe
from riskloom.roles import Roles, nan_to_null, select_by_role, tag_roles


def column(df, name):
    return [r[name] for r in df.collect()]


def frame(spark, kind, values, name="x"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"row_id bigint, {name} {kind}").coalesce(1)


def test_mode_tie_takes_smallest(spark):
    df = frame(spark, "string", ["b", "a", "b", "a", None])
    assert C.fit_mode(df, ["x"]).values == {"x": "a"}
    assert column(C.fit_mode(df, ["x"]).transform(df), "x")[-1] == "a"


def test_mode_of_numbers_ties_by_value_not_text(spark):
    df = spark.createDataFrame([(9, 9.5), (10, 10.5), (9, 9.5), (10, 10.5)], "i int, d double")
    assert C.fit_mode(df, ["i", "d"]).values == {"i": 9, "d": 9.5}


def test_mode_of_booleans_and_empty_column(spark):
    df = spark.createDataFrame([(True, None), (True, None), (False, None), (None, None)], "b boolean, e string")
    assert column(C.fit_mode(df, ["b", "e"]).transform(df), "b") == [True, True, False, True]
    assert column(C.fit_mode(df, ["b", "e"]).transform(df), "e") == [None] * 4


def test_median_of_even_count(spark):
    df = frame(spark, "double", [1.0, 2.0, 3.0, 4.0, None])
    assert C.fit_median(df, ["x"]).values == {"x": 2.5}
    assert C.fit_mean(df, ["x"]).values == {"x": 2.5}


@pytest.mark.parametrize(
    "kind,values,want",
    [
        ("boolean", [True, False, None], [1, 0, 1]),
        ("int", [0, 5, None], [0, 1, 1]),
        ("string", ["", "0", "N", None], [0, 1, 1, 1]),
    ],
)
def test_truthiness(spark, kind, values, want):
    assert column(C.binary_transform(frame(spark, kind, values), ["x"]), "x") == want


def test_truthiness_null_as_zero(spark):
    assert column(C.binary_transform(frame(spark, "boolean", [None]), ["x"], null_as=0), "x") == [0]


def test_missing_indicator(spark):
    assert column(C.missing_indicators(frame(spark, "int", [None, 3]), ["x", "x"]), "x_missing") == [1, 0]


def test_match_feature_keeps_sources(spark):
    df = spark.createDataFrame([(True, True), (True, False), (None, True)], "a boolean, b boolean").coalesce(1)
    out = C.match_feature(df, "a", "b", "m")
    assert column(out, "m") == [1, 0, 1]
    assert column(out, "a") == [True, True, None]


def test_interval_is_nanoseconds_for_times_and_difference_for_numbers(spark):
    day = dt.datetime(2010, 1, 1)
    df = spark.createDataFrame(
        [(day, day + dt.timedelta(days=1), 1990, 2010), (day, None, 1, None)],
        "s timestamp_ntz, e timestamp_ntz, a int, b int",
    ).coalesce(1)
    assert column(C.interval(df, "s", "e", "i"), "i") == [86_400_000_000_000, None]
    assert column(C.interval(df, "a", "b", "i"), "i") == [20, None]


def test_text_numbers_and_times(spark):
    df = frame(spark, "string", ["1,234.5", "12;5", None])
    assert column(df.select(S.strip_thousands(F.col("x")).alias("x")), "x") == [1234.5, None, None]
    times = frame(spark, "string", ["2009-04-08 00:00:00", "no date"])
    assert column(C.change_time(times, ["x"]), "x") == [dt.datetime(2009, 4, 8), None]
    with pytest.raises(Exception):
        C.change_time(times, ["x"], strict=True).collect()
    other = frame(spark, "string", ["08/04/2009"])
    assert column(C.change_time(other, ["x"], "dd/MM/yyyy"), "x") == [dt.datetime(2009, 4, 8)]


def test_date_parts_and_negative_flag(spark):
    df = spark.createDataFrame([(dt.datetime(2010, 12, 6), -5), (None, None)], "d timestamp_ntz, x bigint").coalesce(1)
    out = C.date_parts(df, ["d"]).withColumn("neg", S.negative_flag(F.col("x")))
    assert [tuple(r)[2:] for r in out.collect()] == [(2010, 12, 1), (None, None, 0)]


def test_cap_and_binary_with_null(spark):
    df = frame(spark, "double", [None, 7.0, 2.0])
    assert column(df.select(S.cap(F.col("x"), 5.0).alias("x")), "x") == [None, 5.0, 2.0]
    assert column(df.select(S.at_least(F.col("x"), 5.0).alias("x")), "x") == [False, True, False]


def test_fill_constant_on_several_types(spark):
    df = spark.createDataFrame([(None, None, None)], "t timestamp_ntz, s string, n int")
    row = C.fill_constant(df, {"t": "2009-04-08 00:00:00", "s": "z", "n": 1963}).first()
    assert tuple(row) == (dt.datetime(2009, 4, 8), "z", 1963)


def test_group_mean_leaves_unknown_group_alone(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.0), (2, "a", 3.0), (3, "a", None), (4, None, None), (5, "b", None)],
        "row_id bigint, g string, x double",
    )
    out = C.GroupMeanFill("g", ["x"], "row_id").fit(df).transform(df)
    assert {r["row_id"]: r["x"] for r in out.collect()} == {1: 1.0, 2: 3.0, 3: 2.0, 4: None, 5: None}


def test_equal_width_bins(spark):
    df = frame(spark, "double", [0.0, 1.0, 2.0, 5.0, 10.0, None])
    assert column(X.EqualWidthBins("x", 5).fit(df).transform(df), "x_bins") == [0, 0, 0, 2, 4, None]


@pytest.mark.parametrize("bins,want", [(3, 1), (4, 1), (5, 2)])
def test_equal_width_bins_of_one_value(spark, bins, want):
    df = frame(spark, "double", [4.0, 4.0])
    assert column(X.EqualWidthBins("x", bins).fit(df).transform(df), "x_bins") == [want, want]


def test_capped_bins_replace_the_source(spark):
    df = frame(spark, "double", [0.0, 4.0, 400.0])
    out = X.EqualWidthBins("x", 2, cap=10.0).fit(df).transform(df)
    assert column(out, "x") == [0.0, 4.0, 10.0]
    assert column(out, "x_bins") == [0, 0, 1]


def test_quantile_bins_leave_out_the_minimum(spark):
    df = frame(spark, "double", [0.0, 1.0, 2.0, 5.0, 10.0])
    assert column(X.QuantileBins("x", [0, 0.5, 1]).fit(df).transform(df), "x_qbin") == [None, 0, 0, 1, 1]
    with pytest.raises(ValueError):
        X.QuantileBins("x", [0, 0.1, 0.2, 1]).fit(frame(spark, "double", [1.0, 1.0, 1.0, 2.0]))


def test_one_hot_null_and_unseen(spark):
    train = frame(spark, "string", ["x", "y", None], "k")
    hot = X.OneHot(["k"]).fit(train)
    out = hot.transform(train)
    assert "k" not in out.columns
    assert column(out, "k_x") == [1, 0, 0] and column(out, "k_y") == [0, 1, 0]
    test = hot.transform(frame(spark, "string", ["z"], "k"))
    assert tuple(test.first())[1:] == (0, 0)


def test_one_hot_refuses_too_many_and_long_form_takes_them(spark):
    df = spark.range(50).selectExpr("id as row_id", "cast(id as string) as k")
    with pytest.raises(ValueError):
        X.OneHot(["k"], max_columns=10).fit(df)
    assert X.one_hot_long(df, "row_id", ["k"]).count() == 50


def test_standardize_uses_population_deviation(spark):
    df = frame(spark, "double", [1.0, 3.0])
    assert column(X.Standardize(["x"]).fit(df).transform(df), "x") == [-1.0, 1.0]
    flat = frame(spark, "double", [2.0, 2.0])
    assert column(X.Standardize(["x"]).fit(flat).transform(flat), "x") == [0.0, 0.0]


def test_recipe_uses_train_statistics(spark):
    schema = "row_id bigint, n double, c string, f boolean, g boolean"
    train = spark.createDataFrame([(1, 1.0, "a", True, True), (2, 3.0, "a", None, True), (3, None, "b", False, False)], schema)
    test = spark.createDataFrame([(4, None, None, None, False), (5, 100.0, "z", True, True)], schema)
    recipe = FeatureRecipe(["n"], ["c", "f"], ["n"], ["c"], ["f", "g"], [("f", "g", "same"), ("c_a", "f", "a_f")])
    out = {r["row_id"]: r for r in recipe.fit(train).transform(test).collect()}
    assert out[4]["n"] == 2.0 and out[4]["n_missing"] == 1 and out[4]["c_a"] == 1
    # a tie between false and true goes to the smaller value
    assert out[4]["f"] == 0 and out[4]["same"] == 1
    assert (out[5]["c_a"], out[5]["c_b"]) == (0, 0) and out[5]["n"] == 100.0
    own = recipe.refit_fills(test).transform(test)
    assert {r["row_id"]: r["n"] for r in own.collect()} == {4: 100.0, 5: 100.0}


def test_fitted_recipe_transforms_a_stream(spark, tmp_path):
    df = frame(spark, "double", [1.0, None, 3.0])
    folder = str(tmp_path / "in")
    df.write.parquet(folder)
    fill = C.fit_median(df, ["x"])
    stream = fill.transform(spark.readStream.schema(df.schema).parquet(folder))
    query = stream.writeStream.format("memory").queryName("filled").option(
        "checkpointLocation", str(tmp_path / "cp")
    ).start()
    query.processAllAvailable()
    query.stop()
    assert sorted(r["x"] for r in spark.table("filled").collect()) == [1.0, 2.0, 3.0]


def test_roles(spark):
    df = spark.createDataFrame([(1, 0, "a", True, 2.0)], "id bigint, y int, c string, b boolean, n double")
    roles = Roles.infer(df, ["id"], ["y"])
    assert (roles.categorical, roles.boolean, roles.numerical) == (["c"], ["b"], ["n"])
    assert Roles.from_json(roles.to_json()) == roles
    assert select_by_role(tag_roles(df, roles), "numerical", "categorical").columns == ["c", "n"]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], T.StructType([T.StructField("x", T.DoubleType())]))
    assert nan_to_null(df).where("x is null").count() == 1
