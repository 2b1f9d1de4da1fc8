"""Cases that earlier versions got wrong."""

import pytest
from pyspark.sql import functions as F

from decimal import Decimal

from riskloom.operators import evaluate as E
from riskloom.operators import split as SP
from riskloom.operators.clean import fit_mean, fit_median, fit_mode
from riskloom.operators.features import SparseOneHot
from riskloom.operators.neighbors import nearest
from riskloom.operators.profile import describe
from riskloom.operators.relational import is_small
from riskloom.plans import models as M
from riskloom.plans.models import MAX_DEPTH, _depth
from riskloom.session import fresh_path
from riskloom.sources.csv import read_csv, write_csv


def test_csv_gives_back_quotes_line_breaks_and_times(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-1, 'he said ""hi"",\n"x"\\'), (-2, None), (-3, "  both ends\t "), (-4, "")], "doc_id long, text string")
    rows = docs.unionByName(odd).withColumn("ts", F.expr("timestamp'2020-01-02 03:04:05.123456'"))
    path = fresh_path(spark, "csv")
    write_csv(rows, path)
    rows = rows.withColumn("text", F.when(F.col("text") != "", F.col("text")))  # an empty cell is null
    back = read_csv(spark, path, "doc_id bigint, text string, ts timestamp").withColumnRenamed("row_id", "doc_id")
    assert back.exceptAll(rows).count() == 0 and rows.exceptAll(back).count() == 0


def test_csv_without_line_breaks_is_split_over_tasks(spark):
    rows = spark.range(60_000).select("id", F.concat(F.lit('a "quoted", '), F.col("id")).alias("b")).coalesce(1)
    path = fresh_path(spark, "csv")
    write_csv(rows, path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        whole = read_csv(spark, path, "id bigint, b string", row_key=None)
        parts = read_csv(spark, path, "id bigint, b string", row_key=None, line_breaks=False)
        assert whole.select(F.spark_partition_id()).distinct().count() == 1
        assert parts.select(F.spark_partition_id()).distinct().count() > 4
        assert parts.exceptAll(rows).count() == 0 and parts.count() == whole.count() == 60_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    broken = fresh_path(spark, "csv")
    write_csv(spark.createDataFrame([(1, "x\ny")], "a long, b string"), broken)
    with pytest.raises(Exception):
        read_csv(spark, broken, "a bigint, b string", line_breaks=False).collect()


def test_csv_reports_a_cell_that_does_not_fit(spark):
    path = fresh_path(spark, "csv")
    write_csv(spark.createDataFrame([(1, "x7")], "a long, b string"), path)
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read_csv(spark, path, "a bigint, b double").collect()


def test_fills_keep_their_fraction(spark):
    rows = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    for fit in (fit_mean, fit_median):
        assert sorted(r.a for r in fit(rows, ["a"]).transform(rows).collect()) == [1.0, 1.5, 2.0]


def test_depth_beyond_the_limit_raises():
    assert _depth(None) == MAX_DEPTH and _depth(5) == 5
    with pytest.raises(ValueError):
        _depth(MAX_DEPTH + 1)


def test_null_keys_stay_in_curves_and_draws(spark):
    pred = spark.createDataFrame([(m, y, s) for m in (None, "a") for y, s in ((1, 0.9), (0, 0.2))], "model string, label int, score double")
    assert {(r.model, r.auc_roc) for r in E.areas(pred, ["model"]).collect()} == {(None, 1.0), ("a", 1.0)}
    members = spark.createDataFrame([(g, i) for g in (None, "a") for i in range(10)], "grp string, id long")
    drawn = SP.bootstrap_groups(members, ["grp"], "id", 1.0).groupBy("grp").agg(F.sum("mult").alias("n")).collect()
    assert {(r.grp, r.n) for r in drawn} == {(None, 10), ("a", 10)}


def test_nan_is_no_value_of_a_profile(spark):
    rows = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (float("nan"),), (None,)], "a double")
    got = describe(rows).first()
    assert (got["count"], got["mean"], got["median"], got["max"]) == (3, 2.0, 2.0, 3.0)


def test_mode_of_a_decimal_keeps_its_digits(spark):
    value = Decimal("12345678901234567890.12")
    rows = spark.createDataFrame([(value,), (value,), (Decimal("1.00"),), (None,)], "a decimal(30,2)")
    assert sorted(r.a for r in fit_mode(rows, ["a"]).transform(rows).collect()) == [Decimal("1.00"), value, value, value]


def test_neighbours_at_tiny_distances(spark):
    queries = spark.createDataFrame([(0, [1.1e-5])], "qid long, x array<double>")
    points = spark.createDataFrame([(1, [0.0]), (2, [1e-5])], "cid long, x array<double>")
    found = nearest(queries, points).first()
    assert found.cid == 2 and 0 < found.dist < 1e-11


def test_wide_sides_are_not_small(spark):
    rows = spark.range(100).withColumn("x", F.sequence(F.lit(1), F.lit(1000)))
    assert is_small(rows) and not is_small(rows, size=100_000) and not is_small(rows, rows=99)
    assert not is_small(spark.range(10).withColumn("t", F.repeat(F.lit("x"), 1000)), size=5_000) and is_small(rows.limit(0))


def test_sparse_one_hot_has_no_bound_and_aligns(spark):
    train = spark.range(3000).select(F.col("id").alias("row_id"), F.concat(F.lit("c"), "id").alias("c"), F.lit("x").alias("d"))
    step = SparseOneHot(["c", "d"], "row_id").fit(train)
    test = spark.createDataFrame([(0, "c7", "x"), (1, "new", None), (2, None, "x")], "row_id long, c string, d string")
    got = {r.row_id: r.one_hot for r in step.transform(test).collect()}
    place = {(r.column, r.value): r["at"] for r in step.categories.collect()}
    assert step.size == 3001 and {v.size for v in got.values()} == {3001}
    assert [sorted(got[i].indices.tolist()) for i in range(3)] == [sorted([place["c", "c7"], place["d", "x"]]), [], [place["d", "x"]]]
    rows = train.withColumn("label", (F.col("row_id") % 2).cast("int"))
    data = step.transform(rows)
    pred = M.fit_predict("logistic", data, data, ["one_hot"], {"C": 10.0})
    assert pred.where("pred = label").count() == 3000


def test_unknown_parameters_raise():
    for kind, name in (("logistic", "penalty"), ("gbt", "subsample"), ("bagging", "max_sample")):
        with pytest.raises(ValueError, match=name):
            M.check_parameters(kind, {name: 1})


def test_bagging_joins_the_train_table_once(spark):
    rows = spark.range(200).select(F.col("id").alias("row_id"), (F.col("id") % 2).alias("label"), (F.col("id") % 2 + F.rand(1)).alias("a"))
    joins = []
    kept, M.placed = M.placed, lambda data: joins.append(data) or kept(data)
    try:
        pred = M.fit_predict("bagging", rows, rows, ["a"], {"n_estimators": 4, "max_samples": 0.5}, seed=3)
    finally:
        M.placed = kept
    assert len(joins) == 2 and pred.where("pred = label").count() > 150  # the rows as given, and once with all draws
