"""Profiles, histograms and splits."""

import pytest
from pyspark.sql import functions as F

from riskloom.operators import profile as P
from riskloom.operators import split as SP


def one(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def test_describe(spark):
    row = P.describe(one(spark, [1.0, 2.0, 3.0, 4.0, None])).first()
    assert (row["count"], row["p25"], row["median"], row["p75"]) == (4, 1.75, 2.5, 3.25)
    assert row["std"] == pytest.approx(1.290994, abs=1e-6)


def test_profile_of_text_has_only_mode_and_missing(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 2)], "s string, n int")
    rows = {r["column"]: r for r in P.profile(df).collect()}
    assert (rows["s"]["mode_text"], rows["s"]["missing"], rows["s"]["mean"]) == ("a", 1, None)
    assert (rows["n"]["mode_num"], rows["n"]["max"]) == (2.0, 2.0)
    masked = {r["column"]: r for r in P.mask_profile(P.profile(df), "n").collect()}
    assert masked["n"]["mean"] is not None and masked["n"]["max"] is None and masked["s"]["mode_text"] == "a"


def test_rounding_is_half_even(spark):
    df = spark.createDataFrame([(2.5, 0.125)], "a double, b double")
    assert P.round_half_even(df.select("a"), 0).first()[0] == 2.0
    assert P.round_half_even(df.select("b"), 2).first()[0] == 0.12


def test_histograms(spark):
    counts = [r["count"] for r in P.histogram(one(spark, [0.0, 2.0, 4.0, 10.0, None]), "x", 5).orderBy("bin").collect()]
    assert counts == [1, 1, 1, 0, 1]
    counts = [r["count"] for r in P.histogram_edges(one(spark, [0.0, 2.0, 9.0]), "x", [0, 1, 2]).orderBy("bin").collect()]
    assert counts == [1, 1]
    assert P.histogram(one(spark, [4.0, 4.0]), "x", 3).agg(F.sum("count")).first()[0] == 2


def test_truncated_histograms(spark):
    df = one(spark, [float(i) for i in range(101)])
    assert P.histogram_truncated(df, "x", 0.99).agg(F.sum("count"), F.max("hi")).first()[:] == (99, 98.0)
    assert P.histogram_truncated(df, "x", 0.99, drop_rows=False).agg(F.sum("count"), F.max("hi")).first()[:] == (100, 99.0)


def test_counts_leave_out_nulls(spark):
    df = one(spark, ["b", "a", "b", None], "string")
    assert [tuple(r) for r in P.value_counts(df, "x").collect()] == [("b", 2), ("a", 1)]
    assert [tuple(r) for r in P.group_sizes(df, "x").collect()] == [("a", 1), ("b", 2)]
    assert tuple(P.null_crosstab(df).first()) == ("x", 3, 1)
    assert P.columns_with_missing(df).first()[0] == 1


def test_filter_below_quantile_is_pushed_to_the_scan(spark, sf):
    df = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_extendedprice")
    text = P.filter_below_quantile(df, "l_extendedprice", 0.99)._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(l_extendedprice" in text
    assert "struct<l_orderkey:bigint,l_extendedprice:double>" in text


def test_time_split_leaves_out_unknown_years(spark):
    df = one(spark, [1999, 2000, 2001, None], "int")
    assert [(r["x"], r["role"]) for r in SP.time_split(df, "x", 1999).orderBy("x").collect()] == [
        (1999, "train"),
        (2000, "test"),
        (2001, "test"),
    ]
    assert SP.cv_split(df, "x", 1999, 2000).count() == 2
    train, test = SP.role_frames(SP.time_split(df, "x", 1999))
    assert (train.count(), test.count()) == (1, 2)


def test_sequential_spans():
    spans = SP.sequential_spans(100, 5, 0.4, 0.8)
    assert [s.train_start for s in spans] == [0, 15, 30, 45, 60]
    assert {(s.test_start - s.train_start, s.end - s.test_start) for s in spans} == {(32, 8)}
    assert [s.train_start for s in SP.sequential_spans(97, 5, 0.4, 0.8)] == [0, 15, 30, 45, 58]
    with pytest.raises(ValueError):
        SP.sequential_spans(100, 1, 0.4, 0.8)
    with pytest.warns(UserWarning):
        SP.sequential_spans(100, 10, 0.9, 0.5)


def test_sequential_folds_sizes(spark):
    df = spark.range(100).selectExpr("id", "100 - id as t")
    out = SP.sequential_folds(df, ["t", "id"], "id", 5, 0.4, 0.8)
    sizes = {(r["fold"], r["role"]): r["count"] for r in out.groupBy("fold", "role").count().collect()}
    assert sizes == {(f, r): n for f in range(5) for r, n in (("train", 32), ("test", 8))}
    last = out.where("fold = 4 and role = 'test'").agg(F.min("id"), F.max("id")).first()
    assert last[:] == (0, 7)


@pytest.mark.parametrize("shuffled", [True, False])
def test_kfold_sizes_differ_by_at_most_one(spark, shuffled):
    df = spark.range(103).repartition(7)
    out = SP.kfold_shuffled(df, "id", 5, 1) if shuffled else SP.kfold_contiguous(df, ["id"], "id", 5)
    sizes = {r["fold"]: r["count"] for r in out.groupBy("fold").count().collect()}
    assert sizes == {0: 21, 1: 21, 2: 21, 3: 20, 4: 20}
    if not shuffled:
        assert out.where("fold = 0").agg(F.max("id")).first()[0] == 20


def test_splits_do_not_depend_on_partitioning(spark):
    a, b = spark.range(0, 500, 1, 3), spark.range(0, 500, 1, 8).repartition(5)
    for f in (
        lambda d: SP.kfold_shuffled(d, "id", 4, 9),
        lambda d: SP.random_holdout(d, "id", 0.25, 9),
        lambda d: SP.bootstrap(d, "id", 0.8, 9),
    ):
        assert sorted(map(tuple, f(a).collect())) == sorted(map(tuple, f(b).collect()))


def test_bootstrap_size_is_exact(spark):
    out = SP.bootstrap(spark.range(10), "id", 0.8, 3)
    assert out.agg(F.sum("mult")).first()[0] == 8
    assert SP.bootstrap(spark.range(0), "id", 0.8, 3).count() == 0
    assert SP.half_up(2.5) == 3


def test_bootstrap_time_cv_sizes_and_membership(spark):
    df = spark.range(200).selectExpr("id", "cast(2000 + id % 4 as int) as yr")
    out = SP.bootstrap_time_cv(df, "yr", [(2000, 2001), (2001, 2002)], "id", 0.8, 3, 1)
    sums = {(r["fold"], r["role"], r["replicate"]): r["n"] for r in out.groupBy("fold", "role", "replicate").agg(F.sum("mult").alias("n")).collect()}
    assert set(sums) == {(f, r, k) for f in (0, 1) for r in ("train", "test") for k in range(3)}
    assert {sums[0, "train", 0], sums[0, "test", 1]} == {40} and sums[1, "train", 2] == 80
    assert out.where("fold = 0 and role = 'train' and id % 4 <> 0").count() == 0
    assert out.where("fold = 1 and role = 'test' and id % 4 <> 2").count() == 0


def test_every_column_is_profiled_and_agrees_with_sql(spark, sf):
    import duckdb

    import __spark_entry__ as entry
    from riskloom.sources.tables import cohort, table

    db = duckdb.connect()
    for name in ("lineitem", "orders", "customer"):
        db.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    whole = {"column_modes_all": table(spark, sf, "lineitem").columns}
    of_cohort = cohort(spark, sf).columns
    for name in ("profile_stats_all", "profile_masked_all", "column_modes_all", "missing_counts_all", "cols_with_missing_all", "null_crosstab_all"):
        got = entry.queries()[name](spark, sf)
        want = db.execute(entry.oracle_sql()[name])
        names = [c[0] for c in want.description]
        rows = [tuple(r) for r in got.select(*names).collect()]
        assert sorted(rows, key=repr) == sorted(want.fetchall(), key=repr), name
        if "column" in names:
            assert sorted(r[names.index("column")] for r in rows) == sorted(whole.get(name, of_cohort)), name
