from pyspark.sql import functions as F

from riskloom.plans import search


def test_splits_of_a_bootstrap_share_one_join(spark):
    rows = spark.createDataFrame([(i, i % 5) for i in range(40)] + [(7, 9), (None, 1)], "row_id long, v int")
    draws = [(f, role, r, (i * (f + 1)) % 40, 1 + i % 3) for f in (0, 1) for role in ("train", "test") for r in (0, 1) for i in range(r, 20)]
    draws = spark.createDataFrame(draws, "fold int, role string, replicate int, row_id long, mult bigint")
    wide = search._with_draws(rows, draws, "row_id", 2)
    for fold in (0, 1):
        for rep in (0, 1):
            got = search._drawn(wide, fold * 2 + rep, "train")
            mine = draws.where((F.col("fold") == fold) & (F.col("replicate") == rep) & (F.col("role") == "train"))
            want = rows.join(mine.select("row_id", "mult"), "row_id")
            assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect())
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert "Join" not in plan and "Exchange" not in plan
            assert search._copies(got).count() == want.agg(F.sum("mult")).first()[0]
