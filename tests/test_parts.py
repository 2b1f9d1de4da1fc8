"""What one task holds does not grow with the table."""

from pyspark.sql import functions as F

from riskloom.operators import order
from riskloom.plans import models as M


def test_running_totals_bound_the_rows_of_a_partition(spark, monkeypatch):
    seen, cut = [], order.cut
    monkeypatch.setattr(order, "TOTAL_ROWS", 100, raising=False)
    monkeypatch.setattr(order, "cut", lambda df: seen.append(cut(df)) or seen[-1])
    rows = spark.range(3000).select((F.col("id") % 2).cast("string").alias("g"), "id", (F.col("id") % 7).alias("v"))
    got = order.running_totals(rows, ["g"], ["id"], ["v"]).orderBy("id").collect()
    assert seen[-1].groupBy("_pid").count().agg(F.max("count")).first()[0] < 300
    sums, want = {}, []
    for i in range(3000):
        sums[i % 2] = sums.get(i % 2, 0) + i % 7
        want.append((i, sums[i % 2]))
    assert [(r["id"], r["cum_v"]) for r in got] == want
    assert all(r["total_v"] == sums[int(r["g"])] for r in got)


def test_bagging_draws_once(spark, monkeypatch):
    rows = spark.range(400).select(F.col("id").alias("row_id"), (F.col("id") % 3 == 0).cast("int").alias("label"), (F.col("id") % 11).alias("a"), (F.col("id") % 5).alias("b"))
    drawn, runs = M._drawn, spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    def watched(*args):
        made = drawn(*args)
        return made.mapInArrow(counted, made.schema)

    monkeypatch.setattr(M, "_drawn", watched)
    train = M.placed(M.assemble(rows, ["a", "b"]))
    params = {"n_estimators": 2, "max_samples": 0.5, "base_estimator": ("tree", {"max_depth": 2})}
    assert len(M.fit("bagging", train, params, ["a", "b"], seed=1).members) == 2
    once = drawn(train, 0.5, 2, 1).count()
    assert runs.value == once


def test_discrete_boosting_writes_and_predicts_no_more_than_it_reads(spark, monkeypatch):
    rows = spark.range(400).select(F.col("id").alias("row_id"), (F.col("id") % 3 == 0).cast("int").alias("label"), (F.col("id") % 7).alias("a"), (F.col("id") % 5).alias("b"))
    train = M.placed(M.assemble(rows, ["a", "b"]))
    seen, checkpoint = [], M.checkpoint
    monkeypatch.setattr(M, "checkpoint", lambda df: seen.append(df) or checkpoint(df))
    fitted = M.fit("adaboost_discrete", train, {"n_estimators": M.CUT_EVERY, "learning_rate": 0.5}, ["a", "b"], seed=1)
    # the table before the first round; nothing reads what the last one would write
    assert len(seen) == 1 and len(fitted.members) == M.CUT_EVERY
    made = set(fitted.members[0][1].transform(train).columns) - set(train.columns)
    assert made == {"prediction"}
