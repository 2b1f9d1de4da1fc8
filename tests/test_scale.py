"""Orders, quantiles, joins and neighbours against brute force, with hot keys and small limits."""

import random
from functools import reduce
from operator import add

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import neighbors as N
from riskloom.operators import relational as R
from riskloom.operators.order import dense_positions, running_totals
from riskloom.operators.quantile import exact_quantiles


def skewed(n, seed=0):
    """A third of the values are the same one."""
    rnd = random.Random(seed)
    return [7.0 if rnd.random() < 1 / 3 else round(rnd.gauss(10, 5), 3) for _ in range(n)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("limit", [1 << 20, 40, 1])
def test_quantiles_equal_numpy_however_small_the_limit(spark, limit):
    values = skewed(5000)
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 20, "x double").repartition(8)
    probs = [0, 0.01, 0.25, 0.31, 0.5, 0.66, 0.99, 1]
    got = exact_quantiles(df, ["x"], probs, distinct_limit=limit, accuracy=100)["x"]
    assert [got[p] for p in probs] == pytest.approx(list(np.quantile(values, probs)), abs=1e-9)


def test_quantiles_of_empty_and_constant_columns(spark):
    df = spark.createDataFrame([(None, 2.0), (None, 2.0)], "e double, c double")
    assert exact_quantiles(df, ["e", "c"], [0.5]) == {"e": {0.5: None}, "c": {0.5: 2.0}}


def test_dense_positions_with_a_hot_leading_key(spark):
    rows = [(0 if i % 3 else i, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, id bigint").repartition(8)
    got = [(r["k"], r["id"]) for r in dense_positions(df, ["k", "id"]).orderBy("pos").collect()]
    assert got == sorted(rows)
    assert dense_positions(df, ["k", "id"]).agg(F.min("pos"), F.max("pos")).first()[:] == (0, 2999)
    down = dense_positions(df, ["k", "id"], descending=["k"]).orderBy("pos").collect()
    assert [(r["k"], r["id"]) for r in down] == sorted(rows, key=lambda r: (-r[0], r[1]))


def test_dense_positions_of_nothing(spark):
    assert dense_positions(spark.createDataFrame([], "k int"), ["k"]).count() == 0


def test_positions_are_never_numbered_in_one_task(spark):
    df = spark.range(1000).select(F.col("id"))
    assert "SinglePartition" not in plan(dense_positions(df, ["id"]))


def test_running_totals_with_a_hot_group(spark):
    rnd = random.Random(3)
    rows = [("hot" if i % 3 else f"g{i % 7}", i, rnd.randint(0, 9)) for i in range(4000)]
    df = spark.createDataFrame(rows, "g string, o int, v int").repartition(8)
    got = {(r["g"], r["o"]): (r["cum_v"], r["total_v"]) for r in running_totals(df, ["g"], ["o"], ["v"]).collect()}
    want, total = {}, {}
    for g, o, v in sorted(rows):
        total[g] = total.get(g, 0) + v
        want[g, o] = total[g]
    assert got == {k: (c, total[k[0]]) for k, c in want.items()}


@pytest.mark.parametrize("limit", [1000, 0])
def test_lookup_join_with_a_hot_key(spark, limit):
    df = spark.range(2000).selectExpr("id as row_id", "if(id % 3 = 0, 0, id % 50) as k")
    side = spark.range(60).selectExpr("id as k", "id * 10 as v")
    out = R.lookup_join(df, side, ["k"], "row_id", parts=8, broadcast_rows=limit)
    assert out.count() == 2000
    assert out.where("v <> k * 10 or v is null").count() == 0
    if limit == 0:
        assert R.hot_hashes(df, ["k"], 8) != []
        assert "BroadcastNestedLoopJoin" not in plan(out)


def test_upsert_last_write_wins(spark):
    a = spark.createDataFrame([("m", 1.0), ("n", 2.0)], "model string, v double")
    b = spark.createDataFrame([("m", 9.0)], "model string, v double")
    assert {tuple(r) for r in R.upsert(R.upsert(a, b, ["model"]), b, ["model"]).collect()} == {("m", 9.0), ("n", 2.0)}


def test_grid_and_subsets():
    assert R.value_combinations({"a": [1, 2], "b": ["x"]}) == [{"a": 1, "b": "x"}, {"a": 2, "b": "x"}]
    assert R.feature_subsets("abc") == [("a",), ("b",), ("c",), ("a", "b"), ("a", "c"), ("b", "c"), ("a", "b", "c")]


def brute(queries, cands, k):
    out = {}
    for q, x in queries:
        d = sorted((reduce(add, [(a - b) * (a - b) for a, b in zip(x, y)]), c) for c, y in cands)
        out[q] = d[:k]
    return out


@pytest.mark.parametrize("k,block,dims", [(1, 4096, 2), (1, 16, 2), (3, 16, 2), (5, 20, 6)])
def test_nearest_equals_brute_force(spark, k, block, dims):
    rng = np.random.default_rng(k + dims)
    cands = [(i, [7.0] * dims if i % 3 == 0 else (rng.integers(0, 12, dims) * 1.0).tolist()) for i in range(300)]
    queries = [(1000 + i, [7.0] * dims if i % 3 == 0 else rng.normal(6, 4, dims).round(2).tolist()) for i in range(90)]
    found = N.nearest(
        spark.createDataFrame(queries, "qid bigint, x array<double>"),
        spark.createDataFrame(cands, "cid bigint, x array<double>"),
        k,
        block,
    ).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["qid"], r["rank"])):
        got.setdefault(r["qid"], []).append((r["dist"], r["cid"]))
    assert got == brute(queries, cands, k)


def test_nearest_with_fewer_candidates_than_k(spark):
    q = spark.createDataFrame([(1, [0.0])], "qid bigint, x array<double>")
    c = spark.createDataFrame([(5, [1.0]), (6, [2.0])], "cid bigint, x array<double>")
    assert [r["cid"] for r in N.nearest(q, c, 5).orderBy("rank").collect()] == [5, 6]
    assert N.nearest(q, c.limit(0), 5).count() == 0


def test_impute_nearest_ties_and_nulls(spark):
    rows = [(1, 0.0, 10.0), (2, 2.0, 20.0), (3, 1.0, None), (4, None, None), (5, 2.0, None), (6, None, 5.0)]
    df = spark.createDataFrame(rows, "row_id bigint, r double, v double")
    out = N.impute_nearest(df, "v", ["r"], "row_id").collect()
    assert [(r["row_id"], r["v"]) for r in out] == [(1, 10.0), (2, 20.0), (3, 10.0), (4, None), (5, 20.0), (6, 5.0)]


@pytest.mark.parametrize("group", [["g"], [], ["g", "h"]])
def test_running_totals_equal_windows(spark, group):
    rnd = random.Random(4)
    rows = [(rnd.choice([None, "a", "a", "b", "c"]), i % 2, i, rnd.randrange(9), rnd.choice([None, 0.5, 2.0])) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, h int, o long, v int, x double").repartition(8)
    got = running_totals(df, group, ["o"], ["v", "x"], descending=["o"]).collect()
    want, total = {}, {}
    for r in sorted(rows, key=lambda r: -r[2]):
        key = tuple(r[["g", "h"].index(c)] for c in group)
        v, x = total.get(key, (0, 0.0))
        total[key] = (v + r[3], x + (r[4] or 0.0))
        want[r[2]] = total[key]
    assert {r["o"]: (r["cum_v"], r["cum_x"]) for r in got} == want
    assert all((r["total_v"], r["total_x"]) == total[tuple(r[c] for c in group)] for r in got)


def test_running_totals_exchange_rows_once(spark):
    """What is read behind the written totals is not dealt again, whatever the number of groups."""
    df = spark.range(5000).select((F.col("id") % 1000).alias("g"), F.col("id").alias("o"), F.lit(1).alias("v"))
    made = running_totals(df, ["g"], ["o"], ["v"])
    text = plan(made)
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text and "Window" not in text
    assert "BroadcastHashJoin" in text
    assert running_totals(df.limit(0), ["g"], ["o"], ["v"]).count() == 0


def brute_near(q, c, k):
    out = {}
    for i, x in q:
        out[i] = [j for _, j in sorted((sum((a - b) ** 2 for a, b in zip(x, y)), j) for j, y in c)][:k]
    return out


@pytest.mark.parametrize("dims,k", [(2, 3), (64, 2)])
def test_neighbours_by_pivots(spark, dims, k, monkeypatch):
    """Clusters in few and many dimensions: exact, and most pairs of query and cell are never looked at."""
    rng = np.random.default_rng(dims)
    centres = rng.normal(size=(12, dims)) * 10
    cands = [(i, (centres[i % 12] + rng.normal(size=dims) * 0.3).tolist()) for i in range(900)]
    cands += [(900 + i, cands[5][1]) for i in range(60)]
    queries = [(i, (centres[i % 12] + rng.normal(size=dims) * 0.3).tolist()) for i in range(120)] + [(500, [0.0] * dims), (501, cands[5][1])]
    made = []
    pairs = N._pairs
    monkeypatch.setattr(N, "_pairs", lambda *a: made.append(pairs(*a)) or made[-1])
    got = {}
    for r in N.nearest(spark.createDataFrame(queries, "qid long, x array<double>"), spark.createDataFrame(cands, "cid long, x array<double>"), k, 20).collect():
        got.setdefault(r.qid, {})[r["rank"]] = r.cid
    assert {q: [v[i] for i in sorted(v)] for q, v in got.items()} == brute_near(queries, cands, k)
    # numbers only, and far fewer than queries times cells
    assert all(p.columns == ["qid", "box"] for p in made)
    assert 0 < sum(p.count() for p in made) < 120 * 20


def test_cells_split_until_a_block_holds_them(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "cid long, x array<double>")
    cells = N._build(df, 3000, 3, 4)
    leaf, path = cells.locate(np.array([x for _, x in rows]))
    assert len(path) > 1 and np.unique(leaf, return_counts=True)[1].max() <= 8
    N._measure(cells, df)
    assert (cells.low[leaf] <= path[-1][1] + 1e-9).all() or len(path) > 2


def test_random_projections_reach_their_recall(spark):
    """Clusters, one of them a third of all points: at least nine of ten true neighbours are found."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 32))
    place = [0 if i % 3 == 0 else i % 30 for i in range(1500)]
    cands = [(i, (centres[p] + rng.normal(size=32) * 0.4).tolist()) for i, p in enumerate(place)]
    queries = [(i, (centres[i % 30] + rng.normal(size=32) * 0.4).tolist()) for i in range(90)]
    want = brute_near(queries, cands, 5)
    q, c = spark.createDataFrame(queries, "qid long, x array<double>"), spark.createDataFrame(cands, "cid long, x array<double>")
    got = {}
    for r in N.approx_nearest(q, c, 5, block=200).collect():
        got.setdefault(r.qid, []).append(r.cid)
        assert abs(r.dist - sum((a - b) ** 2 for a, b in zip(queries[r.qid][1], cands[r.cid][1]))) < 1e-9
    assert sum(len(set(got.get(i, [])) & set(want[i])) for i in want) >= 0.9 * 5 * len(want)
    assert all(len(v) == len(set(v)) <= 5 for v in got.values())
    assert N.approx_nearest(q, c.limit(0), 5).count() == 0


def test_quantiles_of_ids_are_exact(spark):
    from riskloom.operators.profile import whole_ranges

    top = 1 << 53
    df = spark.createDataFrame([(top + i, "x") for i in (1, 3, 5, 8)] + [(None, "x")], "id long, t string")
    row = whole_ranges(df).first()
    assert (row["min"], row["max"], row["count"]) == (top + 1, top + 8, 4)
    assert [str(row[c]) for c in ("p25", "median", "p75")] == [f"{top + 2}.50", f"{top + 4}.00", f"{top + 5}.75"]
    many = spark.range(3000).select((F.col("id") * 7 + (1 << 60)).alias("id"))
    assert exact_quantiles(many, ["id"], [0.5])["id"][0.5] == float((1 << 60) + 7 * 2999 // 2)
    assert str(whole_ranges(many, distinct_limit=50).first()["median"]) == f"{(1 << 60) + 7 * 1499 + 3}.50"
    with pytest.raises(ValueError):
        whole_ranges(df, ["t"])


def test_recipe_goes_over_to_sparse_vectors(spark):
    from riskloom.plans import recipe as RC

    rows = [(i, f"c{i % 3000}", i % 2 == 0, float(i)) for i in range(4000)]
    df = spark.createDataFrame(rows, "row_id long, c string, f boolean, x double")
    step = RC.FeatureRecipe(one_hot_cols=["c"], matches=[("c_c7", "f", "same")]).fit(df)
    out = step.transform(df)
    assert out.columns == ["row_id", "f", "x", "same", "one_hot"] or set(out.columns) == {"row_id", "f", "x", "same", "one_hot"}
    got = {r.row_id: r for r in out.where("row_id < 20").collect()}
    assert len(got) == 20 and all(v.one_hot.size == 3000 and v.one_hot.numNonzeros() == 1 for v in got.values())
    assert all(got[i].same == int((i == 7) == (i % 2 == 0)) for i in got)
    few = RC.FeatureRecipe(one_hot_cols=["c"], sparse=True).fit(df.where("row_id < 5")).transform(df.where("row_id in (1, 9)"))
    assert sorted((r.row_id, r.one_hot.numNonzeros()) for r in few.collect()) == [(1, 1), (9, 0)]


def test_a_limit_and_a_rough_distance_lose_no_neighbour():
    """Far from zero, with ties: the same as measuring every pair; a limit leaves out only what is beyond it."""
    rng = np.random.default_rng(5)
    c, q = rng.integers(0, 4, (300, 3)) + 1e6, rng.integers(0, 4, (50, 3)) + 1e6
    cid = rng.permutation(300)
    row, dist, col = N._nearest(q, c, cid, 7)
    every = ((q[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
    for i in range(50):
        want = sorted(zip(every[i], cid))[:7]
        assert list(zip(dist[row == i], cid[col[row == i]])) == want
    limit = np.full(50, 2.0)
    row, dist, col = N._nearest(q, c, cid, 300, limit)
    for i in range(50):
        got = set(zip(dist[row == i], cid[col[row == i]]))
        assert {(d, n) for d, n in zip(every[i], cid) if d <= 2} <= got


def test_points_are_located_without_a_pass_for_each_cell(monkeypatch):
    """A batch is sorted by cell once a level; it is not searched for every cell."""
    rng = np.random.default_rng(1)
    cells = N._Cells(2)
    cells.split(0, rng.random((60, 2)))
    for kid in list(cells.kids[0]):
        cells.split(int(kid), rng.random((5, 2)))
    monkeypatch.setattr(N.np, "unique", lambda *a, **k: pytest.fail("searched"))
    leaf, path = cells.locate(rng.random((500, 2)))
    assert len(path) == 2 and (leaf == path[1][0]).all()
