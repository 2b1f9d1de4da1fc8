"""Integer k-means with JVM expressions only.

Vectors become integers (floor of ``scale`` times a component) and are written once; that
table holds small numbers and is what every round reads. A round compares each vector with
literal centroid arrays (``zip_with`` and ``aggregate`` give the squared distance,
``array_min`` of (distance, number) the cluster), then one aggregation of column sums, combined
before its shuffle, gives the next centroids: at most ``k`` rows reach the driver, whatever the
input or however many vectors share a cluster. Floors of the means are exact integers.

Sums and squares run in 64 bits if the largest component and the number of rows prove that
they fit, else in decimals. Components beyond +-10^17 (after scaling) count as +-10^17; a
distance or inertia beyond 64 bits is returned as null.

Only vectors with exactly ``dims`` components, none null or not finite, take part; others are
not in the result. Null ids take part but never start a centroid while others can; repeated ids
and vectors are rows of their own. Fewer vectors than ``k`` give as many centroids. An empty
table gives an empty result. Other columns are not returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import quoted, scratch

LIMIT = 10**17
LONG = (1 << 63) - 1


def quantise(vector: Column, dims: int, scale: int) -> Column:
    """The integer vector, or null where the vector takes no part."""
    numbers = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(numbers, lambda x: F.floor(F.least(F.greatest(x * float(scale), F.lit(-float(LIMIT))), F.lit(float(LIMIT)))))
    return F.when((F.size(vector) == dims) & finite, whole)


def nearest(q: str, centroids: Sequence[Sequence[int]], kind: str) -> Column:
    """(distance, cluster) of the nearest centroid; equal distances go to the smaller number."""
    number = "L" if kind == "bigint" else "BD"
    arrays = ["array(" + ",".join(f"{x}{number}" if kind == "bigint" else f"cast({x} as {kind})" for x in c) + ")" for c in centroids]
    zero = f"cast(0 as {kind})"
    listed = ",".join(f"named_struct('c', {a}, 'cluster', {i})" for i, a in enumerate(arrays))
    # a centroid is a literal: the optimiser folds it once per plan
    return F.expr(
        f"array_min(transform(array({listed}), t -> named_struct('distance',"
        f" aggregate(zip_with({q}, t.c, (a, b) -> (a - b) * (a - b)), {zero}, (s, d) -> cast(s + d as {kind})), 'cluster', t.cluster)))"
    )


def _fits(value: int) -> int | None:
    return value if -LONG <= value <= LONG else None


def cluster(
    vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: str = "2", key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(key, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that takes part.

    Centroids start as the ``k`` vectors with the smallest SHA-256 of ``<seed>:<key>``.
    """
    spark = vectors.sparkSession
    made = vectors.select(F.col(quoted(key)).alias("id"), quantise(F.col(quoted(vector)), dims, scale).alias("q")).where("q is not null")
    made = scratch(made, "centroids")
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = made.select(rank.alias("h"), "q").orderBy(F.col("h").asc_nulls_last(), "q").limit(k).collect()
    centroids = [list(r["q"]) for r in first]
    kind_of_id = vectors.schema[key].dataType.simpleString()
    if not centroids:
        return spark.createDataFrame([], f"id {kind_of_id}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string").withColumnRenamed("id", key)
    most, rows = made.agg(F.max(F.array_max(F.transform("q", lambda x: F.abs(x)))), F.count(F.lit(1))).first()
    proven = dims * (2 * most) ** 2 <= LONG and most * rows <= LONG
    kind, total = ("bigint", "bigint") if proven else ("decimal(38,0)", "decimal(38,0)")
    vectors_of = made.select("id", F.col("q") if proven else F.transform("q", lambda x: x.cast("decimal(38,0)")).alias("q"))
    sums = [F.sum(F.element_at("q", i + 1).cast(total)).alias(f"s{i}") for i in range(dims)]
    for _ in range(rounds):
        dealt = vectors_of.select(nearest("q", centroids, kind)["cluster"].alias("cluster"), "q")
        for r in dealt.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect():  # a row per centroid
            centroids[r["cluster"]] = [int(r[f"s{i}"]) // r["n"] for i in range(dims)]
    last = vectors_of.select("id", nearest("q", centroids, kind).alias("n")).select("id", "n.cluster", "n.distance")
    last = scratch(last, "centroids")
    inertia = {r["cluster"]: int(r["s"]) for r in last.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    per = [(i, _fits(inertia.get(i, 0)), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids)]
    inertias = F.array(*[F.lit(s).cast("bigint") for _, s, _ in per])
    shas = F.array(*[F.lit(h) for *_, h in per])
    at = F.col("cluster") + 1
    return last.select(
        F.col("id").alias(key), "cluster", F.expr("try_cast(distance as bigint)").alias("distance"),
        F.element_at(inertias, at).alias("cluster_inertia"), F.lit(_fits(sum(inertia.values()))).cast("bigint").alias("inertia"),
        F.element_at(shas, at).alias("centroid_sha256"),
    )
