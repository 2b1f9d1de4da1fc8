"""Approximate nearest neighbours in robust-pruned directed graphs.

Equal vectors are one point with its smallest ids. Points are dealt to shards of bounded
size by the hash of the vector; every shard gets a directed graph of its own. Points are
inserted in batches: a beam search from the medoid proposes neighbours, pruning walks
through them by distance and drops each one that a kept neighbour is nearer to by the
factor ``RELAX``, so that long edges survive; edges are added both ways and pruned again
where a point has too many. A second pass with the finished graph refines the edges.

A query visits all shards. Within one it is a beam search; the points of all beams are
scored exactly, in double precision, on the vectors as given. Graphs live on unit vectors,
where nearness by cosine and by distance agree.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import partitions, quoted

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHARD, DEGREE, BUILD_BEAM, SEARCH_BEAM, RELAX = 4096, 32, 64, 96, 1.2
STEP = 512


def beam_search(unit: np.ndarray, edges: np.ndarray, entry: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(points, distances) of each query's beam, nearest first; -1 and inf where it has fewer.

    All queries advance together, each by the nearest point it has not expanded.
    """
    n, m = len(unit), len(queries)
    beam = min(beam, n)
    at = np.full((m, beam), -1, np.int64)
    far = np.full((m, beam), np.inf, np.float32)
    open_ = np.zeros((m, beam), bool)
    seen = np.zeros((m, n + 1), bool)
    seen[:, n] = True  # edges that are not there point behind the last row
    at[:, 0] = entry
    far[:, 0] = 2 - 2 * (queries @ unit[entry])
    open_[:, 0] = True
    seen[:, entry] = True
    rows = np.arange(m)
    while len(rows):
        pick = np.argmax(open_[rows], axis=1)
        go = open_[rows, pick]
        rows, pick = rows[go], pick[go]
        if not len(rows):
            break
        open_[rows, pick] = False
        near = edges[at[rows, pick]]
        new = ~seen[rows[:, None], near]
        seen[rows[:, None], near] = True
        d = 2 - 2 * np.einsum("ijk,ik->ij", unit[np.minimum(near, n - 1)], queries[rows])
        d[~new] = np.inf
        every = np.concatenate([far[rows], d], axis=1)
        best = np.argsort(every, axis=1, kind="stable")[:, :beam]
        far[rows] = np.take_along_axis(every, best, 1)
        at[rows] = np.take_along_axis(np.concatenate([at[rows], near], axis=1), best, 1)
        open_[rows] = np.take_along_axis(np.concatenate([open_[rows], new], axis=1), best, 1) & np.isfinite(far[rows])
    at[~np.isfinite(far)] = -1
    return at, far


def prune(unit: np.ndarray, point: np.ndarray, near: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """Diverse neighbours of each point out of ``near`` (len(unit) where there is none)."""
    n = len(unit)
    near = np.where((near < 0) | (near == point[:, None]), n, near)
    near = np.sort(near, axis=1)
    near[:, 1:][near[:, 1:] == near[:, :-1]] = n
    x = unit[np.minimum(near, n - 1)]
    far = 2 - 2 * np.einsum("ijk,ik->ij", x, unit[point])
    far[near == n] = np.inf
    by = np.argsort(far, axis=1, kind="stable")
    near, far = np.take_along_axis(near, by, 1), np.take_along_axis(far, by, 1)
    x = np.take_along_axis(x, by[:, :, None], 1)
    between = 2 - 2 * (x @ x.transpose(0, 2, 1))
    alive = np.isfinite(far)
    out = np.full((len(point), degree), n, np.int64)
    rows = np.arange(len(point))
    for k in range(degree):
        pick = np.argmax(alive, axis=1)
        have = alive[rows, pick]
        if not have.any():
            break
        out[have, k] = near[rows, pick][have]
        # what the kept one is nearer to, by the factor, goes; distances are squared
        alive &= ~((relax * relax * between[rows, pick] <= far) & have[:, None])
        alive[rows, pick] = False
    return out


def build(unit: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, relax: float = RELAX) -> tuple[np.ndarray, int]:
    """(edges, entry) of the graph over the rows of ``unit``; missing edges are len(unit)."""
    n = len(unit)
    edges = np.full((n, degree), n, np.int64)
    entry = int(np.argmax(unit @ unit.mean(axis=0)))
    order = np.random.default_rng(7).permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    for turn, factor in enumerate((1.0, relax)):
        at = 1 if turn == 0 else 0
        while at < n:
            # early batches are small: their points see a graph of at least their own number
            some = order[at : at + (min(STEP, max(1, at)) if turn == 0 else STEP)]
            at += len(some)
            found, _ = beam_search(unit, edges, entry, unit[some], beam)
            edges[some] = prune(unit, some, np.concatenate([found, edges[some]], axis=1), degree, factor)
            _back(unit, edges, some, degree, factor)
    return edges, entry


def _back(unit: np.ndarray, edges: np.ndarray, some: np.ndarray, degree: int, relax: float) -> None:
    """Edges back from the neighbours, pruned where there are too many."""
    n = len(unit)
    to, origin = edges[some].ravel(), np.repeat(some, degree)
    real = to < n
    to, origin = to[real], origin[real]
    by = np.argsort(to, kind="stable")
    to, origin = to[by], origin[by]
    heads = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]])) if len(to) else np.zeros(0, np.int64)
    counts = np.diff(np.append(heads, len(to)))
    for width in (8, 32, 128, 1 << 30):  # points with about as many new edges together
        low = 0 if width == 8 else width // 4 if width <= 128 else 128
        which = np.flatnonzero((counts > low) & (counts <= width))
        for at in range(0, len(which), STEP):
            w = which[at : at + STEP]
            most = int(counts[w].max())
            new = np.full((len(w), most), n, np.int64)
            inside = np.arange(most) < counts[w][:, None]
            new[inside] = origin[(heads[w][:, None] + np.arange(most))[inside]]
            point = to[heads[w]]
            merged = np.concatenate([edges[point], new], axis=1)
            edges[point] = prune(unit, point, merged, degree, relax)


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times a power of two that brings its largest component near one: its square cannot overflow or vanish."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1))
    half = exponent // 2
    return np.ldexp(np.ldexp(vectors, -half[:, None]), -(exponent - half)[:, None])


def _search(k: int, dim_beam: int, degree: int, build_beam: int):
    """Rows of a shard come first, then its queries; both in bounded batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, ids, raw, index = None, [], [], None
        for batch in batches:
            # vectors of one length are a shard of their own
            shards = batch.column("shard").to_numpy().astype(np.int64) << 32 | batch.column("dims").to_numpy()
            kinds = batch.column("kind").to_numpy()
            change = np.flatnonzero(np.concatenate([[True], (shards[1:] != shards[:-1]) | (kinds[1:] != kinds[:-1])]))
            for a, z in zip(change.tolist(), [*change[1:].tolist(), batch.num_rows]):
                part = batch.slice(a, z - a)
                vectors = _scaled(np.array(part.column("v").to_pylist(), np.float64))
                if kinds[a] == 0:
                    if shards[a] != shard:
                        shard, ids, raw, index = shards[a], [], [], None
                    ids += part.column("ids").to_pylist()
                    raw.append(vectors)
                    continue
                if shards[a] != shard:
                    continue  # an empty shard
                if index is None:
                    points = np.concatenate(raw)
                    norm = np.linalg.norm(points, axis=1)
                    unit = (points / norm[:, None]).astype(np.float32)
                    index = (points, norm, unit, *build(unit, degree, build_beam))
                points, norm, unit, edges, entry = index
                for b in range(0, len(vectors), STEP):
                    q, own = vectors[b : b + STEP], part.column("id").slice(b, STEP).to_pylist()
                    size = np.linalg.norm(q, axis=1)
                    found, _ = beam_search(unit, edges, entry, (q / size[:, None]).astype(np.float32), dim_beam)
                    rows = []
                    for j, near in enumerate(found):
                        near = near[near >= 0]
                        cosine = points[near] @ q[j] / (norm[near] * size[j])
                        best = sorted(((-c, i) for c, p in zip(cosine.tolist(), near.tolist()) for i in ids[p] if i != own[j]))[:k]
                        rows += [(own[j], i, -c) for c, i in best]
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.float64()))], names=["query_id", "vec_id", "score"])

    return run


def nearest(
    vectors: DataFrame, every: int = 50, k: int = 5, key: str = "vec_id", vector: str = "embedding",
    shard: int = SHARD, beam: int = SEARCH_BEAM, degree: int = DEGREE, build_beam: int = BUILD_BEAM,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest by cosine of the rows whose key ``every`` divides.

    Nearest first, ties to the smaller key. Vectors that are null, zero, or hold null or
    non-finite components take no part; nor do rows without key. A query meets vectors of its
    own length only; a shorter table gives fewer ranks.
    """
    v = F.col(quoted(vector))
    fine = v.isNotNull() & F.col(quoted(key)).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    # minus zero is zero
    plain = F.transform(v, lambda x: x.cast("double") + F.lit(0.0))
    rows = vectors.where(fine).select(F.col(quoted(key)).cast("long").alias("id"), plain.alias("v"))
    # k + 1 ids of a point are all that can be asked for: one may be the query's own
    first = rows.withColumn("place", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("place") <= k + 1)
    points = first.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    shards = max(1, -(-rows.count() // shard))
    placed = points.select(F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("id"), "ids", F.size("v").alias("dims"), "v")
    asked = rows.where(F.col("id") % every == 0).select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"), "id", F.lit(None).cast("array<long>").alias("ids"), F.size("v").alias("dims"), "v"
    )
    dealt = placed.unionByName(asked).repartition(max(shards, 1), "shard").sortWithinPartitions("shard", "dims", "kind", F.col("ids")[0], "id")
    found = dealt.mapInArrow(_search(k, beam, degree, build_beam), "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
