"""Exact nearest neighbours without an all-pairs join.

Candidates are dealt to cells. In up to ``PLANE_DIMS`` dimensions a cell that holds more than a block is
halved across the dimension in which a sample of it spreads most, and so on; each cell knows the smallest and
largest value of its points in every dimension, so the distance to that box bounds from below how near any of
them can be to a query. In more dimensions a cell is split around pivots, a seeded choice of the points
themselves, and knows the smallest and the largest distance of its points to its pivot: the triangle
inequality gives the bound. Boxes or pivots together stay within ``PIVOT_BYTES``.

A query searches its own cell first, then the cells that can still hold a nearer point, nearest
bound first, a few in a round; what a round finds tightens the bound for the next one. The table
of pairs holds numbers only; vectors are met when a cell is searched. The work inside a cell is
numpy on blocks of bounded size: a cell or a query group of any length is split into blocks, and
equal points are merged before the search, so that one hot point costs one row.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.relational import lookup_join, salt_parts
from riskloom.session import cut

# Tasks get the helpers below with their code, so that workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows of each side one task holds at a time.
BLOCK = 4096
# Pivots of one cell at most, and the memory of all of them: the tree is sent to every task.
PIVOTS = 64
PIVOT_BYTES = 128 << 20
# Dimensions in which cells are boxes, points of the sample for each cell to be made, and queries that look for cells at a time.
PLANE_DIMS = 32
SAMPLE = 16
LOOKING = 1024
# Further cells a query searches in the second, third and last round.
# Stands for cells that a later round may have to search.
MORE = -1
ROUNDS = (8, 64, None)
# What the order of additions may change in a distance, relative to it.
SLACK = 1e-9


class _Cells:
    """A tree of pivots, or of planes across a dimension. Node 0 is everything; a node without children is a leaf."""

    def __init__(self, dims: int):
        self.pivot = np.zeros((1, dims))
        self.kids: dict[int, np.ndarray] = {}
        self.low = np.array([0.0])
        self.high = np.array([np.inf])
        # planes: the dimension (-1 in a leaf), where it is cut, and the child below; the one above follows
        self.dim, self.at, self.child = np.array([-1]), np.zeros(1), np.array([-1])
        # and the box around the points of each node
        self.least, self.most = np.full((1, dims), -np.inf), np.full((1, dims), np.inf)

    @property
    def nodes(self) -> int:
        return max(len(self.pivot), len(self.dim))

    def halve(self, node: int, points: np.ndarray, leaf: float) -> None:
        """Planes through the middle of ``points``, until so many of them are left."""
        dim, at, child = (list(a) for a in (self.dim, self.at, self.child))
        work = [(node, points)]
        for i, some in work:
            if len(some) <= leaf or len(some) < 2:
                continue
            spread = some.std(axis=0)
            f = int(np.argmax(spread))
            v = np.sort(some[:, f])
            if not v[0] < v[-1]:
                continue
            middle = v[(len(v) - 1) // 2]
            cut_ = middle if middle < v[-1] else v[np.searchsorted(v, middle) - 1]
            dim[i], at[i], child[i] = f, cut_, len(dim)
            below = some[:, f] <= cut_
            work += [(len(dim), some[below]), (len(dim) + 1, some[~below])]
            for a, none in ((dim, -1), (at, 0.0), (child, -1)):
                a += [none, none]
        self.dim, self.at, self.child = np.array(dim), np.array(at, float), np.array(child)

    def split(self, node: int, points: np.ndarray) -> None:
        points = np.unique(points, axis=0)
        if len(points) > 1:
            self.kids[node] = np.arange(len(self.pivot), len(self.pivot) + len(points))
            self.pivot = np.concatenate([self.pivot, points])

    def locate(self, x: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """The leaf of each point, and level by level the node (-1 below the leaf) and the distance to its pivot."""
        node, path = np.zeros(len(x), np.int64), []
        while True:
            nxt, far = np.full(len(x), -1, np.int64), np.zeros(len(x))
            if len(self.dim) > 1:
                inner = np.flatnonzero(self.child[node] >= 0)
                here = node[inner]
                nxt[inner] = self.child[here] + (x[inner, self.dim[here]] > self.at[here])
            order = np.argsort(node, kind="stable") if self.kids else node[:0]
            for rows in np.split(order, np.flatnonzero(np.diff(node[order])) + 1) if len(order) else []:
                kids = self.kids.get(int(node[rows[0]]))
                if kids is None:
                    continue
                p = self.pivot[kids]
                nearest = np.argmin((p * p).sum(axis=1) - 2 * (x[rows] @ p.T), axis=1)
                nxt[rows] = kids[nearest]
                far[rows] = np.sqrt(((x[rows] - p[nearest]) ** 2).sum(axis=1))
            if not (nxt >= 0).any():
                return node, path
            path.append((nxt, far))
            node = np.where(nxt >= 0, nxt, node)

    def near(self, x: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, leaf, bound) of the leaves that may hold a point within ``reach``; bounds grow towards the leaves."""
        rows, leaves, bounds = [], [], []
        if len(self.dim) > 1:
            for first in range(0, len(x), LOOKING):
                row = np.arange(first, min(first + LOOKING, len(x)))
                node = np.zeros(len(row), np.int64)
                while len(row):
                    gap = np.maximum(self.least[node] - x[row], x[row] - self.most[node])
                    np.maximum(gap, 0.0, out=gap)
                    least = np.sqrt(np.einsum("ij,ij->i", gap, gap)) * (1 - SLACK)
                    keep = (least <= reach[row]) & (self.least[node, 0] <= self.most[node, 0])  # those that hold something
                    row, node, least = row[keep], node[keep], least[keep]
                    leaf = self.child[node] < 0
                    rows.append(row[leaf])
                    leaves.append(node[leaf])
                    bounds.append(least[leaf])
                    row, child = np.repeat(row[~leaf], 2), self.child[node[~leaf]]
                    node = np.stack([child, child + 1], axis=1).ravel()
            return np.concatenate([np.zeros(0, np.int64), *rows]), np.concatenate([np.zeros(0, np.int64), *leaves]), np.concatenate([np.zeros(0), *bounds])
        work = [(0, np.arange(len(x)), np.zeros(len(x)))]
        while work:
            node, some, bound = work.pop()
            kids = self.kids.get(node)
            if kids is None:
                rows.append(some)
                leaves.append(np.full(len(some), node, np.int64))
                bounds.append(bound)
                continue
            for kid in kids:
                if self.high[kid] < self.low[kid]:
                    continue  # holds nothing
                d = np.sqrt(((x[some] - self.pivot[kid]) ** 2).sum(axis=1))
                least = np.maximum(bound, np.maximum(d - self.high[kid], self.low[kid] - d) - SLACK * (1.0 + d))
                keep = least <= reach[some]
                if keep.any():
                    work.append((int(kid), some[keep], least[keep]))
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        return np.concatenate(rows), np.concatenate(leaves), np.concatenate(bounds)


def _place(cells: _Cells):
    @F.pandas_udf("int")
    def box_of(x: pd.Series) -> pd.Series:
        return pd.Series(cells.locate(_matrix(x))[0].astype(np.int32))

    return box_of


def _build(cands: DataFrame, total: int, dims: int, block: int) -> _Cells:
    """Cells for ``cands`` (cid, x): those of more than two blocks are split again."""
    cells = _Cells(dims)
    planes = dims <= PLANE_DIMS
    big = {0: total} if total > block else {}
    while big:
        if planes:
            # two nodes a cell, each with its box, and the sample, all on the driver
            wanted = {node: -(-2 * n // block) for node, n in big.items()}
            if (cells.nodes + 2 * sum(wanted.values())) * (2 * dims + 3) * 8 > PIVOT_BYTES:
                break
            most = max(2, PIVOT_BYTES // 4 // (8 * dims)) / sum(SAMPLE * w for w in wanted.values())
            shares = {node: min(1.0, min(1.0, most) * SAMPLE * wanted[node] / n) for node, n in big.items()}
            drawn = _drawn(cells, cands, shares).toArrow()
            box, order = drawn.column("box").to_numpy(), np.argsort(drawn.column("cid").to_numpy(), kind="stable")
            x = drawn.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            for node, n in big.items():
                cells.halve(node, x[order[box[order] == node]], block * shares[node])
        else:
            wanted = {node: max(2, min(PIVOTS, -(-2 * n // block))) for node, n in big.items()}
            if cells.pivot.nbytes + sum(wanted.values()) * dims * 8 > PIVOT_BYTES:
                break
            # twice as many as wanted, by hash: at most PIVOTS a cell are kept
            drawn = _drawn(cells, cands, {node: min(1.0, 2.0 * wanted[node] / n) for node, n in big.items()})
            picks: dict[int, list] = {}
            for r in drawn.orderBy(_unit("cid"), "cid").collect():
                if len(picks.setdefault(r["box"], [])) < wanted[r["box"]]:
                    picks[r["box"]].append(r["x"])
            for node, points in sorted(picks.items()):
                cells.split(node, np.array(points, float))
        counts = cands.select(_place(cells)("x").alias("box")).groupBy("box").count().collect()  # a row per cell
        big = {r["box"]: r["count"] for r in counts if r["count"] > 2 * block and r["box"] not in big}
    return cells


def _drawn(cells: _Cells, cands: DataFrame, shares: dict[int, float]) -> DataFrame:
    """(cid, x, box): of each of these cells a share of the points, by hash."""
    share = F.create_map(*[F.lit(v) for pair in shares.items() for v in pair])
    return cands.select("cid", "x", _place(cells)("x").alias("box")).where(_unit("cid") < F.coalesce(F.try_element_at(share, F.col("box")), F.lit(0.0)))


def _measure(cells: _Cells, cands: DataFrame) -> None:
    """Smallest and largest distance to the pivot, or value in each dimension, of every cell on the way to a leaf."""
    if len(cells.dim) > 1:
        return _measure_boxes(cells, cands if "box" in cands.columns else cands.withColumn("box", _place(cells)("x")))

    @F.pandas_udf("array<struct<node:int,far:double>>")
    def way(x: pd.Series) -> pd.Series:
        _, path = cells.locate(_matrix(x))
        return pd.Series([[{"node": int(n[i]), "far": float(d[i])} for n, d in path if n[i] >= 0] for i in range(len(x))])

    cells.low, cells.high = np.full(len(cells.pivot), np.inf), np.full(len(cells.pivot), -np.inf)
    spans = cands.select(F.explode(way("x")).alias("e")).groupBy("e.node").agg(F.min("e.far").alias("low"), F.max("e.far").alias("high"))
    for r in spans.collect():  # a row per cell
        cells.low[r["node"]], cells.high[r["node"]] = r["low"], r["high"]


def _measure_boxes(cells: _Cells, cands: DataFrame) -> None:
    dims = cells.pivot.shape[1]

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            box, x = batch.column("box").to_numpy(), batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            order = np.argsort(box, kind="stable")
            first = np.flatnonzero(np.append(True, np.diff(box[order]) != 0))
            low, high = (f.reduceat(x[order], first, axis=0) for f in (np.minimum, np.maximum))
            for i, b in enumerate(box[order][first].tolist()):
                old = found.get(b)
                found[b] = (low[i], high[i]) if old is None else (np.minimum(old[0], low[i]), np.maximum(old[1], high[i]))
        if found:
            sides = [pa.array([span[i].tobytes() for span in found.values()], pa.binary()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), *sides], names=["box", "low", "high"])

    def together(rows: pd.DataFrame) -> pd.DataFrame:
        low, high = (np.frombuffer(b"".join(rows[c])).reshape(-1, dims) for c in ("low", "high"))
        return pd.DataFrame([{"box": rows["box"].iloc[0], "low": low.min(axis=0).tobytes(), "high": high.max(axis=0).tobytes()}])

    schema = "box int, low binary, high binary"
    made = cands.select("box", "x").mapInArrow(spans, schema).groupBy("box").applyInPandas(together, schema).toArrow()  # a row per cell
    cells.low, cells.high = np.zeros(cells.nodes), np.full(cells.nodes, np.inf)
    cells.least, cells.most = np.full((cells.nodes, dims), np.inf), np.full((cells.nodes, dims), -np.inf)
    for c, to in (("low", cells.least), ("high", cells.most)):
        to[made.column("box").to_numpy()] = np.frombuffer(b"".join(made.column(c).to_pylist())).reshape(-1, dims)
    # children come after their parents
    for node in np.flatnonzero(cells.child >= 0)[::-1]:
        kids = slice(cells.child[node], cells.child[node] + 2)
        cells.least[node], cells.most[node] = cells.least[kids].min(axis=0), cells.most[kids].max(axis=0)


def _matrix(points: pd.Series) -> np.ndarray:
    return np.stack(points.to_numpy()).astype(np.float64) if len(points) else np.zeros((0, 1))


def _nearest(q: np.ndarray, c: np.ndarray, cid: np.ndarray, k: int, limit: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per query the k smallest (squared distance, candidate id): row, distance, column.

    A matrix product tells which candidates can be among them; only those are measured, dimension by
    dimension. Candidates beyond a query's ``limit`` may be left out.
    """
    rows, dists, cols = [], [], []
    step = max(1, 2_000_000 // max(1, len(c)))
    centre = c.mean(axis=0)
    around, kk = c - centre, min(k, len(c))
    square = (around * around).sum(axis=1)
    for lo in range(0, len(q), step):
        part = q[lo : lo + step]
        from_centre = part - centre
        own = (from_centre * from_centre).sum(axis=1)
        rough = square[None, :] - 2 * (from_centre @ around.T) + own[:, None]
        # what rounding may change in it, here or in what it is compared with
        slack = 8 * (q.shape[1] + 4) * np.finfo(float).eps * (own + square.max(initial=0.0) + (centre * centre).sum() * np.finfo(float).eps)
        reach = None if limit is None else limit[lo : lo + step] * (1 + SLACK) + slack
        if reach is None or np.count_nonzero(rough <= reach[:, None]) > 16 * kk * len(part):
            kth = np.partition(rough, kk - 1, axis=1)[:, kk - 1] + 2 * slack
            reach = kth if reach is None else np.minimum(kth, reach)
        r, j = np.nonzero(rough <= reach[:, None])
        d = np.zeros(len(r))
        for f in range(q.shape[1]):
            diff = part[r, f] - c[j, f]
            d += diff * diff
        order = np.lexsort((cid[j], d, r))
        r, j, d = r[order], j[order], d[order]
        first = np.searchsorted(r, np.arange(len(part)))
        keep = np.arange(len(r)) - first[r] < kk
        rows.append(r[keep] + lo)
        dists.append(d[keep])
        cols.append(j[keep])
    if not rows:
        none = np.zeros(0, dtype=np.int64)
        return none, np.zeros(0), none
    return np.concatenate(rows), np.concatenate(dists), np.concatenate(cols)


def _search(queries: DataFrame, cands: DataFrame, k: int) -> DataFrame:
    """(qid, cid, dist) of the k best candidates within each (box, query block, candidate block)."""
    group = ["box", "qb", "cb"]

    def run(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if q.empty or c.empty:
            return pd.DataFrame({"qid": [], "cid": [], "dist": []}).astype({"qid": "int64", "cid": "int64"})
        limit = q["limit"].astype(float).fillna(np.inf).to_numpy() if "limit" in q else None
        r, d, j = _nearest(_matrix(q["x"]), _matrix(c["x"]), c["cid"].to_numpy(), k, limit)
        return pd.DataFrame({"qid": q["qid"].to_numpy()[r], "cid": c["cid"].to_numpy()[j], "dist": d})

    return queries.groupBy(*group).cogroup(cands.groupBy(*group)).applyInPandas(
        run, "qid bigint, cid bigint, dist double"
    )


def _per_box(sizes: list[int]):
    return F.element_at(F.expr("array(" + ",".join(map(str, sizes)) + ")"), F.col("box") + 1)


def _blocks(rows: DataFrame, key: str, sizes: list[int], name: str) -> DataFrame:
    """Spread the rows of a box over enough blocks by a hash of their key."""
    return rows.withColumn(name, F.pmod(F.xxhash64(F.col(key)), _per_box(sizes)).cast("int"))


def _repeat(rows: DataFrame, sizes: list[int], name: str) -> DataFrame:
    return rows.withColumn(name, F.explode(F.sequence(F.lit(0), _per_box(sizes) - 1)))


def _block_counts(rows: DataFrame, block: int, boxes: int) -> list[int]:
    counts = {r["box"]: r["count"] for r in rows.groupBy("box").count().collect()}  # one row per box
    return [max(1, -(-counts.get(b, 0) // block)) for b in range(boxes)]


def _top_k(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("qid").orderBy("dist", "cid")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _box_search(queries: DataFrame, cands: DataFrame, k: int, block: int, boxes: int) -> DataFrame:
    cb, qb = _block_counts(cands, block, boxes), _block_counts(queries, block, boxes)
    return _search(
        _repeat(_blocks(queries, "qid", qb, "qb"), cb, "cb"),
        _repeat(_blocks(cands, "cid", cb, "cb"), qb, "qb"),
        k,
    )


def nearest(queries: DataFrame, candidates: DataFrame, k: int = 1, block: int = BLOCK) -> DataFrame:
    """(qid, cid, dist, rank): the k nearest candidates of every query, exactly.

    ``queries`` has (qid, x), ``candidates`` (cid, x), ids unique and whole, x an array
    of doubles. ``dist`` is the squared Euclidean distance, added up in the order of the
    dimensions; equal distances go to the smaller candidate id.
    """
    as_x = F.col("x").cast("array<double>").alias("x")
    # equal candidate points: only the k smallest ids can win
    if k == 1:
        cands = candidates.groupBy(as_x).agg(F.min("cid").alias("cid"))
    else:
        cands = _first_ids(candidates.select("cid", as_x), k)
    cands = cut(cands.select(F.col("cid").cast("bigint"), "x"))
    # equal query points are searched once
    spread = cut(queries.select(F.col("qid").cast("bigint").alias("qid"), as_x))
    points = cut(spread.groupBy("x").agg(F.min("qid").alias("qid")))

    total = cands.count()
    if total == 0:
        return spread.select("qid").limit(0).selectExpr("qid", "0L as cid", "0D as dist", "1 as rank")
    dims = len(cands.first()["x"])
    cells = _build(cands, total, dims, block)
    box_of = _place(cells)
    cands = cut(cands.withColumn("box", box_of("x")))
    here = cut(points.select("qid", "x", box_of("x").alias("box")))
    leaves = cells.nodes
    first = cut(_top_k(_box_search(here, cands, k, block, leaves), k).select("qid", "cid", "dist"))
    if leaves > 1:
        _measure(cells, cands)
        seen = 0
        for more in ROUNDS:
            asking = here.join(_limits(first, k), "qid", "left")
            pairs = cut(_pairs(cells, asking, seen, more))
            met = pairs.where("box >= 0").join(asking.select("qid", "x", "limit"), "qid")
            first = cut(_top_k(first.unionByName(_box_search(met, cands, k, block, leaves)), k).select("qid", "cid", "dist"))
            seen += more or 0
            if pairs.where(F.col("box") == MORE).isEmpty():
                break
    first = _top_k(first, k)
    if points.count() == spread.count():
        return first.select("qid", "cid", "dist", "rank")
    # hand the answer of a point to all queries that sit on it, hot points salted
    owner = points.select(F.col("qid").alias("rep"), "x")
    reps = lookup_join(spread, owner, ["x"], "qid", how="inner").select("qid", "rep")
    answers = first.select(F.col("qid").alias("rep"), "cid", "dist", "rank")
    return lookup_join(reps, answers, ["rep"], "qid", how="inner").select("qid", "cid", "dist", "rank")


def _limits(found: DataFrame, k: int) -> DataFrame:
    """(qid, limit): how far a query's k-th neighbour is so far; null with fewer."""
    bound = found.groupBy("qid").agg(F.count(F.lit(1)).alias("n"), F.max("dist").alias("dist"))
    return bound.select("qid", F.when(F.col("n") >= k, F.col("dist")).alias("limit"))


def _pairs(cells: _Cells, asking: DataFrame, seen: int, more: int | None) -> DataFrame:
    """(qid, box) of the next ``more`` cells, behind the ``seen`` nearest, that may improve a query's answer; ``MORE`` if others are left.

    Cells are ordered by their bound, which does not depend on what has been found: a tighter
    bound shortens the list at its end, so the first ``seen`` are those searched before.
    """

    @F.pandas_udf("array<int>")
    def boxes_near(x: pd.Series, own: pd.Series, limit: pd.Series) -> pd.Series:
        reach = np.sqrt(limit.astype("float64").fillna(np.inf).to_numpy()) * (1 + SLACK)
        row, leaf, least = cells.near(_matrix(x), reach)
        other = leaf != own.to_numpy()[row]
        row, leaf, least = row[other], leaf[other], least[other]
        order = np.lexsort((leaf, least, row))
        row, leaf = row[order], leaf[order]
        start = np.searchsorted(row, np.arange(len(x) + 1))
        out = []
        for a, b in zip(start, start[1:]):
            end = b if more is None else min(b, a + seen + more)
            out.append(np.append(leaf[min(b, a + seen) : end], [MORE] if end < b else []).astype(np.int32))
        return pd.Series(out)

    away = asking.select("qid", boxes_near("x", "box", "limit").alias("boxes"))
    return away.select("qid", F.explode("boxes").alias("box"))


def approx_nearest(
    queries: DataFrame, candidates: DataFrame, k: int = 1, tables: int = 12, bits: int = 10, probes: int = 6, seed: int = 0, block: int = BLOCK
) -> DataFrame:
    """(qid, cid, dist, rank): the k nearest candidates found by random projections, not always the nearest.

    Each of ``tables`` hash tables names a bucket by the sides of ``bits`` random hyperplanes through the
    mean of the candidates. A query looks into its own bucket and into ``probes`` more per table, those
    across the planes it is nearest to. What it meets is compared exactly, on blocks of bounded size
    however many points share a bucket. Equal candidates are merged as in ``nearest``. More tables and
    probes find more; a query that meets nothing has no row.
    """
    as_x = F.col("x").cast("array<double>").alias("x")
    cands = cut(_first_ids(candidates.select(F.col("cid").cast("bigint").alias("cid"), as_x), k))
    asked = cut(queries.select(F.col("qid").cast("bigint").alias("qid"), as_x))
    one = cands.first()
    if one is None:
        return asked.select("qid").limit(0).selectExpr("qid", "0L as cid", "0D as dist", "1 as rank")
    dims = len(one["x"])
    centre = np.array(cands.agg(*[F.avg(F.element_at("x", j + 1)) for j in range(dims)]).first(), float)
    planes = np.random.default_rng(seed).normal(size=(tables, dims, bits))

    def bucket_ids(probes: int):
        @F.pandas_udf("array<bigint>")
        def of(x: pd.Series) -> pd.Series:
            side = np.einsum("nd,tdb->ntb", _matrix(x) - centre, planes)
            own = ((side > 0) << np.arange(bits)).sum(axis=2)
            out = [own]
            if probes:
                near = np.argsort(np.abs(side), axis=2, kind="stable")
                # flip one plane at a time, then the two nearest together, and so on
                flips = [near[:, :, [i]] for i in range(bits)] + [near[:, :, [0, i]] for i in range(1, bits)]
                order = sorted(range(len(flips)), key=lambda i: (i if i < bits else 2 * (i - bits) + 2, i))
                out += [own ^ (1 << flips[i]).sum(axis=2) for i in order[:probes]]
            named = [b + (np.arange(tables) << bits) for b in out]
            return pd.Series(list(np.concatenate(named, axis=1)))

        return of

    keyed = cut(cands.withColumn("box", F.explode(bucket_ids(0)("x"))).withColumn("box", F.col("box").cast("int")))
    probing = asked.select("qid", "x", F.explode(F.array_distinct(bucket_ids(probes)("x"))).alias("box"))
    probing = cut(probing.withColumn("box", F.col("box").cast("int")))
    found = _box_search(probing, keyed, k, block, tables << bits)
    return _top_k(found.distinct(), k).select("qid", "cid", "dist", "rank")


def _unit(key: str):
    return F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def _first_ids(candidates: DataFrame, k: int) -> DataFrame:
    """At most k rows per point, those with the smallest ids.

    Ranked in salted parts first, so that a hot point is never ranked in one task.
    """
    part = Window.partitionBy("x", "_s").orderBy("cid")
    whole = Window.partitionBy("x").orderBy("cid")
    return (
        candidates.withColumn("_s", F.pmod(F.xxhash64("cid"), F.lit(salt_parts(candidates))))
        .withColumn("_r", F.row_number().over(part))
        .where(F.col("_r") <= k)
        .withColumn("_r", F.row_number().over(whole))
        .where(F.col("_r") <= k)
        .select("cid", "x")
    )


def _vector(cols: Sequence[str]):
    return F.array(*[F.col(c).cast("double") for c in cols])


def impute_nearest(
    df: DataFrame, target: str, by: Sequence[str], key: str, block: int = BLOCK
) -> DataFrame:
    """Nulls of ``target`` take the value of the nearest row on ``by`` that has one.

    Equal distances go to the smallest key. Rows with a null in ``by`` cannot be
    compared: they neither give nor take a value. Returns the rows in key order.
    """
    usable = F.lit(True)
    for c in by:
        usable = usable & F.col(c).isNotNull()
    x = _vector(by).alias("x")
    lack = df.where(F.col(target).isNull() & usable).select(F.col(key).alias("qid"), x)
    have = df.where(F.col(target).isNotNull() & usable).select(F.col(key).alias("cid"), x)
    pairs = cut(nearest(lack, have, 1, block).select(F.col("qid").alias(key), "cid"))
    # one row may give its value to many others
    givers = df.select(F.col(key).alias("cid"), F.col(target).alias("_v")).where(F.col("_v").isNotNull())
    got = lookup_join(pairs, givers, ["cid"], key, how="inner").select(key, "_v")
    filled = df.join(got, key, "left").withColumn(target, F.coalesce(F.col(target), F.col("_v")))
    return filled.select(*df.columns).orderBy(key)


def knn_scores(
    train: DataFrame,
    test: DataFrame,
    cols: Sequence[str] | str,
    label: str,
    key: str,
    k: int,
    block: int = BLOCK,
) -> DataFrame:
    """(key, score): share of the k nearest train rows whose label is 1.

    ``cols`` names feature columns or one array column.
    """
    votes = neighbour_labels(train, test, cols, label, key, k, block)
    return votes.groupBy(key).agg(F.avg(F.col("neighbour_label").cast("double")).alias("score"))


def knn_classify(
    train: DataFrame,
    test: DataFrame,
    cols: Sequence[str] | str,
    label: str,
    key: str,
    k: int,
    block: int = BLOCK,
) -> DataFrame:
    """(key, pred, votes): most frequent label among the k nearest; ties go to the smallest."""
    votes = neighbour_labels(train, test, cols, label, key, k, block)
    counts = votes.groupBy(key, "neighbour_label").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("r"), "neighbour_label")).alias("b"))
    return best.select(key, F.col("b.neighbour_label").alias("pred"), (-F.col("b.r")).alias("votes"))


def neighbour_labels(
    train: DataFrame, test: DataFrame, cols: Sequence[str] | str, label: str, key: str, k: int, block: int = BLOCK
) -> DataFrame:
    """(key, rank, dist, neighbour_label) of the k nearest train rows of every test row."""
    x = F.col(cols).alias("x") if isinstance(cols, str) else _vector(cols).alias("x")
    found = nearest(
        test.select(F.col(key).alias("qid"), x), train.select(F.col(key).alias("cid"), x), k, block
    )
    # a popular neighbour may serve a third of all queries
    labels = train.select(F.col(key).alias("cid"), F.col(label).alias("neighbour_label"))
    return lookup_join(cut(found), labels, ["cid"], "qid", how="inner").select(
        F.col("qid").alias(key), "rank", "dist", "neighbour_label"
    )
