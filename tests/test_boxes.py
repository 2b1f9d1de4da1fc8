"""Neighbours among flags and amounts: boxes leave out cells that balls around pivots do not."""

import numpy as np

from riskloom.operators import neighbors as N


def test_few_cells_are_searched_among_flags(spark, monkeypatch):
    """Exact, with fewer than 12 further cells a query of about 150."""
    rng = np.random.default_rng(2)

    def points(n):
        return np.concatenate([rng.integers(0, 2, (n, 6)).astype(float), rng.random((n, 3)) * [8, 5, 3]], axis=1)

    c, q = points(6000), points(80)
    pairs, made = N._pairs, []
    monkeypatch.setattr(N, "_pairs", lambda *a: made.append(pairs(*a)) or made[-1])
    found = N.nearest(
        spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(q)], "qid long, x array<double>"),
        spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(c)], "cid long, x array<double>"),
        5,
        60,
    )
    got = {}
    for r in found.collect():
        got.setdefault(r["qid"], {})[r["rank"]] = r["cid"]
    for i, x in enumerate(q):
        far = sum((x[f] - c[:, f]) ** 2 for f in range(9))
        assert [got[i][k] for k in range(1, 6)] == np.lexsort((np.arange(len(c)), far))[:5].tolist()
    assert sum(p.where("box >= 0").count() for p in made) < 80 * 12


def test_boxes_reach_every_cell_that_can_matter():
    """Each leaf within reach is named, with a bound that no point of it is nearer than; empty leaves never are."""
    rng = np.random.default_rng(3)
    x = np.round(rng.random((500, 3)) * 4)
    cells = N._Cells(3)
    cells.halve(0, x, 20)
    leaf, _ = cells.locate(x)
    assert len(np.unique(leaf)) > 20 and (cells.child[leaf] < 0).all()
    cells.least, cells.most = np.full((cells.nodes, 3), np.inf), np.full((cells.nodes, 3), -np.inf)
    np.minimum.at(cells.least, leaf, x)
    np.maximum.at(cells.most, leaf, x)
    for node in np.flatnonzero(cells.child >= 0)[::-1]:
        kids = [cells.child[node], cells.child[node] + 1]
        cells.least[node], cells.most[node] = cells.least[kids].min(axis=0), cells.most[kids].max(axis=0)
    q = rng.random((40, 3)) * 6 - 1
    row, at, bound = cells.near(q, np.full(40, 1.5))
    named = dict(zip(zip(row.tolist(), at.tolist()), bound))
    for i in range(40):
        far = np.sqrt(((q[i] - x) ** 2).sum(axis=1))
        for j in np.unique(leaf):
            nearest = far[leaf == j].min()
            assert nearest > 1.5 or (i, j) in named
            assert (i, j) not in named or named[i, j] <= nearest
