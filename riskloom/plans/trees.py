"""Decision trees with exact splits, grown level by level over rows that stay where they are.

The rows are written once, features packed. A level is two or three passes over them: each task finds
the node of its rows from the tree so far (a broadcast) and sums class weights per (node, feature, bin).
The boundaries between bins are scored from these sums. Inside a bin no boundary can score more than
the corners of the rectangle between the sums before and after it (the scores are convex), so values are
counted one by one only in bins whose bound reaches the best boundary known: every split
between two different values is tried or proven worse, however many there are. Bins bracket, they do not
cut: the result does not depend on them. Equal scores go to the smallest feature, then the smallest
value; a threshold is the middle of the two values around it, and smaller or equal goes left. Nodes that
no boundary divides, that hold one class, or that reach the depth become leaves; else there is
no limit of depth. Nodes of at most ``local_rows`` rows are finished in one task each, by the same
rules, so that deep trees need few passes.

With ``random`` splits a threshold is drawn by hash per (tree, node, feature) between the node's
smallest and largest value instead, and all trees grow together.

The driver keeps the splits of nodes above ``local_rows`` only; what is below stays in a table, a row per
finished node with its subtree in arrays. Nothing here is fitted by chance: draws hash the seed, the tree,
the path and the feature, so results depend on data and seed only.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import cut

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A node of so many rows is finished in one task; of more, while rows times (features, label, weight and key) stay within the cells.
LOCAL_ROWS = 50_000
LOCAL_CELLS = 4_600_000
# Features with so few values are counted by value in such a node, the others kept in order. Bytes of a message with rows for it.
FEW = 8
SENT_BYTES = 8 << 20
# Nodes of all trees that are sent to the tasks that score; more are met where their rows are sent.
MOST_NODES = 500_000
# Nodes of one pass, and sums a pass brings to the driver.
PASS_NODES = 4096
PASS_SUMS = 1 << 19
# Bins of one feature, rows that place their edges, and what rounding may change in a score.
BINS = 1024
EDGE_ROWS = 20_000
SLACK = 1e-9
# Tasks that finish nodes.
MOST_TASKS = 2_000
# Cells a task holds before it hands them on, and test rows that meet a subtree in one task.
HELD = 2_000_000
MEET_ROWS = 200_000
NODES = "tree int, node string, feature int, threshold double, n0 double, n1 double"
PACKED = "sub int, tree int, node array<string>, feature array<int>, threshold array<double>, kid array<int>, n0 array<double>, n1 array<double>"
UNIT = float(1 << 60)


def as_array(data: DataFrame, name: str = "features") -> Column:
    return vector_to_array(name) if isinstance(data.schema[name].dataType, VectorUDT) else F.col(name)


def _gini(l0: np.ndarray, l1: np.ndarray, r0: np.ndarray, r1: np.ndarray) -> np.ndarray:
    """Larger is better: what the split leaves of sum(p^2), weighted by the sides."""
    return _part_gini(l0, l1) + _part_gini(r0, r1)


def _part_gini(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    whole = a + b
    return (a * a + b * b) / np.where(whole != 0, whole, 1.0)


def _entropy(l0: np.ndarray, l1: np.ndarray, r0: np.ndarray, r1: np.ndarray) -> np.ndarray:
    def part(a: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return np.where(a > 0, a * np.log2(np.where(a > 0, a, 1.0) / np.where(whole > 0, whole, 1.0)), 0.0)

    return part(l0, l0 + l1) + part(l1, l0 + l1) + part(r0, r0 + r1) + part(r1, r0 + r1)


SCORES = {"gini": _gini, "entropy": _entropy}


def _hash(*parts: object) -> int:
    return int(hashlib.md5("-".join(map(str, parts)).encode()).hexdigest()[:15], 16)


@dataclass(frozen=True)
class Growth:
    """How trees grow."""

    max_depth: int | None = None
    criterion: str = "gini"
    max_features: int | None = None
    random: bool = False
    seed: int = 0
    local_rows: int | None = None
    # the features each tree may use; all without
    columns: dict[int, tuple[int, ...]] | None = None

    def __post_init__(self) -> None:
        if self.criterion not in SCORES:
            raise ValueError("criterion is gini or entropy")

    def may_split(self, node: str) -> bool:
        return self.max_depth is None or len(node) < self.max_depth

    def drawn(self, tree: int, node: str, able: Sequence[int]) -> Sequence[int]:
        """The features a node looks at, of those that are not constant in it."""
        if self.max_features is None or len(able) <= self.max_features:
            return able
        # as by ``_hash`` of seed, tree, node and feature: digits of one length sort like their number
        lead, md5 = f"{self.seed}-{tree}-{node}-", hashlib.md5
        placed = sorted((md5(f"{lead}{f}".encode()).hexdigest()[:15], f) for f in able)
        return sorted(f for _, f in placed[: self.max_features])

    def rows_of_a_task(self, width: int) -> int:
        return max(LOCAL_ROWS, LOCAL_CELLS // (width + 3)) if self.local_rows is None else self.local_rows

    def threshold(self, tree: int, node: str, f: int, low: float, high: float) -> float:
        at = float(low + _hash(self.seed, "at", tree, node, f) / UNIT * (high - low))
        return at if at < high else float(low)


def _middle(low: float, high: float) -> float:
    middle = (low + high) / 2
    return low if middle == high or not np.isfinite(middle) else middle


# --- a node whose rows fit one task ----------------------------------------------------------


def _firsts(new: np.ndarray) -> np.ndarray:
    """Where runs of equal sorted numbers begin."""
    return np.flatnonzero(np.append(True, new[1:] != new[:-1])) if len(new) else np.zeros(0, np.int64)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)


def _middles(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        middle = (low + high) / 2
    return np.where((middle == high) | ~np.isfinite(middle), low, middle)


# The lowest and the highest bit of a byte.
_LOWEST = np.array([0] + [(i & -i).bit_length() - 1 for i in range(1, 256)])
_HIGHEST = np.array([0] + [i.bit_length() - 1 for i in range(1, 256)])


class _Column:
    """A feature of the rows of a node: their values in order, and the place of each row's value among them."""

    def __init__(self, x: np.ndarray, w0: np.ndarray, w1: np.ndarray):
        self.values, code = np.unique(x, return_inverse=True)
        self.few = len(self.values) <= FEW
        self.code = code.astype(np.uint8 if self.few else np.int32)
        # no boundary is tried in a node that has a value which is no number
        self.odd = len(self.values) - 1 if len(self.values) and np.isnan(self.values[-1]) else len(self.values)
        self.w0, self.w1 = w0, w1

    def span(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (low < high) & (high < self.odd)

    def counted(self, rows: np.ndarray, run: np.ndarray, nodes: int) -> tuple[np.ndarray, np.ndarray]:
        """Class weights of each node up to each value."""
        c = len(self.values)
        key = run * c + self.code[rows]
        return tuple(np.cumsum(np.bincount(key, w[rows], nodes * c).reshape(nodes, c), axis=1) for w in (self.w0, self.w1))


def _best_of_few(score: Callable, c: _Column, rows, size, present, n0, n1, drawn):
    """(score, place of the last value on the left, threshold) of each node, for a feature with few values."""
    m = len(size)
    c0, c1 = c.counted(rows, np.repeat(np.arange(m), size), m)
    if drawn is not None:
        cut_ = np.searchsorted(c.values, drawn, "right") - 1
        l0, l1 = c0[np.arange(m), cut_], c1[np.arange(m), cut_]
        return score(l0, l1, n0 - l0, n1 - l1), cut_, drawn
    k = len(c.values) - 1
    l0, l1 = c0[:, :k], c1[:, :k]
    each = score(l0, l1, n0[:, None] - l0, n1[:, None] - l1)
    above = present[:, None] >> np.arange(1, k + 1)
    each = np.where((present[:, None] >> np.arange(k) & 1 > 0) & (above > 0), each, -np.inf)
    cut_ = np.argmax(each, axis=1)
    at = np.arange(m), cut_
    after = cut_ + 1 + _LOWEST[above[at]]
    return each[at], cut_, _middles(c.values[cut_], c.values[after])


def _best_of_many(score: Callable, c: _Column, rows, size, n0, n1, drawn):
    """The same for a feature whose rows are in the order of its values."""
    v, m = c.code[rows], len(size)
    first = np.cumsum(size) - size
    if drawn is not None:
        cut_ = np.searchsorted(c.values, drawn, "right") - 1
        left = v <= np.repeat(cut_, size)
        l0, l1 = np.add.reduceat(c.w0[rows] * left, first), np.add.reduceat(c.w1[rows] * left, first)
        return score(l0, l1, n0 - l0, n1 - l1), cut_, drawn
    c0, c1 = np.cumsum(c.w0[rows]), np.cumsum(c.w1[rows])
    b0, b1 = c0[first] - c.w0[rows[first]], c1[first] - c.w1[rows[first]]
    new = v[1:] != v[:-1]
    new[first[1:] - 1] = False
    ends = np.flatnonzero(new)
    run = np.repeat(np.arange(m), size)[ends]
    l0, l1 = c0[ends] - b0[run], c1[ends] - b1[run]
    each = score(l0, l1, n0[run] - l0, n1[run] - l1)
    top = np.maximum.reduceat(each, _firsts(run))
    hit = np.flatnonzero(each == top[run])
    place = ends[hit[_firsts(run[hit])]]
    return top, v[place], _middles(c.values[v[place]], c.values[v[place + 1]])


def _subtree(g: Growth, tree: int, top: str, x: Sequence[np.ndarray], w0: np.ndarray, w1: np.ndarray) -> dict[str, list]:
    """Arrays of the nodes below ``top`` (itself first): kid is the place of the left child, the right one follows. ``x`` has the features.

    All nodes of a depth are split together. A feature of few values is counted by value, which of them a node
    has is told by bits; every other feature keeps the rows sorted by (node, value).
    """
    n, p, score = len(w0), len(x), SCORES[g.criterion]
    out: dict[str, list] = {"node": [], "feature": [], "threshold": [], "kid": [], "n0": [], "n1": []}
    columns = {f: c for f in (range(p) if g.columns is None else g.columns[tree]) if len((c := _Column(x[f], w0, w1)).values) > 1}
    del x
    many = [f for f, c in columns.items() if not c.few]
    # which values of the features with few of them a row has, eight bits a feature
    bits = {f: (i // 8, 8 * (i % 8)) for i, f in enumerate(f for f, c in columns.items() if c.few)}
    words = [np.zeros(n, np.uint64) for _ in range(-(-len(bits) // 8))]
    for f, (word, at) in bits.items():
        words[word] |= np.left_shift(np.uint64(1), columns[f].code.astype(np.uint64) + np.uint64(at))
    orders = {f: np.argsort(columns[f].code, kind="stable").astype(np.int32) for f in many}
    base = np.arange(n, dtype=np.int32)
    goes = np.zeros(n, bool)
    names, size = [top], np.array([n])
    while names:
        m = len(names)
        start = np.cumsum(size) - size
        last = start + size - 1
        n0, n1 = np.add.reduceat(w0[base], start), np.add.reduceat(w1[base], start)
        may = (n0 > 0) & (n1 > 0) & (g.max_depth is None or len(names[0]) < g.max_depth)
        able, lows, highs, present = np.zeros((m, p), bool), {}, {}, {}
        held = [np.bitwise_or.reduceat(word[base], start) for word in words]
        for f, c in columns.items():
            if c.few:
                word, at = bits[f]
                present[f] = (held[word] >> np.uint64(at) & np.uint64(255)).astype(np.int64)
                lows[f], highs[f] = _LOWEST[present[f]], _HIGHEST[present[f]]
            else:
                lows[f], highs[f] = c.code[orders[f][start]], c.code[orders[f][last]]
            able[:, f] = c.span(lows[f], highs[f]) & may
        if g.max_features is not None:
            for i in np.flatnonzero(able.sum(axis=1) > g.max_features):
                used = g.drawn(tree, names[i], np.flatnonzero(able[i]).tolist())
                able[i] = False
                able[i, used] = True
        best, feature, threshold, cut_ = np.full(m, -np.inf), np.full(m, -1), np.zeros(m), np.zeros(m, np.int64)
        for f, c in sorted(columns.items()):
            nodes = np.flatnonzero(able[:, f])
            if not len(nodes):
                continue
            drawn = None
            if g.random:
                drawn = np.array([g.threshold(tree, names[i], f, float(c.values[lows[f][i]]), float(c.values[highs[f][i]])) for i in nodes])
            at = _ranges(start[nodes], size[nodes]) if len(nodes) < m else slice(None)
            if c.few:
                made = _best_of_few(score, c, base[at], size[nodes], present[f][nodes], n0[nodes], n1[nodes], drawn)
            else:
                made = _best_of_many(score, c, orders[f][at], size[nodes], n0[nodes], n1[nodes], drawn)
            better = np.flatnonzero(made[0] > best[nodes])
            to = nodes[better]
            best[to], cut_[to], threshold[to] = (a[better] for a in made)
            feature[to] = f
        split = feature >= 0
        done = len(out["node"])
        # children follow this level, in the order of their parents
        kid = np.where(split, done + m + 2 * (np.cumsum(split) - 1), -1)
        out["node"] += names
        out["feature"] += [f if f >= 0 else None for f in feature.tolist()]
        out["threshold"] += [t if f >= 0 else None for f, t in zip(feature.tolist(), threshold.tolist())]
        out["kid"] += kid.tolist()
        out["n0"] += n0.tolist()
        out["n1"] += n1.tolist()
        for f in np.unique(feature[split]).tolist():
            nodes = np.flatnonzero(feature == f)
            rows = base[_ranges(start[nodes], size[nodes])]
            goes[rows] = columns[f].code[rows] <= np.repeat(cut_[nodes], size[nodes])
        nodes = np.flatnonzero(split)
        at, lengths = _ranges(start[nodes], size[nodes]), size[nodes]
        if len(nodes):
            begin = np.cumsum(lengths) - lengths
            lefts = np.add.reduceat(goes[base[at]].astype(np.int64), begin)
            to_left, to_right = _ranges(begin, lefts), _ranges(begin + lefts, lengths - lefts)

        def parted(order: np.ndarray) -> np.ndarray:
            some = order[at]
            left = goes[some]
            made = np.empty_like(some)
            made[to_left], made[to_right] = some[left], some[~left]
            return made

        if len(nodes):
            base, orders = parted(base), {f: parted(o) for f, o in orders.items()}
            size = np.stack([lefts, lengths - lefts], axis=1).ravel()
        names = [names[i] + s for i in nodes.tolist() for s in "LR"]
    return out


def _finish(g: Growth, p: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        tree, top, sub = int(rows["tree"].iloc[0]), rows["node"].iloc[0], int(rows["sub"].iloc[0])
        cells = [np.frombuffer(b).reshape(p + 3, -1) for b in rows["cells"]]
        # an order that rows bring along, so that sums of fractions do not depend on chance
        order = np.argsort(np.concatenate([c[-1].view(np.int64) for c in cells]), kind="stable")
        x = [np.concatenate([c[f] for c in cells])[order] for f in range(p)]
        y, w = (np.concatenate([c[i] for c in cells])[order] for i in (p, p + 1))
        del cells, rows
        made = _subtree(g, tree, top, x, w * (1 - y), w * y)
        return pd.DataFrame([{"sub": sub, "tree": tree, **made}])

    return run


# --- passes over the rows --------------------------------------------------------------------


@dataclass
class _Top:
    """The trees so far, on the driver: flat nodes, in growth order."""

    tree: list[int] = field(default_factory=list)
    node: list[str] = field(default_factory=list)
    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    kid: list[int] = field(default_factory=list)  # the left child; the right one follows
    n0: list[float] = field(default_factory=list)
    n1: list[float] = field(default_factory=list)
    roots: dict[int, int] = field(default_factory=dict)

    def add(self, tree: int, node: str, n0: float, n1: float) -> int:
        for cells, value in ((self.tree, tree), (self.node, node), (self.feature, -1), (self.threshold, 0.0), (self.kid, -1), (self.n0, n0), (self.n1, n1)):
            cells.append(value)
        return len(self.tree) - 1

    def arrays(self) -> tuple[dict[int, int], np.ndarray, np.ndarray, np.ndarray]:
        return dict(self.roots), np.array(self.feature, np.int64), np.array(self.threshold, float), np.array(self.kid, np.int64)


def _route(root: int, feature: np.ndarray, threshold: np.ndarray, kid: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The last node each row reaches."""
    at = np.full(len(x), root, np.int64)
    some = np.arange(len(x)) if feature[root] >= 0 else np.zeros(0, np.int64)
    while len(some):
        here = at[some]
        here = kid[here] + (x[some, feature[here]] > threshold[here])
        at[some] = here
        some = some[feature[here] >= 0]
    return at


def _unpack(batch: pa.RecordBatch, p: int) -> np.ndarray:
    flat = b"".join(batch.column("x").to_pylist())
    return np.frombuffer(flat).reshape(-1, p) if p else np.zeros((batch.num_rows, 0))


def _members(batch: pa.RecordBatch, trees: Sequence[int]) -> Iterator[tuple[int, np.ndarray | slice, np.ndarray]]:
    """(tree, rows, weights) of a batch: those that a tree drew, all of them without draws."""
    w = batch.column("w").to_numpy(zero_copy_only=False)
    at = batch.schema.get_field_index("drawn")
    if at < 0:
        for t in trees:
            yield t, np.arange(batch.num_rows), w
        return
    drawn = batch.column(at)
    ends = np.asarray(drawn.offsets)
    row = np.repeat(np.arange(batch.num_rows), np.diff(ends))
    part = slice(ends[0], ends[-1])
    keys = drawn.keys.to_numpy(zero_copy_only=False)[part]
    # short numbers are sorted by their digits
    order = np.argsort(keys.astype(np.int16) if max(trees, default=0) < 1 << 15 else keys, kind="stable")
    keys, row = keys[order], row[order]
    weight = w[row] * drawn.items.to_numpy(zero_copy_only=False)[part][order]
    for t, a, b in zip(trees, np.searchsorted(keys, trees), np.searchsorted(keys, trees, "right")):
        yield t, row[a:b], weight[a:b]


def packed_rows(data: DataFrame, drawn: DataFrame | None = None) -> tuple[DataFrame, int]:
    """(k, y, w, x, drawn) of an assembled table, x as bytes, written once; and the number of features."""
    one = data.select(as_array(data).alias("x")).first()
    p = len(one["x"]) if one else 0
    cols = [F.xxhash64("row_id").alias("k"), F.col("label").cast("double").alias("y"), F.col("w").cast("double").alias("w"), as_array(data).cast("array<double>").alias("x")]
    rows = data.join(drawn, "row_id").select(*cols, "drawn") if drawn is not None else data.select(*cols)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).tobytes()
            ends = pa.py_buffer((np.arange(batch.num_rows + 1, dtype=np.int32) * (8 * p)).tobytes())
            made = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, ends, pa.py_buffer(x)])
            yield pa.RecordBatch.from_arrays([made if n == "x" else batch.column(n) for n in batch.schema.names], names=batch.schema.names)

    schema = "k bigint, y double, w double, x binary" + (f", drawn {rows.schema['drawn'].dataType.simpleString()}" if drawn is not None else "")
    return cut(rows.mapInArrow(pack, schema)), p


class Source:
    """Packed rows, the trees that drew them, and how a row's weight follows from its features."""

    def __init__(self, rows: DataFrame, p: int, trees: Sequence[int], weigh: Callable | None = None):
        self.rows, self.p, self.trees, self.weigh = rows, p, list(trees), weigh

    @property
    def spark(self):
        return self.rows.sparkSession

    def edges(self) -> list[np.ndarray]:
        """Values that split each feature into bins of like size. Any values would do."""
        n = self.rows.count()
        few = self.rows.where(F.pmod(F.xxhash64("x", "k"), F.lit(max(1, n // EDGE_ROWS))) == 0).select("x").limit(2 * EDGE_ROWS).toArrow()
        x = np.frombuffer(b"".join(few.column("x").to_pylist())).reshape(-1, self.p) if few.num_rows else np.zeros((0, self.p))
        return [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS), method="lower")) if len(x) else np.zeros(0) for f in range(self.p)]

    def run(self, top: _Top, task: Callable, schema: str, nodes: Sequence[int] | None = None) -> DataFrame:
        """``task`` is called with the active members of a batch: (x, y, w, tree, rows, node), and with None at the end. Trees without one of ``nodes`` are passed over."""
        shared = self.spark.sparkContext.broadcast(top.arrays())
        asked = None if nodes is None else {top.tree[i] for i in nodes}
        p, trees, weigh = self.p, [t for t in self.trees if asked is None or t in asked], self.weigh

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            roots, feature, threshold, kid = shared.value
            hand = task()
            for batch in batches:
                if not batch.num_rows:
                    continue
                x, y = _unpack(batch, p), batch.column("y").to_numpy(zero_copy_only=False)
                key = batch.column("k").to_numpy(zero_copy_only=False)
                parts = []
                for t, some, w in _members(batch, trees):
                    if not len(some) or t not in roots:
                        continue
                    xs = x if len(some) == len(x) and (some == np.arange(len(x))).all() else x[some]
                    if weigh is not None:
                        w = weigh(xs, y[some], w)
                    parts.append((some, _route(roots[t], feature, threshold, kid, xs), w))
                if parts:
                    some, at, w = (np.concatenate(c) for c in zip(*parts))
                    yield from hand(x, y[some], w, key, some, at)
            yield from hand(None, None, None, None, None, None)

        return self.rows.mapInArrow(run, schema)


def _batch(**cells: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cells.values()], names=list(cells))


def _counting(trees: Sequence[int]):
    """Class weights and rows of each node a row is in."""

    def task():
        sums: dict[int, np.ndarray] = {}

        def hand(x, y, w, key, some, at):
            if x is None:
                if sums:
                    made = np.array(list(sums.values()))
                    yield _batch(node=np.array(list(sums), np.int32), n0=made[:, 0], n1=made[:, 1], c=made[:, 2].astype(np.int64))
                return
            order = np.argsort(at, kind="stable")
            first = _firsts(at[order])
            made = np.stack([np.add.reduceat(v[order], first) for v in (w * (1 - y), w * y, np.ones(len(y)))], axis=1)
            for node, cells in zip(at[order][first].tolist(), made):
                sums[node] = sums[node] + cells if node in sums else cells

        return hand

    return task


def _spans(slot: np.ndarray, slots: int, p: int):
    """Smallest and largest value of each feature in each active node."""

    def task():
        low, high = np.full((slots, p), np.inf), np.full((slots, p), -np.inf)

        def hand(x, y, w, key, some, at):
            if x is None:
                i, f = np.nonzero(low <= high)
                yield _batch(slot=i.astype(np.int32), feature=f.astype(np.int32), low=low[i, f], high=high[i, f])
                return
            s = slot[at]
            mine = np.flatnonzero(s >= 0)
            if not len(mine):
                return
            mine = mine[np.argsort(s[mine], kind="stable")]
            first = _firsts(s[mine])
            nodes, cells = s[mine][first], x[some[mine]]
            low[nodes] = np.minimum(low[nodes], np.minimum.reduceat(cells, first, axis=0))
            high[nodes] = np.maximum(high[nodes], np.maximum.reduceat(cells, first, axis=0))

        return hand

    return task


def _each_pair(x, some, s, pair):
    """(feature, members, pair) of a batch's members in active nodes, for the features their nodes look at."""
    for f in np.flatnonzero((pair >= 0).any(axis=0)):
        mine = np.flatnonzero((s >= 0) & (pair[s, f] >= 0))
        if len(mine):
            yield f, mine, pair[s[mine], f]


def _histogram(slot: np.ndarray, pair: np.ndarray, edges: list[np.ndarray], bins: int):
    """Class weights, rows and span of values per (pair, bin)."""
    cells = (int(pair.max()) + 1) * bins

    def task():
        n0, n1, c = np.zeros(cells), np.zeros(cells), np.zeros(cells)
        low, high = np.full(cells, np.inf), np.full(cells, -np.inf)

        def hand(x, y, w, key, some, at):
            if x is None:
                i = np.flatnonzero(c)
                yield _batch(cell=i.astype(np.int32), n0=n0[i], n1=n1[i], c=c[i].astype(np.int64), low=low[i], high=high[i])
                return
            s = slot[at]
            for f, mine, pairs in _each_pair(x, some, s, pair):
                v = x[some[mine], f]
                k = pairs * bins + np.searchsorted(edges[f], v)
                used, k = np.unique(k, return_inverse=True)
                wy, ws = (w * y)[mine], w[mine]
                n1[used] += np.bincount(k, wy)
                n0[used] += np.bincount(k, ws - wy)
                c[used] += np.bincount(k)
                order = np.argsort(k, kind="stable")
                first = _firsts(k[order])
                low[used] = np.minimum(low[used], np.minimum.reduceat(v[order], first))
                high[used] = np.maximum(high[used], np.maximum.reduceat(v[order], first))

        return hand

    return task


def _cells_of(slot: np.ndarray, pair: np.ndarray, edges: list[np.ndarray], bins: int, wanted: np.ndarray):
    """Class weights and rows per (pair, bin, value) of the wanted bins, equal values added up."""

    def task():
        held: list[tuple] = []

        def merged():
            k, v, n0, n1, c = (np.concatenate(a) for a in zip(*held))
            held.clear()
            order = np.lexsort((v, k))
            k, v = k[order], v[order]
            first = np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (v[1:] != v[:-1])))
            held.append((k[first], v[first], *(np.add.reduceat(a[order], first) for a in (n0, n1, c))))

        def out():
            k, v, n0, n1, c = held.pop()
            for at in range(0, len(k), 1 << 16):
                part = slice(at, at + (1 << 16))
                yield _batch(cell=k[part].astype(np.int32), value=v[part], n0=n0[part], n1=n1[part], c=c[part].astype(np.int64))

        def hand(x, y, w, key, some, at):
            if x is None:
                if held:
                    merged()
                    yield from out()
                return
            s = slot[at]
            for f, mine, pairs in _each_pair(x, some, s, pair):
                v = x[some[mine], f]
                k = pairs * bins + np.searchsorted(edges[f], v)
                keep = np.flatnonzero(wanted[k])
                if len(keep):
                    wy, ws = (w * y)[mine[keep]], w[mine[keep]]
                    held.append((k[keep], v[keep] + 0.0, ws - wy, wy, np.ones(len(keep))))
            if sum(len(h[0]) for h in held) > HELD:
                merged()
                if len(held[0][0]) > HELD // 2:
                    yield from out()

        return hand

    return task


def _drawn_sums(slot: np.ndarray, pair: np.ndarray, thresholds: np.ndarray):
    """Class weights and rows left of and right of the threshold of each pair."""
    pairs_ = len(thresholds)

    def task():
        sums = np.zeros((6, pairs_))

        def hand(x, y, w, key, some, at):
            if x is None:
                i = np.flatnonzero(sums[2] + sums[5])
                yield _batch(pair=i.astype(np.int32), l0=sums[0, i], l1=sums[1, i], lc=sums[2, i], r0=sums[3, i], r1=sums[4, i], rc=sums[5, i])
                return
            s = slot[at]
            for f, mine, pairs in _each_pair(x, some, s, pair):
                left = x[some[mine], f] <= thresholds[pairs]
                wy, ws = (w * y)[mine], w[mine]
                for i, v in enumerate((ws - wy, wy, np.ones(len(mine)))):
                    sums[i] += np.bincount(pairs, v * left, pairs_)
                    sums[3 + i] += np.bincount(pairs, v * ~left, pairs_)

        return hand

    return task


@dataclass
class Split:
    feature: int
    threshold: float
    l0: float
    l1: float
    lc: int
    r0: float
    r1: float


def _rows(df: DataFrame, keys: Sequence[str], **how) -> pd.DataFrame:
    # as columns: a Python object a row would cost the driver many times what the numbers take
    return df.groupBy(*keys).agg(*[h(c).alias(c) for c, h in how.items()]).toArrow().to_pandas()


def best_splits(source: Source, top: _Top, active: Sequence[int], g: Growth, edges: list[np.ndarray] | None) -> dict[int, Split]:
    """The best split of each active node that has one; at most ``PASS_NODES`` nodes."""
    slot = np.full(len(top.tree), -1, np.int64)
    slot[list(active)] = np.arange(len(active))
    p = source.p
    pair = np.full((len(active), p), -1, np.int64)
    spans = None
    if g.max_features is not None or g.random:
        spans = _rows(source.run(top, _spans(slot, len(active), p), "slot int, feature int, low double, high double", active), ["slot", "feature"], low=F.min, high=F.max)
        spans = spans[spans["low"] < spans["high"]].sort_values(["slot", "feature"])
        for i, few in spans.groupby("slot")["feature"]:
            able = [f for f in few.tolist() if g.columns is None or f in g.columns[top.tree[active[i]]]]
            pair[i, list(g.drawn(top.tree[active[i]], top.node[active[i]], able))] = 0
    else:
        for i, node in enumerate(active):
            pair[i, slice(None) if g.columns is None else list(g.columns[top.tree[node]])] = 0
    at = np.nonzero(pair >= 0)
    pair[at] = np.arange(len(at[0]))
    if not len(at[0]):
        return {}
    of_slot, of_feature = at
    score = SCORES[g.criterion]
    found: dict[int, tuple] = {}

    def offer(i: int, s: float, f: int, v: float, split: Split) -> None:
        if i not in found or (-s, f, v) < found[i][0]:
            found[i] = ((-s, f, v), split)

    if g.random:
        low = {(r.slot, r.feature): (r.low, r.high) for r in spans.itertuples()}
        drawn = np.array([g.threshold(top.tree[active[i]], top.node[active[i]], f, *low[i, f]) for i, f in zip(of_slot, of_feature)])
        names = ["l0", "l1", "lc", "r0", "r1", "rc"]
        sums = source.run(top, _drawn_sums(slot, pair, drawn), "pair int, " + ", ".join(f"{n} double" for n in names), active)
        made = _rows(sums, ["pair"], **{n: F.sum for n in names})
        s = score(*(made[n].to_numpy() for n in ("l0", "l1", "r0", "r1")))
        for r, value in zip(made.itertuples(), s):
            i, f = int(of_slot[r.pair]), int(of_feature[r.pair])
            offer(i, value, f, 0.0, Split(f, float(drawn[r.pair]), r.l0, r.l1, int(r.lc), r.r0, r.r1))
        return {active[i]: split for i, (_, split) in found.items()}

    step = max(1, -(-BINS * len(at[0]) // PASS_SUMS))
    edges = [e[::step] for e in edges]
    bins = max(len(e) for e in edges) + 1
    sums = source.run(top, _histogram(slot, pair, edges, bins), "cell int, n0 double, n1 double, c bigint, low double, high double", active)
    hist = _rows(sums, ["cell"], n0=F.sum, n1=F.sum, c=F.sum, low=F.min, high=F.max).sort_values("cell")
    cell, low, high = hist["cell"].to_numpy(), hist["low"].to_numpy(), hist["high"].to_numpy()
    pairs = cell // bins
    first = _firsts(pairs)
    run = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(pairs))))

    def sums_of(name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Before and after each bin, and the pair's total."""
        v = hist[name].to_numpy()
        after = np.concatenate([np.cumsum(part) for part in np.split(v, first[1:])]) if len(v) else v
        return np.where(np.isin(np.arange(len(v)), first), 0, np.append(0, after[:-1])), after, np.append(after[first[1:] - 1], after[-1:])[run]

    (a0, b0, t0), (a1, b1, t1), (ac, bc, _) = sums_of("n0"), sums_of("n1"), sums_of("c")
    # boundaries between bins
    ends = np.flatnonzero(run[1:] == run[:-1])
    between = score(b0[ends], b1[ends], t0[ends] - b0[ends], t1[ends] - b1[ends])
    # what a boundary inside a bin can score at most
    bound = np.max([score(l0, l1, t0 - l0, t1 - l1) for l0 in (a0, b0) for l1 in (a1, b1)], axis=0)
    known = np.full(len(active), -np.inf)
    slots = of_slot[pairs]
    np.maximum.at(known, slots[ends], between)
    for e in ends[between >= known[slots[ends]]]:
        i, f = int(slots[e]), int(of_feature[pairs[e]])
        s = float(score(b0[e : e + 1], b1[e : e + 1], t0[e : e + 1] - b0[e : e + 1], t1[e : e + 1] - b1[e : e + 1])[0])
        offer(i, s, f, float(high[e]), Split(f, _middle(float(high[e]), float(low[e + 1])), b0[e], b1[e], int(bc[e]), t0[e] - b0[e], t1[e] - b1[e]))
    with np.errstate(invalid="ignore"):
        open_ = np.flatnonzero((low < high) & (bound >= known[slots] - SLACK * (1 + np.abs(known[slots]))) | ((low < high) & np.isinf(known[slots])))
    if len(open_):
        wanted = np.zeros(len(at[0]) * bins, bool)
        wanted[cell[open_]] = True
        cells = source.run(top, _cells_of(slot, pair, edges, bins, wanted), "cell int, value double, n0 double, n1 double, c bigint", active)
        counts = cells.groupBy("cell", "value").agg(*[F.sum(n).alias(n) for n in ("n0", "n1", "c")])
        base = pd.DataFrame({"cell": cell[open_], "a0": a0[open_], "a1": a1[open_], "ac": ac[open_], "t0": t0[open_], "t1": t1[open_], "slot": slots[open_], "feature": of_feature[pairs[open_]]})
        base = source.spark.createDataFrame(pa.Table.from_pandas(base.astype({"cell": "int32", "slot": "int32", "feature": "int32"}), preserve_index=False), "cell int, a0 double, a1 double, ac bigint, t0 double, t1 double, slot int, feature int")
        order = Window.partitionBy("cell").orderBy("value")
        so_far = order.rowsBetween(Window.unboundedPreceding, 0)
        curve = counts.select("cell", "value", F.lead("value").over(order).alias("next"), *[F.sum(n).over(so_far).alias(n) for n in ("n0", "n1", "c")])
        curve = curve.where("next is not null").join(F.broadcast(base), "cell")
        l0, l1 = F.col("a0") + F.col("n0"), F.col("a1") + F.col("n1")
        made = curve.select("slot", "feature", "value", "next", l0.alias("l0"), l1.alias("l1"), (F.col("ac") + F.col("c")).alias("lc"), (F.col("t0") - l0).alias("r0"), (F.col("t1") - l1).alias("r1"))
        s = COLUMN_SCORES[g.criterion](*[F.col(n) for n in ("l0", "l1", "r0", "r1")])
        best = made.groupBy("slot").agg(F.min_by(F.struct("feature", "value", "next", "l0", "l1", "lc", "r0", "r1"), F.struct(-s, "feature", "value")).alias("s")).select("slot", "s.*")
        for r in best.collect():  # a row per node
            s = float(score(*(np.array([r[n]]) for n in ("l0", "l1", "r0", "r1")))[0])
            offer(r["slot"], s, r["feature"], r["value"], Split(r["feature"], _middle(r["value"], r["next"]), r["l0"], r["l1"], r["lc"], r["r0"], r["r1"]))
    return {active[i]: split for i, (_, split) in found.items()}


def gini_score(l0: Column, l1: Column, r0: Column, r1: Column) -> Column:
    return F.try_divide(l0 * l0 + l1 * l1, l0 + l1) + F.try_divide(r0 * r0 + r1 * r1, r0 + r1)


def entropy_score(l0: Column, l1: Column, r0: Column, r1: Column) -> Column:
    def part(a: Column, whole: Column) -> Column:
        return F.when(a > 0, a * F.log2(a / whole)).otherwise(0.0)

    return part(l0, l0 + l1) + part(l1, l0 + l1) + part(r0, r0 + r1) + part(r1, r0 + r1)


COLUMN_SCORES = {"gini": gini_score, "entropy": entropy_score}


# --- grown trees -----------------------------------------------------------------------------


@dataclass
class Trees:
    """Grown trees: the nodes on the driver, the table of subtrees below them, and the names of the features."""

    top: _Top
    subtrees: DataFrame
    places: dict[int, int]  # number of a subtree to the top node it replaces
    features: list[str] = field(default_factory=list)

    @property
    def nodes(self) -> DataFrame:
        """(tree, node, feature, threshold, n0, n1): node is the path from the root, feature null in a leaf."""
        held = set(self.places.values())
        rows = [
            (t, n, f if f >= 0 else None, v if f >= 0 else None, float(a), float(b))
            for i, (t, n, f, v, a, b) in enumerate(zip(self.top.tree, self.top.node, self.top.feature, self.top.threshold, self.top.n0, self.top.n1))
            if i not in held
        ]
        zipped = F.explode(F.arrays_zip("node", "feature", "threshold", "n0", "n1")).alias("s")
        below = self.subtrees.select("tree", zipped).select("tree", "s.*")
        return self.subtrees.sparkSession.createDataFrame(rows, NODES).unionByName(below)

    def rules(self) -> DataFrame:
        """(tree, node, depth, feature, threshold, n0, n1, share): feature by name, null in a leaf."""
        names = F.array(*[F.lit(n) for n in self.features])
        share = F.col("n1") / (F.col("n0") + F.col("n1"))
        return self.nodes.select(
            "tree", "node", F.length("node").alias("depth"), F.get(names, F.col("feature")).alias("feature"), "threshold", "n0", "n1", share.alias("share")
        )

    def _gains(self) -> DataFrame:
        """(tree, feature, gain): what splits took from the impurity."""

        def gained(feature, kid, n0, n1):
            weight = n0 + n1
            impurity = 2 * n0 * n1 / np.where(weight > 0, weight, 1.0)
            at = np.flatnonzero(feature >= 0)
            return feature[at], impurity[at] - impurity[kid[at]] - impurity[kid[at] + 1]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for tree, feature, kid, n0, n1 in zip(*[batch.column(c) for c in ("tree", "feature", "kid", "n0", "n1")]):
                    f, gain = gained(_ints(feature.values), _ints(kid.values), np.asarray(n0.values), np.asarray(n1.values))
                    yield _batch(tree=np.full(len(f), tree.as_py(), np.int32), feature=f.astype(np.int32), gain=gain)

        below = self.subtrees.select("tree", "feature", "kid", "n0", "n1").mapInArrow(run, "tree int, feature int, gain double")
        t = self.top
        f, gain = gained(*(np.array(v, k) for v, k in ((t.feature, np.int64), (t.kid, np.int64), (t.n0, float), (t.n1, float))))
        above = [(int(t.tree[i]), int(a), float(b)) for i, a, b in zip(np.flatnonzero(np.array(t.feature) >= 0), f, gain)]
        return self.subtrees.sparkSession.createDataFrame(above, "tree int, feature int, gain double").unionByName(below).groupBy("tree", "feature").agg(F.sum("gain").alias("gain"))

    def importances(self) -> DataFrame:
        """(feature, importance): decrease of gini impurity by weight, each tree's adding to one, then the mean."""
        gains = cut(self._gains())
        total = gains.groupBy("tree").agg(F.sum("gain").alias("all"))
        parts = gains.join(total, "tree").where(F.col("all") > 0)
        count = parts.select("tree").distinct().count() or 1
        mean = parts.groupBy("feature").agg((F.sum(F.col("gain") / F.col("all")) / count).alias("importance"))
        names = self.subtrees.sparkSession.createDataFrame(list(enumerate(self.features)), "feature int, name string")
        out = names.join(mean, "feature", "left").select(F.col("name").alias("feature"), F.coalesce("importance", F.lit(0.0)).alias("importance"))
        return out.orderBy("importance", "feature")

    def scores(self, data: DataFrame) -> DataFrame:
        """Appends score (mean share of class 1 in the leaves) and pred to an assembled table."""
        keep = [c for c in data.columns if c != "features"]
        size = self.subtrees.agg(F.sum(F.size("feature"))).first()[0] or 0
        if len(self.top.tree) + size > MOST_NODES:
            return self._scores_apart(data, keep)
        shared = data.sparkSession.sparkContext.broadcast(self._flat(self.subtrees.select("sub", "feature", "threshold", "kid", "n0", "n1").toArrow()))
        slim = data.select(*keep, as_array(data).alias("_x"))
        schema = slim.drop("_x").schema.add("score", "double")
        out = slim.mapInArrow(_scoring(shared), schema)
        return out.withColumn("pred", (F.col("score") > 0.5).cast("int"))

    def _flat(self, subtrees: pa.Table) -> tuple:
        """Roots and arrays of all nodes, subtrees in the place of the nodes they continue."""
        roots, feature, threshold, kid = self.top.arrays()
        n0, n1 = np.array(self.top.n0, float), np.array(self.top.n1, float)
        parts, size = [(feature, threshold, kid, n1 / np.maximum(n0 + n1, 1e-300))], len(feature)
        for r in zip(*[subtrees.column(c) for c in ("sub", "feature", "threshold", "kid", "n0", "n1")]):
            f, below, t = _ints(r[1].values), _ints(r[3].values), np.asarray(r[2].values.fill_null(0.0))
            a, b = (np.asarray(c.values) for c in r[4:])
            below = np.where(below >= 0, below + size, -1)
            at = self.places[r[0].as_py()]
            feature[at], threshold[at], kid[at] = f[0], t[0], below[0]
            parts.append((f, t, below, b / (a + b)))
            size += len(f)
        return [roots[t] for t in sorted(roots)], *(np.concatenate(c) for c in zip(*parts))

    def _scores_apart(self, data: DataFrame, keep: Sequence[str]) -> DataFrame:
        """Rows are sent to the subtrees they reach, so that no task holds all trees."""
        spark = data.sparkSession
        rows = cut(data.select(*keep, as_array(data).cast("array<double>").alias("_x")).withColumn("_k", F.monotonically_increasing_id()))
        sub_of = np.full(len(self.top.tree), -1, np.int64)
        for sub, at in self.places.items():
            sub_of[at] = sub
        share = np.array(self.top.n1, float) / np.maximum(np.array(self.top.n0, float) + np.array(self.top.n1, float), 1e-300)
        shared = spark.sparkContext.broadcast((*self.top.arrays(), sub_of, share))
        slim = rows.select("_k", "_x")
        met = slim.mapInArrow(_counting_met(shared), "sub int, n bigint").groupBy("sub").agg(F.sum("n").alias("n")).collect()  # a row per subtree
        parts = {r["sub"]: -(-r["n"] // MEET_ROWS) for r in met}
        sent = slim.mapInArrow(_sending(shared, parts), "sub int, part int, k binary, x binary, share binary")
        many = spark.createDataFrame([(s, p) for s, n in parts.items() for p in range(n)], "sub int, part int")
        below = self.subtrees.select("sub", "feature", "threshold", "kid", "n0", "n1").join(F.broadcast(many), "sub")
        reached = sent.where("sub >= 0").groupBy("sub", "part").cogroup(below.groupBy("sub", "part")).applyInPandas(_meeting, "k bigint, share double")
        ended = sent.where("sub < 0").select("k", "share").mapInArrow(_plain, "k bigint, share double")
        mean = reached.unionByName(ended).groupBy("k").agg(F.sum("share").alias("_s"))
        out = rows.join(mean, rows["_k"] == mean["k"]).withColumn("score", F.col("_s") / F.lit(float(len(self.top.roots))))
        return out.select(*keep, "score", (F.col("score") > 0.5).cast("int").alias("pred"))


def _ints(values: pa.Array) -> np.ndarray:
    return np.asarray(values.fill_null(-1)).astype(np.int64)


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 1))


def _scoring(shared: object):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots, feature, threshold, kid, share = shared.value
        for batch in batches:
            at = batch.schema.get_field_index("_x")
            x = _matrix(batch.column(at), batch.num_rows)
            score = np.zeros(len(x))
            for root in roots:
                score += share[_route(root, feature, threshold, kid, x)]
            kept = [i for i in range(batch.num_columns) if i != at]
            made = pa.array(score / max(1, len(roots)))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], made], names=[*[batch.schema.names[i] for i in kept], "score"])

    return run


def _counting_met(shared: object):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots, feature, threshold, kid, sub_of, _ = shared.value
        counts = np.zeros(int(sub_of.max(initial=-1)) + 1, np.int64)
        for batch in batches:
            x = _matrix(batch.column("_x"), batch.num_rows)
            for root in roots.values():
                sub = sub_of[_route(root, feature, threshold, kid, x)]
                counts += np.bincount(sub[sub >= 0], minlength=len(counts))
        some = np.flatnonzero(counts)
        yield _batch(sub=some.astype(np.int32), n=counts[some])

    return run


def _sending(shared: object, parts: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots, feature, threshold, kid, sub_of, share = shared.value
        for batch in batches:
            x, k = _matrix(batch.column("_x"), batch.num_rows), batch.column("_k").to_numpy()
            out: list[tuple] = []
            for root in roots.values():
                at = _route(root, feature, threshold, kid, x)
                sub = sub_of[at]
                order = np.argsort(sub, kind="stable")
                first = _firsts(sub[order])
                for some in np.split(order, first[1:]) if len(order) else []:
                    s = int(sub[some[0]])
                    if s < 0:
                        out.append((s, 0, k[some].tobytes(), b"", share[at[some]].tobytes()))
                    else:
                        out.append((s, int(k[some[0]]) % parts[s], k[some].tobytes(), x[some].tobytes(), b""))
            if out:
                cells = list(zip(*out))
                kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, kinds)], names=["sub", "part", "k", "x", "share"])

    return run


def _meeting(sent: pd.DataFrame, below: pd.DataFrame) -> pd.DataFrame:
    if sent.empty:
        return pd.DataFrame({"k": np.zeros(0, np.int64), "share": np.zeros(0)})
    r = below.iloc[0]
    feature = np.array([-1 if v is None or v != v else v for v in r["feature"]], np.int64)
    threshold = np.array([0.0 if v is None else v for v in r["threshold"]], float)
    n0, n1 = np.array(r["n0"], float), np.array(r["n1"], float)
    k = np.frombuffer(b"".join(sent["k"]), np.int64)
    x = np.frombuffer(b"".join(sent["x"])).reshape(len(k), -1)
    return pd.DataFrame({"k": k, "share": (n1 / (n0 + n1))[_route(0, feature, threshold, np.array(r["kid"], np.int64), x)]})


def _plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        k = np.frombuffer(b"".join(batch.column("k").to_pylist()), np.int64)
        yield _batch(k=k, share=np.frombuffer(b"".join(batch.column("share").to_pylist())))


def _to_finish(sub_of: np.ndarray, top: _Top, wanted: Sequence[int]):
    """A batch's rows in nodes that are finished in one task: features column by column, label, weight, key."""
    tree, node = {i: top.tree[i] for i in wanted}, {i: top.node[i] for i in wanted}

    def task():
        def hand(x, y, w, key, some, at):
            if x is None:
                return
            mine = np.flatnonzero(sub_of[at] >= 0)
            if not len(mine):
                return
            mine = mine[np.argsort(at[mine], kind="stable")]
            out = []
            for part in np.split(mine, _firsts(at[mine])[1:]):
                i, rows = int(at[part[0]]), some[part]
                cells = np.concatenate([x[rows].T, y[part][None], w[part][None], key[rows].view(float)[None]])
                out.append((int(sub_of[i]), tree[i], node[i], cells.tobytes()))
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.binary()]
            ends = np.cumsum([len(r[-1]) for r in out])
            for part in np.split(np.arange(len(out)), _firsts(ends // SENT_BYTES)[1:]):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*[out[i] for i in part]), kinds)], names=["sub", "tree", "node", "cells"])

        return hand

    return task


def grow(data: DataFrame, features: Sequence[str], growth: Growth = Growth(), trees: int = 1, drawn: DataFrame | None = None) -> Trees:
    """Trees over an assembled table (row_id, label, w, features).

    ``drawn`` (row_id, drawn: a map from tree to how often it drew the row) makes bootstrap trees; rows
    that a tree did not draw take no part in it. A table without rows gives no nodes.
    """
    rows, p = packed_rows(data, drawn)
    numbers, local = list(range(trees)), growth.rows_of_a_task(p)
    if drawn is not None:
        numbers = sorted(r[0] for r in rows.select(F.explode(F.map_keys("drawn"))).distinct().collect())
    source = Source(rows, p, numbers)
    top = _Top()
    for t in numbers:
        top.roots[t] = top.add(t, "", 0.0, 0.0)
    counted = _rows(source.run(top, _counting(numbers), "node int, n0 double, n1 double, c bigint"), ["node"], n0=F.sum, n1=F.sum, c=F.sum)
    size = {}
    for r in counted.itertuples():
        top.n0[r.node], top.n1[r.node], size[r.node] = r.n0, r.n1, r.c
    if not size:
        top = _Top()  # no rows, no nodes
    finish: list[int] = []
    edges = source.edges() if size and not growth.random and any(c > local for c in size.values()) else None
    while size:
        able = [i for i in size if top.n0[i] > 0 and top.n1[i] > 0 and growth.may_split(top.node[i])]
        finish += [i for i in able if size[i] <= local]
        large = [i for i in able if size[i] > local]
        below: dict[int, int] = {}
        found: dict[int, Split] = {}
        for a in range(0, len(large), PASS_NODES):
            found |= best_splits(source, top, large[a : a + PASS_NODES], growth, edges)
        for i, s in found.items():
            left = top.add(top.tree[i], top.node[i] + "L", s.l0, s.l1)
            right = top.add(top.tree[i], top.node[i] + "R", top.n0[i] - s.l0, top.n1[i] - s.l1)
            below[left], below[right] = s.lc, size[i] - s.lc
            top.feature[i], top.threshold[i], top.kid[i] = s.feature, s.threshold, left
        size = below
    sub_of = np.full(len(top.tree), -1, np.int64)
    sub_of[finish] = np.arange(len(finish))
    sent = source.run(top, _to_finish(sub_of, top, finish), "sub int, tree int, node string, cells binary", finish)
    # little data, much work: subtrees are not put together into few tasks
    sent = sent.repartition(max(1, min(2 * len(finish), MOST_TASKS)), "sub")
    made = sent.groupBy("sub").applyInPandas(_finish(growth, p), PACKED)
    subtrees = cut(made if finish else made.limit(0))
    return Trees(top, subtrees, dict(enumerate(finish)), list(features))


def subset_size(max_features: int | float | str | None, width: int) -> int | None:
    """How many features a split looks at; null for all."""
    if max_features is None:
        return None
    if max_features in ("auto", "sqrt"):
        return max(1, int(np.sqrt(width)))
    if max_features == "log2":
        return max(1, int(np.log2(width)))
    if isinstance(max_features, float):
        return max(1, int(max_features * width))
    return int(max_features)
