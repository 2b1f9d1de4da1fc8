"""Exact quantiles of very large columns.

Spark's exact ``percentile`` keeps every distinct value of the column in one buffer,
and an approximate quantile is not what a median fill asks for. Here a mergeable
sketch narrows a bracket around the wanted rank, a counting pass proves that the
bracket holds it, and only the few values inside the bracket are ordered. Each pass
is a scan with a tiny shuffle; the result is exact with linear interpolation.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.roles import quoted


@dataclass
class _Bracket:
    col: str  # the column as SQL
    lo: float | int
    hi: float | int
    below: int  # values < lo
    inside: int  # values in [lo, hi]
    distinct: int  # estimated distinct values in [lo, hi]
    k0: int  # wanted 0-based ranks
    k1: int


# Expressions are written as SQL text here: many columns times many bounds would
# otherwise cost a Python-to-JVM call for every operator.


def _num(df: DataFrame, name: str) -> str:
    """Whole numbers stay whole: above 2^53 a double would merge neighbours."""
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return f"cast({quoted(name)} as bigint)"
    # NaN is no value: it would be the largest of all
    return f"nullif(cast({quoted(name)} as double), double('NaN'))"


def _at(value: float | int) -> str:
    return f"bigint('{value}')" if isinstance(value, int) else f"double('{value!r}')"


def _within(b: "_Bracket | tuple[str, float, float]") -> str:
    col, lo, hi = (b.col, b.lo, b.hi) if isinstance(b, _Bracket) else b
    return f"{col} between {_at(lo)} and {_at(hi)}"


def _between(v0: float | int, v1: float | int, frac: float) -> float | int | Fraction:
    """Linear interpolation; exact between whole numbers."""
    if isinstance(v0, int):
        mixed = v0 + (v1 - v0) * Fraction(frac).limit_denominator(1 << 20)
        return int(mixed) if mixed.denominator == 1 else mixed
    return v0 + (v1 - v0) * frac


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    distinct_limit: int = 1 << 16,
    accuracy: int = 10_000,
    max_rounds: int = 12,
) -> dict[str, dict[float, float | None]]:
    """``{column: {prob: value}}`` over non-null values, linear interpolation.

    ``distinct_limit`` bounds the distinct values one task orders at the end. The table
    is read at least twice: cut the lineage first if it is costly to compute.
    """
    found = quantiles_and_moments(df, cols, probs, distinct_limit, accuracy, max_rounds)[0]
    return {c: {p: None if v is None else float(v) for p, v in by.items()} for c, by in found.items()}


def quantiles_and_moments(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    distinct_limit: int = 1 << 16,
    accuracy: int = 10_000,
    max_rounds: int = 12,
) -> tuple[dict[str, dict[float, float | None]], dict[str, dict[str, float]]]:
    """Exact quantiles, and count, mean, sample deviation, min and max from the same first pass.

    Quantiles, min and max of whole numbers are whole, or fractions between two of them.
    """
    cols = list(dict.fromkeys(cols))
    if not cols:
        return {}, {}
    parts = {
        "n": "count({x})",
        "mean": "avg({x})",
        "std": "stddev_samp({x})",
        "lo": "min({x})",
        "hi": "max({x})",
        "d": "approx_count_distinct({x})",
    }
    aggs = [F.expr(f"{text.format(x=_num(df, c))} as {k}{i}") for i, c in enumerate(cols) for k, text in parts.items()]
    first = df.agg(*aggs).first()
    moments = {
        c: {k: first[f"{p}{i}"] for k, p in (("count", "n"), ("mean", "mean"), ("std", "std"), ("min", "lo"), ("max", "hi"))}
        for i, c in enumerate(cols)
    }

    out: dict[str, dict[float, float | None]] = {c: {} for c in cols}
    wanted: list[tuple[str, float, float, _Bracket]] = []
    for i, c in enumerate(cols):
        n = first[f"n{i}"]
        for p in probs:
            if n == 0:
                out[c][p] = None
                continue
            at = p * (n - 1)
            k0 = min(n - 1, math.floor(at))
            k1 = min(n - 1, k0 + 1) if at > k0 else k0
            box = _Bracket(_num(df, c), first[f"lo{i}"], first[f"hi{i}"], 0, n, first[f"d{i}"], k0, k1)
            wanted.append((c, p, at - k0, box))

    for _ in range(max_rounds):
        open_boxes = [b for *_, b in wanted if b.distinct > distinct_limit and b.lo < b.hi]
        if not open_boxes or not _narrow(df, open_boxes, accuracy):
            break

    ranks = _pick(df, [b for *_, b in wanted])
    for (c, p, frac, _), (v0, v1) in zip(wanted, ranks):
        out[c][p] = _between(v0, v1, frac)
    return out, moments


def _narrow(df: DataFrame, boxes: list[_Bracket], accuracy: int) -> bool:
    """One round: sketch inside each bracket, then count to prove the smaller one."""
    slack = 2.0 / accuracy
    sketch = []
    for i, b in enumerate(boxes):
        p0 = max(0.0, (b.k0 - b.below) / b.inside - slack)
        p1 = min(1.0, (b.k1 - b.below + 1) / b.inside + slack)
        inside = f"case when {_within(b)} then {b.col} end"
        sketch.append(F.expr(f"percentile_approx({inside}, array({_at(p0)}, {_at(p1)}), {accuracy}) as q{i}"))
    guess = df.agg(*sketch).first()

    counts = []
    for i, b in enumerate(boxes):
        lo, hi = guess[f"q{i}"]
        within = _within((b.col, lo, hi))
        counts += [
            F.expr(f"count_if({b.col} < {_at(lo)}) as b{i}"),
            F.expr(f"count_if({within}) as n{i}"),
            F.expr(f"approx_count_distinct(case when {within} then {b.col} end) as d{i}"),
        ]
    seen = df.agg(*counts).first()

    moved = False
    for i, b in enumerate(boxes):
        lo, hi = guess[f"q{i}"]
        below, upto = seen[f"b{i}"], seen[f"b{i}"] + seen[f"n{i}"]
        low_ok, high_ok = below <= b.k0, b.k1 < upto
        end = upto if high_ok else b.below + b.inside
        new_lo, new_hi = (lo if low_ok else b.lo), (hi if high_ok else b.hi)
        moved |= (new_lo, new_hi) != (b.lo, b.hi)
        b.lo, b.hi = new_lo, new_hi
        b.below = below if low_ok else b.below
        b.inside = end - b.below
        if low_ok and high_ok:
            b.distinct = seen[f"d{i}"]
    return moved


def _pick(df: DataFrame, boxes: list[_Bracket]) -> list[tuple[float, float]]:
    """The values at ranks k0 and k1 of each bracket."""
    shared: dict[tuple[str, float, float], int] = {}
    for b in boxes:
        if b.lo < b.hi:
            shared.setdefault((b.col, b.lo, b.hi), len(shared))
    found: dict[tuple[int, int], float] = {}
    if shared:
        wanted: dict[int, set[int]] = {}
        for b in boxes:
            if b.lo < b.hi:
                wanted.setdefault(shared[b.col, b.lo, b.hi], set()).update({b.k0 - b.below, b.k1 - b.below})
        # whole numbers and doubles have a slot each
        whole = [isinstance(box[1], int) for box in shared]
        cells = ", ".join(
            f"case when {_within(box)} then struct({t} as t, {box[0] if w else 'cast(null as bigint)'} as i, {'cast(null as double)' if w else box[0]} as x) end"
            for (box, t), w in zip(shared.items(), whole)
        )
        values = df.select(F.expr(f"explode(array_compact(array({cells}))) as e")).groupBy("e.t", "e.i", "e.x").count()
        upto = Window.partitionBy("t").orderBy("i", "x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ladder = values.withColumn("upto", F.sum("count").over(upto))
        hits = " or ".join(
            f"(t = {t} and upto - count <= {k} and upto > {k})" for t, ks in wanted.items() for k in ks
        )
        for r in ladder.where(hits).collect():  # at most two rows per wanted quantile
            for k in wanted[r["t"]]:
                if r["upto"] - r["count"] <= k < r["upto"]:
                    found[r["t"], k] = r["x"] if r["i"] is None else r["i"]
    out = []
    for b in boxes:
        if b.lo < b.hi:
            t = shared[b.col, b.lo, b.hi]
            out.append((found[t, b.k0 - b.below], found[t, b.k1 - b.below]))
        else:
            out.append((b.lo, b.lo))
    return out
