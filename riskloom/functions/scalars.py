"""Row-level features as Spark column expressions (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def strip_thousands(c: Column) -> Column:
    """``'1,234.5'`` -> 1234.5; text that is no number gives null."""
    return F.replace(c, F.lit(","), F.lit("")).try_cast("double")


def parse_timestamp(c: Column, fmt: str | None = None, strict: bool = False) -> Column:
    """Text -> timestamp without zone. Strict mode raises on bad text, else null."""
    if strict:
        return c.cast("timestamp_ntz") if fmt is None else F.to_timestamp_ntz(c, F.lit(fmt))
    return c.try_cast("timestamp_ntz") if fmt is None else F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz")


def is_missing(c: Column) -> Column:
    return c.isNull().cast("int")


def truthy(c: Column, dtype: T.DataType, null_as: int = 1) -> Column:
    """1 if the value counts as true, else 0.

    Numbers are true unless 0, text unless empty. A null came from an empty CSV
    cell, and an empty cell counts as true there, hence ``null_as=1``.
    """
    if isinstance(dtype, T.BooleanType):
        yes = c
    elif isinstance(dtype, T.NumericType):
        yes = c != F.lit(0).cast(dtype)
    elif isinstance(dtype, T.StringType):
        yes = c != F.lit("")
    else:
        yes = F.lit(True)
    return F.when(c.isNull(), F.lit(null_as)).when(yes, F.lit(1)).otherwise(F.lit(0))


def match(a: Column, b: Column) -> Column:
    """1 where two 0/1 columns agree."""
    return (a == b).cast("int")


def interval(start: Column, end: Column, is_time: bool) -> Column:
    """``end - start``: nanoseconds for timestamps, plain difference for numbers."""
    if is_time:
        micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
        return micros * F.lit(1000)
    return end - start


def negative_flag(c: Column) -> Column:
    return F.coalesce(c < 0, F.lit(False)).cast("int")


def abs_difference(a: Column, b: Column) -> Column:
    return F.abs(a - b)


def cap(c: Column, limit: float) -> Column:
    """Values above ``limit`` become ``limit``; null stays null (``least`` would drop it)."""
    return F.when(c > F.lit(limit), F.lit(limit)).otherwise(c)


def at_least(c: Column, value: float) -> Column:
    """Boolean ``c >= value``; null counts as false."""
    return F.coalesce(c >= F.lit(value), F.lit(False))


def apply_threshold(score: Column, threshold: Column | float) -> Column:
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.coalesce(score >= t, F.lit(False)).cast("int")


def equal_width_bin(c: Column, lo: float, hi: float, bins: int) -> Column:
    """Right-closed equal-width bins 0..bins-1 over [lo, hi]; the minimum falls into bin 0."""
    if lo == hi:
        return F.when(c.isNotNull(), F.lit((bins - 1) // 2))
    width = (hi - lo) / bins
    code = F.ceil((c - F.lit(lo)) / F.lit(width)) - 1
    return F.when(c.isNotNull(), F.least(F.lit(bins - 1), F.greatest(F.lit(0), code)).cast("int"))


def histogram_bin(c: Column, lo: float, hi: float, bins: int) -> Column:
    """Left-closed equal-width bins, last one closed; values outside [lo, hi] give null."""
    if lo == hi:
        # a single value sits in the middle of a unit-wide range
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    code = F.floor((c - F.lit(lo)) / F.lit(width))
    return F.when((c >= F.lit(lo)) & (c <= F.lit(hi)), F.least(F.lit(bins - 1), code).cast("int"))


def ladder_bin(c: Column, edges: list[float]) -> Column:
    """Code of the right-closed interval ``(edges[i], edges[i+1]]``; outside gives null."""
    out = None
    for i in range(len(edges) - 1):
        inside = (c > F.lit(edges[i])) & (c <= F.lit(edges[i + 1]))
        out = F.when(inside, F.lit(i)) if out is None else out.when(inside, F.lit(i))
    return out


def edge_bin(c: Column, edges: list[float]) -> Column:
    """Code of the left-closed interval ``[edges[i], edges[i+1])``, last one closed."""
    out = None
    last = len(edges) - 2
    for i in range(last + 1):
        upper = c <= F.lit(edges[i + 1]) if i == last else c < F.lit(edges[i + 1])
        inside = (c >= F.lit(edges[i])) & upper
        out = F.when(inside, F.lit(i)) if out is None else out.when(inside, F.lit(i))
    return out


def keyed_hash(*parts: Column | str | int) -> Column:
    """A 60-bit number that depends on its parts only, not on how rows are spread.

    60 bits keep ``hash % n`` close to uniform for any table size; the same
    number can be computed in other SQL engines from md5.
    """
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    text = F.concat_ws("-", *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def unit_hash(*parts: Column | str | int) -> Column:
    """A double in [0, 1) that depends on its parts only."""
    return keyed_hash(*parts).cast("double") / F.lit(float(1 << 60))
