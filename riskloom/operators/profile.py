"""Profiles: null counts, describe, modes, histograms, value counts."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import scalars as S
from riskloom.operators.clean import mode_table
from riskloom.operators.quantile import exact_quantiles, quantiles_and_moments
from riskloom.roles import quoted

_QUARTILES = [0.25, 0.5, 0.75]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def missing_counts(df: DataFrame) -> DataFrame:
    """(column, missing): one scan, one row per column."""
    names = df.columns
    row = df.agg(*[F.count_if(F.col(quoted(c)).isNull()).alias(f"c{i}") for i, c in enumerate(names)])
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("missing")) for i, c in enumerate(names)]
    return row.select(F.explode(F.array(*cells)).alias("e")).select("e.*")


def columns_with_missing(df: DataFrame) -> DataFrame:
    return missing_counts(df).agg(F.count_if(F.col("missing") > 0).alias("columns_with_missing"))


def null_crosstab(df: DataFrame) -> DataFrame:
    """(column, not_null, is_null) frequencies of every column."""
    names = df.columns
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.count(F.col(quoted(c))).alias(f"c{i}") for i, c in enumerate(names)]
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"c{i}").alias("not_null"),
            (F.col("n") - F.col(f"c{i}")).alias("is_null"),
        )
        for i, c in enumerate(names)
    ]
    return df.agg(*aggs).select(F.explode(F.array(*cells)).alias("e")).select("e.*")


def describe(df: DataFrame, cols: Sequence[str] | None = None, **limits: int) -> DataFrame:
    """count, mean, sample deviation, minimum, quartiles and maximum per numeric column."""
    cols = list(cols if cols is not None else numeric_columns(df))
    q, moments = quantiles_and_moments(df, cols, _QUARTILES, **limits)
    real = lambda v: None if v is None else float(v)
    rows = [
        (c, m["count"], m["mean"], m["std"], real(m["min"]), real(q[c][0.25]), real(q[c][0.5]), real(q[c][0.75]), real(m["max"]))
        for c, m in moments.items()
    ]
    schema = "column string, count bigint, mean double, std double, min double, p25 double, median double, p75 double, max double"
    # one row per column
    return df.sparkSession.createDataFrame(rows, schema)


def whole_ranges(df: DataFrame, cols: Sequence[str] | None = None, **limits: int) -> DataFrame:
    """Count, minimum, quartiles and maximum of whole-number columns, to the last digit: ids do not fit a double."""
    known = [f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegralType)]
    cols = list(cols if cols is not None else known)
    if other := [c for c in cols if c not in known]:
        raise ValueError(f"not whole numbers: {', '.join(other)}")
    q, moments = quantiles_and_moments(df, cols, _QUARTILES, **limits)
    exact = lambda v: None if v is None else Decimal(v.numerator) / Decimal(v.denominator)
    rows = [(c, m["count"], m["min"], *[exact(q[c][p]) for p in _QUARTILES], m["max"]) for c, m in moments.items()]
    schema = "column string, count bigint, min bigint, p25 decimal(22,2), median decimal(22,2), p75 decimal(22,2), max bigint"
    return df.sparkSession.createDataFrame(rows, schema)


def profile(df: DataFrame, digits: int | None = None, with_missing: bool = True, **limits: int) -> DataFrame:
    """One row per column: describe (numbers only), mode and null count."""
    out = mode_table(df, df.columns).select(
        "column",
        F.coalesce("num", F.col("whole").cast("double")).alias("mode_num"),
        F.when(F.col("num").isNull(), F.col("text")).alias("mode_text"),
    )
    out = missing_counts(df).join(out, "column", "left").join(describe(df, **limits), "column", "left")
    if not with_missing:
        out = out.drop("missing")
    return round_half_even(out, digits) if digits is not None else out


def round_half_even(df: DataFrame, digits: int) -> DataFrame:
    """Round the floating columns, halves to the even digit."""
    return df.select(
        *[
            F.bround(F.col(quoted(f.name)), digits).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(quoted(f.name))
            for f in df.schema.fields
        ]
    )


def mask_profile(table: DataFrame, target: str, keep: Sequence[str] = ("mean", "missing")) -> DataFrame:
    """Profile of a binary target: quartiles and count go, and only ``keep`` stays for the target."""
    drop = ("p25", "p75", "count")
    cols = [c for c in table.columns if c not in drop]
    is_target = F.col("column") == F.lit(target)
    return table.select(
        *[
            F.col(c) if c == "column" or c in keep else F.when(~is_target, F.col(c)).alias(c)
            for c in cols
        ]
    )


def transpose(table: DataFrame, key: str, keys: Sequence[str]) -> DataFrame:
    """A small summary with its key values as columns and its columns as rows."""
    values = [c for c in table.columns if c != key]
    cells = [F.struct(F.lit(v).alias("statistic"), F.col(v).cast("double").alias("value")) for v in values]
    long = table.select(key, F.explode(F.array(*cells)).alias("e")).select(key, "e.*")
    return long.groupBy("statistic").pivot(key, list(keys)).agg(F.first("value"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """(value, count) without nulls, most frequent first."""
    return (
        df.where(F.col(quoted(col)).isNotNull())
        .groupBy(F.col(quoted(col)).alias("value"))
        .count()
        .orderBy(F.desc("count"), "value")
    )


def group_sizes(df: DataFrame, col: str) -> DataFrame:
    """(value, count) without nulls, in value order."""
    return (
        df.where(F.col(quoted(col)).isNotNull())
        .groupBy(F.col(quoted(col)).alias("value"))
        .count()
        .orderBy("value")
    )


def _bin_counts(df: DataFrame, code: Column, edges: list[float]) -> DataFrame:
    bins = len(edges) - 1
    counts = df.select(code.alias("bin")).where(F.col("bin").isNotNull()).groupBy("bin").count()
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    at = F.array(*[F.lit(float(e)) for e in edges])
    return frame.join(counts, "bin", "left").select(
        "bin",
        F.element_at(at, F.col("bin") + 1).alias("lo"),
        F.element_at(at, F.col("bin") + 2).alias("hi"),
        F.coalesce("count", F.lit(0).cast("bigint")).alias("count"),
    )


def histogram(
    df: DataFrame, col: str, bins: int = 10, lo: float | None = None, hi: float | None = None
) -> DataFrame:
    """Counts in equal-width bins over [min, max] or the given range; empty bins stay."""
    x = F.col(quoted(col)).cast("double")
    if lo is None or hi is None:
        low, high = df.agg(F.min(x), F.max(x)).first()
        lo, hi = low if lo is None else lo, high if hi is None else hi
    if lo is None:
        lo = hi = 0.0
    left, right = (lo - 0.5, hi + 0.5) if lo == hi else (lo, hi)
    edges = [left + i * (right - left) / bins for i in range(bins)] + [right]
    return _bin_counts(df, S.histogram_bin(x, lo, hi, bins), edges)


def histogram_edges(df: DataFrame, col: str, edges: Sequence[float]) -> DataFrame:
    """Counts between explicit edges; values outside are left out."""
    edges = [float(e) for e in edges]
    return _bin_counts(df, S.edge_bin(F.col(quoted(col)).cast("double"), edges), edges)


def filter_below_quantile(df: DataFrame, col: str, prob: float, **limits: int) -> DataFrame:
    """Rows strictly below the column's quantile; the bound is a literal the scan can use."""
    q = exact_quantiles(df, [col], [prob], **limits)[col][prob]
    return df.where(F.col(quoted(col)) < F.lit(q))


def histogram_truncated(
    df: DataFrame, col: str, prob: float, bins: int = 10, drop_rows: bool = True, **limits: int
) -> DataFrame:
    """Histogram of the rows below a quantile, or with the quantile as upper end of the range."""
    q = exact_quantiles(df, [col], [prob], **limits)[col][prob]
    if drop_rows:
        return histogram(df.where(F.col(quoted(col)) < F.lit(q)), col, bins)
    return histogram(df, col, bins, hi=q)


def plot_tables(
    df: DataFrame, ranged: Sequence[str], truncated: Sequence[str], counted: Sequence[str], prob: float = 0.99
) -> dict[str, DataFrame]:
    """The table behind each column's chart, its kind chosen per column."""
    out = {c: histogram(df, c, 10) for c in ranged}
    out |= {c: histogram_truncated(df, c, prob, 10, drop_rows=False) for c in truncated}
    return out | {c: group_sizes(df, c) for c in counted}


def scalar_summary(df: DataFrame, col: str, prob: float = 0.99, **limits: int) -> DataFrame:
    """Row count, mean, median, a quantile, minimum and maximum of one column."""
    q, moments = quantiles_and_moments(df, [col], [0.5, prob], **limits)
    m = moments[col]
    row = (df.count(), *[None if v is None else float(v) for v in (m["mean"], q[col][0.5], q[col][prob], m["min"], m["max"])])
    schema = "rows bigint, mean double, median double, quantile double, min double, max double"
    return df.sparkSession.createDataFrame([row], schema)
