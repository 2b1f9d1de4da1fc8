"""Null handling: indicators and fills. Statistics are fitted, then applied as literals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import scalars as S
from riskloom.operators.quantile import exact_quantiles
from riskloom.operators.relational import lookup_join
from riskloom.roles import quoted
from riskloom.session import cut


def with_columns(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add or replace many columns in one projection."""
    return df.withColumns(dict(columns)) if columns else df


def missing_indicators(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return with_columns(df, {f"{c}_missing": S.is_missing(F.col(quoted(c))) for c in dict.fromkeys(cols)})


def binary_transform(df: DataFrame, cols: Sequence[str], null_as: int = 1) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    return with_columns(df, {c: S.truthy(F.col(quoted(c)), types[c], null_as) for c in dict.fromkeys(cols)})


def match_feature(df: DataFrame, a: str, b: str, name: str, null_as: int = 1) -> DataFrame:
    """1 where the truth of two columns agrees. The sources stay as they are."""
    types = {f.name: f.dataType for f in df.schema.fields}
    left = S.truthy(F.col(quoted(a)), types[a], null_as)
    right = S.truthy(F.col(quoted(b)), types[b], null_as)
    return df.withColumn(name, S.match(left, right))


def change_time(df: DataFrame, cols: Sequence[str], fmt: str | None = None, strict: bool = False) -> DataFrame:
    return with_columns(df, {c: S.parse_timestamp(F.col(quoted(c)), fmt, strict) for c in cols})


def date_parts(df: DataFrame, cols: Sequence[str], year: bool = True, month: bool = True) -> DataFrame:
    new: dict[str, Column] = {}
    for c in cols:
        if year:
            new[f"{c}_yr"] = F.year(F.col(quoted(c)))
        if month:
            new[f"{c}_mth"] = F.month(F.col(quoted(c)))
    return with_columns(df, new)


def interval(df: DataFrame, start: str, end: str, name: str) -> DataFrame:
    kind = df.schema[end].dataType
    is_time = isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType))
    return df.withColumn(name, S.interval(F.col(quoted(start)), F.col(quoted(end)), is_time))


@dataclass
class Fill:
    """Nulls of a column become one value per column."""

    values: dict[str, Any]

    def transform(self, df: DataFrame) -> DataFrame:
        types = {f.name: f.dataType for f in df.schema.fields}

        def wide(c: str, v: Any) -> T.DataType:
            # a fractional value widens an integer column instead of losing its fraction
            fraction = isinstance(v, float) and not v.is_integer()
            return T.DoubleType() if fraction and isinstance(types[c], T.IntegralType) else types[c]

        return with_columns(
            df,
            {
                c: F.coalesce(F.col(quoted(c)).cast(wide(c, v)), F.lit(v).cast(wide(c, v)))
                for c, v in self.values.items()
                if v is not None
            },
        )


def fill_constant(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    return Fill(dict(values)).transform(df)


def fit_mean(df: DataFrame, cols: Sequence[str]) -> Fill:
    row = df.agg(*[F.avg(F.col(quoted(c))).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    return Fill({c: row[i] for i, c in enumerate(cols)})


def fit_median(df: DataFrame, cols: Sequence[str], **limits: int) -> Fill:
    medians = exact_quantiles(df, cols, [0.5], **limits)
    return Fill({c: medians[c][0.5] for c in cols})


def mode_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column: its most frequent value (smallest on a tie) and the frequency.

    The value sits in the slot of its type: ``num``, ``whole`` or ``text``; a decimal is
    in ``text`` too, digit by digit, as ``num`` may not hold all of them. All columns
    are counted in one aggregation; equal values combine before the shuffle.
    """
    types = {f.name: f.dataType for f in df.schema.fields}

    def cell(c: str) -> Column:
        v, t = F.col(quoted(c)), types[c]
        num = isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType))
        whole = isinstance(t, T.IntegralType)
        return F.struct(
            F.lit(c).alias("column"),
            (v.cast("double") if num else F.lit(None).cast("double")).alias("num"),
            (v.cast("bigint") if whole else F.lit(None).cast("bigint")).alias("whole"),
            (v.cast("string") if not (num or whole) or isinstance(t, T.DecimalType) else F.lit(None).cast("string")).alias("text"),
        )

    long = df.select(F.explode(F.array(*[cell(c) for c in dict.fromkeys(cols)])).alias("e")).select("e.*")
    counts = (
        long.where(F.coalesce(F.col("num").cast("string"), F.col("whole").cast("string"), F.col("text")).isNotNull())
        .groupBy("column", "num", "whole", "text")
        .count()
    )
    best = counts.groupBy("column").agg(F.min(F.struct((-F.col("count")).alias("rank"), "num", "whole", "text")).alias("b"))
    return best.select("column", "b.num", "b.whole", "b.text", (-F.col("b.rank")).alias("freq"))


def fit_mode(df: DataFrame, cols: Sequence[str]) -> Fill:
    rows = mode_table(df, cols).collect()  # one row per column
    # the text, where there is one, is the value in full
    values = {r["column"]: next(v for v in (r["text"], r["num"], r["whole"]) if v is not None) for r in rows}
    return Fill({c: values.get(c) for c in cols})


@dataclass
class GroupMeanFill:
    """Nulls become the mean of the row's own category; rows without category stay."""

    by: str
    cols: list[str]
    row_key: str
    stats: DataFrame | None = field(default=None, repr=False)

    def fit(self, df: DataFrame) -> "GroupMeanFill":
        known = df.where(F.col(quoted(self.by)).isNotNull())
        means = [F.avg(F.col(quoted(c))).alias(f"_m{i}") for i, c in enumerate(self.cols)]
        # a hot category shrinks to one row per task before the shuffle
        self.stats = cut(known.groupBy(self.by).agg(*means))
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        joined = lookup_join(df, self.stats, [self.by], self.row_key)
        filled = {
            c: F.coalesce(F.col(quoted(c)).cast("double"), F.col(f"_m{i}")) for i, c in enumerate(self.cols)
        }
        return joined.withColumns(filled).select(*[F.col(quoted(c)) for c in df.columns])
