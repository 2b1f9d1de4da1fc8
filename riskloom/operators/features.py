"""Features that need a fit: bins, one-hot columns, standardisation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import scalars as S
from riskloom.operators.clean import with_columns
from riskloom.operators.order import dense_positions
from riskloom.operators.quantile import exact_quantiles
from riskloom.operators.relational import lookup_join
from riskloom.roles import quoted
from riskloom.session import cut, fresh_path

# Columns one table may gain through one-hot encoding before it has to stay long.
MAX_ONE_HOT = 2_000


@dataclass
class EqualWidthBins:
    """Cap a column, then cut [min, max] into bins of equal width, coded 0..bins-1."""

    col: str
    bins: int
    cap: float | None = None
    name: str | None = None
    lo: float | None = None
    hi: float | None = None

    def _value(self) -> Column:
        x = F.col(quoted(self.col)).cast("double")
        return S.cap(x, float(self.cap)) if self.cap is not None else x

    def fit(self, df: DataFrame) -> "EqualWidthBins":
        self.lo, self.hi = df.agg(F.min(self._value()), F.max(self._value())).first()
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        code = (
            F.lit(None).cast("int")
            if self.lo is None
            else S.equal_width_bin(self._value(), self.lo, self.hi, self.bins)
        )
        out = {self.name or f"{self.col}_bins": code}
        if self.cap is not None:
            out[self.col] = self._value()
        return df.withColumns(out)


@dataclass
class QuantileBins:
    """Right-closed bins between quantiles; the minimum itself belongs to no bin."""

    col: str
    probs: list[float]
    name: str | None = None
    edges: list[float] = field(default_factory=list)

    def fit(self, df: DataFrame, **limits: int) -> "QuantileBins":
        q = exact_quantiles(df, [self.col], self.probs, **limits)[self.col]
        self.edges = [q[p] for p in self.probs]
        if any(a is None or b is None or a >= b for a, b in zip(self.edges, self.edges[1:])):
            raise ValueError(f"bin edges of {self.col} must increase: {self.edges}")
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        x = F.col(quoted(self.col)).cast("double")
        return df.withColumn(self.name or f"{self.col}_qbin", S.ladder_bin(x, self.edges))


def category_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct (column, value) pairs of all columns in one aggregation; nulls left out."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(quoted(c)).cast("string").alias("value")) for c in cols]
    return (
        df.select(F.explode(F.array(*cells)).alias("e"))
        .select("e.column", "e.value")
        .where(F.col("value").isNotNull())
        .distinct()
    )


@dataclass
class OneHot:
    """0/1 columns ``<col>_<value>`` for the categories seen in fit; the source goes.

    Null and unseen values give all zeros, so train and test get the same columns.
    """

    cols: list[str]
    max_columns: int = MAX_ONE_HOT
    categories: dict[str, list[Any]] = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "OneHot":
        pairs = category_pairs(df, self.cols).limit(self.max_columns + 1).collect()
        if len(pairs) > self.max_columns:
            raise ValueError(
                f"more than {self.max_columns} categories in {self.cols}: use SparseOneHot, which has no bound"
            )
        self.categories = {c: sorted(p["value"] for p in pairs if p["column"] == c) for c in self.cols}
        return self

    def names(self) -> list[str]:
        return [f"{c}_{v}" for c in self.cols for v in self.categories[c]]

    def transform(self, df: DataFrame) -> DataFrame:
        keep = [F.col(quoted(c)) for c in df.columns if c not in self.cols]
        new = [
            F.coalesce(F.col(quoted(c)).cast("string") == F.lit(v), F.lit(False)).cast("int").alias(f"{c}_{v}")
            for c in self.cols
            for v in self.categories[c]
        ]
        return df.select(*keep, *new)


def one_hot_long(df: DataFrame, row_key: str, cols: Sequence[str]) -> DataFrame:
    """The ones of a one-hot table as (row, column, value): no bound on categories."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(quoted(c)).cast("string").alias("value")) for c in cols]
    return (
        df.select(F.col(quoted(row_key)), F.explode(F.array(*cells)).alias("e"))
        .select(quoted(row_key), "e.column", "e.value")
        .where(F.col("value").isNotNull())
    )


@dataclass
class SparseOneHot:
    """One-hot of columns with any number of categories, as one sparse vector a row.

    The categories seen in fit stay a table (column, value, at); rows meet it in a join.
    Null and unseen values set nothing, so train and test get vectors of the same size.
    """

    cols: list[str]
    row_key: str
    name: str = "one_hot"
    categories: DataFrame | None = field(default=None, repr=False)
    size: int = 0

    def fit(self, df: DataFrame) -> "SparseOneHot":
        self.categories = cut(dense_positions(category_pairs(df, self.cols), ["column", "value"], name="at"))
        self.size = self.categories.count()
        if self.size >= 1 << 31:
            raise ValueError("a vector has at most 2^31 - 1 places")
        return self

    def positions(self, df: DataFrame) -> DataFrame:
        """(row_key, at): the places set in each row that has any, one per column at most."""
        long = one_hot_long(df, self.row_key, self.cols)
        found = lookup_join(long, self.categories, ["column", "value"], self.row_key, how="inner")
        return found.groupBy(quoted(self.row_key)).agg(F.sort_array(F.collect_list(F.col("at").cast("int"))).alias("at"))

    def transform(self, df: DataFrame) -> DataFrame:
        """The vector in place of the columns; written once and read again as a vector column."""
        kept = [c for c in df.columns if c not in self.cols]
        at = F.coalesce("at", F.array().cast("array<int>"))
        vector = F.struct(
            F.lit(0).cast("byte").alias("type"), F.lit(self.size).alias("size"), at.alias("indices"),
            F.transform(at, lambda _: F.lit(1.0)).alias("values"),
        )
        made = df.join(self.positions(df), self.row_key, "left").select(*map(quoted, kept), vector.alias(self.name))
        path = fresh_path(df.sparkSession, "one-hot")
        made.write.parquet(path)
        fields = [*made.schema.fields[:-1], T.StructField(self.name, VectorUDT())]
        return df.sparkSession.read.schema(T.StructType(fields)).parquet(path)


@dataclass
class Standardize:
    """(x - mean) / population deviation; a constant column is only centred."""

    cols: list[str]
    stats: dict[str, tuple[float, float]] = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "Standardize":
        aggs = []
        for i, c in enumerate(self.cols):
            x = F.col(quoted(c)).cast("double")
            aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
        row = df.agg(*aggs).first()
        self.stats = {c: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0) for i, c in enumerate(self.cols)}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return with_columns(
            df, {c: (F.col(quoted(c)).cast("double") - F.lit(m)) / F.lit(s) for c, (m, s) in self.stats.items()}
        )
