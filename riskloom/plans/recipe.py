"""The preprocessing recipe: fitted on train rows, applied to any rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.clean import (
    Fill,
    binary_transform,
    fit_median,
    fit_mode,
    match_feature,
    missing_indicators,
)
from riskloom.operators.features import MAX_ONE_HOT, OneHot, SparseOneHot, category_pairs
from riskloom.roles import quoted


@dataclass
class FeatureRecipe:
    """Missing flags, mode fill, median fill, one-hot, 0/1 flags, match features, drop.

    ``matches`` holds (left, right, name); sides may be one-hot columns. Statistics come
    from the frame given to ``fit``; to fill a test frame from itself, fit a second recipe
    on it and keep the first one's categories (``refit_fills``).

    Categories become columns, up to ``MAX_ONE_HOT`` of them; more become one sparse vector
    ``one_hot``, for which rows are joined by ``row_key``. ``sparse`` asks for the one or the other.
    Match features may name a category (``<col>_<value>``) either way.
    """

    flag_missing: list[str] = field(default_factory=list)
    mode_cols: list[str] = field(default_factory=list)
    median_cols: list[str] = field(default_factory=list)
    one_hot_cols: list[str] = field(default_factory=list)
    boolean_cols: list[str] = field(default_factory=list)
    matches: list[tuple[str, str, str]] = field(default_factory=list)
    drop_cols: list[str] = field(default_factory=list)
    fills: Fill | None = None
    encoder: OneHot | SparseOneHot | None = None
    sparse: bool | None = None
    row_key: str = "row_id"

    def fit(self, train: DataFrame) -> "FeatureRecipe":
        self.fills = self._fit_fills(train)
        if self.one_hot_cols:
            self.encoder = self._encoder(self.fills.transform(train))
        return self

    def _encoder(self, filled: DataFrame) -> OneHot | SparseOneHot:
        cols = list(self.one_hot_cols)
        sparse = self.sparse
        if sparse is None:
            sparse = category_pairs(filled, cols).limit(MAX_ONE_HOT + 1).count() > MAX_ONE_HOT
        return SparseOneHot(cols, self.row_key).fit(filled) if sparse else OneHot(cols).fit(filled)

    def _named_categories(self, df: DataFrame) -> DataFrame:
        """Columns for the categories that match features name, where the encoder makes a vector."""
        named = {n: c for left, right, _ in self.matches for n in (left, right) for c in self.one_hot_cols if n not in df.columns and n.startswith(f"{c}_")}
        known = {n: F.coalesce(F.col(quoted(c)).cast("string") == F.lit(n[len(c) + 1 :]), F.lit(False)).cast("int") for n, c in named.items()}
        return df.withColumns(known) if known else df

    def _fit_fills(self, df: DataFrame) -> Fill:
        values = {}
        if self.mode_cols:
            values |= fit_mode(df, self.mode_cols).values
        if self.median_cols:
            values |= fit_median(df, self.median_cols).values
        return Fill(values)

    def refit_fills(self, df: DataFrame) -> "FeatureRecipe":
        """The same recipe with fill values taken from ``df`` itself."""
        other = FeatureRecipe(**self.__dict__)
        other.fills = self._fit_fills(df)
        return other

    def transform(self, df: DataFrame) -> DataFrame:
        out = missing_indicators(df, self.flag_missing)
        out = self.fills.transform(out)
        extra: list[str] = []
        if isinstance(self.encoder, SparseOneHot):
            before = out.columns
            out = self._named_categories(out)
            extra = [c for c in out.columns if c not in before]
        if self.encoder:
            out = self.encoder.transform(out)
        out = binary_transform(out, [c for c in self.boolean_cols if c in out.columns])
        for left, right, name in self.matches:
            out = match_feature(out, left, right, name)
        return out.drop(*self.drop_cols, *extra)


def feature_columns(df: DataFrame, skip: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in skip]
