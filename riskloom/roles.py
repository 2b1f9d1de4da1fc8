"""Column roles: which columns are ids, target, times, numbers, categories and flags."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class Roles:
    """Column names by role, in the order they should appear."""

    id: list[str] = field(default_factory=list)
    target: list[str] = field(default_factory=list)
    time: list[str] = field(default_factory=list)
    numerical: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)
    boolean: list[str] = field(default_factory=list)
    # columns that get a <name>_missing flag before anything is filled
    missing_flag: list[str] = field(default_factory=list)
    # columns filled with their mode
    fill_mode: list[str] = field(default_factory=list)

    def role_of(self) -> dict[str, str]:
        kinds = ("id", "target", "time", "numerical", "categorical", "boolean")
        return {name: kind for kind in kinds for name in getattr(self, kind)}

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> "Roles":
        return cls(**json.loads(text))

    @classmethod
    def infer(cls, df: DataFrame, id: list[str], target: list[str]) -> "Roles":
        """Roles by column type, for tables that come without a catalogue."""
        roles = cls(id=list(id), target=list(target))
        taken = set(id) | set(target)
        for f in df.schema.fields:
            if f.name in taken:
                continue
            if isinstance(f.dataType, T.NumericType):
                roles.numerical.append(f.name)
            elif isinstance(f.dataType, T.BooleanType):
                roles.boolean.append(f.name)
            elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
                roles.time.append(f.name)
            else:
                roles.categorical.append(f.name)
        return roles


def tag_roles(df: DataFrame, roles: Roles) -> DataFrame:
    """Write each column's role into its field metadata."""
    kinds = roles.role_of()
    return df.select(
        *[F.col(_q(c)).alias(c, metadata={"role": kinds[c]}) if c in kinds else F.col(_q(c)) for c in df.columns]
    )


def columns_with_role(df: DataFrame, *kinds: str) -> list[str]:
    return [f.name for f in df.schema.fields if f.metadata.get("role") in kinds]


def select_by_role(df: DataFrame, *kinds: str) -> DataFrame:
    return df.select(*[F.col(_q(c)) for c in columns_with_role(df, *kinds)])


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into null once at ingest; everything downstream relies on it."""

    def clean(f: T.StructField) -> Column:
        c = F.col(_q(f.name))
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return F.when(~F.isnan(c), c).alias(f.name, metadata=f.metadata)
        return c

    return df.select(*[clean(f) for f in df.schema.fields])


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


quoted = _q
