"""Joins, unions and the small-table operators of the result tables."""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.roles import quoted
from riskloom.session import cut

# A lookup side is broadcast only when it has been measured to be at most this long and wide.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def _width(name: str, kind: T.DataType) -> Column:
    """Bytes of a cell: measured where the type does not fix them."""
    c = F.col(quoted(name))
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.NumericType, T.BooleanType, T.DateType)):
        return F.coalesce(F.size(c), F.lit(0)) * 8 + 32
    if isinstance(kind, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit(16)
    return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 16


def is_small(side: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether a side is short and light enough to broadcast, by one scan of it."""
    width = sum((_width(f.name, f.dataType) for f in side.schema.fields), F.lit(0))
    n, total = side.agg(F.count(F.lit(1)), F.sum(width.cast("bigint"))).first()
    return n <= rows and (total or 0) <= size


def salt_parts(df: DataFrame) -> int:
    """Salts of a hot key: as many as there are shuffle partitions to fill."""
    return max(64, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join in which a null key equals a null key; the keys come from the left side."""
    named = right.select(
        *[F.col(quoted(k)).alias(f"_k{i}") for i, k in enumerate(keys)], *[F.col(quoted(c)) for c in right.columns if c not in keys]
    )
    same = [F.col(quoted(k)).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return left.join(named, reduce(Column.__and__, same)).drop(*[f"_k{i}" for i in range(len(keys))])


def hot_hashes(df: DataFrame, keys: Sequence[str], parts: int) -> list[int]:
    """Hashes of keys that hold at least 1/parts of the rows: at most ``parts`` of them."""
    counts = df.groupBy(F.xxhash64(*[F.col(quoted(k)) for k in keys]).alias("h")).count()
    top = counts.orderBy(F.desc("count")).limit(parts).collect()
    if not top:
        return []
    total = df.count()
    return [r["h"] for r in top if r["count"] * parts >= total]


def lookup_join(
    df: DataFrame,
    side: DataFrame,
    keys: Sequence[str],
    row_key: str,
    how: str = "left",
    parts: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join ``df`` with a ``side`` that has one row per key.

    A side of checked size is broadcast. Otherwise both sides shuffle on the key, and
    keys that hold 1/parts of ``df`` or more (``parts``: the shuffle partitions) are spread over ``parts`` salts, their
    single ``side`` row being repeated for each salt. ``row_key`` identifies a row of
    ``df``, so that a recomputed task salts the same way.
    """
    if is_small(side, broadcast_rows):
        return df.join(F.broadcast(side), list(keys), how)
    parts = parts or salt_parts(df)
    hot = hot_hashes(df, keys, parts)
    if not hot:
        return df.join(side, list(keys), how)
    is_hot = F.xxhash64(*[F.col(quoted(k)) for k in keys]).isin(hot)
    salt = F.when(is_hot, F.pmod(F.xxhash64(F.col(quoted(row_key))), F.lit(parts)).cast("int")).otherwise(0)
    salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    return (
        df.withColumn("_salt", salt)
        .join(side.withColumn("_salt", F.explode(salts)), [*keys, "_salt"], how)
        .drop("_salt")
    )


def index_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """1:1 left join on the row key."""
    return left.join(right, key, "left")


def lookup_rows(data: DataFrame, picks: DataFrame, key: str) -> DataFrame:
    """Rows of ``data`` in the multiplicity of ``picks``: a key drawn twice gives two rows.

    ``picks`` holds ``key`` and ``mult``; the repeats are produced after the join.
    """
    copies = F.explode(F.sequence(F.lit(1), F.col("mult"))).alias("draw")
    return picks.join(data, key).select("*", copies).drop("mult")


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Append rows; columns a frame lacks become null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def upsert(table: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Add ``rows`` to a result table; for an existing key the new row wins.

    ``rows`` is unique on ``key``.
    """
    return rows.unionByName(table.join(rows.select(*key), list(key), "left_anti"), allowMissingColumns=True)


def value_combinations(values: Mapping[str, Sequence[Any]]) -> list[dict[str, Any]]:
    """All combinations of the value lists, in the order of the lists."""
    names = list(values)
    return [dict(zip(names, combo)) for combo in itertools.product(*(values[n] for n in names))]


def feature_subsets(names: Sequence[str]) -> list[tuple[str, ...]]:
    """All subsets that leave out at most two names."""
    sizes = range(max(0, len(names) - 2), len(names) + 1)
    return [s for k in sizes for s in itertools.combinations(names, k)]


def rank_results(results: DataFrame, criterion: str, name: str = "name") -> DataFrame:
    """Result table, best first; equal values in name order."""
    return results.orderBy(F.desc(criterion), F.asc(name))


def best_config(results: DataFrame, criterion: str, name: str = "name") -> DataFrame:
    return rank_results(results, criterion, name).limit(1)


def best_worst(results: DataFrame, model: str, metrics: Sequence[str]) -> DataFrame:
    """Best and worst model per metric; equal values go to the smallest name."""
    cells = F.explode(
        F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    ).alias("e")
    long = results.select(F.col(model).alias("model"), cells).select("model", "e.metric", "e.value")
    return long.where(F.col("value").isNotNull()).groupBy("metric").agg(
        F.min_by("model", F.struct(-F.col("value"), F.col("model"))).alias("best"),
        F.min_by("model", F.struct(F.col("value"), F.col("model"))).alias("worst"),
    )


def materialise(df: DataFrame) -> DataFrame:
    """Compute once and continue from the reliable copy."""
    return cut(df)
