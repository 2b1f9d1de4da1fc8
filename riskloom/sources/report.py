"""The report of a run as tables instead of prose."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def write_report(tables: Mapping[str, DataFrame], folder: str, mode: str = "overwrite") -> None:
    """One Parquet table per part (profile, metrics, best and worst, confusion, ...)."""
    for name, df in tables.items():
        df.write.mode(mode).parquet(f"{folder.rstrip('/')}/{name}")


def read_report(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}")
