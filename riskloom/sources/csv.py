"""CSV in and out. The first column of a file is the row key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from riskloom.roles import nan_to_null

# Quoting and time formats that both sides share.
_TIME = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
_TEXT = {"quote": '"', "escape": '"', "multiLine": "true", "timestampFormat": _TIME, "timestampNTZFormat": _TIME}


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    row_key: str | None = "row_id",
    null_token: str = "",
    sep: str = ",",
    encoding: str = "UTF-8",
    line_breaks: bool = True,
) -> DataFrame:
    """A CSV file with header; the unnamed or first column becomes ``row_key``.

    Doubled quotes and line breaks inside quotes are read as written, so a file is read by
    one task: large tables come in many part files. ``line_breaks=False`` says that no cell
    holds a line break, and large files are split over tasks; a cell that holds one all the
    same leaves a line of the wrong length, which raises. Give a schema for large tables: without one the
    types are inferred by an extra scan. A cell that does not fit its type raises;
    an empty one is null, quoted or not.
    """
    reader = (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("nullValue", null_token)
        .options(**{**_TEXT, "multiLine": str(line_breaks).lower()})
        .option("mode", "FAILFAST")
    )
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path)
    if row_key and df.columns and df.columns[0] != row_key:
        df = df.withColumnRenamed(df.columns[0], row_key)
    return nan_to_null(df)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", null_token: str = "") -> None:
    """One directory of CSV parts with header; ``mode='append'`` adds to it."""
    kept = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}  # the writer trims by default
    df.write.mode(mode).option("header", True).option("nullValue", null_token).options(**_TEXT, **kept).csv(path)
