"""The Parquet tables and the cohort view that one-row-per-client operators run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.relational import lookup_join
from riskloom.roles import nan_to_null
from riskloom.session import cut


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def clean_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return nan_to_null(table(spark, folder, name))


def cohort(spark: SparkSession, folder: str, exact: bool = False) -> DataFrame:
    """One row per order stands for one client; some cells are null by key.

    ``exact`` takes the mean discount from a decimal sum (six digits after the point), which
    is the same in whatever order its rows are added.
    """
    discount = F.sum(F.col("l_discount").cast("decimal(28,6)")).cast("double") / F.count("l_discount") if exact else F.avg("l_discount")
    lines = (
        clean_table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("label"),
            F.min("l_shipdate").alias("first_ship"),
            F.max("l_shipdate").alias("last_ship"),
            F.sum("l_quantity").alias("qty"),
            discount.alias("disc"),
        )
    )
    customers = clean_table(spark, folder, "customer").select("c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey")
    orders = clean_table(spark, folder, "orders").withColumnRenamed("o_custkey", "c_custkey")
    known = lookup_join(orders, customers, ["c_custkey"], "o_orderkey", how="inner")
    joined = known.join(lines, known["o_orderkey"] == lines["l_orderkey"], "left")

    def unless(remainder: int, modulus: int, value):
        return F.when(F.col("o_orderkey") % modulus != remainder, value)

    return joined.select(
        F.col("o_orderkey").alias("row_id"),
        "label",
        F.col("o_orderdate").alias("enrolled"),
        F.year("o_orderdate").alias("enrolled_yr"),
        "first_ship",
        "last_ship",
        "qty",
        "disc",
        F.col("o_totalprice").alias("total"),
        unless(3, 7, F.col("c_acctbal")).alias("acctbal"),
        unless(5, 11, F.col("c_mktsegment")).alias("segment"),
        F.col("o_orderpriority").alias("priority"),
        unless(1, 13, F.col("o_orderstatus") == "F").alias("flag_a"),
        (F.col("c_nationkey") % 2 == 0).alias("flag_b"),
    )


def cohort_table(spark: SparkSession, folder: str, *cols: str) -> DataFrame:
    """Columns of the cohort, written once: for steps that read their input several times."""
    return cut(cohort(spark, folder).select(*cols))
