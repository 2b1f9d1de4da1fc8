"""Registered queries: a Spark callable and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.roles import quoted
from riskloom.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
# Decimals kept of floating results: the two engines add in different orders.
DIGITS = 6

COHORT = """
li as (
  select l_orderkey,
         max(case when l_returnflag = 'R' then 1 else 0 end) as label,
         min(l_shipdate) as first_ship, max(l_shipdate) as last_ship,
         sum(l_quantity) as qty, avg(l_discount) as disc
  from lineitem group by l_orderkey),
cohort as (
  select o.o_orderkey as row_id, li.label,
         o.o_orderdate as enrolled, cast(year(o.o_orderdate) as integer) as enrolled_yr,
         li.first_ship, li.last_ship, li.qty, li.disc, o.o_totalprice as total,
         case when o.o_orderkey % 7 = 3 then null else c.c_acctbal end as acctbal,
         case when o.o_orderkey % 11 = 5 then null else c.c_mktsegment end as segment,
         o.o_orderpriority as priority,
         case when o.o_orderkey % 13 = 1 then null else o.o_orderstatus = 'F' end as flag_a,
         c.c_nationkey % 2 = 0 as flag_b
  from orders o
  join customer c on c.c_custkey = o.o_custkey
  left join li on li.l_orderkey = o.o_orderkey)"""


def query(sql: str | None = None, rounded: bool = True) -> Callable[[Query], Query]:
    """Register a function under its own name; floating results are rounded."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            out = fn(prepare(spark), folder)
            return round_floats(out) if rounded else out

        QUERIES[fn.__name__] = run
        if sql is not None:
            SQL[fn.__name__] = sql
        return run

    return register


def on_cohort(body: str) -> str:
    return f"with {COHORT.strip()}\n{body}"


def round_floats(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.round(F.col(quoted(f.name)).cast("double"), DIGITS).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(quoted(f.name))
            for f in df.schema.fields
        ]
    )
