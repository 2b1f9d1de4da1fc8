"""Splits, samples and positions as registered queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import split as SP
from riskloom.operators.order import dense_positions
from riskloom.operators.relational import lookup_rows
from riskloom.plans.registry import on_cohort, query
from riskloom.sources.tables import cohort, table

# The draws of one group in SQL: position = hash(seed, group..., replicate, i) % size.
UNIT = "1152921504606846976.0"


def sql_hash(text: str) -> str:
    return f"cast(('0x' || substr(md5({text}), 1, 15)) as bigint)"


@query("select row_number() over (order by o_orderdate, o_orderkey) - 1 as pos, o_orderkey, o_orderdate from orders")
def dense_row_number(spark, folder):
    return dense_positions(table(spark, folder, "orders"), ["o_orderdate", "o_orderkey"])


@query(on_cohort("select row_id, enrolled_yr, case when enrolled_yr <= 1999 then 'train' else 'test' end as role from cohort"))
def time_split(spark, folder):
    return SP.time_split(cohort(spark, folder).select("row_id", "enrolled_yr"), "enrolled_yr", 1999)


@query(
    on_cohort("""select row_id, enrolled_yr, case when enrolled_yr <= 1997 then 'train' else 'test' end as role
from cohort where enrolled_yr <= 1999""")
)
def cv_split(spark, folder):
    return SP.cv_split(cohort(spark, folder).select("row_id", "enrolled_yr"), "enrolled_yr", 1997, 1999)


_SEQUENTIAL = """
with n as (select count(*) as n from events),
size as (select n, cast(round_even(n * 0.4 * 0.8, 0) as bigint) as train,
                cast(round_even(n * 0.4, 0) - round_even(n * 0.4 * 0.8, 0) as bigint) as test from n),
step as (select n, train, test, train + test - (5 * (train + test) - n) // 4 as step from size),
span as (select i as fold, case when i = 4 then n - train - test else i * step end as start, train, test
         from step cross join range(5) r(i)),
pos as (select event_id, row_number() over (order by ts, event_id) - 1 as pos from events)
select event_id, cast(fold as integer) as fold, case when pos < start + train then 'train' else 'test' end as role
from pos join span on pos >= start and pos < start + train + test"""


@query(_SEQUENTIAL)
def sequential_folds(spark, folder):
    return SP.sequential_folds(table(spark, folder, "events"), ["ts", "event_id"], "event_id", 5, 0.4, 0.8)


_BOOT_ROWS = f"""
, placed as (select *, row_number() over (order by row_id) - 1 as pos, count(*) over () as n from cohort),
size as (select count(*) as n from cohort),
draws as (select {sql_hash("'11-all-0-' || i")} % n as pos
          from size cross join range(cast(floor((select count(*) from orders) * 0.8 + 0.5) as bigint)) r(i))
select p.row_id, p.label, p.total, row_number() over (partition by p.row_id) as draw
from draws d join placed p on p.pos = d.pos"""


@query(on_cohort(_BOOT_ROWS.strip()))
def bootstrap_rows(spark, folder):
    rows = cohort(spark, folder).select("row_id", "label", "total")
    return lookup_rows(rows, SP.bootstrap(rows, "row_id", 0.8, seed=11), "row_id")


TIME_FOLDS = [(1997, 1998), (1998, 1999)]
BOOT_CV = f""", fold(fold, a, b) as (values (0, 1997, 1998), (1, 1998, 1999)),
members as (select fold, case when enrolled_yr <= a then 'train' else 'test' end as role, row_id
            from cohort join fold on enrolled_yr <= b),
placed as (select *, row_number() over (partition by fold, role order by row_id) - 1 as pos from members),
size as (select fold, role, count(*) as n from members group by fold, role),
draws as (
  select fold, role, rep as replicate, {sql_hash("'5-' || fold || '-' || role || '-' || rep || '-' || i")} % n as pos
  from (select fold, role, n, unnest(range(cast(floor(n * 0.8 + 0.5) as bigint))) as i from size) cross join range(3) g(rep)),
boot as (select d.fold, d.role, cast(d.replicate as integer) as replicate, p.row_id, count(*) as mult
         from draws d join placed p on p.fold = d.fold and p.role = d.role and p.pos = d.pos group by all)
"""


@query(on_cohort(BOOT_CV + "select * from boot"))
def bootstrap_time_cv(spark, folder):
    rows = cohort(spark, folder).select("row_id", "enrolled_yr")
    return SP.bootstrap_time_cv(rows, "enrolled_yr", TIME_FOLDS, "row_id", 0.8, 3, seed=5)


@query(
    on_cohort(
        f"select row_id, case when {sql_hash(chr(39) + '3-' + chr(39) + ' || row_id')} / {UNIT} > 0.75 "
        "then 'test' else 'train' end as role from cohort"
    )
)
def random_holdout(spark, folder):
    return SP.random_holdout(cohort(spark, folder).select("row_id"), "row_id", 0.25, seed=3)


def _fold_sql(pos: str, folds: int) -> str:
    size, extra = f"(n // {folds})", f"(n % {folds})"
    return (
        f"cast(case when {pos} < {extra} * ({size} + 1) then {pos} // ({size} + 1) "
        f"else {extra} + ({pos} - {extra} * ({size} + 1)) // {size} end as integer)"
    )


@query(
    f"""with h as (select o_orderkey, {sql_hash("'9-' || o_orderkey")} as h from orders),
p as (select o_orderkey, row_number() over (order by h, o_orderkey) - 1 as pos, count(*) over () as n from h)
select o_orderkey, {_fold_sql('pos', 7)} as fold from p"""
)
def kfold_shuffled(spark, folder):
    return SP.kfold_shuffled(table(spark, folder, "orders"), "o_orderkey", 7, seed=9)


@query(
    f"""with p as (select event_id, row_number() over (order by ts, event_id) - 1 as pos, count(*) over () as n from events)
select event_id, {_fold_sql('pos', 7)} as fold from p"""
)
def kfold_contiguous(spark, folder):
    return SP.kfold_contiguous(table(spark, folder, "events"), ["ts", "event_id"], "event_id", 7)


OOF_FOLDS = f"""
, rows_ as (select row_id, label from cohort where label is not null),
h as (select row_id, label, {sql_hash("'2-' || row_id")} as h from rows_),
p as (select row_id, label, row_number() over (order by h, row_id) - 1 as pos, count(*) over () as n from h),
f as (select row_id, label, {_fold_sql('pos', 5)} as fold from p)
"""


@query(
    on_cohort(
        OOF_FOLDS.strip()
        + """ select row_id, label, fold, round((sum(label) over () - sum(label) over (partition by fold)) * 1.0
  / (count(*) over () - count(*) over (partition by fold)), 6) as score from f"""
    )
)
def oof_baseline(spark, folder):
    """Each row is scored with the share of positives among the rows of the other folds."""
    rows = cohort(spark, folder).where("label is not null").select("row_id", "label")
    folded = rows.join(SP.kfold_shuffled(rows, "row_id", 5, seed=2), "row_id")
    counts = folded.groupBy("fold").agg(F.sum("label").alias("p"), F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("p").alias("p"), F.sum("n").alias("n")).first()
    rest = counts.select("fold", ((F.lit(total["p"]) - F.col("p")) / (F.lit(total["n"]) - F.col("n"))).alias("score"))
    # one row per fold
    return folded.join(F.broadcast(rest), "fold").select("row_id", "label", "fold", "score")
