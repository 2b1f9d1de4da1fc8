"""Profiles and counts as registered queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import profile as P
from riskloom.operators.clean import mode_table
from riskloom.plans.registry import COHORT, on_cohort, query
from riskloom.session import cut
from riskloom.sources.tables import cohort, cohort_table, table

_NUMBERS = ("row_id", "label", "enrolled_yr", "qty", "disc", "total", "acctbal")
_TEXTS = ("segment", "priority", "flag_a", "flag_b")
_ALL = _NUMBERS + _TEXTS


def _each(names, row) -> str:
    return " union all ".join(row(c) for c in names)


def _missing_sql(names) -> str:
    return _each(names, lambda c: f"select '{c}' as \"column\", count(*) - count({c}) as missing from cohort")


def _describe_sql(names) -> str:
    return _each(
        names,
        lambda c: f"""select '{c}' as "column", count({c}) as "count", round(avg({c}), 6) as mean,
  round(stddev_samp({c}), 6) as std, round(cast(min({c}) as double), 6) as min,
  round(quantile_cont(cast({c} as double), 0.25), 6) as p25, round(quantile_cont(cast({c} as double), 0.5), 6) as median,
  round(quantile_cont(cast({c} as double), 0.75), 6) as p75, round(cast(max({c}) as double), 6) as max from cohort""",
    )


def _mode_sql(names) -> str:
    def row(c: str) -> str:
        num = f"round(cast(v as double), 6)" if c in _NUMBERS else "cast(null as double)"
        text = "cast(null as varchar)" if c in _NUMBERS else "cast(v as varchar)"
        return (
            f"select '{c}' as \"column\", {num} as mode_num, {text} as mode_text from "
            f"(select {c} as v from cohort where {c} is not null group by {c} order by count(*) desc, {c} limit 1)"
        )

    return _each(names, row)


def _profile_cte(names=_ALL) -> str:
    numbers = [c for c in names if c in _NUMBERS]
    return f""", m as ({_missing_sql(names)}), o as ({_mode_sql(names)}), d as ({_describe_sql(numbers)}),
prof as (
  select m."column", m.missing, o.mode_num, o.mode_text, d."count", d.mean, d.std, d.min, d.p25, d.median, d.p75, d.max
  from m left join o using ("column") left join d using ("column"))
"""


# the mean discount differs between engines in its last bits, so its mode is left out
_PROFILED = tuple(c for c in _ALL if c != "disc")


@query(on_cohort(_profile_cte(_PROFILED) + "select * from prof"))
def profile_stats(spark, folder):
    return P.profile(cohort_table(spark, folder, *_PROFILED))


@query(
    on_cohort(
        _profile_cte(_PROFILED)
        + """select "column", missing, case when "column" <> 'label' then mode_num end as mode_num,
  case when "column" <> 'label' then mode_text end as mode_text, mean,
  case when "column" <> 'label' then std end as std, case when "column" <> 'label' then min end as min,
  case when "column" <> 'label' then median end as median, case when "column" <> 'label' then max end as max from prof"""
    )
)
def profile_masked(spark, folder):
    return P.mask_profile(P.profile(cohort_table(spark, folder, *_PROFILED)), "label")


def _transposed_sql() -> str:
    names = ("qty", "total", "acctbal")
    stats = ("count", "mean", "std", "min", "p25", "median", "p75", "max")
    cells = ", ".join(f"""max(case when "column" = '{c}' then v end) as {c}""" for c in names)
    long = " union all ".join(
        f"""select "column", '{s}' as statistic, cast("{s}" as double) as v from d""" for s in stats
    )
    return on_cohort(
        f", d as ({_describe_sql(names)}), long as ({long}) select statistic, {cells} from long group by statistic"
    )


@query(_transposed_sql())
def profile_transposed(spark, folder):
    names = ["qty", "total", "acctbal"]
    return P.transpose(P.describe(cohort_table(spark, folder, *names), names), "column", names)


@query(on_cohort(_missing_sql(_ALL)))
def missing_counts(spark, folder):
    return P.missing_counts(cohort(spark, folder).select(*_ALL))


@query(on_cohort(f"select count(*) filter (where missing > 0) as columns_with_missing from ({_missing_sql(_ALL)})"))
def cols_with_missing(spark, folder):
    return P.columns_with_missing(cohort(spark, folder).select(*_ALL))


@query(on_cohort(_describe_sql(("qty", "disc", "total", "acctbal"))))
def describe(spark, folder):
    return P.describe(cohort_table(spark, folder, "qty", "disc", "total", "acctbal"))


_IDS = ("o_orderkey", "o_custkey", "far")


@query(
    "with t as (select o_orderkey, o_custkey, o_orderkey + 4611686018427387904 as far from orders), "
    "p as (select *, (n - 1) // 4 as k from (select count(*) as n from t)), "
    + ", ".join(f"r_{c} as (select {c} as v, row_number() over (order by {c}) - 1 as i from t)" for c in _IDS)
    + " "
    + _each(
        _IDS,
        lambda c: f"""select '{c}' as "column", p.n as "count", (select min({c}) from t) as min, """
        + ", ".join(
            f"""cast(cast((select v from r_{c} where i = {q} * (p.n - 1) // 4) as decimal(22,2))
  + cast(((select v from r_{c} where i = ({q} * (p.n - 1) + 3) // 4) - (select v from r_{c} where i = {q} * (p.n - 1) // 4))
         * ({q} * (p.n - 1) % 4) * 25 as decimal(20,0)) * 0.01 as decimal(22,2)) as {name}"""
            for q, name in ((1, "p25"), (2, "median"), (3, "p75"))
        )
        + f", (select max({c}) from t) as max from p",
    )
)
def id_ranges(spark, folder):
    """Ranges and quartiles of ids to the last digit, one column far above 2^53."""
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey", (F.col("o_orderkey") + F.lit(1 << 62)).alias("far"))
    return P.whole_ranges(cut(rows))


def _modes_sql() -> str:
    def row(c: str, num: bool) -> str:
        return (
            f"select '{c}' as \"column\", {'cast(v as double)' if num else 'cast(null as double)'} as mode_num, "
            f"{'cast(null as varchar)' if num else 'v'} as mode_text, n as freq from (select {c} as v, count(*) as n "
            f"from lineitem group by {c} order by n desc, v limit 1)"
        )

    return " union all ".join(
        [
            *(row(c, True) for c in ("l_orderkey", "l_quantity", "l_extendedprice", "l_discount")),
            *(row(c, False) for c in ("l_returnflag", "l_linestatus")),
        ]
    )


@query(_modes_sql())
def column_modes(spark, folder):
    cols = ["l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus"]
    modes = mode_table(table(spark, folder, "lineitem"), cols)
    return modes.select(
        "column",
        F.coalesce("num", F.col("whole").cast("double")).alias("mode_num"),
        F.col("text").alias("mode_text"),
        "freq",
    )


@query(on_cohort('select segment as value, count(*) as "count" from cohort where segment is not null group by segment'))
def value_counts(spark, folder):
    return P.value_counts(cohort(spark, folder), "segment")


@query('select l_quantity as value, count(*) as "count" from lineitem group by l_quantity')
def group_size(spark, folder):
    return P.group_sizes(table(spark, folder, "lineitem"), "l_quantity")


def _histogram_sql(source: str, col: str, bins: int, lo: str, hi: str) -> str:
    return f"""span as (select lo, hi, (hi - lo) / {bins} as w from (select {lo} as lo, {hi} as hi from {source})),
counts as (
  select cast(least({bins - 1}, floor(({col} - lo) / w)) as integer) as bin, count(*) as n
  from {source} cross join span where {col} >= lo and {col} <= hi group by 1)
select cast(r.i as integer) as bin, round(lo + r.i * (hi - lo) / {bins}, 6) as lo,
  round(case when r.i = {bins - 1} then hi else lo + (r.i + 1) * (hi - lo) / {bins} end, 6) as hi,
  coalesce(n, 0) as "count"
from range({bins}) r(i) cross join span left join counts on counts.bin = r.i"""


@query(on_cohort(", " + _histogram_sql("cohort", "acctbal", 40, "min(acctbal)", "max(acctbal)")))
def histogram(spark, folder):
    return P.histogram(cohort_table(spark, folder, "acctbal"), "acctbal", 40)


_EDGES = [0.0, 1000.0, 2500.0, 5000.0, 7500.0, 9000.0]


def _edges_sql() -> str:
    rows = ", ".join(
        f"({i}, {a}, {b}, {'true' if i == len(_EDGES) - 2 else 'false'})"
        for i, (a, b) in enumerate(zip(_EDGES, _EDGES[1:]))
    )
    return f"""select cast(e.bin as integer) as bin, cast(e.lo as double) as lo, cast(e.hi as double) as hi,
  count(c.c_custkey) as "count"
from (values {rows}) e(bin, lo, hi, closed)
left join customer c on c.c_acctbal >= e.lo and (c.c_acctbal < e.hi or (e.closed and c.c_acctbal = e.hi))
group by all"""


@query(_edges_sql())
def histogram_edges(spark, folder):
    return P.histogram_edges(table(spark, folder, "customer"), "c_acctbal", _EDGES)


@query(
    """with q as (select quantile_cont(l_extendedprice, 0.99) as q from lineitem),
kept as (select l_extendedprice from lineitem cross join q where l_extendedprice < q), """
    + _histogram_sql("kept", "l_extendedprice", 10, "min(l_extendedprice)", "max(l_extendedprice)")
)
def histogram_truncated(spark, folder):
    return P.histogram_truncated(table(spark, folder, "lineitem"), "l_extendedprice", 0.99, 10)


@query(
    "with "
    + _histogram_sql(
        "lineitem", "l_extendedprice", 10, "min(l_extendedprice)", "quantile_cont(l_extendedprice, 0.99)"
    )
)
def histogram_range_truncated(spark, folder):
    return P.histogram_truncated(table(spark, folder, "lineitem"), "l_extendedprice", 0.99, 10, drop_rows=False)


@query(
    on_cohort(
        _each(
            _ALL,
            lambda c: f"select '{c}' as \"column\", count({c}) as not_null, count(*) - count({c}) as is_null from cohort",
        )
    )
)
def null_crosstab(spark, folder):
    return P.null_crosstab(cohort(spark, folder).select(*_ALL))


@query("""select count(*) as rows, round(avg(l_extendedprice), 6) as mean, round(median(l_extendedprice), 6) as median,
  round(quantile_cont(l_extendedprice, 0.99), 6) as quantile, min(l_extendedprice) as min, max(l_extendedprice) as max
from lineitem""")
def scalar_aggs(spark, folder):
    return P.scalar_summary(table(spark, folder, "lineitem"), "l_extendedprice")


# Every column of the cohort and of lineitem. The mean discount comes from a decimal sum, so that
# it does not depend on the order in which an engine adds; else the queries are as those above.
_EVERY = ("row_id", "label", "enrolled", "enrolled_yr", "first_ship", "last_ship", "qty", "disc", "total", "acctbal", *_TEXTS)
_LINE_NUMBERS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
_LINE_TEXTS = ("l_returnflag", "l_linestatus", "l_shipdate")


def _on_exact(body: str) -> str:
    exact = "cast(sum(cast(l_discount as decimal(28,6))) as double) / count(l_discount) as disc"
    return f"with {COHORT.strip().replace('avg(l_discount) as disc', exact)}\n{body}"


def _every(spark, folder):
    return cohort(spark, folder, exact=True).select(*_EVERY)


@query(_on_exact(_profile_cte(_EVERY) + "select * from prof"))
def profile_stats_all(spark, folder):
    return P.profile(cut(_every(spark, folder)))


@query(
    _on_exact(
        _profile_cte(_EVERY)
        + """select "column", missing, case when "column" <> 'label' then mode_num end as mode_num,
  case when "column" <> 'label' then mode_text end as mode_text, mean,
  case when "column" <> 'label' then std end as std, case when "column" <> 'label' then min end as min,
  case when "column" <> 'label' then median end as median, case when "column" <> 'label' then max end as max from prof"""
    )
)
def profile_masked_all(spark, folder):
    return P.mask_profile(P.profile(cut(_every(spark, folder))), "label")


def _line_modes_sql() -> str:
    def row(c: str) -> str:
        num = "cast(v as double)" if c in _LINE_NUMBERS else "cast(null as double)"
        text = "cast(null as varchar)" if c in _LINE_NUMBERS else "cast(v as varchar)"
        return (
            f"select '{c}' as \"column\", {num} as mode_num, {text} as mode_text, n as freq from (select {c} as v, count(*) as n "
            f"from lineitem where {c} is not null group by {c} order by n desc, v limit 1)"
        )

    return _each(_LINE_NUMBERS + _LINE_TEXTS, row)


@query(_line_modes_sql())
def column_modes_all(spark, folder):
    modes = mode_table(table(spark, folder, "lineitem"), [*_LINE_NUMBERS, *_LINE_TEXTS])
    return modes.select(
        "column",
        F.coalesce("num", F.col("whole").cast("double")).alias("mode_num"),
        F.col("text").alias("mode_text"),
        "freq",
    )


@query(_on_exact(_missing_sql(_EVERY)))
def missing_counts_all(spark, folder):
    return P.missing_counts(_every(spark, folder))


@query(_on_exact(f"select count(*) filter (where missing > 0) as columns_with_missing from ({_missing_sql(_EVERY)})"))
def cols_with_missing_all(spark, folder):
    return P.columns_with_missing(_every(spark, folder))


@query(
    _on_exact(
        _each(
            _EVERY,
            lambda c: f"select '{c}' as \"column\", count({c}) as not_null, count(*) - count({c}) as is_null from cohort",
        )
    )
)
def null_crosstab_all(spark, folder):
    return P.null_crosstab(_every(spark, folder))
