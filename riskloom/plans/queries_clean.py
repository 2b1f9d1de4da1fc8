"""Sources, projections, cleaning and row features as registered queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions import scalars as S
from riskloom.operators import clean as C
from riskloom.operators import features as X
from riskloom.operators import profile as P
from riskloom.operators import relational as R
from riskloom.operators import split as SP
from riskloom.operators.neighbors import approx_nearest, impute_nearest, knn_classify as knn
from riskloom.plans.recipe import FeatureRecipe
from riskloom.plans.registry import on_cohort, query
from riskloom.roles import Roles, select_by_role as by_role, tag_roles
from riskloom.session import cut, fresh_path
from riskloom.sources.csv import read_csv, write_csv
from riskloom.sources.report import read_report, write_report
from riskloom.sources.tables import cohort, cohort_table, table

COHORT_ROLES = Roles(
    id=["row_id"],
    target=["label"],
    time=["enrolled", "first_ship", "last_ship"],
    numerical=["qty", "disc", "total", "acctbal"],
    categorical=["segment", "priority"],
    boolean=["flag_a", "flag_b"],
)
_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


# --- sources and sinks -------------------------------------------------------------


@query("select c_custkey as row_id, c_name, c_nationkey, round(c_acctbal, 6) as c_acctbal, c_mktsegment from customer")
def csv_roundtrip(spark, folder):
    path = fresh_path(spark, "customer-csv")
    write_csv(table(spark, folder, "customer"), path)
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return read_csv(spark, path, schema)


@query("""select doc_id as row_id, nullif(text, '') as text, lang, source, n_chars,
  timestamp '2020-01-02 03:04:05.123456' as read_at from documents""")
def csv_text(spark, folder):
    """Whole texts with quotes and line breaks, and a time with its fraction; an empty text is an empty cell, so null."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source", F.col("n_chars").cast("bigint").alias("n_chars"))
    path = fresh_path(spark, "text-csv")
    write_csv(docs.withColumn("read_at", F.expr("timestamp'2020-01-02 03:04:05.123456'")), path)
    return read_csv(spark, path, "doc_id bigint, text string, lang string, source string, n_chars bigint, read_at timestamp")


@query(on_cohort("""select 'missing' as part, 'acctbal' as name, count(*) filter (where acctbal is null) as n from cohort
union all select 'missing', 'segment', count(*) filter (where segment is null) from cohort
union all select 'segment', segment, count(*) from cohort where segment is not null group by segment"""))
def report_tables(spark, folder):
    """Parts of a report, written as tables and read back."""
    rows = cohort_table(spark, folder, "acctbal", "segment")
    path = fresh_path(spark, "report")
    write_report({"missing": P.missing_counts(rows), "segment": P.value_counts(rows, "segment")}, path)
    parts = [read_report(spark, path, name).toDF("name", "n").select(F.lit(name).alias("part"), "name", "n") for name in ("missing", "segment")]
    return parts[0].unionByName(parts[1])


@query("""select d.doc_id as row_id, d.lang, d.source, l.quality, l.toxic
from documents d left join labels l on l.doc_id = d.doc_id""")
def csv_options(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source")
    path = fresh_path(spark, "docs-csv")
    wide = R.index_join(docs, table(spark, folder, "labels"), "doc_id")
    wide.write.option("header", True).option("nullValue", "NA").option("encoding", "ISO-8859-1").csv(path)
    schema = "doc_id bigint, lang string, source string, quality int, toxic int"
    return read_csv(spark, path, schema, null_token="NA", sep=",", encoding="ISO-8859-1")


@query("select 2 * count(*) as rows, count(distinct c_custkey) as clients from customer")
def csv_append(spark, folder):
    path = fresh_path(spark, "append-csv")
    part = table(spark, folder, "customer").select("c_custkey", "c_name")
    write_csv(part, path, "overwrite")
    write_csv(part, path, "append")
    back = read_csv(spark, path, "c_custkey bigint, c_name string")
    # count per key first: the distinct keys never meet in one task
    per_key = back.groupBy("row_id").agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("clients"))


@query(on_cohort("select row_id, qty, round(disc, 6) as disc, total, acctbal, flag_a, flag_b from cohort"))
def select_by_role(spark, folder):
    return by_role(tag_roles(cohort(spark, folder), COHORT_ROLES), "id", "numerical", "boolean")


# --- projections and filters -------------------------------------------------------


@query("""select d.doc_id, d.lang, d.source, l.quality, l.toxic
from documents d left join labels l on l.doc_id = d.doc_id where l.quality is not null""")
def dropna_subset(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source")
    return R.index_join(docs, table(spark, folder, "labels"), "doc_id").na.drop(subset=["quality"])


@query("select l_orderkey, l_linenumber, l_quantity, l_discount from lineitem")
def project_cols(spark, folder):
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")


@query("""select l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
from lineitem""")
def project_positional(spark, folder):
    lines = table(spark, folder, "lineitem")
    return lines.select(*lines.columns[3:])


@query("""select l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, l_linestatus, l_shipdate
from lineitem""")
def drop_cols(spark, folder):
    return table(spark, folder, "lineitem").drop("l_partkey", "l_suppkey", "l_discount", "l_tax")


@query("""select l_orderkey, l_linenumber, l_extendedprice from lineitem
where l_extendedprice < (select quantile_cont(l_extendedprice, 0.99) from lineitem)""")
def filter_below_quantile(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return P.filter_below_quantile(lines, "l_extendedprice", 0.99)


@query(on_cohort("select row_id, round_even(qty / 8, 2) as qty from cohort"))
def round_half_even(spark, folder):
    return P.round_half_even(cohort(spark, folder).select("row_id", (F.col("qty") / 8).alias("qty")), 2)


@query("""select distinct 'p_brand' as "column", p_brand as value from part
union all select distinct 'p_type', p_type from part""")
def distinct_values(spark, folder):
    return X.category_pairs(table(spark, folder, "part"), ["p_brand", "p_type"])


# --- cleaning ----------------------------------------------------------------------


@query("select p_partkey, round(p_retailprice * 100, 2) as price from part")
def strip_thousands(spark, folder):
    text = F.format_number(F.col("p_retailprice") * 100, 2)
    return table(spark, folder, "part").select("p_partkey", S.strip_thousands(text).alias("price"))


@query("select event_id, date_trunc('second', ts) as ts from events")
def parse_timestamps(spark, folder):
    text = table(spark, folder, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))
    return C.change_time(text, ["ts"])


@query(on_cohort("""select row_id, coalesce(acctbal, 0.0) as acctbal, coalesce(segment, 'NONE') as segment,
  coalesce(flag_a, false) as flag_a, coalesce(first_ship, timestamp '2000-01-01 00:00:00') as first_ship from cohort"""))
def fill_constant(spark, folder):
    part = cohort(spark, folder).select("row_id", "acctbal", "segment", "flag_a", "first_ship")
    return C.fill_constant(
        part, {"acctbal": 0.0, "segment": "NONE", "flag_a": False, "first_ship": "2000-01-01 00:00:00"}
    )


def _mode(col: str, where: str = "true") -> str:
    return (
        f"(select {col} from cohort where {col} is not null and {where} group by {col}"
        f" order by count(*) desc, {col} limit 1)"
    )


@query(on_cohort(f"""select row_id, coalesce(segment, {_mode('segment')}) as segment,
  coalesce(flag_a, {_mode('flag_a')}) as flag_a, coalesce(qty, {_mode('qty')}) as qty from cohort"""))
def fill_mode(spark, folder):
    part = cohort_table(spark, folder, "row_id", "segment", "flag_a", "qty")
    return C.fit_mode(part, ["segment", "flag_a", "qty"]).transform(part)


@query(on_cohort("""select row_id, round(coalesce(acctbal, (select median(acctbal) from cohort)), 6) as acctbal,
  coalesce(qty, (select median(qty) from cohort)) as qty from cohort"""))
def fill_median(spark, folder):
    part = cohort_table(spark, folder, "row_id", "acctbal", "qty")
    return C.fit_median(part, ["acctbal", "qty"]).transform(part)


@query(on_cohort("""select row_id, case when enrolled_yr <= 1999 then 'train' else 'test' end as role,
  round(coalesce(acctbal, (select median(acctbal) from cohort where enrolled_yr <= 1999)), 6) as acctbal,
  coalesce(qty, (select median(qty) from cohort where enrolled_yr <= 1999)) as qty from cohort"""))
def impute_train_median(spark, folder):
    rows = cohort_table(spark, folder, "row_id", "enrolled_yr", "acctbal", "qty")
    part = SP.time_split(rows, "enrolled_yr", 1999).drop("enrolled_yr")
    return C.fit_median(part.where("role = 'train'"), ["acctbal", "qty"]).transform(part)


@query(on_cohort("""select row_id, round(coalesce(acctbal, (select avg(acctbal) from cohort)), 6) as acctbal,
  round(coalesce(qty, (select avg(qty) from cohort)), 6) as qty from cohort"""))
def fill_mean(spark, folder):
    part = cohort_table(spark, folder, "row_id", "acctbal", "qty")
    return C.fit_mean(part, ["acctbal", "qty"]).transform(part)


@query(on_cohort("""select row_id, segment,
  round(case when segment is null then acctbal else coalesce(acctbal, avg(acctbal) over (partition by segment)) end, 6)
    as acctbal,
  round(case when segment is null then qty else coalesce(qty, avg(qty) over (partition by segment)) end, 6) as qty
from cohort"""))
def impute_group_mean(spark, folder):
    part = cohort_table(spark, folder, "row_id", "segment", "acctbal", "qty")
    return C.GroupMeanFill("segment", ["acctbal", "qty"], "row_id").fit(part).transform(part)


@query(on_cohort("""
, have as (select row_id, acctbal, qty, total from cohort
           where acctbal is not null and qty is not null and total is not null),
best as (
  select q.row_id,
         arg_min(h.acctbal, {'d': (q.qty - h.qty) * (q.qty - h.qty) + (q.total - h.total) * (q.total - h.total),
                             'id': h.row_id}) as v
  from cohort q cross join have h
  where q.acctbal is null and q.qty is not null and q.total is not null
  group by q.row_id)
select c.row_id, c.qty, c.total, coalesce(c.acctbal, b.v) as acctbal
from cohort c left join best b on b.row_id = c.row_id""".replace("\n, have", ", have", 1)))
def impute_1nn(spark, folder):
    part = cohort_table(spark, folder, "row_id", "qty", "total", "acctbal")
    return impute_nearest(part, "acctbal", ["qty", "total"], "row_id")


@query(on_cohort("""select row_id, case when acctbal is null then 1 else 0 end as acctbal_missing,
  case when segment is null then 1 else 0 end as segment_missing,
  case when flag_a is null then 1 else 0 end as flag_a_missing from cohort"""))
def missing_indicator(spark, folder):
    part = cohort(spark, folder).select("row_id", "acctbal", "segment", "flag_a")
    return C.missing_indicators(part, ["acctbal", "segment", "flag_a"]).drop("acctbal", "segment", "flag_a")


@query(on_cohort("""select row_id, case when flag_a is null or flag_a then 1 else 0 end as flag_a,
  case when label is null or label <> 0 then 1 else 0 end as label,
  case when segment is null or segment <> '' then 1 else 0 end as segment from cohort"""))
def binary_transform(spark, folder):
    part = cohort(spark, folder).select("row_id", "flag_a", "label", "segment")
    return C.binary_transform(part, ["flag_a", "label", "segment"])


@query(on_cohort("""select row_id, cast(year(enrolled) as integer) as enrolled_yr,
  cast(month(enrolled) as integer) as enrolled_mth, cast(year(first_ship) as integer) as first_ship_yr,
  cast(month(first_ship) as integer) as first_ship_mth from cohort"""))
def date_parts(spark, folder):
    part = cohort(spark, folder).select("row_id", "enrolled", "first_ship")
    return C.date_parts(part, ["enrolled", "first_ship"]).drop("enrolled", "first_ship")


@query(on_cohort("""select row_id, (epoch_us(last_ship) - epoch_us(enrolled)) * 1000 as duration,
  cast(year(last_ship) as integer) - enrolled_yr as years from cohort"""))
def interval_ns(spark, folder):
    part = cohort(spark, folder).withColumn("last_yr", F.year("last_ship"))
    part = C.interval(part, "enrolled", "last_ship", "duration")
    return C.interval(part, "enrolled_yr", "last_yr", "years").select("row_id", "duration", "years")


@query(on_cohort("select row_id, case when last_ship < enrolled then 1 else 0 end as left_early from cohort"))
def negative_flag(spark, folder):
    part = C.interval(cohort(spark, folder), "enrolled", "last_ship", "duration")
    return part.select("row_id", S.negative_flag(F.col("duration")).alias("left_early"))


@query(on_cohort("select row_id, round(abs(total - acctbal), 6) as difference from cohort"))
def abs_difference(spark, folder):
    return cohort(spark, folder).select("row_id", S.abs_difference(F.col("total"), F.col("acctbal")).alias("difference"))


@query(on_cohort("""select row_id, case when coalesce(flag_a, true) = coalesce(flag_b, true) then 1 else 0 end as matched
from cohort"""))
def match_feature(spark, folder):
    return C.match_feature(cohort(spark, folder), "flag_a", "flag_b", "matched").select("row_id", "matched")


@query(on_cohort("select row_id, case when acctbal > 5000 then 5000.0 else acctbal end as acctbal from cohort"))
def cap_values(spark, folder):
    return cohort(spark, folder).select("row_id", S.cap(F.col("acctbal"), 5000.0).alias("acctbal"))


@query(on_cohort("select row_id, coalesce(acctbal >= 1000, false) as acctbal_binary from cohort"))
def create_binary(spark, folder):
    return cohort(spark, folder).select("row_id", S.at_least(F.col("acctbal"), 1000.0).alias("acctbal_binary"))


@query(on_cohort("select row_id, case when qty / 300 >= 0.3 then 1 else 0 end as pred from cohort"))
def apply_threshold(spark, folder):
    return cohort(spark, folder).select("row_id", S.apply_threshold(F.col("qty") / 300, 0.3).alias("pred"))


# --- features ----------------------------------------------------------------------


@query(on_cohort(""", capped as (select row_id, case when total > 400000 then 400000.0 else total end as total from cohort),
span as (select min(total) as lo, (max(total) - min(total)) / 10 as w from capped)
select row_id, total, cast(least(9, greatest(0, ceil((total - lo) / w) - 1)) as integer) as total_bins
from capped cross join span""".replace(", capped", ", capped", 1)))
def equal_width_bins(spark, folder):
    part = cohort_table(spark, folder, "row_id", "total")
    return X.EqualWidthBins("total", 10, cap=400000.0).fit(part).transform(part)


@query(on_cohort(""", q as (select quantile_cont(acctbal, [0.0, 0.25, 0.5, 0.75, 1.0]) as e from cohort)
select row_id, cast(case when acctbal > e[1] and acctbal <= e[2] then 0 when acctbal > e[2] and acctbal <= e[3] then 1
  when acctbal > e[3] and acctbal <= e[4] then 2 when acctbal > e[4] and acctbal <= e[5] then 3 end as integer)
  as acctbal_qbin
from cohort cross join q"""))
def quantile_bins(spark, folder):
    part = cohort_table(spark, folder, "row_id", "acctbal")
    bins = X.QuantileBins("acctbal", [0.0, 0.25, 0.5, 0.75, 1.0]).fit(part)
    return bins.transform(part).drop("acctbal")


def _dummies(col: str, values) -> str:
    return ", ".join(f"""case when {col} = '{v}' then 1 else 0 end as "{col}_{v}\"""" for v in values)


@query(on_cohort(f"select row_id, {_dummies('segment', _SEGMENTS)}, {_dummies('priority', _PRIORITIES)} from cohort"))
def one_hot(spark, folder):
    part = cohort_table(spark, folder, "row_id", "segment", "priority")
    return X.OneHot(["segment", "priority"]).fit(part).transform(part)


@query(on_cohort(f"""select row_id, {_dummies('segment', _SEGMENTS[:4])} from cohort where enrolled_yr > 1999"""))
def one_hot_aligned(spark, folder):
    part = cohort_table(spark, folder, "row_id", "enrolled_yr", "segment")
    train = part.where("enrolled_yr <= 1999 and segment <> 'MACHINERY'")
    return X.OneHot(["segment"]).fit(train).transform(part.where("enrolled_yr > 1999")).drop("enrolled_yr")


@query(on_cohort("""select row_id, 'segment' as "column", segment as value from cohort where segment is not null
union all select row_id, 'priority', priority from cohort"""))
def one_hot_long(spark, folder):
    return X.one_hot_long(cohort(spark, folder), "row_id", ["segment", "priority"])


@query("""with c as (select distinct c_name as v, 'c_name' as col from customer where c_acctbal >= 0
  union select distinct c_mktsegment, 'c_mktsegment' from customer where c_acctbal >= 0),
places as (select col, v, row_number() over (order by col, v) - 1 as place from c)
select c_custkey as row_id, place from customer join places on (col = 'c_name' and v = c_name) or (col = 'c_mktsegment' and v = c_mktsegment)""")
def one_hot_sparse(spark, folder):
    """Places set by a column of unbounded categories, fitted on customers without debt and applied to all."""
    rows = table(spark, folder, "customer").select(F.col("c_custkey").alias("row_id"), "c_name", "c_mktsegment", "c_acctbal")
    made = X.SparseOneHot(["c_name", "c_mktsegment"], "row_id").fit(rows.where("c_acctbal >= 0"))
    return made.positions(rows).select("row_id", F.explode("at").alias("place")).withColumn("place", F.col("place").cast("bigint"))


@query(on_cohort("""select row_id, round((total - avg(total) over ()) / stddev_pop(total) over (), 6) + 0 as total,
  round((acctbal - avg(acctbal) over ()) / stddev_pop(acctbal) over (), 6) + 0 as acctbal from cohort"""))
def standardize(spark, folder):
    part = cohort_table(spark, folder, "row_id", "total", "acctbal")
    return X.Standardize(["total", "acctbal"]).fit(part).transform(part)


@query(on_cohort("select row_id, round(ln(1 + total), 6) as total from cohort"))
def log1p_feature(spark, folder):
    return cohort(spark, folder).select("row_id", F.log1p("total").alias("total"))


@query(on_cohort(f""", train as (select * from cohort where label is not null and enrolled_yr <= 1999),
filled as (
  select row_id, case when enrolled_yr <= 1999 then 'train' else 'test' end as role,
         case when acctbal is null then 1 else 0 end as acctbal_missing,
         case when segment is null then 1 else 0 end as segment_missing,
         coalesce(segment, (select segment from train where segment is not null
                            group by segment order by count(*) desc, segment limit 1)) as segment,
         coalesce(flag_a, (select flag_a from train where flag_a is not null
                           group by flag_a order by count(*) desc, flag_a limit 1)) as flag_a,
         flag_b,
         round(coalesce(acctbal, (select median(acctbal) from train)), 6) as acctbal
  from cohort where label is not null)
select row_id, role, acctbal_missing, segment_missing, acctbal, {_dummies('segment', _SEGMENTS)},
  case when flag_a then 1 else 0 end as flag_a, case when flag_b then 1 else 0 end as flag_b,
  case when flag_a = flag_b then 1 else 0 end as flags_match,
  case when (segment = 'BUILDING') = flag_a then 1 else 0 end as building_match
from filled"""))
def feature_recipe(spark, folder):
    names = ("row_id", "label", "enrolled_yr", "acctbal", "segment", "flag_a", "flag_b")
    rows = cohort_table(spark, folder, *names).where("label is not null")
    part = SP.time_split(rows, "enrolled_yr", 1999).drop("label", "enrolled_yr")
    recipe = FeatureRecipe(
        flag_missing=["acctbal", "segment"],
        mode_cols=["segment", "flag_a"],
        median_cols=["acctbal"],
        one_hot_cols=["segment"],
        boolean_cols=["flag_a", "flag_b"],
        matches=[("flag_a", "flag_b", "flags_match"), ("segment_BUILDING", "flag_a", "building_match")],
    )
    return recipe.fit(part.where("role = 'train'")).transform(part)


@query(on_cohort("""select row_id, cast(year(coalesce(first_ship, timestamp '2000-01-01')) as integer) as first_ship_yr,
  cast(month(coalesce(first_ship, timestamp '2000-01-01')) as integer) as first_ship_mth,
  (epoch_us(coalesce(first_ship, timestamp '2000-01-01')) - epoch_us(enrolled)) * 1000 as wait,
  case when coalesce(last_ship, timestamp '2000-06-01') < enrolled then 1 else 0 end as left_early,
  cast(year(coalesce(last_ship, timestamp '2000-06-01')) as integer) - enrolled_yr as years,
  case when coalesce(flag_a, true) = coalesce(flag_b, true) then 1 else 0 end as flags_match,
  round(abs(total - acctbal), 6) as difference
from cohort where label is not null"""))
def client_features(spark, folder):
    """Fill dates, take their parts, derive intervals, flags and differences: one projection over the scan."""
    rows = cohort(spark, folder).na.drop(subset=["label"])
    filled = C.fill_constant(rows, {"first_ship": "2000-01-01 00:00:00", "last_ship": "2000-06-01 00:00:00"})
    dated = C.date_parts(filled, ["first_ship", "last_ship"])
    derived = C.interval(C.interval(dated, "enrolled", "first_ship", "wait"), "enrolled", "last_ship", "stay")
    derived = C.interval(derived, "enrolled_yr", "last_ship_yr", "years")
    derived = C.match_feature(derived, "flag_a", "flag_b", "flags_match")
    return derived.select(
        "row_id",
        "first_ship_yr",
        "first_ship_mth",
        "wait",
        S.negative_flag(F.col("stay")).alias("left_early"),
        "years",
        "flags_match",
        S.abs_difference(F.col("total"), F.col("acctbal")).alias("difference"),
    )


# --- joins, unions -----------------------------------------------------------------


@query("select d.doc_id, d.lang, l.quality from documents d left join labels l on l.doc_id = d.doc_id")
def index_join(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang")
    return R.index_join(docs, table(spark, folder, "labels").select("doc_id", "quality"), "doc_id")


@query("""select c_custkey as id, c_name as name, c_acctbal as balance, c_mktsegment as segment from customer
union all select s_suppkey, s_name, s_acctbal, null from supplier""")
def union_all_byname(spark, folder):
    clients = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")
    )
    return R.union_by_name(clients, suppliers)


def _subset_sql(names) -> str:
    subsets = R.feature_subsets(names)
    cells = " union all ".join(
        f"select '{'+'.join(s)}' as subset, count(*) filter (where {' and '.join(f'{c} is not null' for c in s)})"
        " as complete_rows from cohort"
        for s in subsets
    )
    return on_cohort(cells)


_SUBSET_NAMES = ("qty", "acctbal", "segment", "flag_a")


@query(_subset_sql(_SUBSET_NAMES))
def feature_subsets(spark, folder):
    """Rows without any null for every subset that leaves out at most two features."""
    df = cohort(spark, folder).select(*_SUBSET_NAMES)
    subsets = R.feature_subsets(_SUBSET_NAMES)
    aggs = []
    for i, s in enumerate(subsets):
        full = F.lit(True)
        for c in s:
            full = full & F.col(c).isNotNull()
        aggs.append(F.count_if(full).alias(f"n{i}"))
    cells = [F.struct(F.lit("+".join(s)).alias("subset"), F.col(f"n{i}").alias("complete_rows")) for i, s in enumerate(subsets)]
    return df.agg(*aggs).select(F.explode(F.array(*cells)).alias("e")).select("e.*")


_NEAR_SQL = """
with parts as (
  select vec_id, label, list_transform(embedding, lambda e: cast(e as double)) as x,
         cast(('0x' || substr(md5('7-' || vec_id), 1, 15)) as bigint) / 1152921504606846976.0 > 0.75 as is_test
  from embeddings),
pairs as (
  select q.vec_id, t.vec_id as cid, t.label,
         list_sum(list_transform(list_zip(q.x, t.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as d
  from parts q cross join parts t where q.is_test and not t.is_test),
near as (select *, row_number() over (partition by vec_id order by d, cid) as r from pairs),
votes as (select vec_id, label, count(*) as n from near where r <= 5 group by vec_id, label)
select vec_id, arg_min(label, {'n': -n, 'l': label}) as pred, max(n) as votes from votes group by vec_id"""


@query(_NEAR_SQL)
def knn_classify(spark, folder):
    rows = SP.random_holdout(table(spark, folder, "embeddings"), "vec_id", 0.25, seed=7)
    train, test = SP.role_frames(rows)
    return knn(train, test, "embedding", "label", "vec_id", 5)


@query()
def knn_approx(spark, folder):
    """The five neighbours that random projections find: the named alternative to the exact search."""
    rows = SP.random_holdout(table(spark, folder, "embeddings"), "vec_id", 0.25, seed=7)
    train, test = SP.role_frames(rows)
    return approx_nearest(test.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("x")), train.select(F.col("vec_id").alias("cid"), F.col("embedding").alias("x")), 5)


@query(on_cohort("""
, known as (select c.*, cast(o.o_custkey as varchar) || '-' || enrolled_yr || '-' || month(enrolled) as client from cohort c join orders o on o.o_orderkey = c.row_id),
train as (select * from known where label is not null and enrolled_yr <= 1999),
places as (
  select *, row_number() over (order by col, v) - 1 as place from (
    select distinct 'client' as col, client as v from train union select distinct 'priority', priority from train)),
filled as (
  select row_id, case when enrolled_yr <= 1999 then 'train' else 'test' end as role, client, priority,
         round(coalesce(acctbal, (select median(acctbal) from train)), 6) as acctbal,
         case when (priority = '1-URGENT') = coalesce(flag_a, true) then 1 else 0 end as urgent_match
  from known where label is not null)
select row_id, role, acctbal, urgent_match, place from filled join places on (col = 'client' and v = client) or (col = 'priority' and v = priority)"""))
def feature_recipe_sparse(spark, folder):
    """The recipe over a column with thousands of categories: it goes over to sparse vectors by itself."""
    names = table(spark, folder, "orders").select(F.col("o_orderkey").alias("row_id"), "o_custkey")
    known = cohort(spark, folder).where("label is not null").join(names, "row_id")
    client = F.concat_ws("-", "o_custkey", "enrolled_yr", F.month("enrolled")).alias("client")
    rows = known.select("row_id", "enrolled_yr", "priority", "acctbal", "flag_a", client)
    rows = cut(SP.time_split(rows, "enrolled_yr", 1999).drop("enrolled_yr"))
    step = FeatureRecipe(median_cols=["acctbal"], one_hot_cols=["client", "priority"], matches=[("priority_1-URGENT", "flag_a", "urgent_match")], drop_cols=["flag_a"])
    made = step.fit(rows.where("role = 'train'")).transform(rows).select("row_id", "role", "acctbal", "urgent_match")
    places = step.encoder.positions(step.fills.transform(rows))
    return made.join(places.select("row_id", F.explode("at").alias("place")), "row_id").withColumn("place", F.col("place").cast("bigint"))
