"""Models whose solution is exact, next to SQL that grows, boosts or solves the same."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import functions as F

from riskloom.operators.split import bootstrap_time_cv
from riskloom.plans import models as M
from riskloom.plans import search
from riskloom.plans.boost import fit_real_boost
from riskloom.plans.newton import fit_linear
from riskloom.plans.queries_model import clients, prepared, recipe
from riskloom.plans.queries_split import BOOT_CV, TIME_FOLDS, UNIT, sql_hash
from riskloom.plans.registry import on_cohort, query
from riskloom.plans.trees import Growth, Trees, grow
from riskloom.sources.tables import cohort

FEATURES = ["qty", "total", "acctbal", "month", "flag_b"]
_X = "[qty, total, acctbal, cast(month(enrolled) as double), cast(flag_b::int as double)]"
_ROWS = f", base as (select row_id, cast(label as double) as y, 1.0::double as w, {_X} as x, enrolled_yr, qty from cohort where label is not null and acctbal is not null)"


def _rows(spark, folder):
    known = cohort(spark, folder).where("label is not null and acctbal is not null")
    return known.withColumns({"month": F.month("enrolled").cast("double"), "flag_b": F.col("flag_b").cast("int").cast("double")})


# --- SQL of one level ------------------------------------------------------------------------


def _level(k: int, rows: str, width: int) -> str:
    """Class weights per value, running totals, and the best boundary (b<k>) of every node of ``rows``."""
    score = "(l0 * l0 + l1 * l1) / (l0 + l1) + ((t0 - l0) * (t0 - l0) + (t1 - l1) * (t1 - l1)) / ((t0 - l0) + (t1 - l1))"
    return f"""
c{k} as (select node, f, x[f + 1] as v, sum(w * (1 - y)) as n0, sum(w * y) as n1 from {rows} cross join range({width}) t(f) group by all),
t{k} as (
  select node, f, v, sum(n0) over s as l0, sum(n1) over s as l1, sum(n0) over g as t0, sum(n1) over g as t1, lead(v) over s as nxt
  from c{k} window s as (partition by node, f order by v), g as (partition by node, f)),
b{k} as (
  select node, cast(f as integer) as f, (v + nxt) / 2 as threshold, l0, l1, t0 - l0 as r0, t1 - l1 as r1 from (
    select *, row_number() over (partition by node order by {score} desc, f, v) as place from t{k} where nxt is not null and t0 > 0 and t1 > 0)
  where place = 1)"""


def _names(features: Sequence[str]) -> str:
    return "[" + ", ".join(f"'{f}'" for f in features) + "]"


def _tree_sql(source: str, depth: int, features: Sequence[str]) -> str:
    parts = [f"r0 as ({source})"]
    for k in range(depth):
        parts.append(_level(k, f"r{k}", len(features)).strip())
        parts.append(
            f"r{k + 1} as (select row_id, y, w, x, r.node || case when x[f + 1] <= threshold then 'L' else 'R' end as node from r{k} r join b{k} b on b.node = r.node)"
        )
    parts.append(f"b{depth} as (select null::varchar as node, null::integer as f, null::double as threshold where false)")
    nodes = [
        f"""select n.node, cast(length(n.node) as integer) as depth, {_names(features)}[b.f + 1] as feature, round(b.threshold, 6) as threshold, n.n0, n.n1, round(n.n1 / (n.n0 + n.n1), 6) as share
from (select node, sum(w * (1 - y)) as n0, sum(w * y) as n1 from r{k} group by node) n left join b{k} b on b.node = n.node"""
        for k in range(depth + 1)
    ]
    return ",\n" + ",\n".join(parts) + "\n" + "\nunion all ".join(nodes)


_LEARN = "select row_id, y, w, '' as node, x from base"


def _rules(trees: Trees):
    return trees.rules().drop("tree")


@query(on_cohort(_ROWS + _tree_sql(_LEARN, 1, FEATURES)))
def fit_stump_exact(spark, folder):
    return _rules(grow(M.assemble(_rows(spark, folder), FEATURES), FEATURES, Growth(max_depth=1, local_rows=0)))


@query(on_cohort(_ROWS + _tree_sql(_LEARN, 2, FEATURES)))
def fit_tree_exact(spark, folder):
    return _rules(grow(M.assemble(_rows(spark, folder), FEATURES), FEATURES, Growth(max_depth=2, local_rows=0)))


_MISSED = "select row_id, case when y = 1 and qty / 300 < 0.3 then 1.0 else 0.0 end::double as y, w, '' as node, x from base where enrolled_yr > 1999"


@query(on_cohort(_ROWS + _tree_sql(_MISSED, 3, FEATURES)))
def error_tree_exact(spark, folder):
    """Rules over the positives that a score misses: feature, threshold and class counts of every node."""
    rows = _rows(spark, folder).where("enrolled_yr > 1999")
    missed = rows.withColumn("label", ((F.col("label") == 1) & (F.col("qty") / 300 < 0.3)).cast("int"))
    return _rules(grow(M.assemble(missed, FEATURES), FEATURES, Growth(max_depth=3)))


@query()
def fit_tree_deep(spark, folder):
    """Exact splits and no limit of depth, on all features of the recipe."""
    train, test, features = prepared(spark, folder)
    return M.fit_predict("exact_tree", train, test, features, {"criterion": "gini", "max_features": "log2"}, seed=1)


@query()
def fit_forest_exact(spark, folder):
    train, test, features = prepared(spark, folder)
    return M.fit_predict("exact_forest", train, test, features, {"n_estimators": 25, "max_features": "auto"}, seed=1)


# --- extra trees -----------------------------------------------------------------------------

_EXTRA = f"""{_ROWS},
span as (select f, min(x[f + 1]) as low, max(x[f + 1]) as high from base cross join range(5) r(f) group by f having min(x[f + 1]) < max(x[f + 1])),
drawn as (
  select t, f, low + {sql_hash("'5-at-' || t || '--' || f")} / {UNIT} * (high - low) as threshold,
         row_number() over (partition by t order by {sql_hash("'5-' || t || '--' || f")}, f) as place
  from span cross join range(10) g(t)),
sums as (
  select t, f, threshold, count(*) filter (where x[f + 1] <= threshold and y = 0)::double as l0, count(*) filter (where x[f + 1] <= threshold and y = 1)::double as l1,
         count(*) filter (where x[f + 1] > threshold and y = 0)::double as r0, count(*) filter (where x[f + 1] > threshold and y = 1)::double as r1
  from drawn cross join base where place <= 2 group by all),
best as (
  select *, row_number() over (partition by t order by (l0 * l0 + l1 * l1) / (l0 + l1) + (r0 * r0 + r1 * r1) / (r0 + r1) desc, f) as place from sums)
select cast(t as integer) as tree, '' as node, {_names(FEATURES)}[f + 1] as feature, round(threshold, 6) as threshold, l0 + r0 as n0, l1 + r1 as n1 from best where place = 1
union all select cast(t as integer), 'L', null, null, l0, l1 from best where place = 1
union all select cast(t as integer), 'R', null, null, r0, r1 from best where place = 1"""


@query(on_cohort(_EXTRA))
def extra_trees_level(spark, folder):
    """First level of ten trees with drawn features and thresholds."""
    data = M.assemble(_rows(spark, folder), FEATURES)
    return grow(data, FEATURES, Growth(1, "gini", 2, True, 5, 0), trees=10).rules().drop("depth", "share")


@query()
def feature_importance_extra(spark, folder):
    """Importances of ten extra trees without a limit of depth."""
    train, _, features = prepared(spark, folder)
    return M.fit("extra_trees", M.assemble(train, features), {"n_estimators": 10}, features, seed=1).importances()


# --- boosting --------------------------------------------------------------------------------

_BOOSTED = ["qty", "month", "flag_b"]


def _odds(a: str, b: str) -> str:
    return f"(ln(greatest({b} / ({a} + {b}), 2.220446049250313e-16)) - ln(greatest({a} / ({a} + {b}), 2.220446049250313e-16)))"


def _vote(k: int) -> str:
    return f"case when x[b{k}.f + 1] <= b{k}.threshold then {_odds(f'b{k}.l0', f'b{k}.l1')} else {_odds(f'b{k}.r0', f'b{k}.r1')} end"


_BOOST = f"""{_ROWS},
r0 as (select row_id, y, w, '' as node, [x[1], x[4], x[5]] as x from base),
{_level(0, "r0", 3).strip()},
r1 as (select row_id, y, w * exp(-0.25 * (2 * y - 1) * ({_vote(0)})) as w, '' as node, x, {_vote(0)} as first from r0 cross join b0),
{_level(1, "r1", 3).strip()}
select row_id, y as label, 1.0::double as w, round(1 / (1 + exp(-(first + {_vote(1)}) / 2)), 6) as score, case when first + {_vote(1)} > 0 then 1 else 0 end as pred
from r1 cross join b1"""


@query(on_cohort(_BOOST))
def fit_adaboost_real(spark, folder):
    """Two rounds at half rate, scored on the rows they saw."""
    data = M.assemble(_rows(spark, folder), _BOOSTED)
    return fit_real_boost(data, 2, 0.5).scores(data)


@query()
def fit_adaboost_full(spark, folder):
    """The largest of the study's boosting grid: 100 rounds at rate 1."""
    train, test, features = prepared(spark, folder)
    return M.fit_predict("adaboost", train, test, features, {"n_estimators": 100, "learning_rate": 1.0}, seed=1)


@query()
def fit_adaboost_discrete(spark, folder):
    train, test, features = prepared(spark, folder)
    return M.fit_predict("adaboost_discrete", train, test, features, {"n_estimators": 10, "learning_rate": 0.5}, seed=1)


# --- linear models ---------------------------------------------------------------------------


def _newton_sql(loss: str, costs: Sequence[float], steps: int) -> str:
    """The same fits by Newton steps in SQL: three weights, so each step solves its equations by determinants."""
    m = "y * (b0 * x0 + b1 * x1 + b2)"
    if loss == "logistic":
        slope, curve = f"(-1 / (1 + exp({m})))", f"(1 / (1 + exp({m})) * (1 - 1 / (1 + exp({m}))))"
    else:
        slope, curve = f"(-2 * greatest(0, 1 - {m}))", f"(case when {m} < 1 then 2.0 else 0.0 end)"
    x = ["x0", "x1", "1.0"]
    sums = ", ".join(
        [f"b{i} + c * sum(w * {slope} * y * {x[i]}) as g{i}" for i in range(3)]
        + [f"{int(i == j)} + c * sum(w * {curve} * {x[i]} * {x[j]}) as h{i}{j}" for i in range(3) for j in range(i, 3)]
    )
    det = "(h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02))"
    new = [
        f"b0 - (g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) + h02 * (g1 * h12 - h11 * g2)) / {det}",
        f"b1 - (h00 * (g1 * h22 - h12 * g2) - g0 * (h01 * h22 - h12 * h02) + h02 * (h01 * g2 - g1 * h02)) / {det}",
        f"b2 - (h00 * (h11 * g2 - g1 * h12) - h01 * (h01 * g2 - g1 * h02) + g0 * (h01 * h12 - h11 * h02)) / {det}",
    ]
    listed = ", ".join(f"({c}::double)" for c in costs)
    parts = [
        """learn as materialized (
  select fold, replicate, 2.0 * label - 1 as y, cast(mult as double) as w, qty / 50 as x0, total / 100000 as x1
  from boot join cohort using (row_id) where role = 'train' and label is not null)""",
        f"""s0 as materialized (
  select fold, replicate, c, 0.0::double as b0, 0.0::double as b1, 0.0::double as b2
  from (select distinct fold, replicate from learn) cross join (values {listed}) v(c))""",
    ]
    for k in range(steps):
        parts.append(
            f"""s{k + 1} as materialized (
  select fold, replicate, c, {", ".join(f"{e} as b{i}" for i, e in enumerate(new))}
  from (select fold, replicate, c, b0, b1, b2, {sums} from s{k} join learn using (fold, replicate) group by fold, replicate, c, b0, b1, b2))"""
        )
    columns = [("qty", "b0"), ("total", "b1"), ("intercept", "b2")]
    out = " union all ".join(f"select cast(fold as integer) as fold, replicate, c as cost, '{n}' as feature, round({b}, 6) as weight from s{steps}" for n, b in columns)
    return on_cohort(BOOT_CV + ", " + ",\n".join(parts) + "\n" + out)


def _linear(spark, folder, loss, costs):
    rows = cohort(spark, folder).where("label is not null").withColumns({"qty": F.col("qty") / 50, "total": F.col("total") / 100000})
    members = cohort(spark, folder).select("row_id", "enrolled_yr")
    draws = bootstrap_time_cv(members, "enrolled_yr", TIME_FOLDS, "row_id", 0.8, 3, seed=5).where("role = 'train'")
    train = rows.select("row_id", "label", "qty", "total").join(draws.select("row_id", "fold", "replicate", "mult"), "row_id")
    data = M.assemble(train, ["qty", "total"], "mult", ["fold", "replicate"])
    return fit_linear(data, ["qty", "total"], costs, loss, ["fold", "replicate"]).table(spark)


@query(_newton_sql("logistic", [0.01, 0.1, 1.0, 10.0], 8))
def fit_logistic_grid(spark, folder):
    """Four penalties on six bootstrapped time splits: 24 fits in as many passes as one takes."""
    return _linear(spark, folder, "logistic", [0.01, 0.1, 1.0, 10.0])


@query(_newton_sql("squared_hinge", [0.1, 1.0, 10.0], 12))
def fit_svc_grid(spark, folder):
    """Linear support vectors with the squared hinge: three penalties on six splits, 18 fits together."""
    return _linear(spark, folder, "squared_hinge", [0.1, 1.0, 10.0])


@query()
def search_logistic_full(spark, folder):
    """The study's logistic search at its size: 4 penalties, 2 time folds, 3 replicates, 5 thresholds, all features."""
    thresholds = [0.25, 0.3, 0.35, 0.4, 0.45]
    return search.linear_bootstrap_search(
        clients(spark, folder), "enrolled_yr", TIME_FOLDS, recipe(), [], [0.01, 0.1, 1.0, 10.0], thresholds, "auc_roc", seed=1
    )


@query()
def search_svc_full(spark, folder):
    """The same for linear support vectors: 3 penalties; scores are margins, so the threshold is 0."""
    return search.linear_bootstrap_search(
        clients(spark, folder), "enrolled_yr", TIME_FOLDS, recipe(), [], [0.1, 1.0, 10.0], [0.0], "auc_roc", "squared_hinge", seed=1
    )
