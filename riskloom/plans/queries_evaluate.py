"""Evaluation tables on closed-form scores as registered queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import evaluate as E
from riskloom.operators import relational as R
from riskloom.operators import split as SP
from riskloom.operators.clean import fit_median
from riskloom.plans.models import FittedConstant
from riskloom.plans.queries_split import BOOT_CV, TIME_FOLDS
from riskloom.plans.registry import on_cohort, query
from riskloom.sources.tables import cohort, cohort_table, table

# --- scored rows -------------------------------------------------------------------


def cohort_scores(spark, folder):
    """Test rows of the cohort with score = train-median-filled qty / 300."""
    rows = cohort_table(spark, folder, "row_id", "label", "enrolled_yr", "qty").where("label is not null")
    part = SP.time_split(rows, "enrolled_yr", 1999).drop("enrolled_yr")
    filled = fit_median(part.where("role = 'train'"), ["qty"]).transform(part)
    return filled.where("role = 'test'").select("row_id", "label", (F.col("qty") / 300).alias("score"))


def line_scores(spark, folder):
    """Every line item with score = discount and label = returned."""
    return table(spark, folder, "lineitem").select(
        F.col("l_discount").alias("score"), (F.col("l_returnflag") == "R").cast("int").alias("label")
    )


def model_scores(spark, folder):
    """Three closed-form models over all labelled clients, as one long table."""
    rows = cohort(spark, folder).where("label is not null")
    scores = {"quantity": F.col("qty") / 300, "total": F.col("total") / 524288, "year": (F.col("enrolled_yr") - 1994) / 10}
    cells = [F.struct(F.lit(m).alias("model"), s.cast("double").alias("score")) for m, s in scores.items()]
    return rows.select("row_id", "label", F.explode(F.array(*cells)).alias("e")).select("row_id", "label", "e.*")


_COHORT_PRED = """, train as (select median(qty) as m from cohort where label is not null and enrolled_yr <= 1999),
pred as (select row_id, label, coalesce(qty, m) / 300 as score from cohort cross join train
         where label is not null and enrolled_yr > 1999)
"""
_LINE_PRED = """with pred as (
  select l_discount as score, case when l_returnflag = 'R' then 1 else 0 end as label from lineitem)
"""
_MODEL_PRED = """, pred as (
  select row_id, label, 'quantity' as model, qty / 300 as score from cohort where label is not null
  union all select row_id, label, 'total', total / 524288 from cohort where label is not null
  union all select row_id, label, 'year', (enrolled_yr - 1994) / 10 from cohort where label is not null)
"""

# --- the same metrics in SQL ---------------------------------------------------------


def _curve(keys: str = "") -> str:
    """CTEs g (per score) and curve (running totals), optionally per key."""
    part = f"partition by {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    return f""", g as (select {lead}score, cast(sum(label) as bigint) as pos, cast(sum(1 - label) as bigint) as neg
        from pred where score is not null group by {lead}score),
curve as (
  select *, sum(pos) over ({part} order by score desc) as tp, sum(neg) over ({part} order by score desc) as fp,
         sum(pos) over ({part}) as p, sum(neg) over ({part}) as n from g)
"""


_AREAS = """round(cast(sum(neg * (tp - pos / 2)) as double) / max(cast(p as double) * n), 6) as auc_roc,
  round(sum(cast(pos as double) * tp / (tp + fp)) / max(p), 6) as average_precision,
  round(sum(cast(pos as double) * (cast(tp as double) / (tp + fp)
    + case when tp - pos + fp - neg > 0 then cast(tp - pos as double) / (tp - pos + fp - neg) else 1 end) / 2) / max(p), 6)
    as auc_prc"""


def _hard() -> str:
    return """round((tp + tn) / (tp + fp + fn + tn), 6) as accuracy,
  round(case when tp + fp = 0 then 0 else tp / (tp + fp) end, 6) as "precision",
  round(case when tp + fn = 0 then 0 else tp / (tp + fn) end, 6) as recall,
  round(case when 2 * tp + fp + fn = 0 then 0 else 2 * tp / (2 * tp + fp + fn) end, 6) as f1"""


def _cells_cte(thresholds, keys: str = "", weight: str = "1") -> str:
    lead = f"{keys}, " if keys else ""
    values = ", ".join(f"(cast({t!r} as double))" for t in thresholds)
    cond = {
        "tp": "label = 1 and score >= threshold",
        "fp": "label = 0 and score >= threshold",
        "fn": "label = 1 and score < threshold",
        "tn": "label = 0 and score < threshold",
    }
    sums = ", ".join(f"cast(coalesce(sum({weight}) filter (where {c}), 0) as bigint) as {n}" for n, c in cond.items())
    return f""", cells as (select {lead}threshold, {sums} from pred cross join (values {values}) t(threshold)
        where score is not null group by {lead}threshold)
"""


_ALL_METRICS = f"threshold, {_hard()}, auc_roc, average_precision, auc_prc, tp, fp, fn, tn"


def _evaluate_sql(thresholds, keys: str = "") -> str:
    lead = f"{keys}, " if keys else ""
    group = f"group by {keys}" if keys else ""
    join = f"join a using ({keys})" if keys else "cross join a"
    return (
        _curve(keys)
        + _cells_cte(thresholds, keys)
        + f", a as (select {lead}{_AREAS} from curve {group}) select {lead}{_ALL_METRICS} from cells {join}"
    )


# --- queries -------------------------------------------------------------------------


@query(on_cohort(_COHORT_PRED + _evaluate_sql([0.3])))
def evaluate(spark, folder):
    return E.evaluate(cohort_scores(spark, folder), [0.3])


_THRESHOLDS = [0.25, 0.3, 0.35, 0.4, 0.45]


@query(on_cohort(_MODEL_PRED + _evaluate_sql(_THRESHOLDS, "model")))
def threshold_sweep(spark, folder):
    return E.evaluate(model_scores(spark, folder), _THRESHOLDS, ["model"])


@query(
    _LINE_PRED
    + _cells_cte([0.05])
    + """select truth, pred, "count" from (
  select 0 as truth, 0 as pred, tn as "count" from cells union all select 0, 1, fp from cells
  union all select 1, 0, fn from cells union all select 1, 1, tp from cells)"""
)
def confusion_matrix(spark, folder):
    return E.confusion_matrix(line_scores(spark, folder), 0.05)


@query(
    _LINE_PRED
    + _cells_cte([0.05])
    + """, r as (
  select '0' as class, tn as hit, fn as wrong, fp as miss from cells union all select '1', tp, fp, fn from cells),
m as (select class, hit / (hit + wrong) as p, hit / (hit + miss) as r, 2 * hit / (2 * hit + wrong + miss) as f,
             hit + miss as support from r)
select class, round(p, 6) as "precision", round(r, 6) as recall, round(f, 6) as f1, support from m
union all select 'avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
  round(sum(f * support) / sum(support), 6), cast(sum(support) as bigint) from m"""
)
def classification_report(spark, folder):
    return E.classification_report(line_scores(spark, folder), 0.05)


@query(on_cohort(_MODEL_PRED + _curve("model") + f", a as (select model, {_AREAS} from curve group by model) select model, auc_roc from a"))
def auc_roc(spark, folder):
    return E.areas(model_scores(spark, folder), ["model"]).select("model", "auc_roc")


@query(_LINE_PRED + _curve() + f", a as (select {_AREAS} from curve) select average_precision from a")
def average_precision(spark, folder):
    return E.areas(line_scores(spark, folder)).select("average_precision")


@query(on_cohort(_COHORT_PRED + _curve() + f", a as (select {_AREAS} from curve) select auc_prc from a"))
def auc_prc(spark, folder):
    return E.areas(cohort_scores(spark, folder)).select("auc_prc")


@query(
    on_cohort(
        _MODEL_PRED
        + _cells_cte([0.3], "model")
        + "select model, threshold, round((1 + tp / (tp + fn) - fp / (fp + tn)) / 2, 6) as auc_roc_hard from cells"
    )
)
def auc_roc_hard(spark, folder):
    return E.auc_roc_hard(model_scores(spark, folder), 0.3, ["model"])


@query(
    on_cohort(
        _MODEL_PRED
        + _curve("model")
        + """select model, round(fp / n, 6) as fpr, round(tp / p, 6) as tpr, round(score, 6) as threshold from curve
union all select distinct model, 0.0, 0.0, cast(null as double) from curve"""
    )
)
def roc_curve(spark, folder):
    return E.roc_curve(model_scores(spark, folder), ["model"])


@query(
    on_cohort(
        _COHORT_PRED
        + _curve()
        + """select round(tp / (tp + fp), 6) as "precision", round(tp / p, 6) as recall, round(score, 6) as threshold
from curve where tp - pos < p union all select 1.0, 0.0, cast(null as double)"""
    )
)
def pr_curve(spark, folder):
    return E.pr_curve(cohort_scores(spark, folder))


@query(
    on_cohort(
        _MODEL_PRED
        + _curve("model")
        + """select model, round(tp / (tp + fp), 6) as "precision", round(tp / p, 6) as recall,
  round((tp + fp) / (p + n), 6) as population from curve where tp - pos < p"""
    )
)
def pr_population_curve(spark, folder):
    return E.pr_population_curve(model_scores(spark, folder), ["model"])


@query(
    _LINE_PRED
    + _curve()
    + """select round(tp / (tp + fp), 6) as "precision", round(tp / p, 6) as recall, score as threshold
from curve where tp - pos < p"""
)
def pr_threshold_curve(spark, folder):
    return E.pr_threshold_curve(line_scores(spark, folder))


@query(on_cohort(_COHORT_PRED + "select row_id, label, round(score, 6) as score, cast(label = 1 and score < 0.3 as integer) as missed from pred"))
def false_negatives(spark, folder):
    return E.false_negatives(cohort_scores(spark, folder), 0.3)


@query(
    on_cohort(
        _COHORT_PRED
        + """, c as (select count(*) filter (where label = 1) as fn, count(*) filter (where label = 0) as tn from pred)
select 0.5::double as threshold, round(tn / (fn + tn), 6) as accuracy, 0.0::double as "precision",
  0.0::double as recall, 0.0::double as f1, 0::bigint as tp, 0::bigint as fp, fn, tn from c"""
    )
)
def constant_baseline(spark, folder):
    scored = FittedConstant().scores(cohort_scores(spark, folder).drop("score"))
    return E.threshold_metrics(scored, [0.5])


# --- result tables -------------------------------------------------------------------

_AT = {"quantity": 0.3, "total": 0.25, "year": 0.45}
_TABLE_CTE = (
    _MODEL_PRED
    + _curve("model")
    + _cells_cte(sorted(set(_AT.values())), "model")
    + f""", a as (select model, {_AREAS} from curve group by model),
every as (select model, {_ALL_METRICS} from cells join a using (model)),
chosen as (select * from every where (model, threshold) in (
  {', '.join(f"('{m}', cast({t!r} as double))" for m, t in _AT.items())}))
"""
)
_METRIC_LIST = 'accuracy, "precision", recall, f1, auc_roc, average_precision, auc_prc'
_BASE_ROW = """select 'baseline' as model, round(1 - avg(label), 6) as accuracy, 0.0::double as "precision",
  0.0::double as recall, 0.0::double as f1, 0.0::double as auc_roc, 0.0::double as average_precision,
  0.0::double as auc_prc from cohort"""


def _chosen(spark, folder):
    return E.metrics_table(model_scores(spark, folder), _AT).select("model", *E.METRICS)


@query(on_cohort(_TABLE_CTE + "select model, threshold, " + _METRIC_LIST + ", tp, fp, fn, tn from chosen"))
def metrics_table(spark, folder):
    return E.metrics_table(model_scores(spark, folder), _AT)


@query(on_cohort(_TABLE_CTE + f"select model, {_METRIC_LIST} from chosen union all {_BASE_ROW}"))
def baseline_row(spark, folder):
    return E.with_baseline(_chosen(spark, folder), cohort(spark, folder).select("label"))


@query(on_cohort(_TABLE_CTE + f"select model, {_METRIC_LIST} from chosen where recall > 0.2 order by auc_roc desc, model"))
def rank_results(spark, folder):
    return R.rank_results(_chosen(spark, folder).where("recall > 0.2"), "auc_roc", "model")


@query(on_cohort(_TABLE_CTE + f"select model, threshold, {_METRIC_LIST} from every order by f1 desc, model limit 1"))
def best_config(spark, folder):
    every = E.evaluate(model_scores(spark, folder), sorted(set(_AT.values())), ["model"])
    return R.best_config(every.drop("tp", "fp", "fn", "tn"), "f1", "model")


def _best_sql() -> str:
    rows = " union all ".join(
        f"select '{m}' as metric, arg_max(model, \"{m}\") as best, arg_min(model, \"{m}\") as worst from chosen"
        for m in E.METRICS
    )
    return on_cohort(_TABLE_CTE + rows)


@query(_best_sql())
def best_worst_model(spark, folder):
    return R.best_worst(_chosen(spark, folder), "model", E.METRICS)


@query(
    on_cohort(
        _TABLE_CTE
        + f""", fresh as (select model, threshold, {_METRIC_LIST} from every where threshold = 0.25 and recall > 0.5)
select * from fresh
union all select model, threshold, {_METRIC_LIST} from every
where threshold = 0.3 and model not in (select model from fresh)"""
    )
)
def upsert_metrics(spark, folder):
    """The table at threshold 0.3; models with high recall at 0.25 are written again from there."""
    every = R.materialise(E.evaluate(model_scores(spark, folder), [0.25, 0.3], ["model"]))
    every = every.drop("tp", "fp", "fn", "tn")
    return R.upsert(every.where("threshold = 0.3"), every.where("threshold = 0.25 and recall > 0.5"), ["model"])


_GRID = {"scale": [250.0, 300.0], "floor": [0.0, 0.05, 0.1], "threshold": [0.3, 0.4]}


def _grid_sql() -> str:
    rows = " union all ".join(
        f"""select {i} as comb, cast({c['scale']!r} as double) as scale, cast({c['floor']!r} as double) as "floor",
  cast({c['threshold']!r} as double) as threshold, count(*) filter (where hit and label = 1) as tp,
  count(*) filter (where hit and label = 0) as fp
from (select label, qty / {c['scale']!r} - {c['floor']!r} >= {c['threshold']!r}::double as hit from cohort where label is not null)"""
        for i, c in enumerate(R.value_combinations(_GRID))
    )
    return on_cohort(rows)


@query(_grid_sql())
def param_grid(spark, folder):
    """Hits of a rule for every parameter combination, all combinations in one aggregation."""
    rows = cohort(spark, folder).where("label is not null")
    aggs, cells = [], []
    for i, c in enumerate(R.value_combinations(_GRID)):
        hit = (F.col("qty") / c["scale"] - c["floor"]) >= c["threshold"]
        aggs += [F.count_if(hit & (F.col("label") == y)).alias(f"n{i}_{y}") for y in (0, 1)]
        cells.append(
            F.struct(
                F.lit(i).alias("comb"),
                *[F.lit(v).alias(k) for k, v in c.items()],
                F.col(f"n{i}_1").alias("tp"),
                F.col(f"n{i}_0").alias("fp"),
            )
        )
    return rows.agg(*aggs).select(F.explode(F.array(*cells)).alias("e")).select("e.*")


_FOLD_MEAN = (
    BOOT_CV
    + """, pred as (
  select b.fold, b.replicate, b.mult, c.label, c.qty / 300 as score from boot b join cohort c on c.row_id = b.row_id
  where b.role = 'test' and c.label is not null)
"""
    + _cells_cte([0.3, 0.35], "fold, replicate", "mult")
    + f""", m as (select fold, replicate, threshold, {_hard()} from cells),
f as (select fold, threshold, avg(accuracy) as accuracy, avg("precision") as "precision", avg(recall) as recall,
             avg(f1) as f1 from m group by fold, threshold),
w as (select fold, sum(mult) as train_rows from boot where role = 'train' group by fold)
select threshold, round(sum(accuracy * train_rows / total), 5) as accuracy,
  round(sum("precision" * train_rows / total), 5) as "precision",
  round(sum(recall * train_rows / total), 5) as recall, round(sum(f1 * train_rows / total), 5) as f1
from f join w using (fold) cross join (select sum(train_rows) as total from w) group by threshold"""
)


@query(on_cohort(_FOLD_MEAN))
def weighted_fold_mean(spark, folder):
    rows = cohort(spark, folder).select("row_id", "enrolled_yr", "label", (F.col("qty") / 300).alias("score"))
    rows = R.materialise(rows)
    draws = R.materialise(SP.bootstrap_time_cv(rows, "enrolled_yr", TIME_FOLDS, "row_id", 0.8, 3, seed=5))
    pred = draws.where("role = 'test'").join(rows, "row_id").where("label is not null")
    metrics = E.threshold_metrics(pred, [0.3, 0.35], ["fold", "replicate"], weight="mult")
    sizes = draws.where("role = 'train'").groupBy("fold").agg(F.sum("mult").alias("train_rows"))
    names = ["accuracy", "precision", "recall", "f1"]
    mean = E.weighted_fold_mean(metrics, sizes, ["threshold"], "fold", names)
    return mean.select("threshold", *[F.round(n, 5).alias(n) for n in names])



@query(
    on_cohort("""select enrolled_yr, count(*) as rows, count(*) filter (where acctbal is null) as no_score,
  count(*) filter (where label is null) as no_label from cohort group by enrolled_yr""")
)
def unscored_rows(spark, folder):
    """Rows that metrics by year leave out, as they lack a score or a label."""
    rows = cohort(spark, folder).select("enrolled_yr", "label", (F.col("acctbal") / 10000).alias("score"))
    return E.unscored(rows, ["enrolled_yr"])
