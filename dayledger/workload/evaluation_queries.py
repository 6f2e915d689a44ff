"""Queries on evaluation: thresholds, curves, segments, deciles, cohorts, model comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluation as E
from ..sources.schemas import NUMERIC_FEATURES
from . import inputs as I
from .registry import query, rounded, rounded_sql

# Sufficiency limits that suit the smaller tables too.
MIN_ROWS, MIN_POSITIVES = 100, 50


def _confusion_sql(tp: str, pp: str, p: str, n: str) -> str:
    fp, fn = f"({pp} - {tp})", f"({p} - {tp})"
    tn = f"({n} - {pp} - {fn})"

    def over(a: str, b: str) -> str:
        return f"round(CASE WHEN {b} = 0 THEN 0.0 ELSE ({a})::DOUBLE / ({b}) END + 1e-9, 6)"

    return f"""{over(tp, pp)} AS "precision", {over(tp, p)} AS recall, {over(f'2 * {tp}', f'(2 * {tp} + {fp} + {fn})')} AS f1,
       {over(pp, n)} AS predicted_positive_rate, round(1 - {pp}::DOUBLE / {n} + 1e-9, 6) AS predicted_negative_rate,
       {pp} AS positive_prediction_count, {n} - {pp} AS negative_prediction_count,
       {over(tn, f'({tn} + {fp})')} AS specificity, {over(tn, f'({tn} + {fn})')} AS negative_predictive_value,
       {tp} AS true_positive_count, {tn} AS true_negative_count, {fp} AS false_positive_count, {fn} AS false_negative_count"""


_COUNTS = """count(*) FILTER (WHERE score >= {t} AND target = 1) AS tp, count(*) FILTER (WHERE score >= {t}) AS pp,
             count(*) FILTER (WHERE target = 1) AS p, count(*) AS n"""


@query(
    "confusion_metrics",
    f"""SELECT split, {_confusion_sql('tp', 'pp', 'p', 'n')}
        FROM (SELECT split, {_COUNTS.format(t=0.5)} FROM v_splits GROUP BY split) c""",
)
def confusion_metrics(spark, sf):
    return rounded(E.confusion_metrics(I.evaluation_rows(spark, sf), I.THRESHOLD))


def _grid_sql(keys: str, where: str = "") -> str:
    """The grid by brute force: every row against every threshold."""
    return f"""SELECT {keys}, step::INT AS step, step / 20.0::DOUBLE AS threshold, n AS row_count, p AS positive_count,
       round(p::DOUBLE / n + 1e-9, 6) AS prevalence, {_confusion_sql('tp', 'pp', 'p', 'n')}
       FROM (SELECT {keys}, g.step, count(*) FILTER (WHERE score >= g.step / 20.0 AND target = 1) AS tp,
                    count(*) FILTER (WHERE score >= g.step / 20.0) AS pp, count(*) FILTER (WHERE target = 1) AS p, count(*) AS n
             FROM v_splits, generate_series(1, 19) AS g(step) {where} GROUP BY {keys}, g.step) c"""


@query("threshold_grid", _grid_sql("split"))
def threshold_grid(spark, sf):
    return rounded(E.threshold_grid(I.evaluation_rows(spark, sf)))


def _unrounded(sql: str) -> str:
    """The grid with ratios left exact, as the policies compare them."""
    return f"""SELECT *, true_positive_count::DOUBLE / nullif(positive_prediction_count, 0) AS xp,
       true_positive_count::DOUBLE / nullif(true_positive_count + false_negative_count, 0) AS xr,
       2.0 * true_positive_count / nullif(2 * true_positive_count + false_positive_count + false_negative_count, 0) AS xf
       FROM ({sql}) g"""


_SELECT_SQL = f"""
WITH grid AS (SELECT split, step, coalesce(xp, 0) AS xp, coalesce(xr, 0) AS xr, coalesce(xf, 0) AS xf FROM ({_unrounded(_grid_sql('split'))}) u),
a AS (SELECT split, 'max_precision_with_min_recall(minimum_recall=0.60)' AS threshold_policy, step,
      row_number() OVER (PARTITION BY split ORDER BY xp DESC, xf DESC, xr DESC, step DESC) AS r FROM grid WHERE xr >= 0.6),
b AS (SELECT split, 'max_precision' AS threshold_policy, step,
      row_number() OVER (PARTITION BY split ORDER BY xp DESC, xr DESC, xf DESC, step DESC) AS r FROM grid),
c AS (SELECT split, 'best_f1' AS threshold_policy, step,
      row_number() OVER (PARTITION BY split ORDER BY xf DESC, xp DESC, xr DESC, step) AS r FROM grid)
SELECT split, step, step / 20.0::DOUBLE AS selected_threshold, threshold_policy
FROM (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c) picked WHERE r = 1"""


@query("threshold_select", _SELECT_SQL)
def threshold_select(spark, sf):
    grid = E.threshold_grid(I.evaluation_rows(spark, sf))
    return E.policy_choices(grid, list(E.POLICY_KEYS), group=["split"])


def _curve_sql(keys: str, where: str = "") -> str:
    return f"""SELECT {keys}, sum(n)::BIGINT AS "rows", sum(pos)::BIGINT AS positives,
       sum(s * n) AS score_sum, sum((n - pos) * s * s + pos * (1 - s) * (1 - s)) AS square_sum,
       CASE WHEN max(ap) > 0 AND max(ap) < max(an) THEN sum((n - pos)::DOUBLE * (cp - pos + pos / 2.0)) / (max(ap)::DOUBLE * (max(an) - max(ap))) END AS roc_auc,
       CASE WHEN max(ap) > 0 AND max(ap) < max(an) THEN sum(pos::DOUBLE * cp / cn) / max(ap) END AS pr_auc,
       coalesce(sum(pos) FILTER (WHERE s >= 0.5), 0)::BIGINT AS tp, coalesce(sum(n) FILTER (WHERE s >= 0.5), 0)::BIGINT AS pp
       FROM (SELECT *, sum(pos) OVER w AS cp, sum(n) OVER w AS cn, sum(pos) OVER (PARTITION BY {keys}) AS ap,
                    sum(n) OVER (PARTITION BY {keys}) AS an
             FROM (SELECT {keys}, score AS s, count(*) AS n, count(*) FILTER (WHERE target = 1) AS pos
                   FROM v_splits {where} GROUP BY {keys}, score) h
             WINDOW w AS (PARTITION BY {keys} ORDER BY s DESC ROWS UNBOUNDED PRECEDING)) k GROUP BY {keys}"""


def _metrics_sql(keys: str, where: str = "", having: str = "") -> str:
    return f"""SELECT {keys}, "rows", positives, round(positives::DOUBLE / "rows" + 1e-9, 6) AS positive_rate,
       round(score_sum / "rows" + 1e-9, 6) AS score_mean, round(pr_auc + 1e-9, 6) AS pr_auc, round(roc_auc + 1e-9, 6) AS roc_auc,
       round(square_sum / "rows" + 1e-9, 6) AS brier, 0.5::DOUBLE AS threshold, {_confusion_sql('tp', 'pp', 'positives', '"rows"')}
       FROM ({_curve_sql(keys, where)}) m {having}"""


@query("roc_auc", f"SELECT split, round(roc_auc + 1e-9, 6) AS roc_auc FROM ({_curve_sql('split')}) m")
def roc_auc(spark, sf):
    return rounded(E.split_metrics(I.evaluation_rows(spark, sf), I.THRESHOLD).select("split", "roc_auc"))


@query("pr_auc", f"SELECT split, round(pr_auc + 1e-9, 6) AS pr_auc FROM ({_curve_sql('split')}) m")
def pr_auc(spark, sf):
    return rounded(E.split_metrics(I.evaluation_rows(spark, sf), I.THRESHOLD).select("split", "pr_auc"))


@query("brier", "SELECT split, round(avg((score - target) * (score - target)) + 1e-9, 6) AS brier FROM v_splits GROUP BY split")
def brier(spark, sf):
    return rounded(E.brier_score(I.evaluation_rows(spark, sf)))


@query("split_metrics", _metrics_sql("split"))
def split_metrics(spark, sf):
    return rounded(E.split_metrics(I.evaluation_rows(spark, sf), I.THRESHOLD))


@query("segment_metrics", f"""SELECT *, "rows" >= 100 AS sufficient FROM ({_metrics_sql('split, segment_value')}) q""")
def segment_metrics(spark, sf):
    return rounded(E.segment_metrics(I.evaluation_rows(spark, sf), I.THRESHOLD))


@query(
    "segment_inventory",
    f"""SELECT split, segment_value, count(*) AS row_count, sum(target)::BIGINT AS positive_count,
        round(avg(target) + 1e-9, 6) AS prevalence, count(*) >= {MIN_ROWS} AND sum(target) >= {MIN_POSITIVES} AS eligible_for_threshold_grid
        FROM v_splits GROUP BY split, segment_value""",
)
def segment_inventory(spark, sf):
    return rounded(E.segment_inventory(I.evaluation_rows(spark, sf), MIN_ROWS, MIN_POSITIVES))


_ENOUGH = f"row_count >= {MIN_ROWS} AND positive_count >= {MIN_POSITIVES} AS sufficient"
_SEGMENT_GRID = f"SELECT *, {_ENOUGH} FROM ({_grid_sql('split, segment_value')}) g"
_BUSINESS = "WHERE segment_value NOT IN ('UNKNOWN', '__NULL__')"


def _with_curves_sql(grid: str) -> str:
    return f"""SELECT g.*, round(m.pr_auc + 1e-9, 6) AS pr_auc, round(m.roc_auc + 1e-9, 6) AS roc_auc FROM ({grid}) g
       JOIN ({_curve_sql('split, segment_value')}) m ON g.split = m.split AND g.segment_value = m.segment_value"""


@query("segment_threshold_grid", _with_curves_sql(_SEGMENT_GRID))
def segment_threshold_grid(spark, sf):
    return rounded(E.segment_grid_with_curves(I.evaluation_rows(spark, sf), MIN_ROWS, MIN_POSITIVES))


@query("segment_threshold_grid_business", f"{_SEGMENT_GRID} {_BUSINESS}")
def segment_threshold_grid_business(spark, sf):
    return rounded(E.segment_threshold_grid(I.evaluation_rows(spark, sf), MIN_ROWS, MIN_POSITIVES, business_only=True))


_BEST_SQL = f"""SELECT split, segment_value, threshold AS best_threshold, "precision" AS best_precision, recall AS best_recall, f1 AS best_f1
 FROM (SELECT *, row_number() OVER (PARTITION BY split, segment_value ORDER BY coalesce(xf, 0) DESC, coalesce(xp, 0) DESC,
       coalesce(xr, 0) DESC, step) AS r FROM ({_unrounded('{grid}')}) u) b WHERE r = 1"""


@query("segment_best_threshold", _BEST_SQL.replace("{grid}", _SEGMENT_GRID))
def segment_best_threshold(spark, sf):
    grid = E.segment_threshold_grid(I.evaluation_rows(spark, sf), MIN_ROWS, MIN_POSITIVES)
    return rounded(E.segment_best_threshold(grid))


@query(
    "operating_views",
    f"""WITH picked AS (SELECT step FROM ({_SELECT_SQL}) s WHERE split = 'validation' AND threshold_policy LIKE '%min_recall%'),
        views AS (SELECT 'recall-prioritized' AS view, 6 AS step UNION ALL SELECT 'balanced', step FROM picked
                  UNION ALL SELECT 'precision-protected', 12)
        SELECT v.view, g.threshold, g."precision" AS global_precision, g.recall AS global_recall, g.f1 AS global_f1,
        g.predicted_positive_rate AS global_predicted_positive_rate
        FROM ({_grid_sql('split')}) g JOIN views v ON g.step = v.step WHERE g.split = 'test'""",
)
def operating_views(spark, sf):
    return rounded(E.operating_views(E.threshold_grid(I.evaluation_rows(spark, sf))))


@query(
    "threshold_snapshot",
    f"""SELECT split, threshold, "precision", recall, f1, specificity, negative_predictive_value, positive_prediction_count,
        negative_prediction_count, predicted_positive_rate, predicted_negative_rate
        FROM ({_grid_sql('split')}) g WHERE step IN (6, 9, 10, 12)""",
)
def threshold_snapshot(spark, sf):
    grid = E.threshold_snapshot(E.threshold_grid(I.evaluation_rows(spark, sf)), [6, 9, 10, 12])
    return rounded(
        grid.select(
            "split",
            "threshold",
            "precision",
            "recall",
            "f1",
            "specificity",
            "negative_predictive_value",
            "positive_prediction_count",
            "negative_prediction_count",
            "predicted_positive_rate",
            "predicted_negative_rate",
        )
    )


_V12 = "WHERE segment_value IN ('V1', 'V2') AND split IN ('validation', 'test')"


@query(
    "selected_versus_best",
    f"""SELECT m.segment_value AS segment, m.split, m."rows" AS row_count, m.positives AS positive_count,
        m.positive_rate AS prevalence, m.pr_auc, m.roc_auc, m.threshold AS selected_threshold, m.f1 AS selected_f1,
        b.best_threshold AS best_threshold_on_grid, b.best_f1 AS best_f1_on_grid
        FROM ({_metrics_sql('split, segment_value', _V12)}) m
        JOIN ({_BEST_SQL.replace('{grid}', _grid_sql('split, segment_value', _V12))}) b
          ON m.split = b.split AND m.segment_value = b.segment_value""",
)
def selected_versus_best(spark, sf):
    return rounded(E.selected_versus_best(I.evaluation_rows(spark, sf), I.THRESHOLD))


# Fixed value: a second score to compare the first with.
_OTHER_SQL = "round(1 / (1 + exp(-(-0.5 + 0.2 * recent_bet_cnt_7d))), 6)"


def _other_score():
    return F.round(1 / (1 + F.exp(-(-0.5 + 0.2 * F.col("recent_bet_cnt_7d")))), 6)


def _comparison_sql() -> str:
    other = _metrics_sql("split").replace("FROM v_splits", f"FROM (SELECT * REPLACE ({_OTHER_SQL} AS score) FROM v_splits) o")
    cells = ", ".join(
        f"max({m}) FILTER (WHERE split = '{s}') AS {s}_{m}" for s in ("validation", "test") for m in ("pr_auc", "roc_auc", "f1")
    )
    return f"""SELECT model_name, {cells}, max(threshold) AS selected_threshold FROM (
        SELECT 'fixed_logit' AS model_name, * FROM ({_metrics_sql('split')}) a
        UNION ALL SELECT 'bet_count' AS model_name, * FROM ({other}) b) both_models GROUP BY model_name"""


def _two_models(spark, sf):
    """Both scores side by side as one set of rows: the second is another column of the same population."""
    rows = I.evaluation_rows(spark, sf)
    pairs = F.explode(
        F.array(
            F.struct(F.lit("fixed_logit").alias("model_name"), F.col("score").alias("s")),
            F.struct(F.lit("bet_count").alias("model_name"), _other_score().alias("s")),
        )
    )
    both = rows.select("split", "target", pairs.alias("m"))
    return both.select("split", "target", "m.model_name", F.col("m.s").alias("score"))


@query("model_comparison", _comparison_sql())
def model_comparison(spark, sf):
    metrics = E.metrics_by(_two_models(spark, sf), I.THRESHOLD, ["model_name", "split"])
    return rounded(E.model_comparison(metrics))


@query("champion", f"SELECT * FROM ({_comparison_sql()}) c ORDER BY validation_pr_auc DESC NULLS LAST, model_name LIMIT 1")
def champion(spark, sf):
    metrics = E.metrics_by(_two_models(spark, sf), I.THRESHOLD, ["model_name", "split"])
    return rounded(E.champion(E.model_comparison(metrics)))


@query(
    "score_deciles",
    """SELECT CASE WHEN n = 1 THEN 1 ELSE greatest(1, (10 * (r - 1) + n - 2) // (n - 1)) END AS decile, count(*) AS "rows",
       round(avg(target) + 1e-9, 6) AS positive_rate, round(avg(score) + 1e-9, 6) AS avg_score
       FROM (SELECT score, target, row_number() OVER (ORDER BY score, pt, player_id, assignment_date) AS r, count(*) OVER () AS n
             FROM v_splits WHERE split = 'test') k GROUP BY 1""",
)
def score_deciles(spark, sf):
    return rounded(E.score_deciles(I.evaluation_rows(spark, sf).where(F.col("split") == "test")))


_COHORTS = """(SELECT *, r <= greatest(1, n // 5) AS high, r > n - greatest(1, n // 5) AS low
   FROM (SELECT *, row_number() OVER (ORDER BY score DESC, pt, player_id) AS r, count(*) OVER () AS n
         FROM v_splits WHERE split = 'test') k) c"""


def _cohorts(spark, sf, features):
    return E.ranked_cohorts(I.evaluation_rows(spark, sf).where(F.col("split") == "test"), features)


@query(
    "cohort_numeric",
    rounded_sql(
        " UNION ALL ".join(
            f"""SELECT '{f}' AS feature, avg({f}) FILTER (WHERE high) AS high_score_mean, avg({f}) FILTER (WHERE low) AS low_score_mean,
                avg({f}) FILTER (WHERE high) - avg({f}) FILTER (WHERE low) AS difference FROM {_COHORTS}"""
            for f in NUMERIC_FEATURES
        ),
        ["high_score_mean", "low_score_mean", "difference"],
    ),
)
def cohort_numeric(spark, sf):
    return rounded(E.cohort_numeric(_cohorts(spark, sf, NUMERIC_FEATURES), NUMERIC_FEATURES))


@query(
    "cohort_vip",
    f"""SELECT segment_value AS vip_level,
        round(count(*) FILTER (WHERE high) / (sum(count(*) FILTER (WHERE high)) OVER ()) + 1e-9, 6) AS high_score_share,
        round(count(*) FILTER (WHERE low) / (sum(count(*) FILTER (WHERE low)) OVER ()) + 1e-9, 6) AS low_score_share
        FROM {_COHORTS} WHERE high OR low GROUP BY segment_value""",
)
def cohort_vip(spark, sf):
    return rounded(E.cohort_segments(_cohorts(spark, sf, [])))
