"""Evaluation of scored, labelled rows: threshold metrics, curves, threshold policy, segments, deciles, cohorts.

Input rows: `split`, `vip_level`, integer `target`, double `score`. Rows are first counted per distinct
score (or per grid step), so later work depends on the number of distinct scores, not of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import MISSING_IN_REPORTS, labelled, ratio
from .ordering import rank_rows, running_totals

# Grid step i stands for threshold i / 20; sufficiency limits; segments left out of business views.
GRID_STEPS = range(1, 20)
SEGMENT_KEYS = ["split", "segment_value"]
MIN_SEGMENT_ROWS = 100
MIN_GRID_ROWS, MIN_GRID_POSITIVES = 1000, 100
BUSINESS_EXCLUDED_SEGMENTS = ["UNKNOWN", MISSING_IN_REPORTS]


def with_segment(frame: DataFrame, segment: str = "vip_level") -> DataFrame:
    return frame.withColumn("segment_value", labelled(segment, MISSING_IN_REPORTS))


# --- metrics from counts -------------------------------------------------------------------


def confusion_columns(tp: Column, predicted: Column, positives: Column, rows: Column) -> list[Column]:
    """All threshold metrics from four counts; undefined ratios are 0."""
    fp, fn = predicted - tp, positives - tp
    tn = rows - predicted - fn
    rate = ratio(predicted, rows, 0.0)
    return [
        ratio(tp, predicted, 0.0).alias("precision"),
        ratio(tp, positives, 0.0).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn, 0.0).alias("f1"),
        rate.alias("predicted_positive_rate"),
        (1 - rate).alias("predicted_negative_rate"),
        predicted.alias("positive_prediction_count"),
        (rows - predicted).alias("negative_prediction_count"),
        ratio(tn, tn + fp, 0.0).alias("specificity"),
        ratio(tn, tn + fn, 0.0).alias("negative_predictive_value"),
        tp.alias("true_positive_count"),
        tn.alias("true_negative_count"),
        fp.alias("false_positive_count"),
        fn.alias("false_negative_count"),
    ]


def confusion_metrics(frame: DataFrame, threshold: float, group: Sequence[str] = ("split",)) -> DataFrame:
    hit = F.col("score") >= threshold
    counts = frame.groupBy(*group).agg(
        F.count_if(hit & (F.col("target") == 1)).alias("_tp"),
        F.count_if(hit).alias("_pp"),
        F.count_if(F.col("target") == 1).alias("_p"),
        F.count(F.lit(1)).alias("_n"),
    )
    return counts.select(*group, *confusion_columns(*[F.col(c) for c in ("_tp", "_pp", "_p", "_n")]))


# --- curves --------------------------------------------------------------------------------


def score_histogram(frame: DataFrame, group: Sequence[str]) -> DataFrame:
    return frame.groupBy(*group, "score").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("target").cast("bigint")).alias("pos")
    )


def score_curve(frame: DataFrame, group: Sequence[str]) -> DataFrame:
    """Rows and positives per distinct score with their running totals, best score first.

    Written to the shared folder by the sort, so every metric and grid of the same rows can start from it.
    """
    return running_totals(score_histogram(frame, group), group, [F.desc("score")], ["n", "pos"])


def curve_metrics(curve: DataFrame, threshold: float, group: Sequence[str]) -> DataFrame:
    """Every metric of each group in one aggregation.

    ROC-AUC: a negative is beaten by the positives above it and by half of those at its score.
    PR-AUC: precision at each distinct score, weighted by the recall gained there.
    Both are NULL when a group has one class only.
    """
    at = f"score >= {float(threshold)!r}D"
    sums = curve.groupBy(*group).agg(
        F.expr("sum(n) AS rows"),
        F.expr("sum(pos) AS positives"),
        F.expr("sum(score * n) AS _score_sum"),
        F.expr("sum((n - pos) * score * score + pos * (1 - score) * (1 - score)) AS _square_sum"),
        F.expr("sum(CAST(n - pos AS DOUBLE) * (CAST(cum_pos - pos AS DOUBLE) + pos / 2)) AS _beaten"),
        F.expr("sum(pos * (cum_pos / cum_n)) AS _gained"),
        F.expr(f"sum(CASE WHEN {at} THEN pos ELSE 0 END) AS _tp"),
        F.expr(f"sum(CASE WHEN {at} THEN n ELSE 0 END) AS _pp"),
    )
    rows, positives = F.col("rows"), F.col("positives")
    both = "positives > 0 AND positives < rows"
    return sums.select(
        *group,
        rows,
        positives,
        ratio(positives, rows).alias("positive_rate"),
        ratio("_score_sum", rows).alias("score_mean"),
        F.expr(f"CASE WHEN {both} THEN _gained / positives END AS pr_auc"),
        F.expr(f"CASE WHEN {both} THEN _beaten / (CAST(positives AS DOUBLE) * (rows - positives)) END AS roc_auc"),
        ratio("_square_sum", rows).alias("brier"),
        F.lit(float(threshold)).alias("threshold"),
        *confusion_columns(F.col("_tp"), F.col("_pp"), positives, rows),
    )


def metrics_by(frame: DataFrame, threshold: float, group: Sequence[str]) -> DataFrame:
    return curve_metrics(score_curve(frame, group), threshold, group)


def brier_score(frame: DataFrame, group: Sequence[str] = ("split",)) -> DataFrame:
    gap = F.col("score") - F.col("target")
    return frame.groupBy(*group).agg(F.avg(gap * gap).alias("brier"))


def split_metrics(frame: DataFrame, threshold: float) -> DataFrame:
    return metrics_by(frame, threshold, ["split"])


def segment_metrics(frame: DataFrame, threshold: float, min_rows: int = MIN_SEGMENT_ROWS) -> DataFrame:
    metrics = metrics_by(with_segment(frame), threshold, SEGMENT_KEYS)
    return metrics.withColumn("sufficient", F.col("rows") >= min_rows)


# --- threshold grid ------------------------------------------------------------------------


def grid_step(score: str = "score") -> Column:
    """Largest step i with score >= i / 20, exact at the steps."""
    guess = F.floor(F.col(score) * 20)
    return (
        F.when(F.col(score) < guess / 20, guess - 1)
        .when(F.col(score) >= (guess + 1) / 20, guess + 1)
        .otherwise(guess)
    )


def threshold_grid(frame: DataFrame, group: Sequence[str] = ("split",)) -> DataFrame:
    """Metrics at each of the 19 thresholds: rows are read once and counted per step, never multiplied."""
    counted = frame.select(*group, grid_step().alias("step"), F.lit(1).cast("bigint").alias("n"), F.expr("CAST(target AS BIGINT) AS pos"))
    return _grid(counted, group)


def curve_grid(curve: DataFrame, group: Sequence[str]) -> DataFrame:
    """The same grid from the rows of `score_curve`."""
    return _grid(curve.select(*group, grid_step().alias("step"), "n", "pos"), group)


def _grid(counted: DataFrame, group: Sequence[str]) -> DataFrame:
    steps = counted.groupBy(*group, "step").agg(F.expr("sum(n) AS n"), F.expr("sum(pos) AS pos"))
    # at most 21 steps a group from here on
    sums = [F.expr("sum(n) AS _n"), F.expr("sum(pos) AS _p")]
    for i in GRID_STEPS:
        sums.append(F.expr(f"sum(CASE WHEN step >= {i} THEN n ELSE 0 END) AS _pp{i}"))
        sums.append(F.expr(f"sum(CASE WHEN step >= {i} THEN pos ELSE 0 END) AS _tp{i}"))
    wide = steps.groupBy(*group).agg(*sums)
    cells = ", ".join(f"{i}, _tp{i}, _pp{i}" for i in GRID_STEPS)
    tall = wide.selectExpr(*group, "_n", "_p", f"stack({len(GRID_STEPS)}, {cells}) AS (step, _tp, _pp)")
    return tall.select(
        *group,
        "step",
        (F.col("step") / 20).alias("threshold"),
        F.col("_n").alias("row_count"),
        F.col("_p").alias("positive_count"),
        ratio("_p", "_n").alias("prevalence"),
        *confusion_columns(F.col("_tp"), F.col("_pp"), F.col("_p"), F.col("_n")),
    )


# The threshold policies. Each picks the grid row that is largest in its key, left to right.
POLICY_KEYS = {
    "max_precision_with_min_recall": "named_struct('a', precision, 'b', f1, 'c', recall, 'd', step)",
    "max_precision": "named_struct('a', precision, 'b', recall, 'c', f1, 'd', step)",
    "best_f1": "named_struct('a', f1, 'b', precision, 'c', recall, 'd', -step)",
}
WITH_RECALL = "max_precision_with_min_recall"


def chosen_step(policy: str, minimum_recall: float, fallback: str) -> tuple[Column, Column]:
    """Aggregates over a grid: the step the policy picks, and the text of the policy that picked it."""
    for name in (policy, fallback):
        if name not in POLICY_KEYS:
            raise ValueError(f"unknown threshold policy {name!r}")
    if fallback == WITH_RECALL:
        raise ValueError("the fallback policy may not have a condition of its own")

    def best(name: str, rows: str = "true") -> Column:
        return F.abs(F.expr(f"max(CASE WHEN {rows} THEN {POLICY_KEYS[name]} END)").getField("d"))

    if policy != WITH_RECALL:
        return best(policy), F.lit(policy)
    reaching = best(policy, f"recall >= {float(minimum_recall)!r}D")
    label = f"{policy}(minimum_recall={minimum_recall:.2f})"
    return F.coalesce(reaching, best(fallback)), F.when(reaching.isNotNull(), label).otherwise(fallback)


def select_threshold(
    grid: DataFrame,
    policy: str = WITH_RECALL,
    minimum_recall: float = 0.60,
    fallback: str = "max_precision",
    group: Sequence[str] = (),
) -> DataFrame:
    """The chosen threshold and the policy that chose it, one row per group of the grid."""
    return policy_choices(grid, [policy], minimum_recall, fallback, group)


def policy_choices(
    grid: DataFrame,
    policies: Sequence[str],
    minimum_recall: float = 0.60,
    fallback: str = "max_precision",
    group: Sequence[str] = (),
) -> DataFrame:
    """The choice of several policies from one aggregation of the grid, one row per group and policy."""
    aggregates, pairs = [], []
    for i, policy in enumerate(policies):
        step, used = chosen_step(policy, minimum_recall, fallback)
        aggregates += [step.alias(f"_s{i}"), used.alias(f"_u{i}")]
        pairs.append(f"_s{i}, _u{i}")
    picked = grid.groupBy(*group).agg(*aggregates)
    rows = picked.selectExpr(*group, f"stack({len(policies)}, {', '.join(pairs)}) AS (step, threshold_policy)")
    return rows.select(*group, "step", (F.col("step") / 20).alias("selected_threshold"), "threshold_policy")


# --- segments ------------------------------------------------------------------------------


def segment_inventory(
    frame: DataFrame, min_rows: int = MIN_GRID_ROWS, min_positives: int = MIN_GRID_POSITIVES
) -> DataFrame:
    counts = with_segment(frame).groupBy("split", "segment_value").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.col("target").cast("bigint")).alias("positive_count"),
        F.avg(F.col("target").cast("double")).alias("prevalence"),
    )
    enough = (F.col("row_count") >= min_rows) & (F.col("positive_count") >= min_positives)
    return counts.withColumn("eligible_for_threshold_grid", enough)


def _sufficient(grid: DataFrame, min_rows: int, min_positives: int, business_only: bool) -> DataFrame:
    enough = (F.col("row_count") >= min_rows) & (F.col("positive_count") >= min_positives)
    kept = grid.withColumn("sufficient", enough)
    return kept.where(~F.col("segment_value").isin(BUSINESS_EXCLUDED_SEGMENTS)) if business_only else kept


def segment_threshold_grid(
    frame: DataFrame,
    min_rows: int = MIN_GRID_ROWS,
    min_positives: int = MIN_GRID_POSITIVES,
    business_only: bool = False,
) -> DataFrame:
    """The grid of every (split, segment); `sufficient` tells those with enough rows and positives.

    Sufficiency needs no second pass: the grid already carries the counts of its group.
    """
    grid = threshold_grid(with_segment(frame), SEGMENT_KEYS)
    return _sufficient(grid, min_rows, min_positives, business_only)


def segment_grid_with_curves(
    frame: DataFrame,
    min_rows: int = MIN_GRID_ROWS,
    min_positives: int = MIN_GRID_POSITIVES,
    business_only: bool = False,
) -> DataFrame:
    """The same with PR-AUC and ROC-AUC of the group on each row; grid and curves share one pass over the rows."""
    curve = score_curve(with_segment(frame), SEGMENT_KEYS)
    grid = _sufficient(curve_grid(curve, SEGMENT_KEYS), min_rows, min_positives, business_only)
    areas = curve_metrics(curve, 0.5, SEGMENT_KEYS).select(*SEGMENT_KEYS, "pr_auc", "roc_auc")
    return grid.join(areas, SEGMENT_KEYS)


def segment_best_threshold(grid: DataFrame) -> DataFrame:
    """Best-f1 row of each (split, segment): highest f1, precision, recall, then lowest threshold."""
    carried = ["threshold", "precision", "recall", "f1"]
    row = ", ".join(f"'{c}', {c}" for c in carried)
    best = grid.groupBy(*SEGMENT_KEYS).agg(F.expr(f"max_by(named_struct({row}), {POLICY_KEYS['best_f1']}) AS b"))
    return best.select(*SEGMENT_KEYS, *[F.col(f"b.{c}").alias(f"best_{c}") for c in carried])


def threshold_snapshot(grid: DataFrame, steps: Sequence[int]) -> DataFrame:
    return grid.where(F.col("step").isin(list(steps)))


def operating_views(
    grid: DataFrame,
    policy: str = WITH_RECALL,
    minimum_recall: float = 0.60,
    fallback: str = "max_precision",
    split: str = "test",
) -> DataFrame:
    """The global grid of one split at a recall-leaning, the selected, and a precision-leaning threshold.

    The selected one is the policy's choice on the validation rows of the same grid, which is computed once.
    """
    # per policy key one maximum over the validation rows; a handful of rows, one per split and step
    step, _ = chosen_step(policy, minimum_recall, fallback)
    per_split = grid.groupBy("split").agg(
        step.alias("_chosen"),
        F.collect_list(
            F.struct("step", "threshold", "precision", "recall", "f1", "predicted_positive_rate")
        ).alias("_rows"),
    )
    # 19 grid rows per split travel with the split
    both = per_split.agg(
        F.max(F.when(F.col("split") == "validation", F.col("_chosen"))).alias("_selected"),
        F.max_by("_rows", F.col("split") == split).alias("_rows"),
    )
    # Grid steps of thresholds 0.30 and 0.60.
    views = "stack(3, 'recall-prioritized', 6, 'balanced', _selected, 'precision-protected', 12) AS (view, wanted)"
    pairs = both.selectExpr("_rows", views).select("view", "wanted", F.explode("_rows").alias("g"))
    return pairs.where(F.col("g.step") == F.col("wanted")).select(
        "view",
        "g.threshold",
        *[
            F.col(f"g.{c}").alias(f"global_{c}")
            for c in ("precision", "recall", "f1", "predicted_positive_rate")
        ],
    )


def selected_versus_best(frame: DataFrame, threshold: float, segments: Sequence[str] = ("V1", "V2")) -> DataFrame:
    """Per segment and evaluation split: metrics at the selected threshold next to the best one on the grid."""
    rows = with_segment(frame).where(
        F.col("segment_value").isin(list(segments)) & F.col("split").isin("validation", "test")
    )
    curve = score_curve(rows, SEGMENT_KEYS)
    chosen = curve_metrics(curve, threshold, SEGMENT_KEYS)
    best = segment_best_threshold(curve_grid(curve, SEGMENT_KEYS))
    return chosen.join(best, SEGMENT_KEYS).select(
        F.col("segment_value").alias("segment"),
        "split",
        F.col("rows").alias("row_count"),
        F.col("positives").alias("positive_count"),
        F.col("positive_rate").alias("prevalence"),
        "pr_auc",
        "roc_auc",
        F.col("threshold").alias("selected_threshold"),
        F.col("f1").alias("selected_f1"),
        F.col("best_threshold").alias("best_threshold_on_grid"),
        F.col("best_f1").alias("best_f1_on_grid"),
    )


# --- models --------------------------------------------------------------------------------


def model_comparison(metrics: DataFrame) -> DataFrame:
    """One row per model from its split metrics (model_name, split, pr_auc, roc_auc, f1, threshold)."""
    cells = [
        F.max(F.when(F.col("split") == split, F.col(m))).alias(f"{split}_{m}")
        for split in ("validation", "test")
        for m in ("pr_auc", "roc_auc", "f1")
    ]
    return metrics.groupBy("model_name").agg(*cells, F.max("threshold").alias("selected_threshold"))


def champion(comparison: DataFrame, trained: Sequence[str] = ("logistic_regression", "gradient_boosting")) -> DataFrame:
    """The model with the highest validation PR-AUC; of equal ones the first in training order, others by name.

    An undefined area never wins. One row a model goes in.
    """
    order = F.coalesce(*[F.when(F.col("model_name") == m, i) for i, m in enumerate(trained)], F.lit(len(trained)))
    return comparison.orderBy(F.desc_nulls_last("validation_pr_auc"), order, "model_name").limit(1)


# --- deciles and cohorts -------------------------------------------------------------------


def score_deciles(frame: DataFrame) -> DataFrame:
    """Rows, positive rate and mean score of ten groups by rank, equal scores in (pt, player, day) order.

    Group edges lie at tenths of n - 1, so the extra rows do not go to the first groups as with ntile.
    """
    slim = frame.select("score", "target", "pt", "player_id", "assignment_date")
    ranked = rank_rows(slim, ["score", "pt", "player_id", "assignment_date"], "r", "n")
    r, n = F.col("r"), F.col("n")
    decile = F.when(n == 1, 1).otherwise(F.greatest(F.lit(1), F.expr("(10 * (r - 1) + n - 2) div (n - 1)")))
    return (
        ranked.withColumn("decile", decile.cast("bigint"))
        .groupBy("decile")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.avg(F.col("target").cast("double")).alias("positive_rate"),
            F.avg("score").alias("avg_score"),
        )
    )


def ranked_cohorts(frame: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows of the best and the worst fifth, marked `high` and `low` (a row can be both when n < 2)."""
    slim = frame.select("score", "pt", "player_id", "vip_level", *features)
    ranked = rank_rows(slim, [F.desc("score"), "pt", "player_id"], "r", "n")
    k = F.greatest(F.lit(1), F.floor(F.col("n") / 5))
    marked = ranked.withColumn("high", F.col("r") <= k).withColumn("low", F.col("r") > F.col("n") - k)
    return marked.where(F.col("high") | F.col("low"))


def cohort_numeric(cohorts: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean of each feature in both cohorts, and the difference."""
    means = cohorts.agg(
        *[
            F.avg(F.when(F.col(side), F.col(f).cast("double"))).alias(f"{side}_{f}")
            for f in features
            for side in ("high", "low")
        ]
    )
    rows = [
        F.struct(
            F.lit(f).alias("feature"),
            F.col(f"high_{f}").alias("high_score_mean"),
            F.col(f"low_{f}").alias("low_score_mean"),
            (F.col(f"high_{f}") - F.col(f"low_{f}")).alias("difference"),
        )
        for f in features
    ]
    return means.select(F.inline(F.array(*rows)))


def cohort_segments(cohorts: DataFrame, segment: str = "vip_level") -> DataFrame:
    """Share of each segment in both cohorts."""
    counts = cohorts.groupBy(labelled(segment, MISSING_IN_REPORTS).alias(segment)).agg(
        F.count_if("high").alias("_h"), F.count_if("low").alias("_l")
    )
    # one row a segment
    total = Window.partitionBy()
    return counts.select(
        segment,
        ratio("_h", F.sum("_h").over(total), 0.0).alias("high_score_share"),
        ratio("_l", F.sum("_l").over(total), 0.0).alias("low_score_share"),
    )
