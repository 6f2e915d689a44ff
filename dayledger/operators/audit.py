"""Experiment-design audit: timing leakage, group comparability, feasibility."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import MISSING_IN_PROFILES, labelled, treatment_combo
from .ordering import side_by_side

# Limits of the audit.
IMBALANCED_SMD, IMBALANCED_MISSING_GAP = 0.25, 0.10
MIN_MATURED_SHARE, MAX_IMBALANCE_RATE = 0.95, 0.20


def timing_checks(minimum_feature_lag_days: int = 1) -> dict[str, Column]:
    """Named violations; an absent date violates nothing."""
    day, snapshot = F.col("assignment_date"), F.col("feature_snapshot_date")
    checks = {
        "feature_snapshot_not_strictly_before_assignment": snapshot >= day,
        "feature_snapshot_inside_minimum_lag_window": snapshot > F.date_sub(day, minimum_feature_lag_days),
        "first_outcome_event_not_after_assignment": F.col("first_outcome_event_date") <= day,
        "last_outcome_event_not_after_assignment": F.col("last_outcome_event_date") <= day,
    }
    return {name: F.coalesce(found, F.lit(False)) for name, found in checks.items()}


def timing_violations(dataset: DataFrame, minimum_feature_lag_days: int = 1) -> DataFrame:
    """(check, violation_rows), counted in one pass."""
    checks = timing_checks(minimum_feature_lag_days)
    counts = dataset.agg(*[F.count_if(c).alias(name) for name, c in checks.items()])
    return counts.unpivot([], list(checks), "check", "violation_rows")


def timing_violation_rows(dataset: DataFrame, minimum_feature_lag_days: int = 1) -> DataFrame:
    """The violating player-days with one 0/1 flag per check."""
    checks = timing_checks(minimum_feature_lag_days)
    any_found = F.lit(False)
    for found in checks.values():
        any_found = any_found | found
    days = ["assignment_date", "feature_snapshot_date", "first_outcome_event_date", "last_outcome_event_date"]
    return dataset.where(any_found).select(
        "player_id", *days, *[c.cast("bigint").alias(name) for name, c in checks.items()]
    )


def group_label() -> Column:
    return labelled("treatment_group", MISSING_IN_PROFILES).alias("treatment_group")


def _reference_order() -> list[Column]:
    """Group "0" first, then "control", then the larger groups."""
    wish = F.when(F.col("treatment_group") == "0", 0).when(F.col("treatment_group") == "control", 1).otherwise(2)
    return [wish, F.desc("row_count"), F.asc("treatment_group")]


def reference_group(group_counts: DataFrame) -> DataFrame:
    """One row: group "0", else "control", else the largest. Takes one row a group."""
    return group_counts.orderBy(*_reference_order()).limit(1).select(
        F.col("treatment_group").alias("reference_group")
    )


def group_counts(dataset: DataFrame) -> DataFrame:
    return dataset.groupBy(group_label()).agg(F.count(F.lit(1)).alias("row_count"))


def group_comparability(dataset: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean, deviation and missing rate of each feature against the reference group.

    All features are aggregated side by side in one pass over the rows; turning them into rows happens on
    the aggregates, one row a group.
    """
    aggregates = [F.expr("count(1) AS row_count")]
    for f in features:
        aggregates += [
            F.expr(f"avg(TRY_CAST({f} AS DOUBLE)) AS mean_{f}"),
            F.expr(f"var_samp(TRY_CAST({f} AS DOUBLE)) AS var_{f}"),
            F.expr(f"count(TRY_CAST({f} AS DOUBLE)) AS known_{f}"),
        ]
    wide = dataset.groupBy(group_label()).agg(*aggregates)
    # one row a group: the reference row is put next to every row, so the rows above are read once
    whole = F.struct("treatment_group", *[c for c in wide.columns if c != "treatment_group"])
    first = F.first(whole).over(Window.partitionBy().orderBy(*_reference_order()))
    pairs = wide.withColumn("r", first).where("treatment_group != r.treatment_group")
    cells = ", ".join(
        f"'{f}', mean_{f}, var_{f}, known_{f}, 1 - known_{f} / row_count, "
        f"r.mean_{f}, r.var_{f}, r.known_{f}, 1 - r.known_{f} / r.row_count"
        for f in features
    )
    names = "feature_name, mean, variance, known, missing_rate, r_mean, r_variance, r_known, r_missing_rate"
    tall = pairs.selectExpr(
        "treatment_group AS comparison_group",
        "r.treatment_group AS reference_group",
        f"stack({len(features)}, {cells}) AS ({names})",
    )
    pooled = "CASE WHEN known >= 2 AND r_known >= 2 THEN nullif(sqrt((variance + r_variance) / 2), 0D) END"
    measured = tall.withColumns(
        {"smd": F.expr(f"(mean - r_mean) / {pooled}"), "gap": F.expr("missing_rate - r_missing_rate")}
    )
    imbalanced = f"coalesce(abs(smd), 0) >= {IMBALANCED_SMD} OR abs(gap) >= {IMBALANCED_MISSING_GAP}"
    return measured.selectExpr(
        "feature_name",
        "comparison_group",
        "reference_group",
        "r_mean AS reference_mean",
        "mean AS comparison_mean",
        "sqrt(r_variance) AS reference_std",
        "sqrt(variance) AS comparison_std",
        "r_missing_rate AS reference_missing_rate",
        "missing_rate AS comparison_missing_rate",
        "gap AS missing_rate_gap",
        "smd AS standardized_mean_difference",
        f"CAST({imbalanced} AS BIGINT) AS imbalance_flag",
    )


def feasibility(dataset: DataFrame, maturity: DataFrame, timing: DataFrame, comparability: DataFrame) -> DataFrame:
    """One row of flags: which kinds of study the dataset supports, and why not.

    Each input is a small result table; they are reduced to one row each and set side by side.
    """
    def present(name: str) -> Column:
        return F.coalesce(F.max(F.col("treatment_combo") == name), F.lit(False))

    # one row per group and combination carries all that is asked of the rows
    cells = dataset.groupBy(group_label(), treatment_combo("source_treatment_types", "treatment_flag").alias("treatment_combo"))
    cells = cells.agg(F.expr("sum(coalesce(TRY_CAST(treatment_flag AS BIGINT), 0)) AS treated"))
    combos = cells.agg(
        present("no_treatment").alias("has_control_group"),
        (present("voucher_and_sms") & present("voucher_only") & present("sms_only")).alias("_combos_ok"),
        F.expr("coalesce(sum(treated), 0) > 0 AS _treated"),
        F.expr("count(DISTINCT treatment_group) >= 2 AS _groups"),
    )
    mature = maturity.agg(F.coalesce(F.min("matured_share") >= MIN_MATURED_SHARE, F.lit(True)).alias("maturity_ok"))
    clean = timing.agg(F.coalesce(F.max("violation_rows") == 0, F.lit(True)).alias("timing_ok"))
    balance = comparability.agg(
        F.coalesce(F.avg(F.col("imbalance_flag").cast("double")), F.lit(0.0)).alias("imbalance_flag_rate")
    )
    row = side_by_side(combos, mature, clean, balance)
    row = row.withColumn("imbalance_ok", F.col("imbalance_flag_rate") <= MAX_IMBALANCE_RATE)
    sound = F.col("maturity_ok") & F.col("timing_ok") & F.col("imbalance_ok")
    binary = F.col("has_control_group") & F.col("_treated") & sound
    reasons = F.filter(
        F.array(
            F.when(~F.col("has_control_group"), "no untreated rows"),
            F.when(~F.col("maturity_ok"), "outcome windows not complete"),
            F.when(~F.col("timing_ok"), "timing violations"),
            F.when(~F.col("imbalance_ok"), "groups differ before treatment"),
            F.when(~F.col("_combos_ok"), "not every channel combination present"),
        ),
        lambda x: x.isNotNull(),
    )
    return row.select(
        (binary & F.col("_groups")).alias("true_uplift_feasible"),
        binary.alias("binary_treatment_uplift_feasible"),
        (F.col("has_control_group") & F.col("_combos_ok") & sound).alias("multi_treatment_uplift_feasible"),
        (~binary).alias("policy_evaluation_only"),
        "has_control_group",
        "maturity_ok",
        "timing_ok",
        "imbalance_ok",
        "imbalance_flag_rate",
        F.array_join(reasons, "; ").alias("reasons"),
    )
