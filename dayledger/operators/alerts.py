"""Alert rules over one-row metric frames.

Every rule is a column expression giving an alert struct or NULL, so all rules are one projection over one
row: nothing is joined, shuffled or brought to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class DailyLimits:
    """Defaults of the daily checks."""

    min_row_count: int = 1
    row_count_drop_warn_ratio: float = 0.10
    row_count_drop_alert_ratio: float = 0.25
    row_count_growth_warn_ratio: float = 0.15
    row_count_growth_alert_ratio: float = 0.35
    duplicate_player_alert_count: int = 1
    invalid_score_alert_count: int = 1
    max_missing_metadata_rows: int = 0
    max_snapshot_date_lag_days: int = 3
    max_snapshot_date_distinct_count: int = 2
    min_top_bucket_share: float = 0.01
    max_top_bucket_share: float = 0.70
    max_vip_missing_rate: float = 0.05


@dataclass(frozen=True)
class PerformanceLimits:
    """Defaults of the delayed performance checks."""

    label_maturity_days: int = 4
    response_window_days: int = 3
    min_rows: int = 1000
    min_positive: int = 25
    min_bucket_rows: int = 100
    min_segment_rows: int = 100
    response_rate_floor_warn: float = 0.01
    response_rate_floor_alert: float = 0.005
    calibration_gap_warn: float = 0.08
    calibration_gap_alert: float = 0.15


ALERT_FIELDS = [
    "severity",
    "check_name",
    "metric_name",
    "observed_value",
    "threshold_value",
    "reference_value",
    "message",
    "context_json",
]


def alert(
    severity: str,
    check: str,
    metric: str,
    observed: Column,
    limit: object,
    message: str,
    reference: Column | None = None,
    context: Column | None = None,
) -> Column:
    """An alert with every value as text, as the alert table stores it."""
    nothing = F.lit(None).cast("string")
    return F.struct(
        F.lit(severity).alias("severity"),
        F.lit(check).alias("check_name"),
        F.lit(metric).alias("metric_name"),
        observed.cast("string").alias("observed_value"),
        F.lit(str(limit)).alias("threshold_value"),
        (nothing if reference is None else reference.cast("string")).alias("reference_value"),
        F.lit(message).alias("message"),
        (F.lit("{}") if context is None else context).alias("context_json"),
    )


def first_breach(*rules: tuple[Column, Column]) -> Column:
    """The alert of the first condition that holds, else NULL."""
    chain = None
    for condition, raised in rules:
        chain = F.when(condition, raised) if chain is None else chain.when(condition, raised)
    return chain


def raise_alerts(metrics: DataFrame, rules: Sequence[Column]) -> DataFrame:
    raised = F.filter(F.array(*rules), lambda a: a.isNotNull())
    return metrics.select(F.explode(raised).alias("a")).select("a.*")


def daily_alerts(metrics: DataFrame, limits: DailyLimits = DailyLimits()) -> DataFrame:
    """Eleven checks over one row: row_count, reference_row_count, duplicate_player_count, invalid_score_count,
    metadata_missing_rows, snapshot_date_lag_days, snapshot_date_distinct_count, top_bucket_share,
    vip_missing_rate, score_min, score_max."""
    m = {c: F.col(c) for c in metrics.columns}
    t = limits
    change = F.try_divide((m["row_count"] - m["reference_row_count"]).cast("double"), m["reference_row_count"])
    # the limits are held against the exact ratio; the alert shows it rounded
    reference = m["reference_row_count"]

    def moved(condition: Column, severity: str, check: str, limit: float, message: str):
        return condition, alert(severity, check, "row_count_delta_ratio", F.round(change, 6), limit, message, reference)

    def simple(condition: Column, severity: str, check: str, metric: str, limit: object, message: str) -> Column:
        return first_breach((condition, alert(severity, check, metric, m[metric], limit, message)))

    drop_alert, drop_warn = -t.row_count_drop_alert_ratio, -t.row_count_drop_warn_ratio
    grow_alert, grow_warn = t.row_count_growth_alert_ratio, t.row_count_growth_warn_ratio
    top = F.round(m["top_bucket_share"], 6)
    vip = F.round(m["vip_missing_rate"], 6)
    spread = F.concat(m["score_min"].cast("string"), F.lit(".."), m["score_max"].cast("string"))
    rules = [
        simple(m["row_count"] < t.min_row_count, "critical", "empty_or_small_partition", "row_count",
               t.min_row_count, "The scored partition has fewer rows than the minimum."),
        simple(m["duplicate_player_count"] >= t.duplicate_player_alert_count, "critical", "duplicate_player_ids",
               "duplicate_player_count", t.duplicate_player_alert_count, "Players occur more than once."),
        simple(m["invalid_score_count"] >= t.invalid_score_alert_count, "critical", "invalid_score_range",
               "invalid_score_count", t.invalid_score_alert_count, "Scores are absent or outside 0 to 1."),
        simple(m["metadata_missing_rows"] > t.max_missing_metadata_rows, "critical", "missing_model_metadata",
               "metadata_missing_rows", t.max_missing_metadata_rows, "Rows lack model lineage."),
        simple(m["snapshot_date_lag_days"] > t.max_snapshot_date_lag_days, "warning", "snapshot_date_staleness",
               "snapshot_date_lag_days", t.max_snapshot_date_lag_days, "The feature snapshot is old."),
        simple(m["snapshot_date_distinct_count"] > t.max_snapshot_date_distinct_count, "warning",
               "snapshot_date_dispersion", "snapshot_date_distinct_count", t.max_snapshot_date_distinct_count,
               "The partition mixes feature snapshots."),
        first_breach(
            moved(change <= drop_alert, "critical", "row_count_drop", drop_alert, "Far fewer rows than the reference."),
            moved(change <= drop_warn, "warning", "row_count_drop", drop_warn, "Fewer rows than the reference."),
        ),
        # growth never goes beyond a warning
        first_breach(
            moved(change >= grow_alert, "warning", "row_count_growth", grow_alert, "Far more rows than the reference."),
            moved(change >= grow_warn, "warning", "row_count_growth", grow_warn, "More rows than the reference."),
        ),
        first_breach(
            (
                (m["top_bucket_share"] < t.min_top_bucket_share) | (m["top_bucket_share"] > t.max_top_bucket_share),
                alert("warning", "top_bucket_share", "top_bucket_share", top,
                      f"[{t.min_top_bucket_share}, {t.max_top_bucket_share}]",
                      "The share of high-priority rows is out of range."),
            )
        ),
        first_breach(
            (
                m["vip_missing_rate"] > t.max_vip_missing_rate,
                alert("warning", "vip_level_missingness", "vip_missing_rate", vip, t.max_vip_missing_rate,
                      "Too many rows lack a segment."),
            )
        ),
        first_breach(
            (
                (m["score_min"] < 0.0) | (m["score_max"] > 1.0),
                alert("critical", "score_range", "score_min_max", spread, "[0.0, 1.0]", "Scores are no probabilities."),
            )
        ),
    ]
    return raise_alerts(metrics, rules)


def performance_alerts(metrics: DataFrame, limits: PerformanceLimits = PerformanceLimits()) -> DataFrame:
    """Four checks over the evaluated row; a row that is not evaluable raises none."""
    t = limits
    rate = F.round("response_rate_actual", 6)
    gap = F.abs(F.col("avg_score") - F.col("response_rate_actual"))
    shown_gap = F.round(gap, 6)
    rows, positives = F.col("row_count"), F.col("positive_label_count")
    collapse = ("realized_response_collapse", "response_rate_actual")
    drift = ("calibration_gap", "avg_score_vs_actual_response_rate_gap")
    rules = [
        first_breach(
            (rows < t.min_rows, alert("warning", "insufficient_rows", "row_count", rows, t.min_rows, "Few rows to evaluate."))
        ),
        first_breach(
            (
                positives < t.min_positive,
                alert("warning", "insufficient_positive_events", "positive_label_count", positives, t.min_positive,
                      "Few positive labels to evaluate."),
            )
        ),
        first_breach(
            (
                F.col("response_rate_actual") <= t.response_rate_floor_alert,
                alert("critical", *collapse, rate, t.response_rate_floor_alert, "Hardly any response was observed."),
            ),
            (
                F.col("response_rate_actual") <= t.response_rate_floor_warn,
                alert("warning", *collapse, rate, t.response_rate_floor_warn, "Little response was observed."),
            ),
        ),
        first_breach(
            (
                gap >= t.calibration_gap_alert,
                alert("critical", *drift, shown_gap, t.calibration_gap_alert, "Scores and response rate are far apart."),
            ),
            (
                gap >= t.calibration_gap_warn,
                alert("warning", *drift, shown_gap, t.calibration_gap_warn, "Scores and response rate drift apart."),
            ),
        ),
    ]
    return raise_alerts(metrics.where(F.col("status") == "evaluated"), rules)


def missing_partition_alert(
    listing: DataFrame, pt: str, reference_pt: str | None, scoring_table: str
) -> DataFrame:
    """One critical alert when the listing lacks the partition, else no row."""
    found = listing.agg(F.count_if(F.col("pt") == pt).alias("partition_present_flag"))
    context = F.to_json(
        F.struct(
            F.lit(pt).alias("current_pt"),
            F.lit("pt").alias("partition_column"),
            F.lit(scoring_table).alias("prediction_table"),
        )
    )
    rule = first_breach(
        (
            F.col("partition_present_flag") == 0,
            alert("critical", "missing_prediction_partition", "partition_present_flag",
                  F.col("partition_present_flag"), 1, "The scored partition does not exist.",
                  F.lit(reference_pt), context),
        )
    )
    return raise_alerts(found, [rule])


def overall_status(alerts: DataFrame) -> DataFrame:
    """One row: number of alerts and the worst severity."""
    counted = alerts.agg(
        F.count(F.lit(1)).alias("alert_count"),
        F.count_if(F.col("severity") == "critical").alias("_c"),
        F.count_if(F.col("severity") == "warning").alias("_w"),
    )
    status = F.when(F.col("_c") > 0, "critical").when(F.col("_w") > 0, "warning").otherwise("ok")
    return counted.select("alert_count", status.alias("monitor_status"))


def alert_rows(alerts: DataFrame, pt: str, mode: str, run_label: str, run_ts: datetime) -> DataFrame:
    """Alerts in the column order of the alert table."""
    return alerts.select(
        F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz").alias("monitor_run_ts"),
        F.lit(run_label).alias("run_label"),
        F.lit(mode).alias("mode"),
        *ALERT_FIELDS,
        F.lit(pt).alias("pt"),
    )


