"""Monitor one scored partition and write the three monitoring tables."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import parse_pt, shift_pt
from ..operators import alerts as A
from ..operators import contracts as V
from ..operators import dataset as D
from ..operators import monitoring as M
from ..operators import profiling as P
from ..session import cut_lineage
from ..sources import scans
from ..sources.schemas import MONITORING_ALERTS, MONITORING_DAILY, MONITORING_PERFORMANCE
from ..sources.sinks import replace_partition


def run(
    spark: SparkSession,
    folder: str,
    pt: str,
    *,
    scores: DataFrame,
    mart: DataFrame,
    bets: DataFrame,
    as_of: date,
    run_ts: datetime,
    run_label: str,
    scoring_table: str = "response_scores",
    reference_pt: str | None = None,
    daily_limits: A.DailyLimits = A.DailyLimits(),
    performance_limits: A.PerformanceLimits = A.PerformanceLimits(),
) -> dict[str, str]:
    """Replace partition `pt` of the daily, performance and alert tables under `folder`; returns their paths.

    A missing partition leaves its alert in the alert table and then fails the run. Alerts of an earlier run
    of the same partition are removed even when this run raises none.
    """
    paths = {name: f"{folder}/{name}" for name in ("monitoring_daily", "monitoring_performance", "monitoring_alerts")}
    listing = scans.list_partitions(scores)
    reference_pt = scans.reference_partition(listing, pt, reference_pt).first().reference_pt
    missing = A.missing_partition_alert(listing, pt, reference_pt, scoring_table)
    if not missing.isEmpty():
        alerts = A.alert_rows(missing, pt, "daily", run_label, run_ts)
        replace_partition(alerts, paths["monitoring_alerts"], MONITORING_ALERTS, pt)
        raise ValueError(f"scored partition {pt} does not exist")

    scored = scores.where(F.col("pt") == pt)
    V.require_scored_input(scored, pt)
    threshold = scored.agg(F.min("selected_threshold")).first()[0]
    reference_rows = scores.where(F.col("pt") == (reference_pt or "")).agg(F.count(F.lit(1)).alias("reference_row_count"))
    current, reference = (
        None if p is None else P.eligible_population(mart.where(F.col("pt") == p)) for p in (pt, reference_pt)
    )
    daily, raised = M.monitor_daily(
        scored,
        pt,
        threshold=threshold,
        reference_pt=reference_pt,
        reference_row_count=reference_rows,
        population=M.population_delta(current, reference),
        run_ts=run_ts,
        run_label=run_label,
        scoring_table=scoring_table,
        limits=daily_limits,
    )

    days = performance_limits.response_window_days
    mature = as_of >= parse_pt(pt) + timedelta(days=performance_limits.label_maturity_days)
    observed = scored
    if mature:
        window = bets.where(F.col("pt").between(shift_pt(pt, 1), shift_pt(pt, days)))
        # read by the check, the totals and the lineage
        observed = cut_lineage(D.observed_outcomes(scored, window, days), "observed")
        V.require_observed_input(observed, days)
    performance = cut_lineage(
        M.monitor_performance(
            observed,
            pt,
            labels_mature=mature,
            run_ts=run_ts,
            label_maturity_days=performance_limits.label_maturity_days,
            window_days=days,
        ),
        "performance",
    )
    late = A.performance_alerts(performance, performance_limits)
    alerts = A.alert_rows(raised, pt, "daily", run_label, run_ts).unionByName(
        A.alert_rows(late, pt, "performance", run_label, run_ts)
    )
    replace_partition(daily, paths["monitoring_daily"], MONITORING_DAILY, pt)
    replace_partition(performance, paths["monitoring_performance"], MONITORING_PERFORMANCE, pt)
    replace_partition(alerts, paths["monitoring_alerts"], MONITORING_ALERTS, pt)
    return paths
