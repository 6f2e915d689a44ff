"""Daily health and drift of a scored partition, and its performance once labels are mature."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import MISSING_IN_MONITORING, bad_score, labelled, ratio
from ..session import cut_lineage
from ..sources.schemas import MONITORING_DAILY, MONITORING_PERFORMANCE
from ..sources.sinks import align_to_schema
from .alerts import DailyLimits, daily_alerts, overall_status
from .lists import joined_values
from .ordering import exact_quantiles, side_by_side, value_histogram
from .scoring import HIGH_PRIORITY_BUCKETS, SCORE

# Quantiles of the monitored distribution.
QUANTILES = {
    "p01": 0.01,
    "p05": 0.05,
    "p10": 0.10,
    "p25": 0.25,
    "p50": 0.50,
    "p75": 0.75,
    "p90": 0.90,
    "p95": 0.95,
    "p99": 0.99,
}
LINEAGE = ["model_name", "model_version", "model_reference_path", "selected_threshold"]
SCOPE = ["metric_scope", "segment_column", "segment_value"]


def _moments() -> list[Column]:
    return [
        F.min(SCORE).alias("score_min"),
        F.max(SCORE).alias("score_max"),
        F.avg(SCORE).alias("score_mean"),
        F.stddev_samp(SCORE).alias("score_std"),
    ]


def monitor_distribution(scored: DataFrame) -> DataFrame:
    """One row: range, mean, deviation, median and the nine quantiles of the score."""
    quantiles = exact_quantiles(value_histogram(scored, SCORE), SCORE, "n", QUANTILES)
    return side_by_side(quantiles, scored.agg(*_moments())).select(
        "score_min", "score_max", "score_mean", F.col("p50").alias("score_median"), "score_std", *QUANTILES
    )


def bucket_distribution(scored: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Known players, share and score range per bucket, within each group."""
    grouped = scored.groupBy(*group, F.col("response_priority_bucket").alias("bucket_name")).agg(
        F.count("player_id").alias("row_count"),
        F.count_distinct("player_id").alias("distinct_player_count"),
        F.min(SCORE).alias("score_min"),
        F.max(SCORE).alias("score_max"),
        F.avg(SCORE).alias("score_mean"),
    )
    # one row per group and bucket
    everything = F.sum("row_count").over(Window.partitionBy(*group))
    return grouped.withColumn("row_share", ratio("row_count", everything, 0.0))


def with_monitored_segment(scored: DataFrame, segment: str = "vip_level") -> DataFrame:
    return scored.withColumn("segment_value", labelled(segment, MISSING_IN_MONITORING))


def segment_distribution(scored: DataFrame, segment: str = "vip_level", medians: DataFrame | None = None) -> DataFrame:
    """Known players, share, mean and median score per segment. `medians` may hold them already."""
    rows = with_monitored_segment(scored, segment)
    grouped = rows.groupBy("segment_value").agg(
        F.count("player_id").alias("row_count"),
        F.count_distinct("player_id").alias("distinct_player_count"),
        F.avg(SCORE).alias("avg_score"),
    )
    if medians is None:
        histogram = value_histogram(rows, SCORE, ["segment_value"])
        medians = exact_quantiles(histogram, SCORE, "n", {"median_score": 0.5}, ["segment_value"])
    # one row a segment
    everything = F.sum("row_count").over(Window.partitionBy())
    return grouped.join(medians, "segment_value", "left").select(
        F.lit(segment).alias("segment_column"),
        "segment_value",
        "row_count",
        "distinct_player_count",
        ratio("row_count", everything, 0.0).alias("row_share"),
        "avg_score",
        "median_score",
    )


def score_by_segment(scored: DataFrame, segment: str = "vip_level") -> DataFrame:
    rows = with_monitored_segment(scored, segment)
    return rows.groupBy(F.col("response_priority_bucket").alias("bucket_name"), "segment_value").agg(
        F.count("player_id").alias("row_count"), F.avg(SCORE).alias("avg_score")
    ).withColumn("segment_column", F.lit(segment))


def population_delta(current: DataFrame, reference: DataFrame | None, segment: str = "vip_level") -> DataFrame:
    """Eligible population of today against the reference, per segment; a side that is absent counts zero.

    Without a reference the comparison columns are NULL.
    """
    now = current.select(
        "segment_value",
        "eligible_row_count",
        "eligible_distinct_player_count",
        "snapshot_date_min",
        "snapshot_date_max",
    )
    if reference is None:
        before, none = F.lit(None).cast("bigint"), F.lit(None).cast("double")
        joined, delta, change = now, F.lit(None).cast("bigint"), none
    else:
        then = reference.select("segment_value", F.col("eligible_row_count").alias("_before"))
        joined = now.join(then, "segment_value", "full")
        before = F.coalesce("_before", F.lit(0))
        delta = F.coalesce("eligible_row_count", F.lit(0)) - before
        change = ratio(delta, before)
    return joined.select(
        F.lit(segment).alias("segment_column"),
        "segment_value",
        F.coalesce("eligible_row_count", F.lit(0)).alias("eligible_row_count"),
        F.coalesce("eligible_distinct_player_count", F.lit(0)).alias("eligible_distinct_player_count"),
        before.alias("reference_eligible_row_count"),
        delta.alias("eligible_row_delta"),
        change.alias("eligible_row_delta_ratio"),
        "snapshot_date_min",
        "snapshot_date_max",
    )


def _freshness() -> list[Column]:
    return [
        F.min("snapshot_date").alias("snapshot_date_min"),
        F.max("snapshot_date").alias("snapshot_date_max"),
        F.datediff(F.max("score_date"), F.max("snapshot_date")).cast("bigint").alias("snapshot_date_lag_days"),
    ]


def snapshot_freshness(scored: DataFrame) -> DataFrame:
    return scored.agg(*_freshness(), F.count_distinct("snapshot_date").alias("snapshot_date_distinct_count"))


def _metadata_missing() -> Column:
    missing = F.lit(False)
    for c in LINEAGE:
        missing = missing | F.col(c).isNull()
    return missing


# --- one partition by scope: as a whole, and by each value of each segment column -----------


def with_segments(scored: DataFrame, segments: Sequence[str]) -> DataFrame:
    """`scored` with its segment columns labelled, an absent one as `__missing__`; `_absent_<s>` tells these rows."""
    marked = scored.withColumns({f"_absent_{s}": F.col(s).isNull() for s in segments})
    return marked.withColumns({s: labelled(s, MISSING_IN_MONITORING) for s in segments})


def by_scope(rows: DataFrame, segments: Sequence[str], measures: Sequence[Column], keep: Sequence[str] = ()) -> DataFrame:
    """`measures` over all rows and over each value of each segment column (GROUPING SETS), within the `keep` columns."""
    sets = [list(keep), *[[s, *keep] for s in segments]]
    marks = [F.grouping(s).alias(f"_g_{s}") for s in segments]
    grouped = rows.groupingSets(sets, *segments, *keep).agg(*measures, *marks)
    own = [(s, F.col(f"_g_{s}") == 0) for s in segments]
    names = [c for c in grouped.columns if c not in segments and c not in keep and not c.startswith("_g_")]
    column = F.coalesce(*[F.when(used, F.lit(s)) for s, used in own])
    return grouped.select(
        F.when(column.isNull(), "global").otherwise("segment").alias("metric_scope"),
        F.coalesce(column, F.lit("")).alias("segment_column"),
        F.coalesce(*[F.when(used, F.col(s)) for s, used in own], F.lit("")).alias("segment_value"),
        *keep,
        *names,
    )


BUCKET = "response_priority_bucket"


def partition_cells(scored: DataFrame, threshold: float | None, segments: Sequence[str]) -> DataFrame:
    """Sums that add up, by segments, bucket, snapshot day and model: a small table from one pass over the partition."""
    positive = F.coalesce(F.col(SCORE) >= threshold, F.lit(False)) if threshold is not None else F.lit(False)
    known = F.col("player_id").isNotNull()
    spread = F.count(SCORE) * F.var_pop(SCORE)
    return with_segments(scored, segments).groupBy(*segments, BUCKET, "snapshot_date", *LINEAGE[:3]).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(known).alias("known"),
        F.count_if(bad_score(SCORE)).alias("invalid_score_count"),
        F.count_if(_metadata_missing()).alias("metadata_missing_rows"),
        F.count_if(positive).alias("positive_prediction_count"),
        F.count_if(known & F.col(BUCKET).isin(HIGH_PRIORITY_BUCKETS)).alias("top"),
        F.count_if(known & F.col(f"_absent_{segments[0]}")).alias("no_segment"),
        F.max("score_date").alias("score_date"),
        F.count(SCORE).alias("scores"),
        F.avg(SCORE).alias("mean"),
        spread.alias("squares"),
        F.min(SCORE).alias("lowest"),
        F.max(SCORE).alias("highest"),
    )


def _combined_moments() -> list[Column]:
    """Range, mean and deviation of the scores of several cells."""
    n, total = F.sum("scores"), F.sum(F.col("mean") * F.col("scores"))
    squares = F.sum("squares") + F.sum(F.col("scores") * F.col("mean") * F.col("mean")) - F.try_divide(total * total, n)
    return [
        F.min("lowest").alias("score_min"),
        F.max("highest").alias("score_max"),
        F.try_divide(total, n).alias("score_mean"),
        F.when(n > 1, F.sqrt(F.greatest(squares, F.lit(0.0)) / (n - 1))).alias("score_std"),
    ]


def distinct_players(scored: DataFrame, segments: Sequence[str]) -> DataFrame:
    """Distinct players, repeated rows of a player, and repeated rows of a player and partition, by scope and bucket.

    Rows are combined per player before they are multiplied by scopes; no player's rows are held together. Rows of all
    buckets of a scope have bucket NULL and `all_buckets`.
    """
    pairs = with_segments(scored, segments).groupBy("player_id", "pt", *segments, BUCKET).agg(F.count(F.lit(1)).alias("_n"))
    each = [BUCKET, "player_id"]
    whole = by_scope(pairs, segments, [F.sum("_n").alias("_n")], ["player_id", "pt"])
    whole = whole.groupBy(*SCOPE, "player_id").agg(F.sum("_n").alias("_n"), F.sum(F.col("_n") - 1).alias("_pair_extra"))
    parts = by_scope(pairs, segments, [F.sum("_n").alias("_n")], each).withColumn("all_buckets", F.lit(False))
    both = whole.withColumn("all_buckets", F.lit(True)).unionByName(parts, allowMissingColumns=True)
    return both.groupBy(*SCOPE, "all_buckets", BUCKET).agg(
        F.count("player_id").alias("distinct_player_count"),
        F.sum(F.col("_n") - 1).alias("duplicate_player_count"),
        F.sum("_pair_extra").alias("duplicate_partition_count"),
    )


def scope_quantiles(scored: DataFrame, segments: Sequence[str]) -> DataFrame:
    """The nine quantiles of the score by scope, from counts per score and segment values."""
    fine = value_histogram(with_segments(scored, segments), SCORE, segments)
    return exact_quantiles(by_scope(fine, segments, [F.sum("n").alias("n")], [SCORE]), SCORE, "n", QUANTILES, SCOPE)


class PartitionCube:
    """The results of three passes over a scored partition; everything the daily table holds is put together from them."""

    def __init__(self, scored: DataFrame, threshold: float | None, segments: Sequence[str] = ("vip_level",)):
        self.segments = list(segments)
        passes = {
            "cells": lambda: partition_cells(scored, threshold, self.segments),
            "players": lambda: distinct_players(scored, self.segments),
            "quantiles": lambda: scope_quantiles(scored, self.segments),
        }
        # three jobs that need nothing of each other
        with ThreadPoolExecutor(len(passes)) as pool:
            written = pool.map(lambda name: cut_lineage(passes[name](), name), passes)
            self.cells, self.players, self.quantiles = written

    def metrics(self) -> DataFrame:
        """One global row and one row per segment value of every scalar metric of the daily table."""
        rows = by_scope(
            self.cells,
            self.segments,
            [
                *[F.sum(c).alias(c) for c in ("row_count", "invalid_score_count", "metadata_missing_rows", "positive_prediction_count")],
                F.min("snapshot_date").alias("snapshot_date_min"),
                F.max("snapshot_date").alias("snapshot_date_max"),
                F.datediff(F.max("score_date"), F.max("snapshot_date")).cast("bigint").alias("snapshot_date_lag_days"),
                F.count_distinct("snapshot_date").alias("snapshot_date_distinct_count"),
                *_combined_moments(),
            ],
        )
        p, n = F.col("positive_prediction_count"), F.col("row_count")
        counts = self.players.where("all_buckets").drop("all_buckets", BUCKET)
        return (
            rows.join(counts, SCOPE)
            .join(self.quantiles, SCOPE, "left")
            .withColumn("score_median", F.col("p50"))
            .withColumn("negative_prediction_count", n - p)
            .withColumn("predicted_positive_rate", ratio(p, n, 0.0))
            .withColumn("predicted_negative_rate", 1 - ratio(p, n, 0.0))
        )

    def buckets(self) -> DataFrame:
        """Known players, share and score range per scope and bucket."""
        rows = by_scope(self.cells, self.segments, [F.sum("known").alias("row_count"), *_combined_moments()], [BUCKET]).drop("score_std")
        counts = self.players.where("NOT all_buckets").select(*SCOPE, F.col(BUCKET).alias("bucket_name"), "distinct_player_count")
        rows = rows.withColumnRenamed(BUCKET, "bucket_name").withColumn("_b", F.coalesce("bucket_name", F.lit("")))
        counts = counts.withColumn("_b", F.coalesce("bucket_name", F.lit(""))).withColumn("_null", F.col("bucket_name").isNull()).drop("bucket_name")
        joined = rows.withColumn("_null", F.col("bucket_name").isNull()).join(counts, [*SCOPE, "_b", "_null"]).drop("_b", "_null")
        # one row per scope and bucket
        everything = F.sum("row_count").over(Window.partitionBy(*SCOPE))
        return joined.withColumn("row_share", ratio("row_count", everything, 0.0))

    def segment_rows(self, metrics: DataFrame) -> DataFrame:
        """Known players, share, mean and median score per segment value."""
        known = by_scope(self.cells, self.segments, [F.sum("known").alias("row_count")]).where("metric_scope = 'segment'")
        # one row a segment value
        everything = F.sum("row_count").over(Window.partitionBy("segment_column"))
        facts = metrics.select(*SCOPE, "distinct_player_count", F.col("score_mean").alias("avg_score"), F.col("score_median").alias("median_score"))
        return known.withColumn("row_share", ratio("row_count", everything, 0.0)).join(facts, SCOPE).drop("metric_scope")

    def segments_by_bucket(self, buckets: DataFrame) -> DataFrame:
        rows = buckets.where("metric_scope = 'segment'")
        return rows.select("bucket_name", "segment_column", "segment_value", "row_count", F.col("score_mean").alias("avg_score"))

    def lineage(self) -> DataFrame:
        """One row: the model names, versions and paths of the partition."""
        return joined_values(self.cells, LINEAGE[:3])

    def shares(self) -> DataFrame:
        """One row: share of known players in the top buckets, and of those without the first segment."""
        totals = self.cells.agg(*[F.sum(c).alias(c) for c in ("known", "top", "no_segment")])
        return totals.select(ratio("top", "known", 0.0).alias("top_bucket_share"), ratio("no_segment", "known", 0.0).alias("vip_missing_rate"))


def alert_inputs(cube: PartitionCube, metrics: DataFrame, reference_row_count: DataFrame) -> DataFrame:
    """The one-row frame the daily rules read; `reference_row_count` is one row (NULL or 0 without reference)."""
    names = [
        "row_count",
        "duplicate_player_count",
        "invalid_score_count",
        "metadata_missing_rows",
        "snapshot_date_lag_days",
        "snapshot_date_distinct_count",
        "score_min",
        "score_max",
    ]
    row = metrics.where(F.col("metric_scope") == "global").select(*names)
    return side_by_side(row, cube.shares(), reference_row_count.select("reference_row_count"))


def _json_list(rows: DataFrame, name: str, order: Column, fields: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """Result rows (a handful per group) as one JSON list, in the given order, keys sorted."""
    item = F.struct(order.alias("_o"), F.struct(*[F.col(f) for f in sorted(fields)]).alias("_v"))
    listed = F.transform(F.sort_array(F.collect_list(item)), lambda x: x["_v"])
    return rows.groupBy(*group).agg(F.to_json(listed).alias(name))


def monitor_daily(
    scored: DataFrame,
    pt: str,
    *,
    threshold: float | None,
    reference_pt: str | None,
    reference_row_count: DataFrame,
    population: DataFrame,
    run_ts: datetime,
    run_label: str,
    scoring_table: str,
    segments: Sequence[str] = ("vip_level",),
    limits: DailyLimits = DailyLimits(),
) -> tuple[DataFrame, DataFrame]:
    """Rows of the daily table (one global, one per value of each segment column) and the alerts behind its status.

    The partition is read three times whatever the number of segment columns: for sums, players and score counts.
    """
    cube = PartitionCube(scored, threshold, segments)
    metrics = cut_lineage(cube.metrics(), "metrics")  # a handful of rows, read by the table, the alerts and the lists
    alerts = cut_lineage(daily_alerts(alert_inputs(cube, metrics, reference_row_count), limits), "alerts")
    lineage = cube.lineage()
    rows = cut_lineage(cube.buckets(), "buckets")
    bucket_fields = ["bucket_name", "row_count", "distinct_player_count", "row_share", "score_min", "score_max", "score_mean"]
    by_size = F.struct((-F.col("row_count")).alias("n"), "bucket_name")
    buckets = _json_list(rows, "bucket_distribution_json", by_size, bucket_fields, SCOPE)
    segment_rows, by_segment = cube.segment_rows(metrics), cube.segments_by_bucket(rows)
    segment_size = F.struct("segment_column", (-F.col("row_count")).alias("n"), "segment_value")
    by_segment_size = F.struct("segment_column", "bucket_name", (-F.col("row_count")).alias("n"), "segment_value")
    status = overall_status(alerts)

    # results about the whole partition are single values, read as scalar subqueries by the global row
    def text(rows: DataFrame, order: Column) -> Column:
        return _json_list(rows, "text", order, rows.columns).scalar()

    whole_row = F.col("metric_scope") == "global"
    columns = {
        "vip_distribution_json": F.when(whole_row, text(segment_rows, segment_size)),
        "score_by_segment_json": F.when(whole_row, text(by_segment, by_segment_size)),
        "eligible_population_json": F.when(whole_row, text(population, F.col("segment_value"))),
        "alerts_json": F.when(whole_row, text(alerts, F.struct("severity", "check_name"))).otherwise("[]"),
        "alert_count": F.when(whole_row, status.select("alert_count").scalar()).otherwise(0).cast("bigint"),
        "monitor_status": F.when(whole_row, status.select("monitor_status").scalar()).otherwise("ok"),
        **{c: lineage.select(c).scalar() for c in LINEAGE[:3]},
        "monitor_run_ts": F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz"),
        "run_label": F.lit(run_label),
        "segment_column": F.when(~whole_row, F.col("segment_column")),
        "segment_value": F.when(~whole_row, F.col("segment_value")),
        "scoring_table": F.lit(scoring_table),
        "reference_pt": F.lit(reference_pt).cast("string"),
        "partition_present_flag": F.lit(1).cast("bigint"),
        "write_success_flag": F.lit(1).cast("bigint"),
        "selected_threshold": F.lit(threshold).cast("double"),
        "pt": F.lit(pt),
    }
    table = metrics.join(buckets, SCOPE, "left").withColumns(columns)
    return align_to_schema(table, MONITORING_DAILY)[0], alerts


# --- realised performance ------------------------------------------------------------------


def performance_measures(window_days: int = 3) -> list[Column]:
    """Aggregates over observed outcomes: confusion counts, rates, scores and values."""
    n = f"{window_days}d"
    label = F.col(f"observed_response_label_positive_{n}")
    bet, ggr = F.col(f"observed_gross_bet_value_{n}"), F.col(f"observed_gross_ggr_value_{n}")
    hit, score = F.col("_hit"), F.col(SCORE)
    yes, no = label == 1, label == 0
    return [
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(yes).alias("positive_label_count"),
        F.count_if(hit).alias("predicted_positive_count"),
        F.count_if(hit & yes).alias("true_positive_count"),
        F.count_if(hit & no).alias("false_positive_count"),
        F.count_if(~hit & yes).alias("false_negative_count"),
        F.count_if(~hit & no).alias("true_negative_count"),
        F.avg(score).alias("avg_score"),
        F.avg(F.when(yes, score)).alias("avg_score_positive_label"),
        F.avg(F.when(no, score)).alias("avg_score_negative_label"),
        F.sum(bet).alias("total_outcome_gross_bet_3d_value"),
        F.sum(ggr).alias("total_outcome_gross_ggr_3d_value"),
        F.avg(bet).alias("avg_outcome_gross_bet_3d_value"),
        F.avg(ggr).alias("avg_outcome_gross_ggr_3d_value"),
        F.coalesce(F.sum(F.when(hit, bet)), F.lit(0.0)).alias("predicted_positive_total_gross_bet_3d_value"),
        F.coalesce(F.sum(F.when(hit, ggr)), F.lit(0.0)).alias("predicted_positive_total_gross_ggr_3d_value"),
        F.avg(F.when(hit, bet)).alias("predicted_positive_avg_gross_bet_3d_value"),
        F.avg(F.when(hit, ggr)).alias("predicted_positive_avg_gross_ggr_3d_value"),
        F.min("selected_threshold").alias("threshold"),
    ]


def _with_ratios(df: DataFrame) -> DataFrame:
    tp, pp, p, n = (
        F.col(c) for c in ("true_positive_count", "predicted_positive_count", "positive_label_count", "row_count")
    )
    return (
        df.withColumn("precision", ratio(tp, pp, 0.0))
        .withColumn("recall", ratio(tp, p, 0.0))
        .withColumn("f1_score", ratio(2 * tp, pp + p, 0.0))
        .withColumn("response_rate_actual", ratio(p, n))
        .withColumn("response_rate_predicted", ratio(pp, n))
    )


def _marked(observed: DataFrame) -> DataFrame:
    # the threshold of a partition is one value, carried by every row
    return observed.withColumn("_hit", F.coalesce(F.col(SCORE) >= F.col("selected_threshold"), F.lit(False)))


def monitor_performance(
    observed: DataFrame,
    pt: str,
    *,
    labels_mature: bool,
    run_ts: datetime,
    label_maturity_days: int = 4,
    window_days: int = 3,
) -> DataFrame:
    """The performance row of one partition; before maturity a row of zero counts with the reason."""
    if labels_mature:
        lineage = joined_values(observed, ["model_name", "model_version"])
        totals = side_by_side(_marked(observed).agg(*performance_measures(window_days)), lineage)
        row_so_far = _with_ratios(totals).withColumn("evaluated_row_count", F.col("row_count"))
        status, reason = "evaluated", None
    else:
        counts = [
            "row_count",
            "evaluated_row_count",
            "positive_label_count",
            "predicted_positive_count",
            "true_positive_count",
            "false_positive_count",
            "false_negative_count",
            "true_negative_count",
        ]
        # nothing is read: outcomes that are still growing are not looked at
        row_so_far = observed.sparkSession.range(1).select(*[F.lit(0).cast("bigint").alias(c) for c in counts])
        status, reason = "not_evaluable", "labels_not_mature"
    row = row_so_far.select(
        "*",
        F.lit(pt).alias("assignment_start_date"),
        F.lit(pt).alias("assignment_end_date"),
        F.lit(window_days + label_maturity_days).cast("bigint").alias("maturity_horizon_days"),
        F.lit(status).alias("status"),
        F.lit(reason).cast("string").alias("status_reason"),
        F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz").alias("created_at"),
        F.lit(pt).alias("pt"),
    )
    return align_to_schema(row, MONITORING_PERFORMANCE)[0]


def performance_by(observed: DataFrame, key: str, min_rows: int = 100, window_days: int = 3) -> DataFrame:
    """The performance measures per bucket or segment; `sufficient` tells the groups with enough rows."""
    grouped = _marked(observed).groupBy(labelled(key, MISSING_IN_MONITORING).alias(key)).agg(
        *performance_measures(window_days)
    )
    return _with_ratios(grouped).withColumn("sufficient", F.col("row_count") >= min_rows)


def calibration(observed: DataFrame, key: str = "response_priority_bucket", window_days: int = 3) -> DataFrame:
    """Mean score against observed response rate per bucket."""
    label = F.col(f"observed_response_label_positive_{window_days}d")
    grouped = observed.groupBy(labelled(key, MISSING_IN_MONITORING).alias(key)).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.avg(SCORE).alias("avg_score"),
        F.avg(label.cast("double")).alias("response_rate_actual"),
    )
    return grouped.withColumn("calibration_gap", F.abs(F.col("avg_score") - F.col("response_rate_actual")))


def prediction_partition_summary(scored: DataFrame, pt: str, threshold: float | None) -> DataFrame:
    """Existence, rows, score range and predicted positives of a partition."""
    positive = F.coalesce(F.col(SCORE) >= threshold, F.lit(False)) if threshold is not None else F.lit(False)
    row = scored.where(F.col("pt") == pt).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(SCORE).alias("score_min"),
        F.max(SCORE).alias("score_max"),
        F.count_if(positive).alias("predicted_positive_count"),
    )
    return row.select(F.lit(pt).alias("pt"), (F.col("row_count") > 0).alias("partition_exists"), *row.columns)
