"""Scoring of one partition: audience, rank, priority bucket, recommended action, and score summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import MISSING_IN_REPORTS, labelled, parse_pt, ratio
from ..session import cut_lineage
from ..sources.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES, RESPONSE_SCORES
from .ordering import exact_quantiles, rank_rows, value_histogram

SCORE = "predicted_response_score"

# Bucket labels from the bottom up, their lower quantiles, and the action rules.
BUCKETS = ["very_low", "low", "medium", "high", "very_high"]
BUCKET_QUANTILES = {"low": 0.2, "medium": 0.4, "high": 0.6, "very_high": 0.8}
HIGH_PRIORITY_BUCKETS = ["very_high", "high"]
LOW_PRIORITY_BUCKETS = ["very_low", "low"]
HIGH_VALUE_SEGMENTS = ["V4", "V5", "V6", "V7", "V8"]


def scoring_audience(mart: DataFrame, pt: str, features: Sequence[str] = tuple(NUMERIC_FEATURES)) -> DataFrame:
    """Eligible players of one partition; features that are no number become NULL."""
    needed = ["player_id", "snapshot_date", "pt", "is_eligible", *features, *CATEGORICAL_FEATURES]
    missing = [c for c in needed if c not in mart.columns]
    if missing:
        raise ValueError(f"scoring population lacks columns {missing}")
    rows = mart.where((F.col("pt") == pt) & (F.col("is_eligible") == 1) & F.col("player_id").isNotNull())
    return rows.select(
        F.col("player_id").cast("string").alias("player_id"),
        F.col("snapshot_date").cast("date").alias("snapshot_date"),
        *[F.col(f).try_cast("double").alias(f) for f in features],
        *[F.col(c).cast("string").alias(c) for c in CATEGORICAL_FEATURES],
        "pt",
    )


def rank_scores(scored: DataFrame) -> DataFrame:
    """Rank by score, best first, equal scores by player; percentile 1 for the best."""
    ranked = rank_rows(scored, [F.desc(SCORE), F.asc("player_id")], "score_rank", "score_total")
    return ranked.withColumn("score_percentile", 1 - (F.col("score_rank") - 1) / F.col("score_total"))


def bucket_thresholds(ranked: DataFrame) -> dict[str, float]:
    """Lower score bound of each bucket above the lowest: quantiles read off the ranks.

    Needs the rank, not another sort: the neighbours of a quantile are the rows at two known ranks.
    Only these numbers come to the driver.
    """
    n, position = F.col("score_total"), F.col("score_total") - F.col("score_rank")
    picks = []
    for name, q in BUCKET_QUANTILES.items():
        at = F.lit(q) * (n - 1)
        lo = F.max(F.when(position == F.floor(at), F.col(SCORE)))
        hi = F.max(F.when(position == F.ceil(at), F.col(SCORE)))
        picks.append((lo + (hi - lo) * F.max(at - F.floor(at))).alias(name))
    return {name: value for name, value in ranked.agg(*picks).first().asDict().items() if value is not None}


def priority_bucket(thresholds: Mapping[str, float]) -> Column:
    chain = F.lit(BUCKETS[0])
    for name in BUCKETS[1:]:
        chain = F.when(F.col(SCORE) >= thresholds[name], name).otherwise(chain) if name in thresholds else chain
    return chain


def threshold_rule(thresholds: Mapping[str, float]) -> Column:
    """Text of the score range of each bucket."""
    rules = {BUCKETS[0]: f"score < {thresholds['low']:.6f}"}
    for name, above in zip(BUCKETS[1:], [*BUCKETS[2:], None]):
        low = thresholds[name]
        rules[name] = f"{low:.6f} <= score < {thresholds[above]:.6f}" if above else f"score >= {low:.6f}"
    pairs = [x for name, rule in rules.items() for x in (F.lit(name), F.lit(rule))]
    return F.element_at(F.create_map(*pairs), F.col("response_priority_bucket"))


def action_recommendation(bucket: str = "response_priority_bucket", segment: str = "vip_level") -> Column:
    b, high_value = F.col(bucket), F.coalesce(F.col(segment).isin(HIGH_VALUE_SEGMENTS), F.lit(False))
    return (
        F.when(b.isin(HIGH_PRIORITY_BUCKETS), "prioritize_for_campaign_review")
        .when((b == "medium") & high_value, "manual_review_high_value_medium_score")
        .when(b.isin(LOW_PRIORITY_BUCKETS), "deprioritize_aggressive_promo")
        .otherwise("standard_priority_review")
    )


def score_output(
    scored: DataFrame,
    pt: str,
    *,
    scoring_ts: datetime,
    model_name: str,
    model_version: str,
    model_reference_path: str,
    selected_threshold: float,
) -> tuple[DataFrame, dict[str, float]]:
    """The publishable partition in table order, and the bucket thresholds.

    `scored` holds player_id, snapshot_date, vip_level and the score.
    """
    # written first: a sort reads its input twice, for its bounds and to deal the rows
    slim = cut_lineage(scored.select("player_id", "snapshot_date", "vip_level", F.col(SCORE).cast("double").alias(SCORE)), "scored")
    ranked = rank_scores(slim)
    thresholds = bucket_thresholds(ranked)
    bucketed = ranked.withColumn("response_priority_bucket", priority_bucket(thresholds))
    output = bucketed.select(
        "player_id",
        F.lit(parse_pt(pt)).alias("score_date"),
        F.lit(pt).alias("scoring_pt"),
        F.lit(scoring_ts.isoformat(sep=" ")).cast("timestamp_ntz").alias("scoring_ts"),
        "snapshot_date",
        SCORE,
        "score_rank",
        "score_percentile",
        "response_priority_bucket",
        action_recommendation().alias("action_recommendation"),
        "vip_level",
        F.lit(model_name).alias("model_name"),
        F.lit(model_version).alias("model_version"),
        F.lit(model_reference_path).alias("model_reference_path"),
        F.lit(float(selected_threshold)).alias("selected_threshold"),
        F.lit(pt).alias("pt"),
    )
    return output.select(*RESPONSE_SCORES.fieldNames()), thresholds


# --- summaries -----------------------------------------------------------------------------


def score_distribution(scored: DataFrame) -> DataFrame:
    """(metric, value): minimum, five quantiles, maximum, mean and sample standard deviation."""
    points = {"min": 0.0, "p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "max": 1.0}
    histogram = value_histogram(scored, SCORE)
    quantiles = exact_quantiles(histogram, SCORE, "n", points)
    moments = scored.agg(F.avg(SCORE).alias("mean"), F.stddev_samp(SCORE).alias("std"))
    return quantiles.unpivot([], list(points), "metric", "value").unionByName(
        moments.unpivot([], ["mean", "std"], "metric", "value")
    )


def prediction_volume(scored: DataFrame, threshold: float | None) -> DataFrame:
    """Rows at or above the threshold and below it; a missing score is below."""
    if threshold is None:
        positive = F.lit(False)
    else:
        positive = F.coalesce(F.col(SCORE) >= threshold, F.lit(False))
    counted = scored.agg(F.count(F.lit(1)).alias("n"), F.count_if(positive).alias("positive_prediction_count"))
    p, n = F.col("positive_prediction_count"), F.col("n")
    rate = ratio(p, n, 0.0)
    return counted.select(
        p,
        (n - p).alias("negative_prediction_count"),
        rate.alias("predicted_positive_rate"),
        F.when(n > 0, 1 - rate).otherwise(0.0).alias("predicted_negative_rate"),
    )


def bucket_summary(scored: DataFrame) -> DataFrame:
    """Rows, share of all rows and score range of each bucket."""
    grouped = scored.groupBy("response_priority_bucket").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(SCORE).alias("min_score"),
        F.max(SCORE).alias("max_score"),
        F.avg(SCORE).alias("avg_score"),
    )
    # one row a bucket
    everything = F.sum("row_count").over(Window.partitionBy())
    return grouped.withColumn("population_share", ratio("row_count", everything))


def bucket_segment_mix(scored: DataFrame, segment: str = "vip_level") -> DataFrame:
    """Share of each segment within its bucket."""
    grouped = (
        scored.groupBy("response_priority_bucket", labelled(segment, MISSING_IN_REPORTS).alias(segment))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    in_bucket = F.sum("row_count").over(Window.partitionBy("response_priority_bucket"))
    return grouped.withColumn("bucket_share", ratio("row_count", in_bucket))
