"""Profiles of the response dataset and of its audit form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import (
    MISSING_IN_MONITORING,
    MISSING_IN_PROFILES,
    labelled,
    ratio,
    treatment_combo,
    week_start,
)
from .lists import MOST_VALUES, few_values

LABEL = "response_label_positive_3d"


def _positive_rate() -> Column:
    return F.avg(F.col(LABEL).cast("double")).alias("positive_rate")


def _first_rows(rows: DataFrame, limit: int | None) -> DataFrame:
    return rows if limit is None else rows.limit(limit)


def partition_summary(dataset: DataFrame, modeling_end_pt: str, limit: int | None = None) -> DataFrame:
    """Rows and positive rate of the partitions, marked when mature enough for modelling."""
    grouped = dataset.groupBy("pt").agg(F.count(F.lit(1)).alias("row_count"), _positive_rate())
    return _first_rows(grouped.withColumn("mature_for_modeling", F.col("pt") <= modeling_end_pt).orderBy("pt"), limit)


def overall_summary(dataset: DataFrame) -> DataFrame:
    """One row of totals.

    Distinct counts come from one row per player-day: its per-player counts are combined, so the two
    distinct counts share a single pass instead of multiplying the rows.
    """
    pair = dataset.groupBy(F.col("player_id"), F.col("assignment_date")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("feature_snapshot_date").alias("lo"),
        F.max("feature_snapshot_date").alias("hi"),
        F.sum(LABEL).alias("pos"),
        F.count(LABEL).alias("labelled"),
    )
    player = pair.groupBy("player_id").agg(
        F.sum("n").alias("n"),
        F.count("assignment_date").alias("days"),
        F.min("assignment_date").alias("first"),
        F.max("assignment_date").alias("last"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        F.sum("pos").alias("pos"),
        F.sum("labelled").alias("labelled"),
    )
    return player.agg(
        F.sum("n").alias("total_rows"),
        F.sum("days").alias("distinct_player_day_rows"),
        F.count("player_id").alias("distinct_players"),
        F.min("first").alias("min_assignment_date"),
        F.max("last").alias("max_assignment_date"),
        F.min("lo").alias("min_feature_snapshot_date"),
        F.max("hi").alias("max_feature_snapshot_date"),
        F.sum("pos").alias("positive_rows"),
        ratio(F.sum("pos"), F.sum("labelled")).alias("positive_rate"),
    )


def treatment_mix(dataset: DataFrame, limit: int | None = None) -> DataFrame:
    flags = ["treatment_flag", "has_voucher_treatment", "has_sms_treatment"]
    counts = dataset.groupBy(*flags).agg(F.count(F.lit(1)).alias("row_count"))
    return _first_rows(counts.orderBy(F.desc("row_count"), *flags), limit)


def segment_summary(dataset: DataFrame, segment: str = "vip_level", limit: int | None = None) -> DataFrame:
    grouped = dataset.groupBy(segment).agg(F.count(F.lit(1)).alias("row_count"), _positive_rate())
    return _first_rows(grouped.orderBy(F.desc("row_count"), segment), limit)


# Columns whose NULLs are reported.
KEY_NULL_COLUMNS = [
    "player_id",
    "assignment_date",
    "treatment_timestamp",
    "feature_snapshot_date",
    "vip_level",
    "response_label_positive_3d",
]


def key_nulls(dataset: DataFrame) -> DataFrame:
    return dataset.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in KEY_NULL_COLUMNS])


def missingness(dataset: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, missing_rows, missing_rate) from one pass; a column that is absent is missing throughout."""
    columns = list(columns or dataset.columns)
    counted = dataset.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns if c in dataset.columns],
    )
    n = F.col("_n")
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            (F.col(c) if c in dataset.columns else n).alias("missing_rows"),
            ratio(c if c in dataset.columns else n, n).alias("missing_rate"),
        )
        for c in columns
    ]
    return counted.select(F.inline(F.array(*rows))).orderBy(F.desc("missing_rate"), "column_name")


def profile_overview(dataset: DataFrame) -> DataFrame:
    """(metric, value) pairs as text."""
    day = F.col("assignment_date")
    per_player = dataset.groupBy("player_id").agg(
        F.count(F.lit(1)).alias("n"), F.min(day).alias("lo"), F.max(day).alias("hi")
    )
    totals = per_player.agg(
        F.sum("n").cast("string").alias("row_count"),
        F.count("player_id").cast("string").alias("unique_users"),
        F.min("lo").cast("string").alias("assignment_date_min"),
        F.max("hi").cast("string").alias("assignment_date_max"),
    )
    days = dataset.select(day).distinct().agg(F.count("assignment_date").cast("string").alias("distinct_assignment_dates"))
    metrics = [*totals.columns]
    return totals.unpivot([], metrics, "metric", "value").unionByName(
        days.unpivot([], days.columns, "metric", "value")
    )


def value_distribution(dataset: DataFrame, column: str) -> DataFrame:
    """Rows and share of each value; the absent value has its own label.

    The column may have any number of values, so the total is one more aggregate of the counts (whose shuffle
    both sides share), read as a scalar subquery.
    """
    counts = dataset.groupBy(labelled(column, MISSING_IN_PROFILES).alias(column)).agg(F.count(F.lit(1)).alias("row_count"))
    total = counts.agg(F.sum("row_count")).scalar()
    return counts.select(column, "row_count", ratio("row_count", total).alias("row_share"))


# Fixed value: stands for an absent number in outcome distributions.
ABSENT_OUTCOME = -999999.0


def outcome_distribution(dataset: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(outcome_column, outcome_value, row_count) next to the column's mean and missing rate, one row a value.

    Kept long: an amount can have as many values as there are rows, too many for one text cell.
    """
    long = dataset.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("outcome_column"), F.col(c).try_cast("double").alias("v"))
                    for c in columns
                ]
            )
        ).alias("o")
    ).select("o.outcome_column", "o.v")
    values = long.groupBy("outcome_column", "v").agg(F.count(F.lit(1)).alias("row_count"))
    v, n = F.col("v"), F.col("row_count")
    known = v.isNotNull()
    summary = values.groupBy("outcome_column").agg(
        ratio(F.sum(F.when(known, v * n)), F.sum(F.when(known, n))).alias("mean"),
        ratio(F.sum(F.when(known, 0).otherwise(n)), F.sum(n)).alias("missing_rate"),
    )
    # one row per outcome column, named by the caller; the counted values are shuffled once for both sides
    return values.join(F.broadcast(summary), "outcome_column").select(
        "outcome_column", F.coalesce("v", F.lit(ABSENT_OUTCOME)).alias("outcome_value"), "row_count", "mean", "missing_rate"
    )


def outcome_distribution_json(distribution: DataFrame, most: int = MOST_VALUES) -> DataFrame:
    """The same as one JSON map per column, for columns with few values such as flags; over `most` values are refused."""
    few = few_values(distribution, ["outcome_column"], "outcome_value", most)
    pairs = F.sort_array(F.collect_list(F.struct(F.col("outcome_value").cast("string").alias("k"), "row_count")))
    return few.groupBy("outcome_column", "mean", "missing_rate").agg(F.to_json(F.map_from_entries(pairs)).alias("distribution_json"))


def _rows_and_users(df: DataFrame, *keys: Column) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("player_id").alias("unique_users")
    )


def assignment_coverage(dataset: DataFrame) -> DataFrame:
    return _rows_and_users(dataset, F.col("assignment_date"))


def eligible_population(partition: DataFrame, segment: str = "vip_level") -> DataFrame:
    """Eligible rows and players of one feature partition by segment."""
    eligible = partition.where(F.col("is_eligible") == 1)
    return eligible.groupBy(labelled(segment, MISSING_IN_MONITORING).alias("segment_value")).agg(
        F.count(F.lit(1)).alias("eligible_row_count"),
        F.count_distinct(F.col("player_id").cast("string")).alias("eligible_distinct_player_count"),
        F.min(F.col("snapshot_date").cast("date")).alias("snapshot_date_min"),
        F.max(F.col("snapshot_date").cast("date")).alias("snapshot_date_max"),
    )


# --- treatments ----------------------------------------------------------------------------


def _combo() -> Column:
    return treatment_combo("source_treatment_types", "treatment_flag").alias("treatment_combo")


def treatment_combo_summary(dataset: DataFrame) -> DataFrame:
    """Rows, share and users per channel combination (six at most)."""
    grouped = _rows_and_users(dataset, _combo())
    return grouped.withColumn("row_share", ratio("row_count", F.sum("row_count").over(Window.partitionBy())))


def treatment_trend_daily(dataset: DataFrame) -> DataFrame:
    return _rows_and_users(dataset, F.col("assignment_date"), _combo())


def treatment_trend_weekly(dataset: DataFrame) -> DataFrame:
    return _rows_and_users(dataset, week_start("assignment_date").alias("assignment_week"), _combo())
