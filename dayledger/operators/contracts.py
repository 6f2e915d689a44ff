"""Checks that count violations in one pass, and gates that raise on them."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import bad_score, blank, no_number, parse_pt, ratio
from ..sources.schemas import RESPONSE_SCORES
from .ordering import side_by_side
from .scoring import BUCKETS, SCORE

CRITICAL_COLUMNS = [c for c in RESPONSE_SCORES.fieldNames() if c != "pt"]

# Columns never used as model inputs, and name patterns that give away later knowledge.
EXCLUDED_COLUMNS = [
    "player_id",
    "assignment_date",
    "treatment_timestamp",
    "treatment_flag",
    "raw_assignment_event_count",
    "feature_snapshot_date",
    "feature_create_time",
    "data_version",
    "outcome_gross_bet_3d_value",
    "outcome_gross_ggr_3d_value",
    "outcome_source_row_count_3d",
    "outcome_distinct_source_keys_3d",
    "first_outcome_event_date",
    "last_outcome_event_date",
    "response_label_positive_3d",
    "pt",
]
FORBIDDEN_NAME_PATTERNS = ["^label_", "^future_", "^post_", r"_t\+", "churn_d[0-9]+$"]


# --- columns -------------------------------------------------------------------------------


def require_columns(df: DataFrame, columns: Iterable[str], context: str, exact: bool = False, ordered: bool = False) -> None:
    """Raise when columns are absent; with `exact` also on others, with `ordered` also on another order."""
    wanted = list(columns)
    missing = [c for c in wanted if c not in df.columns]
    unexpected = [c for c in df.columns if c not in wanted] if exact or ordered else []
    if missing or unexpected:
        raise ValueError(f"{context}: missing columns {missing}, unexpected columns {unexpected}")
    if ordered and df.columns != wanted:
        raise ValueError(f"{context}: columns are {df.columns}, expected in the order {wanted}")


def numeric_features(df: DataFrame, configured: Sequence[str]) -> list[str]:
    """Configured features that are present and numeric, in configured order."""
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    return [c for c in configured if c in numeric]


def leaking_columns(columns: Sequence[str]) -> list[tuple[str, str]]:
    """(column, reason) of the columns that may not be model inputs."""
    found = [(c, "excluded") for c in columns if c in EXCLUDED_COLUMNS]
    found += [(c, p) for c in columns for p in FORBIDDEN_NAME_PATTERNS if re.search(p, c)]
    return found


def require_no_leakage(features: Sequence[str]) -> None:
    found = leaking_columns(features)
    if found:
        raise ValueError(f"features that may not be model inputs: {found}")


# --- counting ------------------------------------------------------------------------------


def count_violations(rows: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """One row: each check's rows, and the repeated-player counts in the three senses in use.

    Rows are first combined per (player, partition): one shuffle of partial counts serves all of them,
    and no player has to be held together.
      duplicate_extra_rows      rows beyond the first of each player
      duplicate_all_rows        all rows of players that occur more than once
      duplicate_distinct_gap    rows minus distinct known players
      duplicate_groups          known players that occur more than once
    """
    names = list(checks)
    per_pair = rows.groupBy("player_id", "pt").agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(checks[c]).alias(c) for c in names]
    )
    n = F.col("_n")
    per_player = per_pair.groupBy("player_id").agg(
        F.sum(n).alias("_n"),
        F.sum(F.when(n > 1, n).otherwise(0)).alias("_pair_all"),
        F.sum(n - 1).alias("_pair_extra"),
        *[F.sum(c).alias(c) for c in names],
    )
    known = F.col("player_id").isNotNull()

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    return per_player.agg(
        total(n).alias("total_rows"),
        F.count_if(known).alias("distinct_players"),
        total(n - 1).alias("duplicate_extra_rows"),
        total(F.when(n > 1, n)).alias("duplicate_all_rows"),
        (total(n) - F.count_if(known)).alias("duplicate_distinct_gap"),
        F.count_if(known & (n > 1)).alias("duplicate_groups"),
        total(F.col("_pair_all")).alias("duplicate_pair_all_rows"),
        total(F.col("_pair_extra")).alias("duplicate_pair_extra_rows"),
        *[total(F.col(c)).alias(c) for c in names],
    )


def _unknown_bucket() -> Column:
    # a NULL bucket is counted as missing, not here
    return ~F.col("response_priority_bucket").isin(BUCKETS)


def _score_checks(pt: str) -> dict[str, Column]:
    """Checks common to the pre- and post-write contracts."""
    score = F.col(SCORE)
    return {
        "player_id_missing_rows": blank("player_id"),
        "score_missing_rows": no_number(SCORE),
        "score_out_of_range_rows": bad_score(SCORE) & ~no_number(score),
        "bucket_missing_rows": blank("response_priority_bucket"),
        "invalid_bucket_rows": _unknown_bucket(),
        "score_date_missing_rows": F.col("score_date").isNull(),
        "scoring_pt_missing_rows": blank("scoring_pt"),
        "scoring_pt_mismatch_rows": F.col("scoring_pt") != pt,
        "scoring_ts_missing_rows": F.col("scoring_ts").isNull(),
        "snapshot_date_missing_rows": F.col("snapshot_date").isNull(),
        "model_name_missing_rows": blank("model_name"),
        "model_version_missing_rows": blank("model_version"),
        "model_reference_path_missing_rows": blank("model_reference_path"),
        "selected_threshold_missing_rows": F.col("selected_threshold").isNull(),
    }


def prewrite_contract(source: DataFrame, pt: str) -> DataFrame:
    """One row of violation counts for the rows about to be published as `pt`."""
    checks = _score_checks(pt)
    counted = count_violations(source.where(F.col("scoring_pt") == pt), checks)
    return counted.select(
        F.lit(pt).alias("scoring_pt"),
        "total_rows",
        F.when(F.col("total_rows") > 0, 0).otherwise(1).cast("bigint").alias("empty_output_violation_rows"),
        F.col("duplicate_distinct_gap").alias("duplicate_player_id_rows"),
        F.col("duplicate_groups").alias("duplicate_player_id_groups"),
        *checks,
    )


def postwrite_contract(table: DataFrame, pt: str) -> DataFrame:
    """One row of violation counts for the written partition `pt`."""
    checks = {
        **_score_checks(pt),
        "action_recommendation_missing_rows": blank("action_recommendation"),
        "partition_mismatch_rows": F.col("pt") != pt,
    }
    counted = count_violations(table.where(F.col("pt") == pt), checks)
    return counted.select(
        F.lit(pt).alias("scoring_pt"),
        F.col("total_rows").alias("row_count"),
        F.col("duplicate_distinct_gap").alias("duplicate_player_id_rows"),
        F.col("duplicate_groups").alias("duplicate_player_id_groups"),
        *checks,
    )


def duplicate_players(rows: DataFrame, limit: int | None = None) -> DataFrame:
    """Repeated players, the most repeated first; all of them unless a report asks for fewer."""
    counts = rows.groupBy("player_id").agg(F.count(F.lit(1)).alias("duplicate_row_count"))
    repeated = counts.where(F.col("duplicate_row_count") > 1)
    ordered = repeated.orderBy(F.desc("duplicate_row_count"), F.asc_nulls_first("player_id"))
    return ordered if limit is None else ordered.limit(limit)


def score_counts(table: DataFrame, pt: str) -> DataFrame:
    rows = table.where(F.col("pt") == pt)
    return rows.groupBy("pt").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("player_id").alias("distinct_player_id_count"),
        (F.count(F.lit(1)) - F.count_distinct("player_id")).alias("duplicate_player_id_rows"),
        F.min("score_date").alias("min_score_date"),
        F.max("score_date").alias("max_score_date"),
        F.min("snapshot_date").alias("min_snapshot_date"),
        F.max("snapshot_date").alias("max_snapshot_date"),
    )


def score_nulls(table: DataFrame, pt: str) -> DataFrame:
    """Rows with an absent value per column; text also counts when blank."""
    # Columns checked, by kind of check.
    plain = ["score_date", "scoring_ts", "snapshot_date", SCORE, "score_rank", "score_percentile", "selected_threshold"]
    text = ["player_id", "scoring_pt", "response_priority_bucket", "action_recommendation", "model_name"]
    return table.where(F.col("pt") == pt).agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_null_rows") for c in plain],
        *[F.count_if(blank(c)).alias(f"{c}_null_or_blank_rows") for c in text],
    )


def score_ranges(table: DataFrame, pt: str) -> DataFrame:
    return table.where(F.col("pt") == pt).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(SCORE) < 0.0).alias("score_below_zero_rows"),
        F.count_if(F.col(SCORE) > 1.0).alias("score_above_one_rows"),
        F.count_if(F.col("score_percentile") < 0.0).alias("percentile_below_zero_rows"),
        F.count_if(F.col("score_percentile") > 1.0).alias("percentile_above_one_rows"),
        F.count_if(_unknown_bucket()).alias("invalid_bucket_rows"),
    )


def lineage_completeness(table: DataFrame, pt: str) -> DataFrame:
    names = ["model_name", "model_version", "model_reference_path"]
    return table.where(F.col("pt") == pt).agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(blank(c)).alias(f"{c}_missing_rows") for c in names],
        F.count_if(F.col("selected_threshold").isNull()).alias("selected_threshold_missing_rows"),
    )


def lineage_combinations(table: DataFrame, pt: str) -> DataFrame:
    return (
        table.where(F.col("pt") == pt)
        .groupBy("model_name", "model_version", "selected_threshold")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


# --- gates ---------------------------------------------------------------------------------


def prewrite_gate(
    rows: DataFrame, pt: str, buckets: Sequence[str] = tuple(BUCKETS), non_null: Sequence[str] = tuple(CRITICAL_COLUMNS)
) -> DataFrame:
    """One row of what must be zero before publishing.

    `non_null` decides whether an absent segment blocks the publish; by default it does.
    """
    require_columns(rows, RESPONSE_SCORES.fieldNames(), "scoring output", exact=True)
    bucket = F.col("response_priority_bucket")
    checks = {
        "invalid_score_rows": bad_score(SCORE),
        "invalid_bucket_rows": bucket.isNull() | ~bucket.isin(list(buckets)),
        **{f"null_{c}": F.col(c).isNull() for c in non_null},
        "wrong_scoring_pt_rows": F.col("scoring_pt") != pt,
        "wrong_pt_rows": F.col("pt") != pt,
        "wrong_score_date_rows": F.col("score_date") != F.lit(parse_pt(pt)),
    }
    counted = count_violations(rows, checks)
    return counted.select(
        F.col("total_rows").alias("row_count"),
        F.col("duplicate_all_rows").alias("duplicate_player_id_rows"),
        F.col("duplicate_pair_all_rows").alias("duplicate_partition_rows"),
        *checks,
    )


def require_clean(gate: DataFrame, context: str) -> dict:
    """Raise when the table is empty or any count of the gate is above zero; else return the gate row."""
    row = gate.first().asDict()  # one row of counts
    broken = {name: n for name, n in row.items() if name != "row_count" and n}
    if not row["row_count"]:
        broken["row_count"] = 0
    if broken:
        raise ValueError(f"{context} failed: {broken}")
    return row


def postwrite_gate(
    written: DataFrame,
    pt: str,
    expected_rows: int,
    lineage: Mapping[str, object],
    buckets: Sequence[str] = tuple(BUCKETS),
    non_null: Sequence[str] = tuple(CRITICAL_COLUMNS),
) -> DataFrame:
    """The pre-write counts on the re-read partition, plus row count and lineage against what was sent."""
    checks = {
        f"wrong_{c}_rows": F.col(c).isNotNull() & (F.col(c).cast("string") != F.lit(value).cast("string"))
        for c, value in lineage.items()
    }
    gate = prewrite_gate(written, pt, buckets, non_null)
    stray = written.agg(*[F.count_if(c).alias(name) for name, c in checks.items()])
    return side_by_side(gate, stray).withColumn("row_count_gap", F.col("row_count") - F.lit(expected_rows))


def scored_input_check(rows: DataFrame, pt: str) -> DataFrame:
    """What monitoring needs to know of a scored partition before it reads it."""
    require_columns(rows, RESPONSE_SCORES.fieldNames(), "monitoring input")
    checks = {
        "invalid_score_count": bad_score(SCORE),
        "unexpected_pt_rows": F.col("pt") != pt,
        "unexpected_scoring_pt_rows": F.col("scoring_pt") != pt,
    }
    counted = count_violations(rows, checks)
    return counted.select(
        F.col("total_rows").alias("row_count"),
        F.col("duplicate_extra_rows").alias("duplicate_player_count"),
        F.col("duplicate_pair_extra_rows").alias("duplicate_partition_count"),
        *checks,
    )


def require_scored_input(rows: DataFrame, pt: str) -> dict:
    """Raise on an empty partition or foreign partition values; duplicates and bad scores become alerts."""
    row = scored_input_check(rows, pt).first().asDict()
    if not row["row_count"]:
        raise ValueError(f"scored partition {pt} is empty")
    if row["unexpected_pt_rows"] or row["unexpected_scoring_pt_rows"]:
        raise ValueError(f"scored partition {pt} holds rows of other partitions: {row}")
    return row


def observed_input_check(observed: DataFrame, window_days: int = 3) -> DataFrame:
    """Columns, row count and repeated (player, partition) rows of the observed outcomes."""
    n = f"{window_days}d"
    needed = [
        "player_id",
        "pt",
        SCORE,
        "selected_threshold",
        "model_name",
        "model_version",
        f"observed_response_label_positive_{n}",
        f"observed_gross_bet_value_{n}",
        f"observed_gross_ggr_value_{n}",
    ]
    require_columns(observed, needed, "observed outcomes")
    counted = count_violations(observed, {"missing_score_rows": F.col(SCORE).isNull()})
    return counted.select(
        F.col("total_rows").alias("row_count"), F.col("duplicate_pair_extra_rows").alias("duplicate_rows")
    )


def require_observed_input(observed: DataFrame, window_days: int = 3) -> dict:
    return require_clean(observed_input_check(observed, window_days), "observed outcomes check")


# --- monitoring tables ---------------------------------------------------------------------


def _outside_unit(name: str) -> Column:
    return (F.col(name) < 0.0) | (F.col(name) > 1.0)


def _per_partition(table: DataFrame, rows_name: str, checks: Mapping[str, Column]) -> DataFrame:
    return table.groupBy("pt").agg(
        F.count(F.lit(1)).alias(rows_name), *[F.count_if(c).alias(name) for name, c in checks.items()]
    )


def validate_monitor_daily(table: DataFrame) -> DataFrame:
    scope = F.col("metric_scope")
    return _per_partition(
        table,
        "monitoring_rows",
        {
            "invalid_metric_scope_rows": ~scope.isin("global", "segment"),
            "missing_segment_identity_rows": (scope == "segment")
            & (F.col("segment_column").isNull() | F.col("segment_value").isNull()),
            "missing_run_ts_rows": F.col("monitor_run_ts").isNull(),
            "missing_run_label_rows": F.col("run_label").isNull(),
            "non_positive_row_count_rows": F.col("row_count") <= 0,
            "non_positive_distinct_player_rows": F.col("distinct_player_count") <= 0,
            "invalid_score_range_rows": (F.col("score_min") < 0.0) | (F.col("score_max") > 1.0),
            "missing_bucket_distribution_rows": F.col("bucket_distribution_json").isNull(),
            "missing_vip_distribution_rows": F.col("vip_distribution_json").isNull(),
        },
    )


def validate_monitor_performance(table: DataFrame) -> DataFrame:
    # Fixed values: (output name, column) of the counts and ratios checked.
    counts = ["row_count", "evaluated_row_count", "positive_label_count", "predicted_positive_count"]
    ratios = {
        "invalid_precision_rows": "precision",
        "invalid_recall_rows": "recall",
        "invalid_f1_rows": "f1_score",
        "invalid_actual_response_rate_rows": "response_rate_actual",
        "invalid_predicted_response_rate_rows": "response_rate_predicted",
        "invalid_avg_score_rows": "avg_score",
        "invalid_threshold_rows": "threshold",
    }
    return _per_partition(
        table,
        "performance_rows",
        {
            **{f"negative_{c}_rows": F.col(c) < 0 for c in counts},
            **{name: _outside_unit(c) for name, c in ratios.items()},
            "missing_model_name_rows": blank("model_name"),
            "missing_model_version_rows": blank("model_version"),
        },
    )


def validate_alerts(table: DataFrame) -> DataFrame:
    return _per_partition(
        table,
        "alert_rows",
        {
            "invalid_severity_rows": ~F.col("severity").isin("warning", "critical"),
            "invalid_mode_rows": ~F.col("mode").isin("daily", "performance"),
            "missing_check_name_rows": F.col("check_name").isNull(),
            "missing_message_rows": F.col("message").isNull(),
        },
    )


# --- dataset contract ----------------------------------------------------------------------

# Highest share of NULLs per column, columns that may not be NULL, flag values, treatment share range.
MAX_NULL_RATE = {
    "treatment_type": 0.0,
    "treatment_group": 0.2,
    "feature_snapshot_date": 0.02,
    "outcome_gross_bet_3d_flag": 0.0,
    "response_label_positive_3d": 0.0,
}
KEY_COLUMNS = ["player_id", "assignment_date", "treatment_flag", "feature_snapshot_date"]
REQUIRED_COLUMNS = [
    "player_id",
    "assignment_date",
    "treatment_flag",
    "treatment_type",
    "treatment_group",
    "feature_snapshot_date",
    "source_treatment_types",
    "treatment_event_count",
    "treatment_source_count",
]
OUTCOME_COLUMNS = [
    "outcome_gross_bet_3d_value",
    "outcome_gross_bet_3d_flag",
    "outcome_gross_ggr_3d_value",
    "response_label_positive_3d",
]
TREATMENT_SHARE_RANGE = (0.01, 1.0)


def data_contract(dataset: DataFrame) -> DataFrame:
    """(check, column, observed, limit, violated) of the dataset contract, from one pass over the rows."""
    require_columns(dataset, REQUIRED_COLUMNS + OUTCOME_COLUMNS, "dataset contract")
    flag = F.col("treatment_flag")
    nulls = list(dict.fromkeys([*MAX_NULL_RATE, *KEY_COLUMNS]))
    counts = dataset.agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(~flag.isin(0, 1)).alias("_odd_flags"),
        F.avg(flag.cast("double")).alias("_share"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in nulls],
    )

    def entry(check: str, column: str, observed: Column, limit: float, violated: Column) -> Column:
        return F.struct(
            F.lit(check).alias("check_name"),
            F.lit(column).alias("column_name"),
            observed.cast("double").alias("observed"),
            F.lit(float(limit)).alias("limit_value"),
            F.coalesce(violated, F.lit(False)).alias("violated"),
        )

    low, high = TREATMENT_SHARE_RANGE
    entries = [entry("max_null_rate", c, ratio(c, "_n"), m, ratio(c, "_n") > m) for c, m in MAX_NULL_RATE.items()]
    entries += [entry("key_not_null", c, F.col(c), 0, F.col(c) > 0) for c in KEY_COLUMNS]
    entries += [
        entry("allowed_flag_values", "treatment_flag", F.col("_odd_flags"), 0, F.col("_odd_flags") > 0),
        entry("minimum_treatment_share", "treatment_flag", F.col("_share"), low, F.col("_share") < low),
        entry("maximum_treatment_share", "treatment_flag", F.col("_share"), high, F.col("_share") > high),
    ]
    return counts.select(F.inline(F.array(*entries)))
