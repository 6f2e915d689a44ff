"""Schemas of the produced tables. Columns, order and types are fixed values shared with readers of the tables."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    # wall-clock time, so results do not move with the session time zone
    "timestamp": T.TimestampNTZType(),
}


# What the columns of the dataset and of the scores hold, as the catalog tells readers.
COMMENTS = {
    "player_id": "player",
    "assignment_date": "day the row describes",
    "treatment_timestamp": "first voucher or message of the day",
    "treatment_flag": "1 if the player was treated that day",
    "raw_assignment_event_count": "vouchers and messages of the day",
    "has_voucher_treatment": "1 if a voucher was given",
    "has_sms_treatment": "1 if a message was delivered",
    "feature_snapshot_date": "last day the features look at",
    "recency_last_bet_to_t": "days since the last bet",
    "feature_create_time": "when the features were made",
    "data_version": "version of the features",
    "vip_level": "segment, absent for some players",
    "outcome_gross_bet_3d_value": "bets of the three days after the assignment day",
    "outcome_gross_ggr_3d_value": "gross gaming revenue of these days",
    "outcome_source_row_count_3d": "bet rows of these days",
    "outcome_distinct_source_keys_3d": "different days and sites among them",
    "first_outcome_event_date": "first day with a bet",
    "last_outcome_event_date": "last day with a bet",
    "response_label_positive_3d": "1 if the bets of these days are above zero",
    "score_date": "day the score is for",
    "predicted_response_score": "probability of a response",
    "score_rank": "rank by score, best first",
    "score_percentile": "1 for the best rank",
}


def comment_of(column: str) -> str:
    """The comment of a column; features of a window say which days they cover."""
    days = {"_7d": "of the 7 days before", "_30d": "of the 30 days before"}
    for end, text in days.items():
        if column.endswith(end) and column not in COMMENTS:
            return f"{column.removesuffix(end).split('_', 1)[1].replace('_', ' ')} {text}"
    return COMMENTS.get(column, "")


def _schema(text: str, partition_note: str) -> T.StructType:
    """Build a schema from lines of `type: name, name, ...`; `pt` comes last."""
    fields = []
    for line in text.strip().splitlines():
        kind, names = line.split(":")
        for name in map(str.strip, names.split(",")):
            note = comment_of(name)
            fields.append(T.StructField(name, _TYPES[kind.strip()], True, {"comment": note} if note else None))
    fields.append(T.StructField("pt", T.StringType(), True, {"comment": partition_note}))
    return T.StructType(fields)


# Model inputs in training order.
NUMERIC_FEATURES = [
    "recent_bet_cnt_7d",
    "recent_bet_amt_7d",
    "recent_win_amt_7d",
    "recent_ggr_amt_7d",
    "recent_net_loss_amt_7d",
    "recent_bet_days_7d",
    "recency_last_bet_to_t",
    "pre_bet_cnt_30d",
    "pre_bet_amt_30d",
    "pre_win_amt_30d",
    "pre_ggr_amt_30d",
    "pre_net_loss_amt_30d",
    "pre_bet_days_30d",
    "recent_dep_cnt_7d",
    "recent_dep_amt_7d",
    "recent_withdraw_cnt_7d",
    "recent_withdraw_amt_7d",
    "recent_net_cash_in_7d",
]
CATEGORICAL_FEATURES = ["vip_level"]
LONG_FEATURES = [f for f in NUMERIC_FEATURES if "_cnt_" in f or "_days_" in f or f.startswith("recency")]

RESPONSE_DATASET = _schema(
    """
    string: player_id
    date: assignment_date
    timestamp: treatment_timestamp
    long: treatment_flag, raw_assignment_event_count, has_voucher_treatment, has_sms_treatment
    date: feature_snapshot_date
    long: recent_bet_cnt_7d
    double: recent_bet_amt_7d, recent_win_amt_7d, recent_ggr_amt_7d, recent_net_loss_amt_7d
    long: recent_bet_days_7d, recency_last_bet_to_t, pre_bet_cnt_30d
    double: pre_bet_amt_30d, pre_win_amt_30d, pre_ggr_amt_30d, pre_net_loss_amt_30d
    long: pre_bet_days_30d, recent_dep_cnt_7d
    double: recent_dep_amt_7d
    long: recent_withdraw_cnt_7d
    double: recent_withdraw_amt_7d, recent_net_cash_in_7d
    timestamp: feature_create_time
    string: data_version, vip_level
    double: outcome_gross_bet_3d_value, outcome_gross_ggr_3d_value
    long: outcome_source_row_count_3d, outcome_distinct_source_keys_3d
    date: first_outcome_event_date, last_outcome_event_date
    long: response_label_positive_3d
    """,
    "assignment day, yyyymmdd",
)

RESPONSE_SCORES = _schema(
    """
    string: player_id
    date: score_date
    string: scoring_pt
    timestamp: scoring_ts
    date: snapshot_date
    double: predicted_response_score
    long: score_rank
    double: score_percentile
    string: response_priority_bucket, action_recommendation, vip_level, model_name, model_version, model_reference_path
    double: selected_threshold
    """,
    "scored day, yyyymmdd",
)

MONITORING_DAILY = _schema(
    """
    timestamp: monitor_run_ts
    string: run_label, metric_scope, segment_column, segment_value, monitor_status, scoring_table, reference_pt
    long: partition_present_flag, write_success_flag, row_count, distinct_player_count
    long: duplicate_player_count, duplicate_partition_count, invalid_score_count, metadata_missing_rows
    string: model_name, model_version, model_reference_path
    double: selected_threshold
    long: positive_prediction_count, negative_prediction_count
    double: predicted_positive_rate, predicted_negative_rate
    date: snapshot_date_min, snapshot_date_max
    long: snapshot_date_distinct_count, snapshot_date_lag_days
    double: score_min, score_max, score_mean, score_median, score_std
    double: p01, p05, p10, p25, p50, p75, p90, p95, p99
    string: bucket_distribution_json, vip_distribution_json, score_by_segment_json, eligible_population_json
    long: alert_count
    string: alerts_json
    """,
    "scored day, yyyymmdd",
)

MONITORING_PERFORMANCE = _schema(
    """
    string: assignment_start_date, assignment_end_date
    long: maturity_horizon_days
    string: status, status_reason
    long: row_count, evaluated_row_count, positive_label_count, predicted_positive_count
    long: true_positive_count, false_positive_count, false_negative_count, true_negative_count
    double: precision, recall, f1_score, response_rate_actual, response_rate_predicted
    double: avg_score, avg_score_positive_label, avg_score_negative_label
    double: total_outcome_gross_bet_3d_value, total_outcome_gross_ggr_3d_value
    double: avg_outcome_gross_bet_3d_value, avg_outcome_gross_ggr_3d_value
    double: predicted_positive_total_gross_bet_3d_value, predicted_positive_total_gross_ggr_3d_value
    double: predicted_positive_avg_gross_bet_3d_value, predicted_positive_avg_gross_ggr_3d_value
    double: threshold
    string: model_name, model_version
    timestamp: created_at
    """,
    "scored day, yyyymmdd",
)

MONITORING_ALERTS = _schema(
    """
    timestamp: monitor_run_ts
    string: run_label, mode, severity, check_name, metric_name
    string: observed_value, threshold_value, reference_value, message, context_json
    """,
    "scored day, yyyymmdd",
)

MODEL_RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("iteration_id", T.StringType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("model_path", T.StringType()),
        T.StructField("selected_threshold", T.DoubleType()),
        T.StructField("selected_score_variant", T.StringType()),
        T.StructField("threshold_policy", T.StringType()),
        T.StructField("raw_feature_order", T.ArrayType(T.StringType())),
        T.StructField("transformed_feature_names", T.ArrayType(T.StringType())),
        T.StructField("source_table", T.StringType()),
        T.StructField("target_column", T.StringType()),
        T.StructField("is_champion", T.BooleanType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)

# Retention of each table in days.
LIFECYCLE_DAYS = {
    "response_dataset": 90,
    "response_scores": 90,
    "monitoring_daily": 180,
    "monitoring_performance": 180,
    "monitoring_alerts": 180,
}
TABLES = {
    "response_dataset": RESPONSE_DATASET,
    "response_scores": RESPONSE_SCORES,
    "monitoring_daily": MONITORING_DAILY,
    "monitoring_performance": MONITORING_PERFORMANCE,
    "monitoring_alerts": MONITORING_ALERTS,
}
