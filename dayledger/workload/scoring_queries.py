"""Queries on scoring, ranks, buckets, score summaries and the score contracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import contracts as V
from ..operators import scoring as C
from . import inputs as I
from .registry import query, rounded, rounded_sql

_IN_BUCKETS = "('very_low', 'low', 'medium', 'high', 'very_high')"
_SCORE_DOUBLES = ["score_percentile"]


@query(
    "scoring_audience",
    """SELECT player_id, snapshot_date, vip_level, recent_bet_cnt_7d::DOUBLE AS recent_bet_cnt_7d,
       round(recent_bet_amt_7d + 1e-9, 6) AS recent_bet_amt_7d, recency_last_bet_to_t::DOUBLE AS recency_last_bet_to_t,
       round(recent_net_cash_in_7d + 1e-9, 6) + 0.0 AS recent_net_cash_in_7d, pt
       FROM fx_feature_mart WHERE pt = '20240126' AND is_eligible = 1 AND player_id IS NOT NULL""",
)
def scoring_audience(spark, sf):
    features = ["recent_bet_cnt_7d", "recent_bet_amt_7d", "recency_last_bet_to_t", "recent_net_cash_in_7d"]
    table = I.eligible_mart(spark, sf, I.SCORING_PT, I.SCORING_PT)
    return rounded(C.scoring_audience(table, I.SCORING_PT, features))


@query(
    "score_rank",
    rounded_sql("SELECT player_id, predicted_response_score, score_rank, score_percentile FROM v_scores", _SCORE_DOUBLES),
)
def score_rank(spark, sf):
    slim = I.audience(spark, sf).select("player_id", C.SCORE)
    return rounded(C.rank_scores(slim).select("player_id", C.SCORE, "score_rank", "score_percentile"))


@query("priority_buckets", "SELECT player_id, predicted_response_score, response_priority_bucket FROM v_scores")
def priority_buckets(spark, sf):
    ranked = C.rank_scores(I.audience(spark, sf).select("player_id", C.SCORE))
    bucket = C.priority_bucket(C.bucket_thresholds(ranked)).alias("response_priority_bucket")
    return ranked.select("player_id", C.SCORE, bucket)


@query("score_partition", rounded_sql("SELECT * FROM v_scores", _SCORE_DOUBLES))
def score_partition(spark, sf):
    return rounded(I.scores(spark, sf))


@query(
    "action_recommendation",
    """SELECT response_priority_bucket, vip_level, action_recommendation, count(*) AS row_count FROM v_scores
       GROUP BY response_priority_bucket, vip_level, action_recommendation""",
)
def action_recommendation(spark, sf):
    keys = ["response_priority_bucket", "vip_level", "action_recommendation"]
    return I.scores(spark, sf).groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))


_DISTRIBUTION = {
    "min": "min({s})",
    "p10": "quantile_cont({s}, 0.1)",
    "p25": "quantile_cont({s}, 0.25)",
    "p50": "quantile_cont({s}, 0.5)",
    "p75": "quantile_cont({s}, 0.75)",
    "p90": "quantile_cont({s}, 0.9)",
    "max": "max({s})",
    "mean": "avg({s})",
    "std": "stddev_samp({s})",
}


@query(
    "score_distribution",
    " UNION ALL ".join(
        f"SELECT '{name}' AS metric, round({sql.format(s='predicted_response_score')} + 1e-9, 6) AS value FROM v_audience WHERE pt = '20240126'"
        for name, sql in _DISTRIBUTION.items()
    ),
)
def score_distribution(spark, sf):
    return rounded(C.score_distribution(I.audience(spark, sf)))


@query(
    "prediction_volume",
    """SELECT count(*) FILTER (WHERE predicted_response_score >= 0.5) AS positive_prediction_count,
       count(*) FILTER (WHERE predicted_response_score < 0.5) AS negative_prediction_count,
       round(avg(CASE WHEN predicted_response_score >= 0.5 THEN 1.0 ELSE 0.0 END) + 1e-9, 6) AS predicted_positive_rate,
       round(1 - avg(CASE WHEN predicted_response_score >= 0.5 THEN 1.0 ELSE 0.0 END) + 1e-9, 6) AS predicted_negative_rate
       FROM v_audience WHERE pt = '20240126'""",
)
def prediction_volume(spark, sf):
    return rounded(C.prediction_volume(I.audience(spark, sf), I.THRESHOLD))


@query(
    "bucket_summary",
    """SELECT response_priority_bucket, count(*) AS row_count, min(predicted_response_score) AS min_score,
       max(predicted_response_score) AS max_score, round(avg(predicted_response_score) + 1e-9, 6) AS avg_score,
       round(count(*) / (sum(count(*)) OVER ()) + 1e-9, 6) AS population_share FROM v_scores GROUP BY response_priority_bucket""",
)
def bucket_summary(spark, sf):
    return rounded(C.bucket_summary(I.scores(spark, sf)))


@query(
    "bucket_segment_mix",
    """SELECT response_priority_bucket, coalesce(vip_level, '__NULL__') AS vip_level, count(*) AS row_count,
       round(count(*) / (sum(count(*)) OVER (PARTITION BY response_priority_bucket)) + 1e-9, 6) AS bucket_share
       FROM v_scores GROUP BY response_priority_bucket, coalesce(vip_level, '__NULL__')""",
)
def bucket_segment_mix(spark, sf):
    return rounded(C.bucket_segment_mix(I.scores(spark, sf)))


# --- contracts -----------------------------------------------------------------------------


def _count(condition: str, name: str) -> str:
    return f"count(*) FILTER (WHERE {condition}) AS {name}"


def _blank(column: str) -> str:
    return f"{column} IS NULL OR trim({column}) = ''"


_OUT_OF_RANGE = "predicted_response_score < 0.0 OR predicted_response_score > 1.0"
_CONTRACT = ", ".join(
    [
        _count(_blank("player_id"), "player_id_missing_rows"),
        _count("predicted_response_score IS NULL", "score_missing_rows"),
        _count(_OUT_OF_RANGE, "score_out_of_range_rows"),
        _count(_blank("response_priority_bucket"), "bucket_missing_rows"),
        _count(f"response_priority_bucket NOT IN {_IN_BUCKETS}", "invalid_bucket_rows"),
        _count("score_date IS NULL", "score_date_missing_rows"),
        _count(_blank("scoring_pt"), "scoring_pt_missing_rows"),
        _count("scoring_pt <> '20240126'", "scoring_pt_mismatch_rows"),
        _count("scoring_ts IS NULL", "scoring_ts_missing_rows"),
        _count("snapshot_date IS NULL", "snapshot_date_missing_rows"),
        _count(_blank("model_name"), "model_name_missing_rows"),
        _count(_blank("model_version"), "model_version_missing_rows"),
        _count(_blank("model_reference_path"), "model_reference_path_missing_rows"),
        _count("selected_threshold IS NULL", "selected_threshold_missing_rows"),
    ]
)
_REPEATED = """(SELECT count(*) FROM (SELECT player_id FROM {rows} WHERE player_id IS NOT NULL
                 GROUP BY player_id HAVING count(*) > 1) repeated)"""
_PRE_ROWS = "(SELECT * FROM v_flawed WHERE scoring_pt = '20240126') pre_rows"


@query(
    "prewrite_contract",
    f"""SELECT '20240126' AS scoring_pt, count(*) AS total_rows,
        (CASE WHEN count(*) > 0 THEN 0 ELSE 1 END)::BIGINT AS empty_output_violation_rows,
        count(*) - count(DISTINCT player_id) AS duplicate_player_id_rows,
        {_REPEATED.format(rows=_PRE_ROWS)} AS duplicate_player_id_groups, {_CONTRACT} FROM {_PRE_ROWS}""",
)
def prewrite_contract(spark, sf):
    return V.prewrite_contract(I.flawed_scores(spark, sf), I.SCORING_PT)


@query(
    "postwrite_contract",
    f"""SELECT '20240126' AS scoring_pt, count(*) AS row_count,
        count(*) - count(DISTINCT player_id) AS duplicate_player_id_rows,
        {_REPEATED.format(rows='v_flawed')} AS duplicate_player_id_groups, {_CONTRACT},
        {_count(_blank('action_recommendation'), 'action_recommendation_missing_rows')},
        {_count("pt <> '20240126'", 'partition_mismatch_rows')} FROM v_flawed""",
)
def postwrite_contract(spark, sf):
    return V.postwrite_contract(I.flawed_scores(spark, sf), I.SCORING_PT)


_EXTRA_ALL = """(SELECT coalesce(sum(n), 0)::BIGINT FROM (SELECT count(*) AS n FROM v_flawed GROUP BY {keys} HAVING count(*) > 1) g)"""
_EXTRA = """(SELECT coalesce(sum(n - 1), 0)::BIGINT FROM (SELECT count(*) AS n FROM v_flawed GROUP BY {keys}) g)"""


@query(
    "prewrite_gate",
    f"""SELECT count(*) AS row_count, {_EXTRA_ALL.format(keys='player_id')} AS duplicate_player_id_rows,
        {_EXTRA_ALL.format(keys='player_id, pt')} AS duplicate_partition_rows,
        {_count(f'predicted_response_score IS NULL OR {_OUT_OF_RANGE}', 'invalid_score_rows')},
        {_count(f'response_priority_bucket IS NULL OR response_priority_bucket NOT IN {_IN_BUCKETS}', 'invalid_bucket_rows')},
        {', '.join(_count(f'{c} IS NULL', f'null_{c}') for c in V.CRITICAL_COLUMNS)},
        {_count("scoring_pt <> '20240126'", 'wrong_scoring_pt_rows')}, {_count("pt <> '20240126'", 'wrong_pt_rows')},
        {_count("score_date <> DATE '2024-01-26'", 'wrong_score_date_rows')} FROM v_flawed""",
)
def prewrite_gate(spark, sf):
    return V.prewrite_gate(I.flawed_scores(spark, sf), I.SCORING_PT)


@query(
    "score_counts",
    """SELECT pt, count(*) AS row_count, count(DISTINCT player_id) AS distinct_player_id_count,
       count(*) - count(DISTINCT player_id) AS duplicate_player_id_rows, min(score_date) AS min_score_date,
       max(score_date) AS max_score_date, min(snapshot_date) AS min_snapshot_date, max(snapshot_date) AS max_snapshot_date
       FROM v_flawed GROUP BY pt""",
)
def score_counts(spark, sf):
    return V.score_counts(I.flawed_scores(spark, sf), I.SCORING_PT)


@query(
    "duplicate_players",
    """SELECT player_id, count(*) AS duplicate_row_count FROM v_flawed GROUP BY player_id HAVING count(*) > 1
       ORDER BY duplicate_row_count DESC, player_id NULLS FIRST""",
)
def duplicate_players(spark, sf):
    return V.duplicate_players(I.flawed_scores(spark, sf))


@query(
    "score_nulls",
    "SELECT count(*) AS total_rows, "
    + ", ".join(
        [
            _count(f"{c} IS NULL", f"{c}_null_rows")
            for c in (
                "score_date",
                "scoring_ts",
                "snapshot_date",
                "predicted_response_score",
                "score_rank",
                "score_percentile",
                "selected_threshold",
            )
        ]
        + [
            _count(_blank(c), f"{c}_null_or_blank_rows")
            for c in ("player_id", "scoring_pt", "response_priority_bucket", "action_recommendation", "model_name")
        ]
    )
    + " FROM v_flawed",
)
def score_nulls(spark, sf):
    return V.score_nulls(I.flawed_scores(spark, sf), I.SCORING_PT)


@query(
    "score_ranges",
    f"""SELECT count(*) AS total_rows, {_count('predicted_response_score < 0.0', 'score_below_zero_rows')},
        {_count('predicted_response_score > 1.0', 'score_above_one_rows')},
        {_count('score_percentile < 0.0', 'percentile_below_zero_rows')},
        {_count('score_percentile > 1.0', 'percentile_above_one_rows')},
        {_count(f'response_priority_bucket NOT IN {_IN_BUCKETS}', 'invalid_bucket_rows')} FROM v_flawed""",
)
def score_ranges(spark, sf):
    return V.score_ranges(I.flawed_scores(spark, sf), I.SCORING_PT)


@query(
    "score_lineage",
    f"""SELECT count(*) AS total_rows, {_count(_blank('model_name'), 'model_name_missing_rows')},
        {_count(_blank('model_version'), 'model_version_missing_rows')},
        {_count(_blank('model_reference_path'), 'model_reference_path_missing_rows')},
        {_count('selected_threshold IS NULL', 'selected_threshold_missing_rows')} FROM v_flawed""",
)
def score_lineage(spark, sf):
    return V.lineage_completeness(I.flawed_scores(spark, sf), I.SCORING_PT)


@query(
    "score_lineage_combinations",
    """SELECT model_name, model_version, selected_threshold, count(*) AS row_count FROM v_flawed
       GROUP BY model_name, model_version, selected_threshold""",
)
def score_lineage_combinations(spark, sf):
    return V.lineage_combinations(I.flawed_scores(spark, sf), I.SCORING_PT)


@query(
    "scored_input_check",
    f"""SELECT count(*) AS row_count, {_EXTRA.format(keys='player_id')} AS duplicate_player_count,
        {_EXTRA.format(keys='player_id, pt')} AS duplicate_partition_count,
        {_count(f'predicted_response_score IS NULL OR {_OUT_OF_RANGE}', 'invalid_score_count')},
        {_count("pt <> '20240126'", 'unexpected_pt_rows')}, {_count("scoring_pt <> '20240126'", 'unexpected_scoring_pt_rows')}
        FROM v_flawed""",
)
def scored_input_check(spark, sf):
    return V.scored_input_check(I.flawed_scores(spark, sf), I.SCORING_PT)


@query(
    "observed_input_check",
    """SELECT count(*) AS row_count, count(*) - count(DISTINCT (player_id, pt)) AS duplicate_rows FROM v_observed""",
)
def observed_input_check(spark, sf):
    return V.observed_input_check(I.observed(spark, sf))
