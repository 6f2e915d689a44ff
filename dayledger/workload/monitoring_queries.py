"""Queries on daily and performance monitoring, alerts, and the validators of the monitoring tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import alerts as A
from ..operators import contracts as V
from ..operators import monitoring as M
from ..operators import profiling as P
from ..operators.lists import joined_values
from ..sources import fixtures as fx
from . import inputs as I
from .registry import query, rounded

SCORING_TABLE = "response_scores"
RUN_LABEL = "monitoring_20240126"
_S = "predicted_response_score"

_QUANTILES = ", ".join(f"round(quantile_cont({_S}, {q}) + 1e-9, 6) AS {name}" for name, q in M.QUANTILES.items())
_MOMENTS = f"""round(min({_S}) + 1e-9, 6) AS score_min, round(max({_S}) + 1e-9, 6) AS score_max, round(avg({_S}) + 1e-9, 6) AS score_mean,
   round(quantile_cont({_S}, 0.5) + 1e-9, 6) AS score_median, round(stddev_samp({_S}) + 1e-9, 6) AS score_std"""


@query("monitor_distribution", f"SELECT {_MOMENTS}, {_QUANTILES} FROM v_flawed")
def monitor_distribution(spark, sf):
    return rounded(M.monitor_distribution(I.flawed_scores(spark, sf)))


@query(
    "bucket_distribution",
    f"""SELECT response_priority_bucket AS bucket_name, count(player_id) AS row_count,
        count(DISTINCT player_id) AS distinct_player_count, min({_S}) AS score_min, max({_S}) AS score_max,
        round(avg({_S}) + 1e-9, 6) AS score_mean, round(count(player_id) / (sum(count(player_id)) OVER ()) + 1e-9, 6) AS row_share
        FROM v_flawed GROUP BY response_priority_bucket""",
)
def bucket_distribution(spark, sf):
    return rounded(M.bucket_distribution(I.flawed_scores(spark, sf)))


_SEGMENT_SQL = f"""SELECT 'vip_level' AS segment_column, coalesce(vip_level, '__missing__') AS segment_value,
   count(player_id) AS row_count, count(DISTINCT player_id) AS distinct_player_count,
   round(count(player_id) / (sum(count(player_id)) OVER ()) + 1e-9, 6) AS row_share, round(avg({_S}) + 1e-9, 6) AS avg_score,
   round(quantile_cont({_S}, 0.5) + 1e-9, 6) AS median_score FROM v_flawed GROUP BY coalesce(vip_level, '__missing__')"""


@query("segment_distribution", _SEGMENT_SQL)
def segment_distribution(spark, sf):
    return rounded(M.segment_distribution(I.flawed_scores(spark, sf)))


@query(
    "score_by_segment",
    f"""SELECT response_priority_bucket AS bucket_name, 'vip_level' AS segment_column,
        coalesce(vip_level, '__missing__') AS segment_value, count(player_id) AS row_count, round(avg({_S}) + 1e-9, 6) AS avg_score
        FROM v_flawed GROUP BY response_priority_bucket, coalesce(vip_level, '__missing__')""",
)
def score_by_segment(spark, sf):
    return rounded(M.score_by_segment(I.flawed_scores(spark, sf)))


def _eligible_sql(pt: str) -> str:
    return f"""SELECT coalesce(vip_level, '__missing__') AS segment_value, count(*) AS eligible_row_count,
        count(DISTINCT player_id) AS eligible_distinct_player_count, min(snapshot_date) AS snapshot_date_min,
        max(snapshot_date) AS snapshot_date_max FROM fx_feature_mart WHERE pt = '{pt}' AND is_eligible = 1
        GROUP BY coalesce(vip_level, '__missing__')"""


@query("eligible_population", _eligible_sql(I.SCORING_PT))
def eligible_population(spark, sf):
    return P.eligible_population(I.eligible_mart(spark, sf, I.SCORING_PT, I.SCORING_PT))


def _population(spark, sf):
    current, reference = (
        P.eligible_population(I.eligible_mart(spark, sf, pt, pt)) for pt in (I.SCORING_PT, I.REFERENCE_PT)
    )
    return M.population_delta(current, reference)


@query(
    "population_delta",
    f"""SELECT 'vip_level' AS segment_column, coalesce(c.segment_value, r.segment_value) AS segment_value,
        coalesce(c.eligible_row_count, 0) AS eligible_row_count,
        coalesce(c.eligible_distinct_player_count, 0) AS eligible_distinct_player_count,
        coalesce(r.eligible_row_count, 0) AS reference_eligible_row_count,
        coalesce(c.eligible_row_count, 0) - coalesce(r.eligible_row_count, 0) AS eligible_row_delta,
        round((coalesce(c.eligible_row_count, 0) - r.eligible_row_count) / r.eligible_row_count + 1e-9, 6) + 0.0 AS eligible_row_delta_ratio,
        c.snapshot_date_min, c.snapshot_date_max
        FROM ({_eligible_sql(I.SCORING_PT)}) c FULL JOIN ({_eligible_sql(I.REFERENCE_PT)}) r ON c.segment_value = r.segment_value""",
)
def population_delta(spark, sf):
    return rounded(_population(spark, sf))


_FRESHNESS = """min(snapshot_date) AS snapshot_date_min, max(snapshot_date) AS snapshot_date_max,
   count(DISTINCT snapshot_date) AS snapshot_date_distinct_count,
   datediff('day', max(snapshot_date), max(score_date)) AS snapshot_date_lag_days"""


@query("snapshot_freshness", f"SELECT {_FRESHNESS} FROM v_flawed")
def snapshot_freshness(spark, sf):
    return M.snapshot_freshness(I.flawed_scores(spark, sf))


def _joined(column: str) -> str:
    return f"""(SELECT nullif(string_agg(v, ',' ORDER BY v), '') FROM (SELECT DISTINCT {column} AS v FROM v_flawed
        WHERE {column} IS NOT NULL) distinct_values)"""


@query(
    "single_value",
    f"SELECT {', '.join(f'{_joined(c)} AS {c}' for c in ('model_name', 'response_priority_bucket', 'scoring_pt'))}",
)
def single_value(spark, sf):
    names = ["model_name", "response_priority_bucket", "scoring_pt"]
    return joined_values(I.flawed_scores(spark, sf), names)


# --- daily ---------------------------------------------------------------------------------

SEGMENTS = ["vip_level", "action_recommendation"]
_SCOPED = "(" + " UNION ALL ".join(
    [
        "SELECT *, 'global' AS metric_scope, '' AS segcol, '' AS seg FROM v_flawed",
        *(f"SELECT *, 'segment' AS metric_scope, '{c}' AS segcol, coalesce({c}, '__missing__') AS seg FROM v_flawed" for c in SEGMENTS),
    ]
) + ") scoped"
_BAD_SCORE = f"{_S} IS NULL OR {_S} < 0.0 OR {_S} > 1.0"
_NO_LINEAGE = "model_name IS NULL OR model_version IS NULL OR model_reference_path IS NULL OR selected_threshold IS NULL"
_HEALTH = f"""SELECT metric_scope, segcol, seg, count(*) AS row_count, count(DISTINCT player_id) AS distinct_player_count,
   count(*) - count(DISTINCT {{'p': player_id}}) AS duplicate_player_count,
   count(*) - count(DISTINCT {{'p': player_id, 'q': pt}}) AS duplicate_partition_count,
   count(*) FILTER (WHERE {_BAD_SCORE}) AS invalid_score_count,
   count(*) FILTER (WHERE {_NO_LINEAGE}) AS metadata_missing_rows,
   count(*) FILTER (WHERE {_S} >= 0.5) AS positive_prediction_count,
   count(*) - count(*) FILTER (WHERE {_S} >= 0.5) AS negative_prediction_count,
   round(count(*) FILTER (WHERE {_S} >= 0.5) / count(*) + 1e-9, 6) AS predicted_positive_rate,
   round(1 - count(*) FILTER (WHERE {_S} >= 0.5) / count(*) + 1e-9, 6) AS predicted_negative_rate,
   {_FRESHNESS}, {_MOMENTS}, {_QUANTILES} FROM {_SCOPED} GROUP BY metric_scope, segcol, seg"""

_ALERT_INPUT = f"""
SELECT h.*, (SELECT count(*) FROM fx_feature_mart WHERE pt = '20240125' AND is_eligible = 1) AS reference_row_count,
   (SELECT count(*) FILTER (WHERE response_priority_bucket IN ('very_high', 'high')) / count(*) FROM v_flawed WHERE player_id IS NOT NULL) AS top_share,
   (SELECT count(*) FILTER (WHERE vip_level IS NULL) / count(*) FROM v_flawed WHERE player_id IS NOT NULL) AS no_segment
FROM ({_HEALTH}) h WHERE metric_scope = 'global'"""


# Texts of the alerts.
_MESSAGES = {
    ("critical", "empty_or_small_partition"): "The scored partition has fewer rows than the minimum.",
    ("critical", "duplicate_player_ids"): "Players occur more than once.",
    ("critical", "invalid_score_range"): "Scores are absent or outside 0 to 1.",
    ("critical", "missing_model_metadata"): "Rows lack model lineage.",
    ("warning", "snapshot_date_staleness"): "The feature snapshot is old.",
    ("warning", "snapshot_date_dispersion"): "The partition mixes feature snapshots.",
    ("critical", "row_count_drop"): "Far fewer rows than the reference.",
    ("warning", "row_count_drop"): "Fewer rows than the reference.",
    ("warning", "top_bucket_share"): "The share of high-priority rows is out of range.",
    ("warning", "vip_level_missingness"): "Too many rows lack a segment.",
    ("critical", "score_range"): "Scores are no probabilities.",
    ("warning", "insufficient_rows"): "Few rows to evaluate.",
    ("warning", "insufficient_positive_events"): "Few positive labels to evaluate.",
    ("critical", "realized_response_collapse"): "Hardly any response was observed.",
    ("warning", "realized_response_collapse"): "Little response was observed.",
    ("critical", "calibration_gap"): "Scores and response rate are far apart.",
    ("warning", "calibration_gap"): "Scores and response rate drift apart.",
}


def _alert_sql(severity, check, metric, observed, limit, condition, source, reference="NULL"):
    growth = {"0.35": "Far more rows than the reference.", "0.15": "More rows than the reference."}
    message = growth[limit] if check == "row_count_growth" else _MESSAGES[severity, check]
    return f"""SELECT '{message}' AS message, '{severity}' AS severity, '{check}' AS check_name, '{metric}' AS metric_name,
        CAST({observed} AS VARCHAR) AS observed_value, '{limit}' AS threshold_value,
        CAST({reference} AS VARCHAR) AS reference_value FROM {source} WHERE {condition}"""


_EXACT = "(row_count - reference_row_count) / reference_row_count"
_CHANGE = f"round({_EXACT}, 6)"
_RULES = [
    ("critical", "empty_or_small_partition", "row_count", "row_count", "1", "row_count < 1"),
    ("critical", "duplicate_player_ids", "duplicate_player_count", "duplicate_player_count", "1", "duplicate_player_count >= 1"),
    ("critical", "invalid_score_range", "invalid_score_count", "invalid_score_count", "1", "invalid_score_count >= 1"),
    ("critical", "missing_model_metadata", "metadata_missing_rows", "metadata_missing_rows", "0", "metadata_missing_rows > 0"),
    ("warning", "snapshot_date_staleness", "snapshot_date_lag_days", "snapshot_date_lag_days", "3", "snapshot_date_lag_days > 3"),
    ("warning", "snapshot_date_dispersion", "snapshot_date_distinct_count", "snapshot_date_distinct_count", "2",
     "snapshot_date_distinct_count > 2"),
    ("critical", "row_count_drop", "row_count_delta_ratio", _CHANGE, "-0.25", f"{_EXACT} <= -0.25", "reference_row_count"),
    ("warning", "row_count_drop", "row_count_delta_ratio", _CHANGE, "-0.1", f"{_EXACT} <= -0.1 AND {_EXACT} > -0.25",
     "reference_row_count"),
    ("warning", "row_count_growth", "row_count_delta_ratio", _CHANGE, "0.35", f"{_EXACT} >= 0.35", "reference_row_count"),
    ("warning", "row_count_growth", "row_count_delta_ratio", _CHANGE, "0.15", f"{_EXACT} >= 0.15 AND {_EXACT} < 0.35",
     "reference_row_count"),
    ("warning", "top_bucket_share", "top_bucket_share", "round(top_share, 6)", "[0.01, 0.7]", "top_share < 0.01 OR top_share > 0.70"),
    ("warning", "vip_level_missingness", "vip_missing_rate", "round(no_segment, 6)", "0.05", "no_segment > 0.05"),
    ("critical", "score_range", "score_min_max", "concat(score_min, '..', score_max)", "[0.0, 1.0]", "score_min < 0.0 OR score_max > 1.0"),
]


def _alerts_sql(rules: list[tuple], source: str) -> str:
    return " UNION ALL ".join(_alert_sql(*r[:6], source, *r[6:]) for r in rules)


_DAILY_ALERTS_TOLD = _alerts_sql(_RULES, f"({_ALERT_INPUT}) i")
_DAILY_ALERTS = f"SELECT * EXCLUDE (message) FROM ({_DAILY_ALERTS_TOLD}) told"
_SHOWN = ["severity", "check_name", "metric_name", "observed_value", "threshold_value", "reference_value"]


def _daily_inputs(spark, sf, scored=None):
    cube = M.PartitionCube(I.flawed_scores(spark, sf, scored), I.THRESHOLD)
    return M.alert_inputs(cube, cube.metrics(), I.reference_row_count(spark, sf))


@query("daily_alerts", _DAILY_ALERTS)
def daily_alerts(spark, sf):
    return A.daily_alerts(_daily_inputs(spark, sf)).select(*_SHOWN)


def _monitored(spark, sf):
    return M.monitor_daily(
        I.flawed_scores(spark, sf),
        I.SCORING_PT,
        threshold=I.THRESHOLD,
        reference_pt=I.REFERENCE_PT,
        reference_row_count=I.reference_row_count(spark, sf),
        population=_population(spark, sf),
        run_ts=I.RUN_TS,
        run_label=RUN_LABEL,
        scoring_table=SCORING_TABLE,
        segments=SEGMENTS,
    )


# --- the lists of the daily table, as sorted lines ------------------------------------------

#: Fields of each list: text, whole numbers (n) and doubles (d).
_LISTS = {
    "bucket_distribution_json": "bucket_name row_count:n distinct_player_count:n row_share:d score_min:d score_max:d score_mean:d",
    "vip_distribution_json": "segment_column segment_value row_count:n distinct_player_count:n row_share:d avg_score:d median_score:d",
    "score_by_segment_json": "segment_column segment_value bucket_name row_count:n avg_score:d",
    "eligible_population_json": "segment_column segment_value eligible_row_count:n eligible_distinct_player_count:n reference_eligible_row_count:n "
    "eligible_row_delta:n eligible_row_delta_ratio:d snapshot_date_min snapshot_date_max",
    "alerts_json": "severity check_name metric_name observed_value threshold_value reference_value message context_json",
}


def _fields(name: str) -> list[tuple[str, str]]:
    return [(f.split(":")[0], {"n": "bigint", "d": "double"}.get(f.partition(":")[2], "string")) for f in _LISTS[name].split()]


def _lines(name: str) -> str:
    """SQL: the row as a line."""
    shown = [f"format('{{:.6f}}', round({f} + 1e-9, 6) + 0.0)" if t == "double" else f"CAST({f} AS VARCHAR)" for f, t in _fields(name)]
    return f"concat_ws('|', {', '.join(f'coalesce({x}, {chr(39)}-{chr(39)})' for x in shown)})"


def _listed(name: str, rows: str, where: str = "true") -> str:
    return f"(SELECT string_agg({_lines(name)}, ';' ORDER BY {_lines(name)}) FROM ({rows}) listed WHERE {where})"


def with_lines(table):
    """The JSON lists of the daily table as sorted lines: their rows and values, whatever the spelling of the text."""

    def shown(x, f, t):
        value = F.format_string("%.6f", F.round(x[f] + 1e-9, 6) + 0.0) if t == "double" else x[f].cast("string")
        return F.when(x[f].isNull(), "-").otherwise(value)

    def line(name):
        return lambda x: F.concat_ws("|", *[shown(x, f, t) for f, t in _fields(name)])

    for name in _LISTS:
        schema = "array<struct<" + ", ".join(f"{f}: {t}" for f, t in _fields(name)) + ">>"
        lines = F.transform(F.from_json(name, schema), line(name))
        table = table.withColumn(name, F.nullif(F.array_join(F.array_sort(lines), ";"), F.lit("")))
    return table


_BY_BUCKET = f"""SELECT metric_scope, segcol AS segment_column, seg AS segment_value, response_priority_bucket AS bucket_name, count(player_id) AS row_count,
   count(DISTINCT player_id) AS distinct_player_count, count(player_id) / sum(count(player_id)) OVER (PARTITION BY metric_scope, segcol, seg) AS row_share,
   min({_S}) AS score_min, max({_S}) AS score_max, avg({_S}) AS score_mean, avg({_S}) AS avg_score
   FROM {_SCOPED} GROUP BY metric_scope, segcol, seg, response_priority_bucket"""
_BY_SEGMENT = f"""SELECT segcol AS segment_column, seg AS segment_value, count(player_id) AS row_count, count(DISTINCT player_id) AS distinct_player_count,
   count(player_id) / sum(count(player_id)) OVER (PARTITION BY segcol) AS row_share, avg({_S}) AS avg_score, quantile_cont({_S}, 0.5) AS median_score
   FROM {_SCOPED} WHERE metric_scope = 'segment' GROUP BY segcol, seg"""
_POPULATION = f"""SELECT 'vip_level' AS segment_column, coalesce(c.segment_value, r.segment_value) AS segment_value, coalesce(c.eligible_row_count, 0) AS eligible_row_count,
   coalesce(c.eligible_distinct_player_count, 0) AS eligible_distinct_player_count, coalesce(r.eligible_row_count, 0) AS reference_eligible_row_count,
   coalesce(c.eligible_row_count, 0) - coalesce(r.eligible_row_count, 0) AS eligible_row_delta,
   (coalesce(c.eligible_row_count, 0) - r.eligible_row_count) / r.eligible_row_count AS eligible_row_delta_ratio, c.snapshot_date_min, c.snapshot_date_max
   FROM ({_eligible_sql(I.SCORING_PT)}) c FULL JOIN ({_eligible_sql(I.REFERENCE_PT)}) r ON c.segment_value = r.segment_value"""
_IN_SCOPE = "listed.metric_scope = h.metric_scope AND listed.segment_column = h.segcol AND listed.segment_value = h.seg"
_GLOBAL_LISTS = {
    "vip_distribution_json": _BY_SEGMENT,
    "score_by_segment_json": f"SELECT * FROM ({_BY_BUCKET}) b WHERE metric_scope = 'segment'",
    "eligible_population_json": _POPULATION,
    "alerts_json": f"SELECT *, '{{}}' AS context_json FROM ({_DAILY_ALERTS_TOLD}) told",
}


@query(
    "monitor_daily",
    f"""SELECT h.* EXCLUDE (seg, segcol), {_listed('bucket_distribution_json', _BY_BUCKET, _IN_SCOPE)} AS bucket_distribution_json,
        {', '.join(f"CASE WHEN h.metric_scope = 'global' THEN {_listed(n, rows)} END AS {n}" for n, rows in _GLOBAL_LISTS.items())},
        CASE WHEN h.metric_scope = 'segment' THEN h.segcol END AS segment_column,
        CASE WHEN h.metric_scope = 'segment' THEN h.seg END AS segment_value,
        CASE WHEN h.metric_scope = 'segment' THEN 'ok' ELSE (SELECT CASE WHEN bool_or(severity = 'critical') THEN 'critical'
             WHEN bool_or(severity = 'warning') THEN 'warning' ELSE 'ok' END FROM ({_DAILY_ALERTS}) a) END AS monitor_status,
        TIMESTAMP '2024-01-27 02:00:00' AS monitor_run_ts, '{RUN_LABEL}' AS run_label, '{SCORING_TABLE}' AS scoring_table,
        '20240125' AS reference_pt, 1::BIGINT AS partition_present_flag, 1::BIGINT AS write_success_flag,
        {', '.join(f'{_joined(c)} AS {c}' for c in ('model_name', 'model_version', 'model_reference_path'))},
        0.5::DOUBLE AS selected_threshold,
        CASE WHEN h.metric_scope = 'segment' THEN 0 ELSE (SELECT count(*) FROM ({_DAILY_ALERTS}) a) END AS alert_count,
        '20240126' AS pt FROM ({_HEALTH}) h""",
)
def monitor_daily(spark, sf):
    """All 48 columns for two segment columns; the lists as sorted lines."""
    return rounded(with_lines(_monitored(spark, sf)[0]))


@query(
    "missing_partition_alert",
    """SELECT 'critical' AS severity, 'missing_prediction_partition' AS check_name, 'partition_present_flag' AS metric_name,
       '0' AS observed_value, '1' AS threshold_value, '20240126' AS reference_value
       WHERE NOT EXISTS (SELECT 1 FROM v_listing WHERE pt = '20240202')""",
)
def missing_partition_alert(spark, sf):
    listing = fx.partition_days(spark, sf)
    return A.missing_partition_alert(listing, "20240202", I.SCORING_PT, SCORING_TABLE).select(*_SHOWN)


@query(
    "prediction_partition_summary",
    f"""SELECT '20240126' AS pt, count(*) > 0 AS partition_exists, count(*) AS row_count, min({_S}) AS score_min,
        max({_S}) AS score_max, count(*) FILTER (WHERE {_S} >= 0.5) AS predicted_positive_count FROM v_flawed""",
)
def prediction_partition_summary(spark, sf):
    return M.prediction_partition_summary(I.flawed_scores(spark, sf), I.SCORING_PT, I.THRESHOLD)


# --- performance ---------------------------------------------------------------------------

_HIT = f"{_S} >= selected_threshold"
_MEASURES = f"""count(*) AS row_count, count(*) FILTER (WHERE label = 1) AS positive_label_count,
   count(*) FILTER (WHERE {_HIT}) AS predicted_positive_count,
   count(*) FILTER (WHERE {_HIT} AND label = 1) AS true_positive_count,
   count(*) FILTER (WHERE {_HIT} AND label = 0) AS false_positive_count,
   count(*) FILTER (WHERE NOT ({_HIT}) AND label = 1) AS false_negative_count,
   count(*) FILTER (WHERE NOT ({_HIT}) AND label = 0) AS true_negative_count,
   round(avg({_S}) + 1e-9, 6) AS avg_score, round(avg({_S}) FILTER (WHERE label = 1) + 1e-9, 6) AS avg_score_positive_label,
   round(avg({_S}) FILTER (WHERE label = 0) + 1e-9, 6) AS avg_score_negative_label,
   round(sum(bet) + 1e-9, 6) AS total_outcome_gross_bet_3d_value, round(sum(ggr) + 1e-9, 6) AS total_outcome_gross_ggr_3d_value,
   round(avg(bet) + 1e-9, 6) AS avg_outcome_gross_bet_3d_value, round(avg(ggr) + 1e-9, 6) AS avg_outcome_gross_ggr_3d_value,
   round(coalesce(sum(bet) FILTER (WHERE {_HIT}), 0.0) + 1e-9, 6) AS predicted_positive_total_gross_bet_3d_value,
   round(coalesce(sum(ggr) FILTER (WHERE {_HIT}), 0.0) + 1e-9, 6) AS predicted_positive_total_gross_ggr_3d_value,
   round(avg(bet) FILTER (WHERE {_HIT}) + 1e-9, 6) AS predicted_positive_avg_gross_bet_3d_value,
   round(avg(ggr) FILTER (WHERE {_HIT}) + 1e-9, 6) AS predicted_positive_avg_gross_ggr_3d_value,
   min(selected_threshold) AS threshold,
   round(coalesce(count(*) FILTER (WHERE {_HIT} AND label = 1) / nullif(count(*) FILTER (WHERE {_HIT}), 0), 0.0) + 1e-9, 6) AS "precision",
   round(coalesce(count(*) FILTER (WHERE {_HIT} AND label = 1) / nullif(count(*) FILTER (WHERE label = 1), 0), 0.0) + 1e-9, 6) AS recall,
   round(coalesce(2 * count(*) FILTER (WHERE {_HIT} AND label = 1)
         / nullif(count(*) FILTER (WHERE {_HIT}) + count(*) FILTER (WHERE label = 1), 0), 0.0) + 1e-9, 6) AS f1_score,
   round(count(*) FILTER (WHERE label = 1) / count(*) + 1e-9, 6) AS response_rate_actual,
   round(count(*) FILTER (WHERE {_HIT}) / count(*) + 1e-9, 6) AS response_rate_predicted"""

_EVALUATED = f"""SELECT {_MEASURES}, count(*) AS evaluated_row_count, '20240126' AS assignment_start_date,
   '20240126' AS assignment_end_date, 7::BIGINT AS maturity_horizon_days, 'evaluated' AS status, NULL::VARCHAR AS status_reason,
   'fixed_logit' AS model_name, 'fixed__fixed_logit__v1' AS model_version,
   TIMESTAMP '2024-01-27 02:00:00' AS created_at, '20240126' AS pt FROM v_observed"""
_ZEROS = ", ".join(
    f"0::BIGINT AS {c}"
    for c in (
        "row_count",
        "evaluated_row_count",
        "positive_label_count",
        "predicted_positive_count",
        "true_positive_count",
        "false_positive_count",
        "false_negative_count",
        "true_negative_count",
    )
)


def _performance(spark, sf, scored=None):
    return M.monitor_performance(I.observed(spark, sf, scored=scored), I.SCORING_PT, labels_mature=True, run_ts=I.RUN_TS)


@query(
    "monitor_performance",
    f"""SELECT * FROM ({_EVALUATED}) e UNION ALL BY NAME
        SELECT {_ZEROS}, '20240128' AS assignment_start_date, '20240128' AS assignment_end_date,
        7::BIGINT AS maturity_horizon_days, 'not_evaluable' AS status, 'labels_not_mature' AS status_reason,
        TIMESTAMP '2024-01-27 02:00:00' AS created_at, '20240128' AS pt""",
)
def monitor_performance(spark, sf):
    """A mature partition next to an immature one."""
    immature = M.monitor_performance(
        I.audience(spark, sf, I.IMMATURE_PT), I.IMMATURE_PT, labels_mature=False, run_ts=I.RUN_TS
    )
    return rounded(_performance(spark, sf).unionByName(immature))


_GAP = "abs(avg_s - rate)"
_PERFORMANCE_RULES = [
    ("warning", "insufficient_rows", "row_count", "row_count", "1000", "row_count < 1000"),
    ("warning", "insufficient_positive_events", "positive_label_count", "positive_label_count", "25", "positive_label_count < 25"),
    ("critical", "realized_response_collapse", "response_rate_actual", "round(rate, 6)", "0.005", "rate <= 0.005"),
    ("warning", "realized_response_collapse", "response_rate_actual", "round(rate, 6)", "0.01", "rate <= 0.01 AND rate > 0.005"),
    ("critical", "calibration_gap", "avg_score_vs_actual_response_rate_gap", f"round({_GAP}, 6)", "0.15", f"{_GAP} >= 0.15"),
    ("warning", "calibration_gap", "avg_score_vs_actual_response_rate_gap", f"round({_GAP}, 6)", "0.08",
     f"{_GAP} >= 0.08 AND {_GAP} < 0.15"),
]
_PERFORMANCE_INPUT = f"""(SELECT count(*) AS row_count, sum(label)::BIGINT AS positive_label_count, avg({_S}) AS avg_s,
   avg(label) AS rate FROM v_observed) i"""
_PERFORMANCE_ALERTS_TOLD = _alerts_sql(_PERFORMANCE_RULES, _PERFORMANCE_INPUT)
_PERFORMANCE_ALERTS = f"SELECT * EXCLUDE (message) FROM ({_PERFORMANCE_ALERTS_TOLD}) told"


@query("performance_alerts", _PERFORMANCE_ALERTS)
def performance_alerts(spark, sf):
    return A.performance_alerts(_performance(spark, sf)).select(*_SHOWN)


@query(
    "alerts_table",
    f"""SELECT TIMESTAMP '2024-01-27 02:00:00' AS monitor_run_ts, '{RUN_LABEL}' AS run_label, mode, severity, check_name,
        metric_name, observed_value, threshold_value, reference_value, message, '{{}}' AS context_json, '20240126' AS pt
        FROM (SELECT 'daily' AS mode, * FROM ({_DAILY_ALERTS_TOLD}) d
              UNION ALL SELECT 'performance' AS mode, * FROM ({_PERFORMANCE_ALERTS_TOLD}) p) a""",
)
def alerts_table(spark, sf):
    scored = I.scores(spark, sf)  # ranked once: both parts read its files
    daily = A.alert_rows(A.daily_alerts(_daily_inputs(spark, sf, scored)), I.SCORING_PT, "daily", RUN_LABEL, I.RUN_TS)
    late = A.alert_rows(A.performance_alerts(_performance(spark, sf, scored)), I.SCORING_PT, "performance", RUN_LABEL, I.RUN_TS)
    return daily.unionByName(late)



def _performance_by_sql(key: str) -> str:
    return f"""SELECT *, row_count >= 100 AS sufficient FROM (SELECT coalesce({key}, '__missing__') AS {key}, {_MEASURES}
        FROM v_observed GROUP BY coalesce({key}, '__missing__')) g"""


@query("performance_by_bucket", _performance_by_sql("response_priority_bucket"))
def performance_by_bucket(spark, sf):
    return rounded(M.performance_by(I.observed(spark, sf), "response_priority_bucket"))


@query("performance_by_segment", _performance_by_sql("vip_level"))
def performance_by_segment(spark, sf):
    return rounded(M.performance_by(I.observed(spark, sf), "vip_level"))


@query(
    "calibration",
    f"""SELECT response_priority_bucket, count(*) AS row_count, round(avg({_S}) + 1e-9, 6) AS avg_score,
        round(avg(label) + 1e-9, 6) AS response_rate_actual, round(abs(avg({_S}) - avg(label)) + 1e-9, 6) AS calibration_gap
        FROM v_observed GROUP BY response_priority_bucket""",
)
def calibration(spark, sf):
    return rounded(M.calibration(I.observed(spark, sf)))


# --- validators ----------------------------------------------------------------------------


@query(
    "validate_monitor_daily",
    f"""SELECT '20240126' AS pt, count(*) AS monitoring_rows, 0::BIGINT AS invalid_metric_scope_rows,
        0::BIGINT AS missing_segment_identity_rows, 0::BIGINT AS missing_run_ts_rows, 0::BIGINT AS missing_run_label_rows,
        count(*) FILTER (WHERE row_count <= 0) AS non_positive_row_count_rows,
        count(*) FILTER (WHERE distinct_player_count <= 0) AS non_positive_distinct_player_rows,
        count(*) FILTER (WHERE score_min < 0.0 OR score_max > 1.0) AS invalid_score_range_rows,
        0::BIGINT AS missing_bucket_distribution_rows,
        count(*) FILTER (WHERE metric_scope = 'segment') AS missing_vip_distribution_rows FROM ({_HEALTH}) h""",
)
def validate_monitor_daily(spark, sf):
    return V.validate_monitor_daily(_monitored(spark, sf)[0])


_NONE = ", ".join(
    f"0::BIGINT AS {c}"
    for c in (
        "negative_row_count_rows",
        "negative_evaluated_row_count_rows",
        "negative_positive_label_count_rows",
        "negative_predicted_positive_count_rows",
        "invalid_precision_rows",
        "invalid_recall_rows",
        "invalid_f1_rows",
        "invalid_actual_response_rate_rows",
        "invalid_predicted_response_rate_rows",
        "invalid_threshold_rows",
        "missing_model_name_rows",
        "missing_model_version_rows",
    )
)


@query(
    "validate_monitor_perf",
    f"""SELECT pt, count(*) AS performance_rows, {_NONE},
        count(*) FILTER (WHERE avg_score < 0.0 OR avg_score > 1.0) AS invalid_avg_score_rows FROM ({_EVALUATED}) e GROUP BY pt""",
)
def validate_monitor_perf(spark, sf):
    return V.validate_monitor_performance(_performance(spark, sf))


@query(
    "validate_alerts",
    f"""SELECT '20240126' AS pt, count(*) AS alert_rows, count(*) FILTER (WHERE severity NOT IN ('warning', 'critical')) AS invalid_severity_rows,
        0::BIGINT AS invalid_mode_rows, 0::BIGINT AS missing_check_name_rows, 0::BIGINT AS missing_message_rows
        FROM ({_DAILY_ALERTS}) d""",
)
def validate_alerts(spark, sf):
    daily = A.daily_alerts(_daily_inputs(spark, sf))
    return V.validate_alerts(A.alert_rows(daily, I.SCORING_PT, "daily", RUN_LABEL, I.RUN_TS))
