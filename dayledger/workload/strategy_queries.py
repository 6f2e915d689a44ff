"""Queries of the strategy comparison, and their SQL by plain joins of decisions with all later events."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..operators import strategy as S
from ..session import cut_lineage
from ..sources import fixtures as fx
from . import inputs as I
from .registry import query

# Parameters of the registered queries.
OBSERVED_THROUGH = datetime(2024, 1, 30)
BUILD_VERSION = "strategy_v1"
TABLES = {
    "eligibility": "feature_mart", "strategy": "decisions", "score": "response_scores", "treatment": "treatment_log",
    "outcome": "timed_bets", "feature": "feature_mart",
}


def _dataset(spark, sf):
    # snapshots and scores, each looked at by the day and within the day, read the mart four times: it is made once
    shown = ["player_id", "snapshot_date", "is_eligible", "vip_level", "pt"]
    mart = cut_lineage(I.eligible_mart(spark, sf).select(*shown, fx.fixed_score().alias("score")), "mart")
    snapshots = mart.select("player_id", "snapshot_date", "is_eligible", "vip_level", F.lit(None).cast("string").alias("value_segment"))
    scores = mart.select(
        "player_id", (F.to_timestamp_ntz("pt", F.lit("yyyyMMdd")) + F.expr("INTERVAL 2 HOURS")).alias("scoring_ts"),
        "score", F.lit(I.THRESHOLD).alias("selected_threshold"),
    )
    return S.strategy_dataset(
        fx.decisions(spark, sf), fx.treatment_log(spark, sf), fx.timed_bets(spark, sf), snapshots, scores,
        observed_through=OBSERVED_THROUGH, build_version=BUILD_VERSION, build_timestamp=I.RUN_TS, sources=TABLES,
    )


def _as_doubles(df):
    """Money as doubles, which both engines show alike."""
    return df.select(*[F.col(n).cast("double").alias(n) if t.startswith("decimal") else F.col(n) for n, t in df.dtypes])


_SCORE = """round(1 / (1 + exp(-(-0.9 + 0.35 * recent_bet_cnt_7d + 0.001 * recent_bet_amt_7d + 0.1 * recent_dep_cnt_7d
    - 0.05 * coalesce(recency_last_bet_to_t, 0)))), 6)"""

# every decision is joined with all that its player does later, or did before
_DATASET = f"""
WITH decided AS (
    SELECT login_name AS player_id, ts AS decision_timestamp, IF(event_type = 'signup', 'churn_model_based', 'rule_based') AS strategy_group,
           IF(event_type = 'signup', 'churn_v2', 'rules_v1') AS strategy_version, IF(k % 3 = 0, 0, 1)::BIGINT AS selected_flag,
           concat(event_type, '_', k % 5) AS selection_reason_code
    FROM fx_events WHERE event_type = 'signup' OR event_type = 'error'
), followed AS (
    SELECT a.*, (SELECT min(b.decision_timestamp) FROM decided b WHERE b.player_id = a.player_id AND b.decision_timestamp > a.decision_timestamp) AS following
    FROM decided a
), sent AS (
    SELECT login_name, IF(event_type = 'click' AND k % 3 = 0, ts + INTERVAL 1 HOUR, ts) AS treatment_timestamp,
           IF(event_type = 'click', 'voucher', 'sms') AS treatment_type, concat('kind', k % 3) AS treatment_subtype, CAST(event_id AS VARCHAR) AS treatment_source_event_id,
           CAST(CASE WHEN k % 4 = 0 THEN NULL WHEN event_type = 'click' THEN value ELSE 0.07 END AS DECIMAL(20,6)) AS treatment_cost_actual,
           CAST(CASE WHEN k % 5 = 0 THEN NULL WHEN event_type = 'click' THEN 5.0 ELSE 0.05 END AS DECIMAL(20,6)) AS treatment_cost_fallback,
           IF(k % 20 = 0, NULL, 'EUR') AS treatment_cost_currency
    FROM fx_events WHERE event_type = 'click' OR event_type = 'view' AND k % 10 < 7
), treated AS (
    SELECT f.*, s.* EXCLUDE (login_name) FROM followed f LEFT JOIN sent s ON s.login_name = f.player_id AND s.treatment_timestamp >= f.decision_timestamp
        AND s.treatment_timestamp <= f.decision_timestamp + INTERVAL 3 DAY AND (f.following IS NULL OR s.treatment_timestamp < f.following)
    QUALIFY row_number() OVER (PARTITION BY f.player_id, f.decision_timestamp ORDER BY s.treatment_timestamp, s.treatment_type, s.treatment_subtype) = 1
), opened AS (SELECT *, ifnull(treatment_timestamp, decision_timestamp) AS opening FROM treated),
amounts AS (
    SELECT login_name, ts, CAST(value AS DECIMAL(20,6)) AS amount, CAST(CAST(value AS DECIMAL(20,6)) * (10 - k % 10) / 10 AS DECIMAL(20,6)) AS ggr
    FROM fx_events WHERE event_type = 'purchase'
), outcomes AS (
    SELECT o.player_id, o.decision_timestamp, ifnull(sum(amount) FILTER (a.ts <= opening + INTERVAL 3 DAY), 0) AS bet3, ifnull(sum(amount), 0) AS bet7,
           ifnull(sum(ggr) FILTER (a.ts <= opening + INTERVAL 3 DAY), 0) AS ggr3, ifnull(sum(ggr), 0) AS ggr7
    FROM opened o LEFT JOIN amounts a ON a.login_name = o.player_id AND a.ts > opening AND a.ts <= opening + INTERVAL 7 DAY
    GROUP BY o.player_id, o.decision_timestamp
), mart AS (SELECT * FROM fx_feature_mart WHERE is_eligible = 1),
known AS (
    SELECT o.player_id, o.decision_timestamp, max_by(m, m.snapshot_date) AS m FROM opened o JOIN mart m ON m.player_id = o.player_id AND m.snapshot_date < CAST(o.decision_timestamp AS DATE)
    GROUP BY o.player_id, o.decision_timestamp
), scored AS (
    SELECT o.player_id, o.decision_timestamp, max_by({_SCORE}, m.pt) AS score FROM opened o
    JOIN mart m ON m.player_id = o.player_id AND strptime(m.pt, '%Y%m%d') + INTERVAL 2 HOUR <= o.decision_timestamp GROUP BY o.player_id, o.decision_timestamp
), priced AS (
    SELECT *, CASE WHEN treatment_timestamp IS NULL THEN 0 WHEN treatment_cost_actual IS NOT NULL THEN treatment_cost_actual ELSE treatment_cost_fallback END AS cost,
           CASE WHEN treatment_timestamp IS NULL THEN 'none' WHEN treatment_cost_actual IS NOT NULL THEN 'actual' WHEN treatment_cost_fallback IS NOT NULL THEN 'fallback'
                ELSE 'missing' END AS treatment_cost_source
    FROM opened
)
SELECT p.player_id, CAST(p.decision_timestamp AS DATE) AS decision_date, p.decision_timestamp, ifnull(m.is_eligible, 0)::BIGINT AS eligibility_flag, strategy_group,
       strategy_version, selected_flag, selection_reason_code, count(treatment_timestamp) OVER (PARTITION BY p.player_id, p.decision_timestamp) AS actual_treatment_flag,
       treatment_type, treatment_subtype, treatment_source_event_id, treatment_timestamp, treatment_cost_actual::DOUBLE AS treatment_cost_actual,
       treatment_cost_fallback::DOUBLE AS treatment_cost_fallback, treatment_cost_currency, treatment_cost_source, score AS churn_score_at_decision,
       CASE WHEN score IS NOT NULL THEN 0.5::DOUBLE END AS selected_threshold_at_decision, m.vip_level AS vip_level_at_decision,
       TRY_CAST(regexp_extract(m.vip_level, '([0-9]+)$', 1) AS BIGINT) AS vip_level_num_at_decision, NULL::VARCHAR AS value_segment_at_decision,
       m.snapshot_date AS feature_snapshot_date, ggr3::DOUBLE AS gross_ggr_t_plus_3, ggr7::DOUBLE AS gross_ggr_t_plus_7, bet3::DOUBLE AS gross_bet_amount_t_plus_3,
       bet7::DOUBLE AS gross_bet_amount_t_plus_7, (ggr3 - cost)::DOUBLE AS net_value_t_plus_3, (ggr7 - cost)::DOUBLE AS net_value_t_plus_7,
       (opening < TIMESTAMP '2024-01-27')::BIGINT AS label_ready_3d, (opening < TIMESTAMP '2024-01-23')::BIGINT AS label_ready_7d, opening AS outcome_window_start_ts,
       opening + INTERVAL 3 DAY AS outcome_window_end_3d_ts, opening + INTERVAL 7 DAY AS outcome_window_end_7d_ts, 'feature_mart' AS eligibility_source_table,
       'decisions' AS strategy_source_table, 'response_scores' AS score_source_table, 'treatment_log' AS treatment_source_table, 'timed_bets' AS outcome_source_table,
       'feature_mart' AS feature_source_table, '{BUILD_VERSION}' AS build_version, TIMESTAMP '2024-01-27 02:00:00' AS build_timestamp,
       replace(CAST(CAST(p.decision_timestamp AS DATE) AS VARCHAR), '-', '') AS pt
FROM priced p LEFT JOIN outcomes USING (player_id, decision_timestamp) LEFT JOIN known USING (player_id, decision_timestamp) LEFT JOIN scored USING (player_id, decision_timestamp)"""


@query("strategy_dataset", _DATASET)
def strategy_dataset(spark, sf):
    return _as_doubles(_dataset(spark, sf))


@query(
    "net_value",
    f"""SELECT player_id, decision_timestamp, treatment_cost_source,
        CASE treatment_cost_source WHEN 'actual' THEN treatment_cost_actual WHEN 'fallback' THEN treatment_cost_fallback WHEN 'none' THEN 0 END AS treatment_cost,
        net_value_t_plus_3, net_value_t_plus_7,
        round(net_value_t_plus_3 / nullif(CASE treatment_cost_source WHEN 'actual' THEN treatment_cost_actual WHEN 'fallback' THEN treatment_cost_fallback END, 0) + 1e-9, 6) AS roi_t_plus_3,
        round(net_value_t_plus_7 / nullif(CASE treatment_cost_source WHEN 'actual' THEN treatment_cost_actual WHEN 'fallback' THEN treatment_cost_fallback END, 0) + 1e-9, 6) AS roi_t_plus_7
        FROM ({_DATASET}) d""",
)
def net_value(spark, sf):
    """Chosen cost, its source, net value and return of every decision."""
    bare = _dataset(spark, sf).drop("treatment_cost_source", "net_value_t_plus_3", "net_value_t_plus_7")
    priced = S.net_value(bare, {f"net_value_t_plus_{n}": f"gross_ggr_t_plus_{n}" for n in S.WINDOWS})
    rates = {f"roi_t_plus_{n}": F.round(S.return_on_cost(f"net_value_t_plus_{n}", "treatment_cost") + 1e-9, 6) for n in S.WINDOWS}
    shown = ["player_id", "decision_timestamp", "treatment_cost_source", "treatment_cost", "net_value_t_plus_3", "net_value_t_plus_7"]
    return _as_doubles(priced.withColumns(rates).select(*shown, *rates))


@query(
    "strategy_comparison",
    f"""SELECT strategy_group, selected_flag, count(*) AS decisions, sum(actual_treatment_flag)::BIGINT AS treated,
        count(*) FILTER (treatment_cost_source = 'missing') AS unknown_costs, round(sum(gross_bet_amount_t_plus_3), 6) AS gross_bet_amount,
        round(sum(gross_ggr_t_plus_3), 6) AS gross_ggr,
        round(sum(CASE treatment_cost_source WHEN 'actual' THEN treatment_cost_actual WHEN 'fallback' THEN treatment_cost_fallback ELSE 0 END), 6) AS known_cost,
        round(sum(net_value_t_plus_3), 6) AS net_value,
        round(sum(net_value_t_plus_3) / sum(CASE treatment_cost_source WHEN 'actual' THEN treatment_cost_actual WHEN 'fallback' THEN treatment_cost_fallback ELSE 0 END) + 1e-9, 6) AS return_on_cost
        FROM ({_DATASET}) d WHERE label_ready_3d = 1 GROUP BY strategy_group, selected_flag""",
)
def strategy_comparison(spark, sf):
    compared = S.strategy_comparison(_dataset(spark, sf))
    return _as_doubles(compared.withColumn("return_on_cost", F.round(F.col("return_on_cost") + 1e-9, 6)))
