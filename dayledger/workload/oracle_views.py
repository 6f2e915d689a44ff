"""SQL views the comparison queries are built from, each written the plain way on whole tables."""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {}

VIEWS["fx_events"] = """
SELECT event_id, CAST(user_id AS VARCHAR) AS login_name, user_id, ts, CAST(ts AS DATE) AS d,
       event_type, value, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k
FROM events"""

VIEWS["fx_segment"] = """
SELECT u.user_id,
       CASE WHEN u.user_id % 37 = 36 THEN NULL WHEN u.user_id % 41 = 40 THEN 'UNKNOWN'
            WHEN c.c_mktsegment = 'BUILDING' THEN 'V1' WHEN c.c_mktsegment = 'HOUSEHOLD' THEN 'V2'
            WHEN c.c_mktsegment = 'FURNITURE' THEN 'V3' WHEN c.c_mktsegment = 'MACHINERY' THEN 'V4'
            ELSE 'V5' END AS vip_level
FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN customer c ON c.c_custkey = u.user_id"""

VIEWS["fx_days"] = """
SELECT DISTINCT d FROM fx_events"""

VIEWS["fx_win"] = """
SELECT dd.d, s.user_id, s.vip_level,
       count(*) FILTER (bet AND near) AS bet_cnt, coalesce(sum(value) FILTER (bet AND near), 0.0) AS bet_amt,
       coalesce(sum(won) FILTER (bet AND near), 0.0) AS win_amt, count(DISTINCT e.d) FILTER (bet AND near) AS bet_days,
       max(e.d) FILTER (bet AND near) AS last_bet,
       count(*) FILTER (event_type = 'signup' AND near) AS dep_cnt,
       coalesce(sum(value) FILTER (event_type = 'signup' AND near), 0.0) AS dep_amt,
       count(*) FILTER (event_type = 'error' AND near) AS wd_cnt,
       coalesce(sum(value) FILTER (event_type = 'error' AND near), 0.0) AS wd_amt,
       count(*) FILTER (bet) AS bet_cnt_30, coalesce(sum(value) FILTER (bet), 0.0) AS bet_amt_30,
       coalesce(sum(won) FILTER (bet), 0.0) AS win_amt_30, count(DISTINCT e.d) FILTER (bet) AS bet_days_30
FROM fx_days dd CROSS JOIN fx_segment s
LEFT JOIN (SELECT a.*, b.d AS day, a.event_type = 'purchase' AS bet, a.value * (a.k % 10) / 10 AS won,
                  datediff('day', a.d, b.d) <= 7 AS near
           FROM fx_events a JOIN fx_days b ON datediff('day', a.d, b.d) BETWEEN 1 AND 30) e
  ON e.user_id = s.user_id AND e.day = dd.d
GROUP BY dd.d, s.user_id, s.vip_level"""

VIEWS["fx_feature_mart"] = """
SELECT CAST(user_id AS VARCHAR) AS player_id, CAST(d - INTERVAL 1 DAY AS DATE) AS snapshot_date,
       bet_cnt AS recent_bet_cnt_7d, bet_amt AS recent_bet_amt_7d, win_amt AS recent_win_amt_7d,
       bet_amt - win_amt AS recent_ggr_amt_7d, bet_amt - win_amt AS recent_net_loss_amt_7d,
       bet_days AS recent_bet_days_7d, datediff('day', last_bet, d) AS recency_last_bet_to_t,
       bet_cnt_30 AS pre_bet_cnt_30d, bet_amt_30 AS pre_bet_amt_30d, win_amt_30 AS pre_win_amt_30d,
       bet_amt_30 - win_amt_30 AS pre_ggr_amt_30d, bet_amt_30 - win_amt_30 AS pre_net_loss_amt_30d,
       bet_days_30 AS pre_bet_days_30d,
       dep_cnt AS recent_dep_cnt_7d, dep_amt AS recent_dep_amt_7d,
       wd_cnt AS recent_withdraw_cnt_7d, wd_amt AS recent_withdraw_amt_7d, dep_amt - wd_amt AS recent_net_cash_in_7d,
       CAST(d AS TIMESTAMP) AS feature_create_time, 'v2' AS data_version, vip_level,
       (CASE WHEN bet_cnt > 0 THEN 1 ELSE 0 END)::BIGINT AS is_eligible,
       (CASE WHEN d <= DATE '2024-01-26' THEN 1 ELSE 0 END)::BIGINT AS label_maturity_d3,
       replace(CAST(d AS VARCHAR), '-', '') AS pt
FROM fx_win"""

VIEWS["fx_voucher"] = """
SELECT login_name, CASE WHEN k % 3 = 0 THEN NULL ELSE ts END AS release_datetime,
       CASE WHEN k % 7 = 0 THEN NULL ELSE ts + INTERVAL 1 HOUR END AS clamined_datetime,
       replace(CAST(d AS VARCHAR), '-', '') AS pt
FROM fx_events WHERE event_type = 'click'"""

VIEWS["fx_sms"] = """
SELECT login_name, CASE WHEN k % 5 = 0 THEN NULL ELSE ts END AS send_time, ts AS create_time,
       CASE WHEN k % 10 < 7 THEN 3 ELSE 4 END AS state, replace(CAST(d AS VARCHAR), '-', '') AS pt
FROM fx_events WHERE event_type = 'view'"""

VIEWS["fx_bets"] = """
SELECT d AS stat_date, login_name, CASE WHEN k % 11 = 0 THEN NULL ELSE concat('site', CAST(k % 4 AS VARCHAR)) END AS bet_site_id,
       value AS bet_amount, value - value * (k % 10) / 10 AS gross_gaming_revenue,
       replace(CAST(d AS VARCHAR), '-', '') AS pt
FROM fx_events WHERE event_type = 'purchase'"""

# --- dataset -------------------------------------------------------------------------------

VIEWS["v_listing"] = "SELECT replace(CAST(d AS VARCHAR), '-', '') AS pt, d FROM fx_days"

VIEWS["v_base"] = """
SELECT player_id, CAST(strptime(pt, '%Y%m%d') AS DATE) AS assignment_date, snapshot_date AS feature_snapshot_date,
       recent_bet_cnt_7d, recent_bet_amt_7d, recent_win_amt_7d, recent_ggr_amt_7d, recent_net_loss_amt_7d,
       recent_bet_days_7d, recency_last_bet_to_t, pre_bet_cnt_30d, pre_bet_amt_30d, pre_win_amt_30d,
       pre_ggr_amt_30d, pre_net_loss_amt_30d, pre_bet_days_30d, recent_dep_cnt_7d, recent_dep_amt_7d,
       recent_withdraw_cnt_7d, recent_withdraw_amt_7d, recent_net_cash_in_7d,
       feature_create_time, data_version, vip_level, pt
FROM fx_feature_mart WHERE is_eligible = 1 AND label_maturity_d3 = 1"""

# one list of contacts for both channels; a contact counts on the partition day it was made
VIEWS["v_contacts"] = """
SELECT 'voucher' AS channel, pt, login_name AS player_id, ifnull(release_datetime, clamined_datetime) AS made FROM fx_voucher
UNION ALL
SELECT 'sms', pt, login_name, ifnull(send_time, create_time) FROM fx_sms WHERE state = 3"""

VIEWS["v_channel_days"] = """
SELECT channel, pt, player_id, CAST(made AS DATE) AS assignment_date, min(made) AS first_treatment_timestamp, count(made) AS n
FROM v_contacts WHERE made IS NOT NULL GROUP BY ALL"""

VIEWS["v_voucher"] = """
SELECT * EXCLUDE (channel, n), n AS voucher_event_count FROM v_channel_days WHERE channel = 'voucher'"""

VIEWS["v_sms"] = """
SELECT * EXCLUDE (channel, n), n AS sms_event_count FROM v_channel_days WHERE channel = 'sms'"""

VIEWS["v_treatment"] = """
SELECT player_id, assignment_date, min(first_treatment_timestamp) AS treatment_timestamp,
       least(count(n), 1)::BIGINT AS treatment_flag, ifnull(sum(n), 0)::BIGINT AS raw_assignment_event_count,
       count(DISTINCT n) FILTER (channel = 'voucher') AS has_voucher_treatment,
       count(DISTINCT n) FILTER (channel = 'sms') AS has_sms_treatment
FROM v_base LEFT JOIN v_channel_days USING (player_id, assignment_date, pt)
GROUP BY player_id, assignment_date"""

VIEWS["v_outcome_daily"] = """
SELECT login_name AS player_id, stat_date, bet_site_id, sum(bet_amount) AS bet_amount_1d,
       sum(gross_gaming_revenue) AS gross_ggr_1d, count(*) AS source_row_count_1d
FROM fx_bets GROUP BY ALL"""


def _outcome(days: int) -> str:
    """From single bets: totals, the different (day, site) pairs, and the first and last day."""
    return f"""
SELECT p.player_id, p.assignment_date, ifnull(sum(o.bet_amount), 0.0) AS gross_bet,
       ifnull(sum(o.gross_gaming_revenue), 0.0) AS gross_ggr, count(o.stat_date) AS source_rows,
       count(DISTINCT row(o.stat_date, o.bet_site_id)) FILTER (o.stat_date IS NOT NULL) AS source_keys,
       min(o.stat_date) AS first_day, max(o.stat_date) AS last_day
FROM (SELECT player_id, assignment_date, unnest(generate_series(1, {days})) AS k FROM v_base) p
LEFT JOIN fx_bets o ON o.login_name = p.player_id AND datediff('day', p.assignment_date, o.stat_date) = p.k
GROUP BY p.player_id, p.assignment_date"""


VIEWS["v_outcome3"] = _outcome(3)
VIEWS["v_outcome7"] = _outcome(7)

VIEWS["v_response"] = """
SELECT b.*, t.* EXCLUDE (player_id, assignment_date), gross_bet AS outcome_gross_bet_3d_value,
       gross_ggr AS outcome_gross_ggr_3d_value, source_rows AS outcome_source_row_count_3d,
       source_keys AS outcome_distinct_source_keys_3d, first_day AS first_outcome_event_date,
       last_day AS last_outcome_event_date, (gross_bet > 0)::BIGINT AS response_label_positive_3d
FROM v_base b JOIN v_treatment t USING (player_id, assignment_date) JOIN v_outcome3 o USING (player_id, assignment_date)"""

VIEWS["v_audited"] = """
SELECT r.*,
       CASE WHEN has_voucher_treatment = 1 AND has_sms_treatment = 1 THEN 'voucher_and_sms'
            WHEN has_voucher_treatment = 1 THEN 'voucher' WHEN has_sms_treatment = 1 THEN 'sms' ELSE 'none' END AS treatment_type,
       CASE WHEN treatment_flag = 0 THEN 'control'
            WHEN has_voucher_treatment = 1 AND has_sms_treatment = 1 THEN 'voucher_and_sms'
            WHEN has_voucher_treatment = 1 THEN 'voucher' ELSE 'sms' END AS treatment_group,
       CASE WHEN has_voucher_treatment = 1 AND has_sms_treatment = 1 THEN 'sms|voucher'
            WHEN has_voucher_treatment = 1 THEN 'voucher' WHEN has_sms_treatment = 1 THEN 'sms' END AS source_treatment_types,
       (CASE WHEN outcome_gross_bet_3d_value > 0 THEN 1 ELSE 0 END)::BIGINT AS outcome_gross_bet_3d_flag,
       (CASE WHEN outcome_gross_bet_3d_value > 0 THEN 1 ELSE 0 END)::BIGINT AS outcome_paid_activity_3d_flag,
       (CASE WHEN o7.gross_bet > 0 THEN 1 ELSE 0 END)::BIGINT AS outcome_paid_activity_7d_flag
FROM v_response r LEFT JOIN v_outcome7 o7 ON r.player_id = o7.player_id AND r.assignment_date = o7.assignment_date"""

VIEWS["v_combo"] = """
SELECT *, CASE WHEN source_treatment_types = 'voucher' THEN 'voucher_only' WHEN source_treatment_types = 'sms' THEN 'sms_only'
               WHEN source_treatment_types = 'sms|voucher' THEN 'voucher_and_sms'
               WHEN source_treatment_types IS NULL AND treatment_flag = 0 THEN 'no_treatment'
               ELSE 'unknown' END AS treatment_combo
FROM v_audited"""

# --- scores --------------------------------------------------------------------------------

FIXED_SCORE = """round(1 / (1 + exp(-(-0.9 + 0.35 * recent_bet_cnt_7d + 0.001 * recent_bet_amt_7d
       + 0.1 * recent_dep_cnt_7d - 0.05 * coalesce(recency_last_bet_to_t, 0)))), 6)"""

VIEWS["v_audience"] = f"""
SELECT *, {FIXED_SCORE} AS predicted_response_score FROM fx_feature_mart WHERE is_eligible = 1"""

VIEWS["v_ranked"] = """
SELECT player_id, snapshot_date, vip_level, predicted_response_score,
       row_number() OVER (ORDER BY predicted_response_score DESC, player_id) AS score_rank,
       count(*) OVER () AS score_total
FROM v_audience WHERE pt = '20240126'"""

VIEWS["v_cuts"] = """
SELECT quantile_cont(predicted_response_score, 0.2) AS q20, quantile_cont(predicted_response_score, 0.4) AS q40,
       quantile_cont(predicted_response_score, 0.6) AS q60, quantile_cont(predicted_response_score, 0.8) AS q80
FROM v_ranked"""

VIEWS["v_bucketed"] = """
SELECT r.*, 1.0 - (score_rank - 1) / score_total::DOUBLE AS score_percentile,
       CASE WHEN predicted_response_score >= q80 THEN 'very_high' WHEN predicted_response_score >= q60 THEN 'high'
            WHEN predicted_response_score >= q40 THEN 'medium' WHEN predicted_response_score >= q20 THEN 'low'
            ELSE 'very_low' END AS response_priority_bucket
FROM v_ranked r, v_cuts"""

VIEWS["v_scores"] = """
SELECT player_id, DATE '2024-01-26' AS score_date, '20240126' AS scoring_pt, TIMESTAMP '2024-01-27 02:00:00' AS scoring_ts,
       snapshot_date, predicted_response_score, score_rank, score_percentile, response_priority_bucket,
       CASE WHEN response_priority_bucket IN ('very_high', 'high') THEN 'prioritize_for_campaign_review'
            WHEN response_priority_bucket = 'medium' AND coalesce(vip_level, '') IN ('V4', 'V5', 'V6', 'V7', 'V8')
            THEN 'manual_review_high_value_medium_score'
            WHEN response_priority_bucket IN ('very_low', 'low') THEN 'deprioritize_aggressive_promo'
            ELSE 'standard_priority_review' END AS action_recommendation,
       vip_level, 'fixed_logit' AS model_name, 'fixed__fixed_logit__v1' AS model_version,
       'models/fixed_logit' AS model_reference_path, 0.5::DOUBLE AS selected_threshold, '20240126' AS pt
FROM v_bucketed"""

# every row is kept; each residue gets one defect, so that every check has something to find
VIEWS["v_flawed"] = """
SELECT CASE m WHEN 1 THEN NULL WHEN 2 THEN '  ' ELSE player_id END AS player_id,
       CASE m WHEN 11 THEN NULL ELSE score_date END AS score_date,
       CASE m WHEN 9 THEN '20240101' WHEN 10 THEN NULL ELSE scoring_pt END AS scoring_pt,
       CASE m WHEN 12 THEN NULL ELSE scoring_ts END AS scoring_ts,
       CASE m WHEN 13 THEN NULL WHEN 23 THEN CAST(snapshot_date - INTERVAL 1 DAY AS DATE)
              WHEN 24 THEN CAST(snapshot_date - INTERVAL 2 DAY AS DATE) ELSE snapshot_date END AS snapshot_date,
       CASE m WHEN 3 THEN -0.1 WHEN 4 THEN 1.1 WHEN 5 THEN NULL ELSE predicted_response_score END AS predicted_response_score,
       CASE m WHEN 20 THEN NULL ELSE score_rank END AS score_rank,
       CASE m WHEN 21 THEN -0.1 WHEN 22 THEN 1.2 ELSE score_percentile END AS score_percentile,
       CASE m WHEN 6 THEN 'x' WHEN 7 THEN NULL WHEN 8 THEN '' ELSE response_priority_bucket END AS response_priority_bucket,
       CASE m WHEN 18 THEN '' ELSE action_recommendation END AS action_recommendation,
       CASE m WHEN 19 THEN NULL ELSE vip_level END AS vip_level,
       CASE m WHEN 14 THEN NULL ELSE model_name END AS model_name,
       CASE m WHEN 15 THEN '' ELSE model_version END AS model_version,
       CASE m WHEN 16 THEN NULL ELSE model_reference_path END AS model_reference_path,
       CASE m WHEN 17 THEN NULL ELSE selected_threshold END AS selected_threshold,
       pt
FROM (SELECT *, CAST(player_id AS BIGINT) % 29 AS m FROM v_scores) s
JOIN (VALUES (1), (2)) AS c(copy) ON c.copy = 1 OR s.m = 0"""

# --- evaluation rows -----------------------------------------------------------------------

VIEWS["v_plan"] = """
SELECT pt, CASE WHEN age <= 7 THEN 'test' WHEN age <= 11 THEN 'validation' ELSE 'train' END AS split
FROM (SELECT pt, row_number() OVER (ORDER BY pt DESC) AS age FROM v_listing WHERE pt <= '20240126') l WHERE age <= 25"""

VIEWS["v_splits"] = f"""
SELECT r.player_id, r.assignment_date, r.pt, r.vip_level, coalesce(r.vip_level, '__NULL__') AS segment_value,
       CAST(r.response_label_positive_3d AS INT) AS target, {FIXED_SCORE} AS score, p.split,
       {', '.join('r.' + f for f in ('recent_bet_cnt_7d', 'recent_bet_amt_7d', 'recent_win_amt_7d', 'recent_ggr_amt_7d',
       'recent_net_loss_amt_7d', 'recent_bet_days_7d', 'recency_last_bet_to_t', 'pre_bet_cnt_30d', 'pre_bet_amt_30d',
       'pre_win_amt_30d', 'pre_ggr_amt_30d', 'pre_net_loss_amt_30d', 'pre_bet_days_30d', 'recent_dep_cnt_7d',
       'recent_dep_amt_7d', 'recent_withdraw_cnt_7d', 'recent_withdraw_amt_7d', 'recent_net_cash_in_7d'))}
FROM v_response r JOIN v_plan p ON r.pt = p.pt"""

# --- monitoring ----------------------------------------------------------------------------

VIEWS["v_observed"] = """
SELECT s.player_id, s.scoring_pt AS pt, s.predicted_response_score, s.response_priority_bucket, s.vip_level,
       s.selected_threshold, s.model_name, s.model_version,
       coalesce(sum(o.bet_amount), 0.0) AS bet, coalesce(sum(o.gross_gaming_revenue), 0.0) AS ggr,
       (CASE WHEN coalesce(sum(o.bet_amount), 0.0) > 0 THEN 1 ELSE 0 END)::BIGINT AS label,
       count(o.login_name) AS source_rows, min(o.stat_date) AS first_day, max(o.stat_date) AS last_day
FROM v_scores s LEFT JOIN fx_bets o
  ON s.player_id = o.login_name AND o.stat_date > s.score_date AND o.stat_date <= CAST(s.score_date + INTERVAL 3 DAY AS DATE)
GROUP BY s.player_id, s.scoring_pt, s.predicted_response_score, s.response_priority_bucket, s.vip_level,
         s.selected_threshold, s.model_name, s.model_version"""

_WORD = re.compile(r"\b(?:fx|v)_[a-z0-9_]+\b")


def with_views(sql: str) -> str:
    """The statement with the views it needs in front, each after the views it reads."""
    ordered: list[str] = []

    def need(text: str) -> None:
        for name in _WORD.findall(text):
            if name in VIEWS and name not in ordered:
                need(VIEWS[name])
                if name not in ordered:
                    ordered.append(name)

    need(sql)
    if not ordered:
        return sql.strip()
    body = sql.strip()
    head = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in ordered)
    if body[:5].upper() == "WITH ":
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"
