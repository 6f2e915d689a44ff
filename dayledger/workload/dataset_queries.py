"""Queries on scans, the response dataset, splits and maturity."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.columns import to_day
from ..operators import dataset as D
from ..operators import profiling as P
from ..operators import splits as S
from ..session import fresh_path
from ..sources import fixtures as fx
from ..sources import scans, sinks
from ..sources.schemas import NUMERIC_FEATURES, RESPONSE_DATASET, RESPONSE_SCORES, comment_of
from . import inputs as I
from .registry import query, rounded, rounded_sql

_DOUBLE_FEATURES = [f for f in NUMERIC_FEATURES if "_amt_" in f or f == "recent_net_cash_in_7d"]
_DATASET_DOUBLES = [*_DOUBLE_FEATURES, "outcome_gross_bet_3d_value", "outcome_gross_ggr_3d_value"]

# --- scans ---------------------------------------------------------------------------------


@query(
    "scan_partition",
    """SELECT player_id, vip_level, recent_bet_cnt_7d, round(recent_bet_amt_7d + 1e-9, 6) AS recent_bet_amt_7d, pt
       FROM fx_feature_mart WHERE pt = '20240126' AND is_eligible = 1 AND recent_bet_cnt_7d > 1""",
)
def scan_partition(spark, sf):
    table = I.eligible_mart(spark, sf, I.SCORING_PT, I.SCORING_PT)
    columns = ["player_id", "vip_level", "recent_bet_cnt_7d", "player_id", "recent_bet_amt_7d", "pt"]
    wanted = {"pt": I.SCORING_PT, "is_eligible": 1, "vip_level": None}
    return rounded(scans.scan(table, columns, wanted, [F.col("recent_bet_cnt_7d") > 1]))


@query(
    "scan_pt_range",
    """SELECT player_id, pt, snapshot_date, recent_bet_cnt_7d, is_eligible FROM fx_feature_mart
       WHERE pt BETWEEN '20240110' AND '20240112'""",
)
def scan_pt_range(spark, sf):
    first, last = "20240110", "20240112"
    columns = ["player_id", "pt", "snapshot_date", "recent_bet_cnt_7d", "is_eligible"]
    return scans.scan_pt_range(I.mart(spark, sf, first, last), first, last, columns)


@query("list_partitions", "SELECT DISTINCT pt FROM fx_feature_mart")
def list_partitions(spark, sf):
    return scans.list_partitions(fx.partition_days(spark, sf))


@query("latest_partition", "SELECT max(pt) AS pt FROM fx_feature_mart")
def latest_partition(spark, sf):
    return scans.latest_partition(fx.partition_days(spark, sf))


@query("reference_partition", "SELECT max(pt) AS reference_pt FROM v_listing WHERE pt < '20240126'")
def reference_partition(spark, sf):
    return scans.reference_partition(fx.partition_days(spark, sf), I.SCORING_PT)


@query(
    "split_row_counts",
    "SELECT p.split, count(*) AS row_count FROM v_base b JOIN v_plan p ON b.pt = p.pt GROUP BY p.split",
)
def split_row_counts(spark, sf):
    plan = S.split_plan(fx.partition_days(spark, sf), I.AS_OF, *I.SPLIT_DAYS)
    S.require_complete_plan(plan, sum(I.SPLIT_DAYS))
    windows = {r.split: (r.start_pt, r.end_pt) for r in S.split_windows(plan).collect()}  # three ranges
    first, last = min(w[0] for w in windows.values()), max(w[1] for w in windows.values())
    return scans.split_row_counts(I.base(spark, sf, first, last), windows)


_INVENTORY_SQL = " UNION ALL ".join(
    f"""SELECT '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS data_type, '{comment_of(f.name) or f.metadata.get("comment", "")}' AS comment,
        {str(f.name == "pt").lower()} AS is_partition, count(*) FILTER (WHERE {f.name} IS NULL) AS missing_rows,
        round(count(*) FILTER (WHERE {f.name} IS NULL) / count(*) + 1e-9, 6) AS missing_rate FROM v_response"""
    for f in RESPONSE_DATASET.fields
)


@query("schema_inventory", _INVENTORY_SQL)
def schema_inventory(spark, sf):
    """The columns of the dataset with the comments that the catalog gives back, next to the missing rows of each."""
    path, name = fresh_path(spark, "inventory"), f"inventory_{uuid.uuid4().hex}"
    spark.sql(sinks.create_table_sql(name, "response_dataset", path))
    inventory = scans.catalog_inventory(spark, name)
    spark.sql(f"DROP TABLE {name}")
    return rounded(inventory.join(P.missingness(I.response(spark, sf)), "column_name"))


@query(
    "expired_partitions",
    """SELECT pt, datediff('day', d, DATE '2024-01-30')::BIGINT AS age_days FROM v_listing
       WHERE datediff('day', d, DATE '2024-01-30') > 14""",
)
def expired_partitions(spark, sf):
    return sinks.expired_partitions(fx.partition_days(spark, sf), I.AS_OF, 14)


@query("sample_rows", rounded_sql("SELECT * FROM v_response WHERE pt = '20240126' ORDER BY player_id LIMIT 5", _DATASET_DOUBLES))
def sample_rows(spark, sf):
    return rounded(scans.sample_rows(I.response(spark, sf, I.MATURE_PT, I.MATURE_PT), I.MATURE_PT))


@query(
    "partition_row_count",
    """SELECT d.pt, count(r.pt) AS row_count, count(r.pt) > 0 AS partition_exists
       FROM (VALUES ('20240110'), ('20240126'), ('20240301')) AS d(pt) LEFT JOIN v_response r ON r.pt = d.pt GROUP BY d.pt""",
)
def partition_row_count(spark, sf):
    """Rows of written partitions and of one that is not there."""
    path = fresh_path(spark, "response_dataset")
    sinks.write_dataset(I.response(spark, sf), path, RESPONSE_DATASET)
    table = sinks.read_table(spark, path, RESPONSE_DATASET)
    counted = [scans.partition_row_count(table, pt) for pt in ("20240110", "20240126", "20240301")]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query(
    "align_schema",
    """SELECT player_id, NULL::DATE AS score_date, NULL::VARCHAR AS scoring_pt, NULL::TIMESTAMP AS scoring_ts, snapshot_date,
       predicted_response_score, NULL::BIGINT AS score_rank, NULL::DOUBLE AS score_percentile,
       NULL::VARCHAR AS response_priority_bucket, NULL::VARCHAR AS action_recommendation, vip_level,
       NULL::VARCHAR AS model_name, NULL::VARCHAR AS model_version, NULL::VARCHAR AS model_reference_path,
       NULL::DOUBLE AS selected_threshold, pt FROM v_audience WHERE pt = '20240126'""",
)
def align_schema(spark, sf):
    return sinks.align_to_schema(I.audience(spark, sf), RESPONSE_SCORES)[0]


# --- dataset -------------------------------------------------------------------------------


@query("base_population", rounded_sql("SELECT * FROM v_base", _DOUBLE_FEATURES))
def base_population(spark, sf):
    return rounded(I.base(spark, sf))


@query("voucher_rollup", "SELECT * FROM v_voucher")
def voucher_rollup(spark, sf):
    return D.voucher_rollup(fx.vouchers(spark, sf))


@query("sms_rollup", "SELECT * FROM v_sms")
def sms_rollup(spark, sf):
    return D.sms_rollup(fx.sms_sends(spark, sf))


@query("treatment_rollup", "SELECT * FROM v_treatment")
def treatment_rollup(spark, sf):
    first, last = I.first_day(spark, sf), I.MATURE_PT
    keys = I.base(spark, sf).select(*D.KEYS)
    return D.treatment_rollup(keys, fx.vouchers(spark, sf, first, last), fx.sms_sends(spark, sf, first, last))


@query("outcome_daily", rounded_sql("SELECT * FROM v_outcome_daily", ["bet_amount_1d", "gross_ggr_1d"]))
def outcome_daily(spark, sf):
    return rounded(D.outcome_daily(fx.bets(spark, sf)))


def _outcome_sql(n: int) -> str:
    return f"""SELECT player_id, assignment_date, round(gross_bet + 1e-9, 6) AS outcome_gross_bet_{n}d_value,
       round(gross_ggr + 1e-9, 6) AS outcome_gross_ggr_{n}d_value, source_rows AS outcome_source_row_count_{n}d,
       source_keys AS outcome_distinct_source_keys_{n}d, first_day AS first_outcome_event_date,
       last_day AS last_outcome_event_date,
       (CASE WHEN gross_bet > 0 THEN 1 ELSE 0 END)::BIGINT AS response_label_positive_{n}d FROM v_outcome{n}"""


def _outcome(spark, sf, days):
    keys = I.base(spark, sf).select(*D.KEYS)
    return rounded(D.outcome_rollup(keys, I.bets_after(spark, sf, I.first_day(spark, sf), I.MATURE_PT, days), days))


@query("outcome_rollup_3d", _outcome_sql(3))
def outcome_rollup_3d(spark, sf):
    return _outcome(spark, sf, 3)


@query("outcome_rollup_7d", _outcome_sql(7))
def outcome_rollup_7d(spark, sf):
    return _outcome(spark, sf, 7)


@query("response_dataset", rounded_sql("SELECT * FROM v_response", _DATASET_DOUBLES))
def response_dataset(spark, sf):
    return rounded(I.response(spark, sf))


RECONCILE_SQL = """WITH expected AS (
         SELECT b.pt, b.player_id, b.assignment_date, coalesce(sum(o.bet_amount), 0.0) AS bet, count(o.login_name) AS n
         FROM v_base b LEFT JOIN fx_bets o ON o.login_name = b.player_id AND o.stat_date > b.assignment_date
          AND o.stat_date <= CAST(b.assignment_date + INTERVAL 3 DAY AS DATE)
         GROUP BY b.pt, b.player_id, b.assignment_date),
       treated AS (SELECT DISTINCT pt, player_id, assignment_date FROM v_voucher
                   UNION SELECT DISTINCT pt, player_id, assignment_date FROM v_sms)
       SELECT a.pt, count(*) AS base_rows, count(*) FILTER (WHERE t.player_id IS NOT NULL) AS treatment_rows,
              count(*) FILTER (WHERE e.n > 0) AS matched_outcome_rows,
              count(*) FILTER (WHERE e.bet > 0) AS expected_positive_bet_rows,
              sum(a.response_label_positive_3d)::BIGINT AS actual_positive_labels,
              round(avg(a.response_label_positive_3d) + 1e-9, 6) AS actual_label_rate,
              count(*) FILTER (WHERE (a.response_label_positive_3d = 1) = (e.bet > 0)) AS matching_label_rows,
              count(*) FILTER (WHERE (a.response_label_positive_3d = 1) <> (e.bet > 0)) AS mismatching_label_rows
       FROM v_response a JOIN expected e ON a.pt = e.pt AND a.player_id = e.player_id AND a.assignment_date = e.assignment_date
       LEFT JOIN treated t ON a.pt = t.pt AND a.player_id = t.player_id AND a.assignment_date = t.assignment_date
       GROUP BY a.pt"""


@query("dataset_reconcile", RECONCILE_SQL)
def dataset_reconcile(spark, sf):
    first, last = I.first_day(spark, sf), I.MATURE_PT
    return rounded(
        D.dataset_reconcile(
            I.response(spark, sf),
            I.base(spark, sf),
            fx.vouchers(spark, sf, first, last),
            fx.sms_sends(spark, sf, first, last),
            I.bets_after(spark, sf, first, last),
        )
    )


@query(
    "treatment_source_audit",
    """SELECT pt, treatment_type, treatment_group, count(*) AS row_count, count(DISTINCT player_id) AS distinct_players,
       round(avg(treatment_flag) + 1e-9, 6) AS treatment_rate,
       round(avg(outcome_paid_activity_3d_flag) + 1e-9, 6) AS outcome_paid_activity_3d_rate,
       round(avg(outcome_paid_activity_7d_flag) + 1e-9, 6) AS outcome_paid_activity_7d_rate
       FROM v_audited GROUP BY pt, treatment_type, treatment_group""",
)
def treatment_source_audit(spark, sf):
    return rounded(D.treatment_source_audit(I.audited(spark, sf)))


@query(
    "observed_outcomes",
    """SELECT player_id, pt, predicted_response_score, response_priority_bucket, vip_level, selected_threshold, model_name,
       model_version, round(bet + 1e-9, 6) AS observed_gross_bet_value_3d, round(ggr + 1e-9, 6) AS observed_gross_ggr_value_3d,
       label AS observed_response_label_positive_3d, source_rows AS observed_outcome_source_rows_3d,
       first_day AS first_observed_outcome_date, last_day AS last_observed_outcome_date FROM v_observed""",
)
def observed_outcomes(spark, sf):
    return rounded(I.observed(spark, sf))


# --- splits and maturity -------------------------------------------------------------------


@query(
    "runtime_window",
    """SELECT min(pt) AS min_pt, max(pt) AS max_pt, '20240126' AS maturity_end_pt,
       max(pt) FILTER (WHERE pt <= '20240126') AS modeling_end_pt FROM v_listing""",
)
def runtime_window(spark, sf):
    return S.runtime_window(fx.partition_days(spark, sf), I.AS_OF)


@query("split_plan", "SELECT pt, split FROM v_plan")
def split_plan(spark, sf):
    return S.split_plan(fx.partition_days(spark, sf), I.AS_OF, *I.SPLIT_DAYS)


@query(
    "split_assign",
    "SELECT b.player_id, b.assignment_date, b.pt, p.split FROM v_base b JOIN v_plan p ON b.pt = p.pt",
)
def split_assign(spark, sf):
    plan = S.split_plan(fx.partition_days(spark, sf), I.AS_OF, *I.SPLIT_DAYS)
    return S.assign_splits(I.base(spark, sf).select("player_id", "assignment_date", "pt"), plan)


@query(
    "label_maturity",
    """SELECT pt AS scoring_pt, d AS score_date, CAST(d + INTERVAL 3 DAY AS DATE) AS observed_outcome_end_date,
       CAST(d + INTERVAL 4 DAY AS DATE) AS matured_on_date, DATE '2024-01-30' AS as_of_date,
       DATE '2024-01-30' >= d + INTERVAL 4 DAY AS labels_mature FROM v_listing""",
)
def label_maturity(spark, sf):
    return S.label_maturity(fx.partition_days(spark, sf), I.AS_OF)


_MATURITY_SQL = " UNION ALL ".join(
    f"""SELECT 'gross_bet_{n}d' AS outcome_window, {n}::BIGINT AS window_days, DATE '2024-01-30' AS as_of_date,
        count(*) FILTER (WHERE assignment_date + INTERVAL {n} DAY <= DATE '2024-01-30') AS matured_rows,
        count(*) FILTER (WHERE assignment_date + INTERVAL {n} DAY > DATE '2024-01-30') AS incomplete_rows,
        round(avg(CASE WHEN assignment_date + INTERVAL {n} DAY <= DATE '2024-01-30' THEN 1.0 ELSE 0.0 END) + 1e-9, 6) AS matured_share
        FROM v_base"""
    for n in (3, 7)
)


@query("outcome_maturity", _MATURITY_SQL)
def outcome_maturity(spark, sf):
    return rounded(S.outcome_maturity(I.base(spark, sf), {"gross_bet_3d": 3, "gross_bet_7d": 7}, I.AS_OF))


@query(
    "outcome_maturity_flags",
    """SELECT player_id, assignment_date,
       (assignment_date + INTERVAL 3 DAY <= DATE '2024-01-30')::BIGINT AS outcome_gross_bet_3d_matured_flag,
       (assignment_date + INTERVAL 7 DAY <= DATE '2024-01-30')::BIGINT AS outcome_gross_bet_7d_matured_flag FROM v_base""",
)
def outcome_maturity_flags(spark, sf):
    return S.outcome_maturity_flags(I.base(spark, sf), {"gross_bet_3d": 3, "gross_bet_7d": 7}, I.AS_OF)


_DAY_TEXT = """CASE k % 5 WHEN 0 THEN substr(CAST(ts AS {text}), 1, 10) WHEN 1 THEN 'no day' WHEN 2 THEN NULL ELSE CAST(ts AS {text}) END"""


@query(
    "parsed_days",
    f"""SELECT day, count(*) AS row_count, count(text) AS texts FROM (
            SELECT {_DAY_TEXT.format(text='VARCHAR')} AS text, CAST(TRY_CAST({_DAY_TEXT.format(text='VARCHAR')} AS TIMESTAMP) AS DATE) AS day FROM fx_events) p GROUP BY day""",
)
def parsed_days(spark, sf):
    """Days read from text in several forms; text that is no day becomes NULL and stays counted."""
    text = fx.events(spark, sf).select(F.expr(_DAY_TEXT.format(text="STRING")).alias("text"))
    return text.groupBy(to_day("text").alias("day")).agg(F.count(F.lit(1)).alias("row_count"), F.count("text").alias("texts"))
