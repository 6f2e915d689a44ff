"""Queries on dataset profiles and the experiment-design audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit as X
from ..operators import contracts as V
from ..operators import profiling as P
from ..operators.splits import outcome_maturity
from ..session import cut_lineage
from ..sources.schemas import NUMERIC_FEATURES
from . import inputs as I
from .registry import query, rounded

_RATE = "round(avg(response_label_positive_3d) + 1e-9, 6) AS positive_rate"


@query(
    "partition_summary",
    f"""SELECT pt, count(*) AS row_count, {_RATE}, pt <= '20240122' AS mature_for_modeling FROM v_response GROUP BY pt
        ORDER BY pt""",
)
def partition_summary(spark, sf):
    return rounded(P.partition_summary(I.response(spark, sf), "20240122"))


_OVERALL = f"""SELECT count(*) AS total_rows, count(DISTINCT concat(player_id, '|', assignment_date)) AS distinct_player_day_rows,
        count(DISTINCT player_id) AS distinct_players, min(assignment_date) AS min_assignment_date,
        max(assignment_date) AS max_assignment_date, min(feature_snapshot_date) AS min_feature_snapshot_date,
        max(feature_snapshot_date) AS max_feature_snapshot_date, sum(response_label_positive_3d)::BIGINT AS positive_rows, {_RATE}
        FROM v_response"""


@query("overall_summary", _OVERALL)
def overall_summary(spark, sf):
    return rounded(P.overall_summary(I.response(spark, sf)))


@query("overall_summary_mature", f"{_OVERALL} WHERE pt <= '20240122'")
def overall_summary_mature(spark, sf):
    """The same over the partitions that modelling may use."""
    return rounded(P.overall_summary(I.response(spark, sf, None, "20240122")))


@query(
    "treatment_mix",
    """SELECT treatment_flag, has_voucher_treatment, has_sms_treatment, count(*) AS row_count FROM v_response
       GROUP BY treatment_flag, has_voucher_treatment, has_sms_treatment
       ORDER BY row_count DESC, treatment_flag, has_voucher_treatment, has_sms_treatment""",
)
def treatment_mix(spark, sf):
    return P.treatment_mix(I.response(spark, sf))


@query(
    "segment_summary",
    f"""SELECT vip_level, count(*) AS row_count, {_RATE} FROM v_response GROUP BY vip_level
        ORDER BY row_count DESC, vip_level NULLS FIRST""",
)
def segment_summary(spark, sf):
    return rounded(P.segment_summary(I.response(spark, sf)))


@query(
    "key_nulls",
    "SELECT " + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}_nulls" for c in P.KEY_NULL_COLUMNS) + " FROM v_response",
)
def key_nulls(spark, sf):
    return P.key_nulls(I.response(spark, sf))


_MISSING = ["treatment_timestamp", "vip_level", "first_outcome_event_date", "recency_last_bet_to_t", "player_id", "not_there"]


@query(
    "missingness",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS missing_rows,
            round(count(*) FILTER (WHERE {c} IS NULL) / count(*) + 1e-9, 6) AS missing_rate
            FROM (SELECT *, NULL AS not_there FROM v_response) r"""
        for c in _MISSING
    ),
)
def missingness(spark, sf):
    return rounded(P.missingness(I.response(spark, sf), _MISSING))


@query(
    "profile_overview",
    """SELECT 'row_count' AS metric, CAST(count(*) AS VARCHAR) AS value FROM v_response
       UNION ALL SELECT 'unique_users', CAST(count(DISTINCT player_id) AS VARCHAR) FROM v_response
       UNION ALL SELECT 'assignment_date_min', CAST(min(assignment_date) AS VARCHAR) FROM v_response
       UNION ALL SELECT 'assignment_date_max', CAST(max(assignment_date) AS VARCHAR) FROM v_response
       UNION ALL SELECT 'distinct_assignment_dates', CAST(count(DISTINCT assignment_date) AS VARCHAR) FROM v_response""",
)
def profile_overview(spark, sf):
    return P.profile_overview(I.response(spark, sf))


@query(
    "value_distribution",
    """SELECT coalesce(vip_level, '<null>') AS vip_level, count(*) AS row_count,
       round(count(*) / (sum(count(*)) OVER ()) + 1e-9, 6) AS row_share FROM v_response GROUP BY coalesce(vip_level, '<null>')""",
)
def value_distribution(spark, sf):
    return rounded(P.value_distribution(I.response(spark, sf), "vip_level"))


@query(
    "outcome_distribution",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS outcome_column, round(coalesce(v, -999999.0) + 1e-9, 6) + 0.0 AS outcome_value, count(*) AS row_count,
            round((SELECT avg({c}) FROM v_audited) + 1e-9, 6) AS mean,
            round((SELECT avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) FROM v_audited) + 1e-9, 6) AS missing_rate
            FROM (SELECT round(CAST({c} AS DOUBLE) + 1e-9, 6) AS v FROM v_audited) x GROUP BY v"""
        for c in V.OUTCOME_COLUMNS
    ),
)
def outcome_distribution(spark, sf):
    """Amounts are rounded before they are counted: equal sums may differ in the last digit."""
    amounts = [c for c in V.OUTCOME_COLUMNS if c.endswith("_value")]
    rows = I.audited(spark, sf).withColumns({c: F.round(c, 6) for c in amounts})
    return rounded(P.outcome_distribution(rows, V.OUTCOME_COLUMNS))


_FLAGS = [c for c in V.OUTCOME_COLUMNS if not c.endswith("_value")]


@query(
    "outcome_distribution_json",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS outcome_column, round(avg({c}) + 1e-9, 6) AS mean, 0.0::DOUBLE AS missing_rate,
            concat('{{', concat_ws(',', IF(bool_or({c} = 0), concat('"0.0":', count(*) FILTER ({c} = 0)), NULL), IF(bool_or({c} = 1), concat('"1.0":', count(*) FILTER ({c} = 1)), NULL)), '}}') AS distribution_json
            FROM v_audited"""
        for c in _FLAGS
    ),
)
def outcome_distribution_json(spark, sf):
    """The outcome flags, each as one map of its values."""
    return rounded(P.outcome_distribution_json(P.outcome_distribution(I.audited(spark, sf), _FLAGS)))


@query(
    "assignment_coverage",
    "SELECT assignment_date, count(*) AS row_count, count(DISTINCT player_id) AS unique_users FROM v_response GROUP BY assignment_date",
)
def assignment_coverage(spark, sf):
    return P.assignment_coverage(I.response(spark, sf))


@query(
    "treatment_combo_summary",
    """SELECT treatment_combo, count(*) AS row_count, count(DISTINCT player_id) AS unique_users,
       round(count(*) / (sum(count(*)) OVER ()) + 1e-9, 6) AS row_share FROM v_combo GROUP BY treatment_combo""",
)
def treatment_combo_summary(spark, sf):
    return rounded(P.treatment_combo_summary(I.audited(spark, sf)))


@query(
    "treatment_trend_daily",
    """SELECT assignment_date, treatment_combo, count(*) AS row_count, count(DISTINCT player_id) AS unique_users
       FROM v_combo GROUP BY assignment_date, treatment_combo""",
)
def treatment_trend_daily(spark, sf):
    return P.treatment_trend_daily(I.audited(spark, sf))


@query(
    "treatment_trend_weekly",
    """SELECT CAST(date_trunc('week', assignment_date) AS DATE) AS assignment_week, treatment_combo, count(*) AS row_count,
       count(DISTINCT player_id) AS unique_users FROM v_combo GROUP BY 1, treatment_combo""",
)
def treatment_trend_weekly(spark, sf):
    return P.treatment_trend_weekly(I.audited(spark, sf))


# --- timing --------------------------------------------------------------------------------

# every row is kept; some dates are moved so that the checks have something to find
_MOVED_SQL = """(SELECT * REPLACE (
     CASE WHEN u % 17 = 0 THEN assignment_date WHEN u % 17 = 1 THEN NULL ELSE feature_snapshot_date END AS feature_snapshot_date,
     CASE WHEN u % 19 = 0 AND first_outcome_event_date IS NOT NULL THEN assignment_date ELSE first_outcome_event_date END AS first_outcome_event_date,
     CASE WHEN u % 23 = 0 AND last_outcome_event_date IS NOT NULL THEN assignment_date ELSE last_outcome_event_date END AS last_outcome_event_date)
   FROM (SELECT *, CAST(player_id AS BIGINT) AS u FROM v_response) r) moved"""


def _moved_dates(spark, sf):
    u, day = F.col("player_id").cast("bigint"), F.col("assignment_date")
    first, last = F.col("first_outcome_event_date"), F.col("last_outcome_event_date")
    return I.response(spark, sf).withColumns(
        {
            "feature_snapshot_date": F.when(u % 17 == 0, day).when(u % 17 != 1, F.col("feature_snapshot_date")),
            "first_outcome_event_date": F.when((u % 19 == 0) & first.isNotNull(), day).otherwise(first),
            "last_outcome_event_date": F.when((u % 23 == 0) & last.isNotNull(), day).otherwise(last),
        }
    )


_TIMING = {
    "feature_snapshot_not_strictly_before_assignment": "feature_snapshot_date >= assignment_date",
    "feature_snapshot_inside_minimum_lag_window": "feature_snapshot_date > assignment_date - INTERVAL 1 DAY",
    "first_outcome_event_not_after_assignment": "first_outcome_event_date <= assignment_date",
    "last_outcome_event_not_after_assignment": "last_outcome_event_date <= assignment_date",
}


@query(
    "timing_violations",
    " UNION ALL ".join(
        f'SELECT \'{name}\' AS "check", count(*) FILTER (WHERE {rule}) AS violation_rows FROM {_MOVED_SQL}' for name, rule in _TIMING.items()
    ),
)
def timing_violations(spark, sf):
    return X.timing_violations(_moved_dates(spark, sf))


@query(
    "timing_violation_rows",
    f"""SELECT player_id, assignment_date, feature_snapshot_date, first_outcome_event_date, last_outcome_event_date,
        {', '.join(f'coalesce(({rule})::BIGINT, 0) AS {name}' for name, rule in _TIMING.items())}
        FROM {_MOVED_SQL} WHERE {' OR '.join(f'coalesce({rule}, false)' for rule in _TIMING.values())}""",
)
def timing_violation_rows(spark, sf):
    return X.timing_violation_rows(_moved_dates(spark, sf))


# --- groups --------------------------------------------------------------------------------


@query(
    "reference_group",
    """SELECT treatment_group AS reference_group FROM (SELECT coalesce(treatment_group, '<null>') AS treatment_group, count(*) AS n
       FROM v_audited GROUP BY 1) g ORDER BY CASE treatment_group WHEN '0' THEN 0 WHEN 'control' THEN 1 ELSE 2 END, n DESC, treatment_group LIMIT 1""",
)
def reference_group(spark, sf):
    return X.reference_group(X.group_counts(I.audited(spark, sf)))


_STATS = " UNION ALL ".join(
    f"""SELECT treatment_group AS g, '{f}' AS feature_name, avg({f}) AS m, var_samp({f}) AS v, count({f}) AS k,
        1 - count({f}) / count(*) AS miss FROM v_audited GROUP BY treatment_group"""
    for f in NUMERIC_FEATURES
)
_COMPARABILITY = f"""
SELECT c.feature_name, c.g AS comparison_group, r.g AS reference_group, round(r.m + 1e-9, 6) + 0.0 AS reference_mean,
   round(c.m + 1e-9, 6) + 0.0 AS comparison_mean, round(sqrt(r.v) + 1e-9, 6) AS reference_std, round(sqrt(c.v) + 1e-9, 6) AS comparison_std,
   round(r.miss + 1e-9, 6) AS reference_missing_rate, round(c.miss + 1e-9, 6) AS comparison_missing_rate,
   round(c.miss - r.miss + 1e-9, 6) + 0.0 AS missing_rate_gap,
   round((c.m - r.m) / nullif(sqrt((c.v + r.v) / 2), 0) + 1e-9, 6) + 0.0 AS standardized_mean_difference,
   (coalesce(abs((c.m - r.m) / nullif(sqrt((c.v + r.v) / 2), 0)), 0) >= 0.25 OR abs(c.miss - r.miss) >= 0.10)::BIGINT AS imbalance_flag
FROM ({_STATS}) c JOIN ({_STATS}) r ON c.feature_name = r.feature_name AND r.g = 'control' WHERE c.g <> 'control'"""


@query("group_comparability", _COMPARABILITY)
def group_comparability(spark, sf):
    return rounded(X.group_comparability(I.audited(spark, sf), NUMERIC_FEATURES))


@query(
    "feasibility",
    f"""WITH c AS (SELECT count(*) FILTER (WHERE treatment_combo = 'no_treatment') > 0 AS control,
          count(*) FILTER (WHERE treatment_combo = 'voucher_and_sms') > 0 AND count(*) FILTER (WHERE treatment_combo = 'voucher_only') > 0
          AND count(*) FILTER (WHERE treatment_combo = 'sms_only') > 0 AS combos, sum(treatment_flag) > 0 AS treated,
          count(DISTINCT treatment_group) >= 2 AS grps,
          avg(CASE WHEN assignment_date + INTERVAL 3 DAY <= DATE '2024-01-30' THEN 1.0 ELSE 0.0 END) >= 0.95 AS maturity_ok,
          count(*) FILTER (WHERE {' OR '.join(f'coalesce({r}, false)' for r in _TIMING.values())}) = 0 AS timing_ok FROM v_combo),
        b AS (SELECT coalesce(avg(imbalance_flag), 0) AS imbalance FROM ({_COMPARABILITY}) q),
        a AS (SELECT *, imbalance <= 0.20 AS balance_ok FROM c, b)
        SELECT control AND treated AND grps AND maturity_ok AND timing_ok AND balance_ok AS true_uplift_feasible,
          control AND treated AND maturity_ok AND timing_ok AND balance_ok AS binary_treatment_uplift_feasible,
          control AND combos AND maturity_ok AND timing_ok AND balance_ok AS multi_treatment_uplift_feasible,
          NOT (control AND treated AND maturity_ok AND timing_ok AND balance_ok) AS policy_evaluation_only,
          control AS has_control_group, maturity_ok, timing_ok, balance_ok AS imbalance_ok, round(imbalance + 1e-9, 6) AS imbalance_flag_rate,
          concat_ws('; ', IF(control, NULL, 'no untreated rows'), IF(maturity_ok, NULL, 'outcome windows not complete'), IF(timing_ok, NULL, 'timing violations'),
            IF(balance_ok, NULL, 'groups differ before treatment'), IF(combos, NULL, 'not every channel combination present')) AS reasons FROM a""",
)
def feasibility(spark, sf):
    """The audited rows are written once for the four results made from them."""
    rows = cut_lineage(I.audited(spark, sf))
    result = X.feasibility(
        rows,
        outcome_maturity(rows, {"gross_bet_3d": 3}, I.AS_OF),
        X.timing_violations(rows),
        X.group_comparability(rows, NUMERIC_FEATURES),
    )
    return rounded(result)


_CONTRACT_SQL = " UNION ALL ".join(
    [
        f"""SELECT 'max_null_rate' AS check_name, '{c}' AS column_name, round(count(*) FILTER (WHERE {c} IS NULL) / count(*) + 1e-9, 6) AS observed,
            {m}::DOUBLE AS limit_value, count(*) FILTER (WHERE {c} IS NULL) / count(*) > {m} AS violated FROM v_audited"""
        for c, m in V.MAX_NULL_RATE.items()
    ]
    + [
        f"""SELECT 'key_not_null', '{c}', count(*) FILTER (WHERE {c} IS NULL)::DOUBLE, 0::DOUBLE,
            count(*) FILTER (WHERE {c} IS NULL) > 0 FROM v_audited"""
        for c in V.KEY_COLUMNS
    ]
    + [
        """SELECT 'allowed_flag_values', 'treatment_flag', count(*) FILTER (WHERE treatment_flag NOT IN (0, 1))::DOUBLE, 0::DOUBLE,
           count(*) FILTER (WHERE treatment_flag NOT IN (0, 1)) > 0 FROM v_audited""",
        """SELECT 'minimum_treatment_share', 'treatment_flag', round(avg(treatment_flag) + 1e-9, 6), 0.01::DOUBLE, avg(treatment_flag) < 0.01 FROM v_audited""",
        """SELECT 'maximum_treatment_share', 'treatment_flag', round(avg(treatment_flag) + 1e-9, 6), 1.0::DOUBLE, avg(treatment_flag) > 1.0 FROM v_audited""",
    ]
)


@query("data_contract", _CONTRACT_SQL)
def data_contract(spark, sf):
    return rounded(V.data_contract(I.audited(spark, sf)))
