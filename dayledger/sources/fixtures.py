"""The four source tables of the jobs, derived from the `events` and `customer` tables.

purchase = bet, signup = deposit, error = withdrawal, click = voucher, view = SMS, market segment = segment.
Every function takes the partition range the caller needs and turns it into a `ts` range, so the
predicate reaches the parquet scan.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import parse_pt

# Days of history: of eligibility and the recent features, and of the longer features.
RECENT_DAYS, LOOKBACK_DAYS = 7, 30
# The day the jobs look back from, and the days until a label counts as mature.
AS_OF = date(2024, 1, 30)
MATURITY_DAYS = 4


_schemas: dict[tuple[str, str], T.StructType] = {}


def given_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its schema is read from the files once a session, not by every query."""
    path = f"{sf_dir}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _schemas:
        _schemas[key] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[key]).parquet(path)


def events(
    spark: SparkSession, sf_dir: str, first: date | None = None, last: date | None = None
) -> DataFrame:
    """Events of whole days, by a range of `ts` that the scan can push down."""
    raw = given_table(spark, sf_dir, "events")
    stamp = raw.schema["ts"].dataType.simpleString()
    if first is not None:
        raw = raw.where(f"ts >= CAST('{first}' AS {stamp})")
    if last is not None:
        raw = raw.where(f"ts < CAST('{last + timedelta(days=1)}' AS {stamp})")
    return raw.selectExpr(
        "event_id",
        "CAST(user_id AS STRING) AS login_name",
        "user_id",
        "ts",
        "CAST(ts AS DATE) AS d",
        "event_type",
        "value",
        "TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k",
    )


def _events_in(spark: SparkSession, sf_dir: str, first_pt: str | None, last_pt: str | None) -> DataFrame:
    return events(
        spark, sf_dir, parse_pt(first_pt) if first_pt else None, parse_pt(last_pt) if last_pt else None
    )


def _pt(day: str) -> str:
    """Partition value of a day, by arithmetic: formatting a date costs far more for every row."""
    return f"CAST(year({day}) * 10000 + month({day}) * 100 + dayofmonth({day}) AS STRING)"


_calendars: dict[tuple[str, str], tuple[str, str, int]] = {}


def _extent(spark: SparkSession, sf_dir: str) -> tuple[str, str, int]:
    """First and last day with events, and the number of events; looked up once a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _calendars:
        bounds = given_table(spark, sf_dir, "events").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"), F.count(F.lit(1)).alias("n"))
        row = bounds.selectExpr("date_format(lo, 'yyyyMMdd') AS lo", "date_format(hi, 'yyyyMMdd') AS hi", "n").first()
        _calendars[key] = (row.lo, row.hi, row.n)
    return _calendars[key]


def calendar(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """First and last day with events."""
    return _extent(spark, sf_dir)[:2]


#: Events whose users one task of the mart looks after, on average.
TASK_EVENTS = 100_000


def mart_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks among which users are dealt. They follow the events: sizes of compressed shuffle files say little about sorted rows."""
    return max(1, -(-_extent(spark, sf_dir)[2] // TASK_EVENTS))


def partition_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition listing of the mart: one row for each day with events."""
    return events(spark, sf_dir).select("d").distinct().selectExpr(f"{_pt('d')} AS pt")


# Segment by market, with absent and unknown segments for two user residues.
_SEGMENT = """
CASE WHEN user_id % 37 = 36 THEN NULL WHEN user_id % 41 = 40 THEN 'UNKNOWN'
     WHEN market = 'BUILDING' THEN 'V1' WHEN market = 'HOUSEHOLD' THEN 'V2'
     WHEN market = 'FURNITURE' THEN 'V3' WHEN market = 'MACHINERY' THEN 'V4' ELSE 'V5' END"""

_MEASURES = ("bet_cnt", "bet_amt", "win_amt", "bet_days", "dep_cnt", "dep_amt", "wd_cnt", "wd_amt")


def feature_mart(
    spark: SparkSession,
    sf_dir: str,
    first_pt: str | None = None,
    last_pt: str | None = None,
    eligible_only: bool = False,
    as_of: date = AS_OF,
) -> DataFrame:
    """One row per user and day with the features of the days before it; by default for all days with events.

    Events are first combined per user and day, so a hot user shrinks to one row a day before any window work.
    Those rows and the wanted days of a user are then sorted once, and each wanted day looks back over them.
    `eligible_only` leaves out the users without a bet in the recent days, and with them the user-by-day panel.
    """
    known, tasks = calendar(spark, sf_dir), mart_tasks(spark, sf_dir)
    lo, hi = parse_pt(first_pt or known[0]), parse_pt(last_pt or known[1])
    daily = (
        events(spark, sf_dir, lo - timedelta(days=LOOKBACK_DAYS), hi - timedelta(days=1))
        .groupBy("user_id", "d")
        .agg(
            F.expr("count_if(event_type = 'purchase') AS bet_cnt"),
            F.expr("coalesce(sum(CASE WHEN event_type = 'purchase' THEN value END), 0D) AS bet_amt"),
            F.expr("coalesce(sum(CASE WHEN event_type = 'purchase' THEN value * (k % 10) / 10 END), 0D) AS win_amt"),
            F.expr("max(CASE WHEN event_type = 'purchase' THEN 1L ELSE 0L END) AS bet_days"),
            F.expr("count_if(event_type = 'signup') AS dep_cnt"),
            F.expr("coalesce(sum(CASE WHEN event_type = 'signup' THEN value END), 0D) AS dep_amt"),
            F.expr("count_if(event_type = 'error') AS wd_cnt"),
            F.expr("coalesce(sum(CASE WHEN event_type = 'error' THEN value END), 0D) AS wd_amt"),
        )
        # all days of a user in one place: at most one row a day, however busy the user
        .repartition(tasks, "user_id")
    )
    if eligible_only:
        reach = f"greatest(date_add(d, 1), DATE'{lo}'), least(date_add(d, {RECENT_DAYS}), DATE'{hi}')"
        bet = daily.where(f"bet_cnt > 0 AND d >= date_sub(DATE'{lo}', {RECENT_DAYS})")
        wanted = bet.selectExpr("user_id", f"explode(sequence({reach})) AS d").distinct()
    else:
        users = given_table(spark, sf_dir, "events").select("user_id").distinct().repartition(tasks, "user_id")
        wanted = users.selectExpr("user_id", f"explode(sequence(DATE'{lo}', DATE'{hi}')) AS d")
    history = daily.selectExpr("*", "CASE WHEN bet_cnt > 0 THEN d END AS bet_day", "false AS wanted")
    both = history.unionByName(wanted.selectExpr("user_id", "d", "true AS wanted"), allowMissingColumns=True)
    both = both.withColumn("at", F.expr("unix_date(d)"))
    by_day = Window.partitionBy("user_id").orderBy("at")

    def before(days: int, measure: str) -> Column:
        return F.coalesce(F.sum(measure).over(by_day.rangeBetween(-days, -1)), F.lit(0))

    features = both.select(
        "user_id",
        F.col("d").alias("day"),
        "wanted",
        F.max("bet_day").over(by_day.rangeBetween(-RECENT_DAYS, -1)).alias("last_bet"),
        *[before(RECENT_DAYS, m).alias(m) for m in _MEASURES],
        *[before(LOOKBACK_DAYS, m).alias(f"long_{m}") for m in ("bet_cnt", "bet_amt", "win_amt", "bet_days")],
    ).where("wanted")

    market = given_table(spark, sf_dir, "customer").selectExpr("c_custkey AS user_id", "c_mktsegment AS market")
    return features.join(market, "user_id", "left").selectExpr(
        "CAST(user_id AS STRING) AS player_id",
        "date_sub(day, 1) AS snapshot_date",
        "bet_cnt AS recent_bet_cnt_7d",
        "bet_amt AS recent_bet_amt_7d",
        "win_amt AS recent_win_amt_7d",
        "bet_amt - win_amt AS recent_ggr_amt_7d",
        "bet_amt - win_amt AS recent_net_loss_amt_7d",
        "bet_days AS recent_bet_days_7d",
        "CAST(datediff(day, last_bet) AS BIGINT) AS recency_last_bet_to_t",
        "long_bet_cnt AS pre_bet_cnt_30d",
        "long_bet_amt AS pre_bet_amt_30d",
        "long_win_amt AS pre_win_amt_30d",
        "long_bet_amt - long_win_amt AS pre_ggr_amt_30d",
        "long_bet_amt - long_win_amt AS pre_net_loss_amt_30d",
        "long_bet_days AS pre_bet_days_30d",
        "dep_cnt AS recent_dep_cnt_7d",
        "dep_amt AS recent_dep_amt_7d",
        "wd_cnt AS recent_withdraw_cnt_7d",
        "wd_amt AS recent_withdraw_amt_7d",
        "dep_amt - wd_amt AS recent_net_cash_in_7d",
        "CAST(day AS TIMESTAMP_NTZ) AS feature_create_time",
        "'v2' AS data_version",
        f"{_SEGMENT} AS vip_level",
        "CASE WHEN bet_cnt > 0 THEN 1L ELSE 0L END AS is_eligible",
        f"CASE WHEN day <= DATE'{as_of - timedelta(days=MATURITY_DAYS)}' THEN 1L ELSE 0L END AS label_maturity_d3",
        f"{_pt('day')} AS pt",
    )


def vouchers(spark: SparkSession, sf_dir: str, first_pt: str | None = None, last_pt: str | None = None) -> DataFrame:
    clicks = _events_in(spark, sf_dir, first_pt, last_pt).where("event_type = 'click'")
    return clicks.selectExpr(
        "login_name",
        "CASE WHEN k % 3 != 0 THEN ts END AS release_datetime",
        "CASE WHEN k % 7 != 0 THEN ts + INTERVAL 1 HOUR END AS clamined_datetime",
        f"{_pt('d')} AS pt",
    )


def sms_sends(spark: SparkSession, sf_dir: str, first_pt: str | None = None, last_pt: str | None = None) -> DataFrame:
    views = _events_in(spark, sf_dir, first_pt, last_pt).where("event_type = 'view'")
    return views.selectExpr(
        "login_name",
        "CASE WHEN k % 5 != 0 THEN ts END AS send_time",
        "ts AS create_time",
        "CASE WHEN k % 10 < 7 THEN 3 ELSE 4 END AS state",
        f"{_pt('d')} AS pt",
    )


def bets(spark: SparkSession, sf_dir: str, first_pt: str | None = None, last_pt: str | None = None) -> DataFrame:
    purchases = _events_in(spark, sf_dir, first_pt, last_pt).where("event_type = 'purchase'")
    return purchases.selectExpr(
        "d AS stat_date",
        "login_name",
        "CASE WHEN k % 11 != 0 THEN concat('site', CAST(k % 4 AS STRING)) END AS bet_site_id",
        "value AS bet_amount",
        "value - value * (k % 10) / 10 AS gross_gaming_revenue",
        f"{_pt('d')} AS pt",
    )


# --- the strategy comparison: decisions, treatments with costs, bets at their moment ---------


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deposit or a withdrawal is a moment at which one of two strategies decides."""
    made = events(spark, sf_dir).where("event_type IN ('signup', 'error')")
    return made.selectExpr(
        "login_name AS player_id",
        "CAST(ts AS TIMESTAMP_NTZ) AS decision_timestamp",
        "CASE WHEN event_type = 'signup' THEN 'churn_model_based' ELSE 'rule_based' END AS strategy_group",
        "CASE WHEN event_type = 'signup' THEN 'churn_v2' ELSE 'rules_v1' END AS strategy_version",
        "CASE WHEN k % 3 != 0 THEN 1L ELSE 0L END AS selected_flag",
        "concat(event_type, '_', CAST(k % 5 AS STRING)) AS selection_reason_code",
    )


def treatment_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vouchers and delivered messages with an actual cost, a fallback cost, both or none."""
    sent = events(spark, sf_dir).where("event_type = 'click' OR (event_type = 'view' AND k % 10 < 7)")
    return sent.selectExpr(
        "login_name AS player_id",
        "CAST(CASE WHEN event_type = 'click' AND k % 3 = 0 THEN ts + INTERVAL 1 HOUR ELSE ts END AS TIMESTAMP_NTZ) AS treatment_timestamp",
        "CASE WHEN event_type = 'click' THEN 'voucher' ELSE 'sms' END AS treatment_type",
        "concat('kind', CAST(k % 3 AS STRING)) AS treatment_subtype",
        "CAST(event_id AS STRING) AS treatment_source_event_id",
        "CAST(CASE WHEN k % 4 != 0 THEN CASE WHEN event_type = 'click' THEN value ELSE 0.07D END END AS DECIMAL(20,6)) AS treatment_cost_actual",
        "CAST(CASE WHEN k % 5 != 0 THEN CASE WHEN event_type = 'click' THEN 5.0D ELSE 0.05D END END AS DECIMAL(20,6)) AS treatment_cost_fallback",
        "CASE WHEN k % 4 != 0 OR k % 5 != 0 THEN 'EUR' END AS treatment_cost_currency",
    )


def timed_bets(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = events(spark, sf_dir).where("event_type = 'purchase'")
    return placed.selectExpr(
        "login_name AS player_id",
        "CAST(ts AS TIMESTAMP_NTZ) AS event_ts",
        "CAST(value AS DECIMAL(20,6)) AS bet_amount",
        "CAST(CAST(value AS DECIMAL(20,6)) - CAST(value AS DECIMAL(20,6)) * (k % 10) / 10 AS DECIMAL(20,6)) AS ggr",
    )


def fixed_score() -> Column:
    """A fixed logit in place of a fitted model, so the same score can be written in SQL."""
    logit = (
        -0.9
        + 0.35 * F.col("recent_bet_cnt_7d")
        + 0.001 * F.col("recent_bet_amt_7d")
        + 0.1 * F.col("recent_dep_cnt_7d")
        - 0.05 * F.coalesce(F.col("recency_last_bet_to_t"), F.lit(0))
    )
    return F.round(1 / (1 + F.exp(-logit)), 6)
