from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from dayledger.operators import dataset as D
from dayledger.sources import fixtures as fx
from dayledger.workload import inputs as I

BETS = "stat_date date, login_name string, bet_site_id string, bet_amount double, gross_gaming_revenue double, pt string"
KEYS = "player_id string, assignment_date date, pt string"


def test_counts_of_the_derived_tables(spark, sf):
    events = fx.given_table(spark, sf, "events")
    users, days = events.select("user_id").distinct().count(), events.select(F.to_date("ts")).distinct().count()
    assert I.mart(spark, sf).count() == users * days  # a row for each user and day
    number = "try_cast(regexp_extract(props, '([0-9]+)', 1) as int)"
    assert fx.vouchers(spark, sf).count() == events.where("event_type = 'click'").count()
    assert fx.sms_sends(spark, sf).where("state = 3").count() == events.where(f"event_type = 'view' and {number} % 10 < 7").count()
    assert fx.bets(spark, sf).where("bet_site_id IS NOT NULL").count() == events.where(f"event_type = 'purchase' and {number} % 11 != 0").count()


def test_labels_are_those_of_later_bets(spark, sf):
    bets = fx.bets(spark, sf).where("bet_amount > 0").select(F.col("login_name").alias("player_id"), "stat_date")
    rows = I.response(spark, sf)
    paired = rows.join(bets, "player_id").where("datediff(stat_date, assignment_date) BETWEEN 1 AND 3")
    assert rows.agg(F.sum("response_label_positive_3d")).first()[0] == paired.select("player_id", "assignment_date").distinct().count() > 0


def test_eligible_mart_is_the_eligible_part(spark, sf):
    whole = I.mart(spark, sf).where("is_eligible = 1")
    part = I.eligible_mart(spark, sf)
    rounded = [F.round(f.name, 6).alias(f.name) if f.dataType.simpleString() == "double" else F.col(f.name) for f in part.schema]
    assert whole.select(rounded).exceptAll(part.select(rounded)).isEmpty()
    assert whole.count() == part.count()


def test_outcome_window_is_open_at_the_start(spark):
    base = spark.createDataFrame([("a", date(2024, 1, 10), "20240110"), ("b", date(2024, 1, 10), "20240110")], KEYS)
    days = [10, 11, 13, 14]
    bets = spark.createDataFrame([(date(2024, 1, d), "a", "s", float(d), 1.0, f"202401{d}") for d in days], BETS)
    rows = {r.player_id: r for r in D.outcome_rollup(base, bets).collect()}
    a, b = rows["a"], rows["b"]
    assert a.outcome_gross_bet_3d_value == 24.0 and a.outcome_source_row_count_3d == 2
    assert (a.first_outcome_event_date, a.last_outcome_event_date) == (date(2024, 1, 11), date(2024, 1, 13))
    assert a.response_label_positive_3d == 1
    assert (b.outcome_gross_bet_3d_value, b.outcome_source_row_count_3d, b.response_label_positive_3d) == (0.0, 0, 0)
    assert b.first_outcome_event_date is None


def test_null_and_empty_site_are_one_source_key(spark):
    base = spark.createDataFrame([("a", date(2024, 1, 10), "20240110")], KEYS)
    bets = spark.createDataFrame(
        [(date(2024, 1, 11), "a", site, 1.0, 1.0, "20240111") for site in (None, "", "s")], BETS
    )
    row = D.outcome_rollup(base, bets).first()
    assert row.outcome_distinct_source_keys_3d == 2 and row.outcome_source_row_count_3d == 3
    assert D.outcome_daily(bets).count() == 3


def test_treatment_timestamps(spark):
    t1, t2 = datetime(2024, 1, 10, 8), datetime(2024, 1, 10, 9)
    base = spark.createDataFrame([(p, date(2024, 1, 10), "20240110") for p in "abcde"], KEYS)
    vouchers = spark.createDataFrame(
        [("a", None, t2, "20240110"), ("c", t1, None, "20240110"), ("d", None, None, "20240110"),
         ("e", datetime(2024, 1, 11), None, "20240110")],
        "login_name string, release_datetime timestamp_ntz, clamined_datetime timestamp_ntz, pt string",
    )
    sends = spark.createDataFrame(
        [("b", None, t1, "3", "20240110"), ("b", t1, t1, "4", "20240110"), ("c", t1, t1, "3", "20240110")],
        "login_name string, send_time timestamp_ntz, create_time timestamp_ntz, state string, pt string",
    )
    rows = {r.player_id: r for r in D.treatment_rollup(base, vouchers, sends).collect()}
    assert [rows[p].treatment_timestamp for p in "abcde"] == [t2, t1, t1, None, None]
    assert [rows[p].raw_assignment_event_count for p in "abcde"] == [1, 1, 2, 0, 0]
    assert [(rows[p].has_voucher_treatment, rows[p].has_sms_treatment) for p in "abc"] == [(1, 0), (0, 1), (1, 1)]


def test_repeated_player_day_is_refused(spark):
    base = spark.createDataFrame([("a", date(2024, 1, 10), "20240110")] * 2, KEYS)
    with pytest.raises(ValueError, match="repeated keys"):
        D.require_unique_grain(base)


def test_one_hot_player_does_not_change_the_outcome(spark):
    """A third of all bets on one player: equal to plain SQL, and no task holds them unaggregated."""
    rows = spark.range(30000).selectExpr(
        "date_add(DATE'2024-01-08', CAST(id % 20 AS INT)) AS stat_date",
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id % 500 AS STRING) END AS login_name",
        "concat('s', id % 7) AS bet_site_id", "1D AS bet_amount", "1D AS gross_gaming_revenue",
        "date_format(date_add(DATE'2024-01-08', CAST(id % 20 AS INT)), 'yyyyMMdd') AS pt",
    )
    base = rows.selectExpr("login_name AS player_id", "stat_date AS assignment_date", "pt").distinct()
    rows.createOrReplaceTempView("hot_bets")
    base.createOrReplaceTempView("hot_base")
    want = spark.sql(
        """SELECT b.player_id, b.assignment_date, count(h.login_name) AS n FROM hot_base b LEFT JOIN hot_bets h
           ON h.login_name = b.player_id AND h.stat_date > b.assignment_date AND h.stat_date <= date_add(b.assignment_date, 3)
           GROUP BY ALL"""
    )
    got = D.outcome_rollup(base, rows).select("player_id", "assignment_date", F.col("outcome_source_row_count_3d").alias("n"))
    assert got.exceptAll(want).isEmpty() and got.count() == want.count()
