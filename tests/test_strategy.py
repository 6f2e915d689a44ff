"""Decisions, treatments and outcome windows at their edges, and costs by priority."""

import itertools
import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dayledger.operators import strategy as S
from dayledger.operators.timeline import nearest, window_sums
from dayledger.sources import fixtures as fx
from dayledger.workload import strategy_queries as queries

T0 = datetime(2024, 1, 10, 12)
SOURCES = {s: s for s in S.SOURCES}


def at(days=0.0, seconds=0):
    return T0 + timedelta(days=days, seconds=seconds)


def build(spark, decisions, treatments=(), bets=(), snapshots=(), scores=(), **more):
    frames = [
        spark.createDataFrame([(p, t, "rule_based", "v", 1, "r") for p, t in decisions],
                              "player_id string, decision_timestamp timestamp_ntz, strategy_group string, strategy_version string, selected_flag long, selection_reason_code string"),
        spark.createDataFrame([(p, t, "sms", "s", f"id{i}", a, f, "EUR") for i, (p, t, a, f) in enumerate(treatments)],
                              "player_id string, treatment_timestamp timestamp_ntz, treatment_type string, treatment_subtype string, treatment_source_event_id string, "
                              "treatment_cost_actual decimal(20,6), treatment_cost_fallback decimal(20,6), treatment_cost_currency string"),
        spark.createDataFrame([(p, t, Decimal(v), Decimal(v) / 2) for p, t, v in bets], "player_id string, event_ts timestamp_ntz, bet_amount decimal(20,6), ggr decimal(20,6)"),
        spark.createDataFrame(list(snapshots), "player_id string, snapshot_date date, is_eligible long, vip_level string, value_segment string"),
        spark.createDataFrame(list(scores), "player_id string, scoring_ts timestamp_ntz, score double, selected_threshold double"),
    ]
    settings = {"observed_through": at(5), "build_version": "b", "build_timestamp": T0, "sources": SOURCES} | more
    return S.strategy_dataset(*frames, **settings)


def by_moment(rows):
    return {(r.player_id, r.decision_timestamp): r for r in rows.collect()}


def test_windows_are_open_at_the_start_and_closed_at_the_end(spark):
    bets = [("a", at(), "1"), ("a", at(seconds=1), "2"), ("a", at(3), "4"), ("a", at(3, 1), "8"), ("a", at(7), "16"), ("a", at(7, 1), "32"), ("b", at(1), "64"), (None, at(1), "5"), ("a", None, "5")]
    row = build(spark, [("a", at()), ("c", at())], bets=bets).orderBy("player_id").collect()
    assert [float(x) for x in (row[0].gross_bet_amount_t_plus_3, row[0].gross_bet_amount_t_plus_7, row[0].gross_ggr_t_plus_3)] == [6, 30, 3]
    assert (row[0].label_ready_3d, row[0].label_ready_7d, row[0].treatment_cost_source) == (1, 0, "none")
    assert row[0].net_value_t_plus_3 == 3 and row[1].gross_bet_amount_t_plus_7 == 0 and row[1].net_value_t_plus_7 == 0
    assert row[0].outcome_window_end_7d_ts == at(7) and row[0].pt == "20240110"


def test_a_treatment_belongs_to_the_decision_before_it(spark):
    decisions = [("a", at()), ("a", at(0.1)), ("a", at(0.2)), ("a", at(10)), ("b", at())]
    treatments = [("a", at(-0.1), "1", None), ("a", at(0.1), "2", "9"), ("a", at(0.15), "3", None), ("a", at(13, 1), "4", None), ("b", at(3), None, "5")]
    treatments = [(p, t, Decimal(a) if a else None, Decimal(f) if f else None) for p, t, a, f in treatments]
    rows = by_moment(build(spark, decisions, treatments, [("a", at(0.1), "7"), ("a", at(0.1, 1), "8"), ("b", at(2), "3"), ("b", at(4), "6")]))
    assert rows["a", at()].treatment_timestamp is None  # the next decision's moment is the next decision's
    second = rows["a", at(0.1)]
    assert (second.treatment_timestamp, second.treatment_cost_source, second.outcome_window_start_ts) == (at(0.1), "actual", at(0.1))
    assert second.net_value_t_plus_3 == Decimal("8") / 2 - 2
    assert rows["a", at(0.2)].actual_treatment_flag == 0 and rows["a", at(10)].actual_treatment_flag == 0
    late = rows["b", at()]
    assert (late.treatment_timestamp, late.treatment_cost_source) == (at(3), "fallback")
    assert (late.gross_bet_amount_t_plus_3, late.net_value_t_plus_3) == (6, 3 - 5)


def test_unknown_costs_are_not_free(spark):
    row = build(spark, [("a", at())], [("a", at(), None, None)], [("a", at(1), "4")]).first()
    assert (row.treatment_cost_source, row.net_value_t_plus_3, row.gross_ggr_t_plus_3) == ("missing", None, 2)
    frame = spark.createDataFrame([(1, 5.0, None, 10.0), (1, None, 2.0, 10.0), (1, 0.0, 2.0, 10.0), (0, 5.0, 1.0, 10.0), (None, 5.0, 1.0, 10.0), (1, 1.0, 1.0, None)],
                                  "treated long, invoice double, list_price double, gross double")
    priced = S.net_value(frame, {"net": "gross"}, costs={"invoice": "invoice", "list": "list_price"}, treated="treated")
    assert [(r.treatment_cost_source, float(r.treatment_cost), r.net and float(r.net)) for r in priced.collect()] == [
        ("invoice", 5, 5), ("list", 2, 8), ("invoice", 0, 10), ("none", 0, 10), ("none", 0, 10), ("invoice", 1, None),
    ]
    rates = priced.select(S.return_on_cost("net", "treatment_cost").alias("r")).collect()
    assert [r.r for r in rates] == [1, 4, None, None, None, None]


def test_context_is_what_was_known_by_the_decision(spark):
    day = T0.date()
    snapshots = [("a", day - timedelta(days=3), 1, "V3", None), ("a", day - timedelta(days=1), 0, "gold", "s"), ("a", day, 1, "V9", None)]
    scores = [("a", at(-5), 0.1, 0.5), ("a", at(), 0.2, 0.6), ("a", at(seconds=1), 0.3, 0.7)]
    row = build(spark, [("a", at())], snapshots=snapshots, scores=scores).first()
    assert (row.feature_snapshot_date, row.eligibility_flag, row.vip_level_at_decision, row.vip_level_num_at_decision, row.value_segment_at_decision) == (day - timedelta(days=1), 0, "gold", None, "s")
    assert (row.churn_score_at_decision, row.selected_threshold_at_decision) == (0.2, 0.6)


def test_repeated_decisions_are_refused(spark):
    with pytest.raises(ValueError, match="repeated"):
        build(spark, [("a", at()), ("a", at())])
    with pytest.raises(ValueError, match="without key"):
        build(spark, [(None, at())])
    assert build(spark, []).collect() == []


def test_many_moments_against_brute_force(spark):
    rng = random.Random(1)
    moment = lambda: at(rng.randint(0, 12), rng.choice([0, 60, 3600, 86399]))
    facts = [(rng.choice("abc"), moment(), rng.randint(0, 9)) for _ in range(200)]
    points = sorted({(rng.choice("abcd"), moment()) for _ in range(120)})
    left, right = spark.createDataFrame(points, "player_id string, t timestamp_ntz"), spark.createDataFrame(facts, "player_id string, f timestamp_ntz, v int")
    for after, inclusive in itertools.product((False, True), repeat=2):
        got = {(r.player_id, r.t): r.n and (r.n.f, r.n.v) for r in nearest(left, right, at="t", fact_at="f", into="n", after=after, inclusive=inclusive).collect()}
        for p, t in points:
            near = [(f, v) for q, f, v in facts if q == p and (f == t and inclusive or (f > t if after else f < t))]
            assert got[p, t] == ((min if after else max)(near) if near else None)
    sums = window_sums(left, right, keys=["player_id", "t"], start="t", fact_at="f", measures={"s": "v", "m": "v"}, days=(1, 3))
    for r in sums.collect():
        for n in (1, 3):
            assert r[f"s_{n}"] == r[f"m_{n}"] == sum(v for q, f, v in facts if q == r.player_id and r.t < f <= r.t + timedelta(days=n))


def test_hot_players_are_dealt_by_day(spark):
    left = spark.range(3).select(F.lit("a").alias("player_id"), F.lit(T0).cast("timestamp_ntz").alias("t"))
    plan = nearest(left, left.withColumnRenamed("t", "f"), at="t", fact_at="f", into="n")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_p" in plan and plan.count("_day") > 4


def test_mart_is_made_once_in_tasks_that_follow_the_events(spark, tmp_path, monkeypatch):
    kinds = "element_at(array('purchase', 'click', 'error', 'signup'), CAST(1 + id % 4 AS INT))"
    rows = spark.range(400).selectExpr(
        "id AS event_id", "TIMESTAMP'2024-01-03' + make_dt_interval(CAST(id % 27 AS INT)) AS ts", "id % 40 AS user_id",
        f"{kinds} AS event_type", "CAST(id % 9 AS DOUBLE) AS value", "concat('k', id) AS props",
    )
    rows.write.parquet(f"{tmp_path}/events.parquet")
    spark.range(40).selectExpr("id AS c_custkey", "'BUILDING' AS c_mktsegment").write.parquet(f"{tmp_path}/customer.parquet")
    sf = str(tmp_path)
    # one task for few events, and as many as it takes for more of them, whatever the shuffle setting
    assert fx.feature_mart(spark, sf, eligible_only=True).rdd.getNumPartitions() == 1
    monkeypatch.setattr(fx, "TASK_EVENTS", 50, raising=False)
    for eligible in (True, False):
        assert fx.feature_mart(spark, sf, eligible_only=eligible).rdd.getNumPartitions() == 8
    dataset = queries._dataset(spark, sf)
    # the customers are read by the mart only
    assert not [f for f in dataset.inputFiles() if "customer.parquet" in f]
    assert dataset.count() == 200
