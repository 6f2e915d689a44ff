from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from dayledger.operators import alerts as A
from dayledger.operators import audit as X
from dayledger.operators import monitoring as M
from dayledger.operators import scoring as C
from dayledger.operators import splits as S
from dayledger.functions.columns import treatment_combo, week_start
from dayledger.sources import fixtures as fx
from dayledger.sources import scans, sinks
from dayledger.sources.schemas import MONITORING_ALERTS, RESPONSE_DATASET
from dayledger.session import fresh_path
from dayledger.workload import inputs as I
from dayledger.workload import model_queries, monitoring_queries

QUIET = dict(
    row_count=100, reference_row_count=100, duplicate_player_count=0, invalid_score_count=0, metadata_missing_rows=0,
    snapshot_date_lag_days=1, snapshot_date_distinct_count=1, top_bucket_share=0.4, vip_missing_rate=0.0,
    score_min=0.1, score_max=0.9,
)
TYPES = ", ".join(f"{k} {'double' if isinstance(v, float) else 'long'}" for k, v in QUIET.items())


def raised(spark, **changes):
    row = spark.createDataFrame([tuple({**QUIET, **changes}.values())], TYPES)
    return {(a.check_name, a.severity) for a in A.daily_alerts(row).collect()}


@pytest.mark.parametrize(
    ("changes", "expected"),
    [
        ({}, set()),
        ({"row_count": 0, "reference_row_count": 0}, {("empty_or_small_partition", "critical")}),
        ({"duplicate_player_count": 1}, {("duplicate_player_ids", "critical")}),
        ({"invalid_score_count": 1}, {("invalid_score_range", "critical")}),
        ({"metadata_missing_rows": 1}, {("missing_model_metadata", "critical")}),
        ({"snapshot_date_lag_days": 3}, set()),
        ({"snapshot_date_lag_days": 4}, {("snapshot_date_staleness", "warning")}),
        ({"snapshot_date_lag_days": None}, set()),
        ({"snapshot_date_distinct_count": 2}, set()),
        ({"snapshot_date_distinct_count": 3}, {("snapshot_date_dispersion", "warning")}),
        ({"row_count": 91}, set()),
        ({"row_count": 90}, {("row_count_drop", "warning")}),
        ({"row_count": 76}, {("row_count_drop", "warning")}),
        ({"row_count": 75}, {("row_count_drop", "critical")}),
        ({"row_count": 114}, set()),
        ({"row_count": 115}, {("row_count_growth", "warning")}),
        ({"row_count": 135}, {("row_count_growth", "warning")}),
        ({"row_count": 500, "reference_row_count": None}, set()),
        ({"top_bucket_share": 0.7}, set()),
        ({"top_bucket_share": 0.71}, {("top_bucket_share", "warning")}),
        ({"top_bucket_share": 0.009}, {("top_bucket_share", "warning")}),
        ({"vip_missing_rate": 0.05}, set()),
        ({"vip_missing_rate": 0.051}, {("vip_level_missingness", "warning")}),
        ({"score_max": 1.01}, {("score_range", "critical")}),
    ],
)
def test_daily_limits(spark, changes, expected):
    assert raised(spark, **changes) == expected


@pytest.mark.parametrize(
    ("rows", "positives", "rate", "avg", "status", "expected"),
    [
        (1000, 25, 0.5, 0.5, "evaluated", set()),
        (999, 25, 0.5, 0.5, "evaluated", {("insufficient_rows", "warning")}),
        (1000, 24, 0.5, 0.5, "evaluated", {("insufficient_positive_events", "warning")}),
        (1000, 25, 0.01, 0.01, "evaluated", {("realized_response_collapse", "warning")}),
        (1000, 25, 0.005, 0.005, "evaluated", {("realized_response_collapse", "critical")}),
        (1000, 25, 0.5, 0.75, "evaluated", {("calibration_gap", "critical")}),
        (1000, 25, 0.5, 0.59, "evaluated", {("calibration_gap", "warning")}),
        (0, 0, None, None, "not_evaluable", set()),
    ],
)
def test_performance_limits(spark, rows, positives, rate, avg, status, expected):
    row = spark.createDataFrame(
        [(rows, positives, rate, avg, status)],
        "row_count long, positive_label_count long, response_rate_actual double, avg_score double, status string",
    )
    assert {(a.check_name, a.severity) for a in A.performance_alerts(row).collect()} == expected


def test_status_is_the_worst_severity(spark):
    kinds = spark.createDataFrame([("warning",), ("critical",)], "severity string")
    assert A.overall_status(kinds).first().monitor_status == "critical"
    assert A.overall_status(kinds.where("severity = 'warning'")).first().monitor_status == "warning"
    assert A.overall_status(kinds.where("false")).first()[:] == (0, "ok")


def test_immature_partition(spark):
    row = M.monitor_performance(spark.range(3), "20240128", labels_mature=False, run_ts=datetime(2024, 1, 29)).first()
    assert (row.status, row.status_reason, row.row_count, row.precision, row.maturity_horizon_days) == (
        "not_evaluable", "labels_not_mature", 0, None, 7,
    )


def test_population_delta_sides(spark):
    columns = "segment_value string, eligible_row_count long, eligible_distinct_player_count long, snapshot_date_min date, snapshot_date_max date"
    now = spark.createDataFrame([("today", 5, 5, None, None), ("both", 3, 3, None, None)], columns)
    then = spark.createDataFrame([("gone", 4, 4, None, None), ("both", 2, 2, None, None)], columns)
    rows = {r.segment_value: r for r in M.population_delta(now, then).collect()}
    assert (rows["today"].reference_eligible_row_count, rows["today"].eligible_row_delta_ratio) == (0, None)
    assert (rows["gone"].eligible_row_count, rows["gone"].eligible_row_delta_ratio) == (0, -1.0)
    assert rows["both"].eligible_row_delta_ratio == 0.5
    assert M.population_delta(now, None).where("eligible_row_delta IS NOT NULL").isEmpty()


def test_treatment_labels(spark):
    cases = [("voucher", 1), ("sms", 1), ("sms | voucher|sms", 1), ("", 0), (None, 0), (None, 1), ("push", 1), ("push|sms", 1)]
    rows = spark.createDataFrame(cases, "tokens string, flag long").select(treatment_combo("tokens", "flag"))
    assert [r[0] for r in rows.collect()] == [
        "voucher_only", "sms_only", "voucher_and_sms", "no_treatment", "no_treatment", "unknown",
        "other_multi_treatment", "other_multi_treatment",
    ]


def test_week_starts_on_monday(spark):
    row = spark.createDataFrame([(date(2024, 1, 14),), (date(2024, 1, 15),)], "d date").select(week_start("d")).collect()
    assert [r[0] for r in row] == [date(2024, 1, 8), date(2024, 1, 15)]


def listing(spark, *pts):
    return spark.createDataFrame([(p,) for p in pts], "pt string")


def test_split_plan_gaps_and_shortage(spark):
    days = [f"202401{d:02d}" for d in range(1, 11)]
    plan = S.split_plan(listing(spark, *days), date(2024, 1, 14), 5, 2, 3)
    assert {r.pt: r.split for r in plan.collect()}["20240110"] == "test"
    S.require_complete_plan(plan, 10)
    S.require_same_partitions(listing(spark, *days), plan)
    with pytest.raises(ValueError, match="differ"):
        S.require_same_partitions(listing(spark, *days[1:]), plan)
    with pytest.raises(ValueError, match="gaps"):
        S.require_complete_plan(S.split_plan(listing(spark, *days[:4], *days[5:]), date(2024, 1, 14), 4, 2, 3), 9)
    with pytest.raises(ValueError, match="not enough"):
        S.require_complete_plan(S.split_plan(listing(spark, *days), date(2024, 1, 12), 5, 2, 3), 10)


def test_recorded_split_windows(spark):
    first = date(2026, 2, 1)
    days = [date.fromordinal(first.toordinal() + i).strftime("%Y%m%d") for i in range(92)]
    windows = {r.split: (r.start_pt, r.end_pt) for r in S.split_windows(S.split_plan(listing(spark, *days), date(2026, 5, 5))).collect()}
    assert windows == {"train": ("20260312", "20260410"), "validation": ("20260411", "20260417"), "test": ("20260418", "20260501")}


def test_no_mature_partition(spark):
    with pytest.raises(ValueError, match="mature"):
        S.require_mature_window(S.runtime_window(listing(spark, "20240110"), date(2024, 1, 11)))


def test_partition_resolution(spark):
    days = listing(spark, "20240101", "20240103")
    assert scans.latest_partition(days).first().pt == "20240103"
    assert scans.latest_partition(days, "20240101").first().pt == "20240101"
    with pytest.raises(Exception, match="not listed"):
        scans.latest_partition(days, "20240102").collect()
    assert scans.reference_partition(days, "20240101").first().reference_pt is None


def test_empty_dataset_is_refused(spark):
    days = listing(spark, "20240101")
    assert scans.load_dataset(days, ["pt", "pt"]).columns == ["pt"]
    with pytest.raises(ValueError, match="20240102"):
        scans.load_dataset(days, ["pt"], "20240102")


def test_writes_replace_one_partition(spark):
    path = fresh_path(spark, "alerts")
    rows = spark.createDataFrame([("warning", "c")], "severity string, check_name string")
    for pt in ("20240101", "20240102"):
        sinks.write_partition(rows, path, MONITORING_ALERTS, pt)
    table = lambda: {r.pt: r["count"] for r in sinks.read_table(spark, path, MONITORING_ALERTS).groupBy("pt").count().collect()}
    sinks.write_partition(rows, path, MONITORING_ALERTS, "20240102", "append")
    assert table() == {"20240101": 1, "20240102": 2}
    sinks.write_partition(rows.where("false"), path, MONITORING_ALERTS, "20240102")
    assert table() == {"20240101": 1, "20240102": 2}  # an empty frame changes nothing
    sinks.replace_partition(rows.where("false"), path, MONITORING_ALERTS, "20240102")
    assert table() == {"20240101": 1}  # unless results of earlier runs must go
    with pytest.raises(ValueError):
        sinks.write_partition(rows, path, MONITORING_ALERTS, "20240102", "upsert")
    expired = sinks.drop_expired(spark, path, listing(spark, "20240101"), date(2024, 8, 1), 180)
    assert expired == ["20240101"]


def test_catalog_table(spark):
    spark.sql("DROP TABLE IF EXISTS days_kept")
    path = fresh_path(spark, "catalog")
    spark.sql(sinks.create_table_sql("days_kept", "response_dataset", path))
    assert spark.table("days_kept").schema.fieldNames() == RESPONSE_DATASET.fieldNames()
    spark.sql("ALTER TABLE days_kept ADD PARTITION (pt='20240101')")
    assert [r.pt for r in scans.catalog_partitions(spark, "days_kept").collect()] == ["20240101"]
    spark.sql("DROP TABLE days_kept")


def test_align_reports_both_lists(spark):
    aligned, report = sinks.align_to_schema(spark.createDataFrame([("w", 1)], "severity string, odd int"), MONITORING_ALERTS)
    assert report["extra_columns"] == ["odd"] and "message" in report["missing_columns"]
    assert aligned.schema.fieldNames() == MONITORING_ALERTS.fieldNames()


def test_reference_group_order(spark):
    def pick(*groups):
        return X.reference_group(spark.createDataFrame(groups, "treatment_group string, row_count long")).first()[0]

    assert pick(("1", 9), ("0", 1), ("control", 5)) == "0"
    assert pick(("1", 9), ("control", 5)) == "control"
    assert pick(("1", 9), ("2", 10)) == "2"


def test_comparability_of_constant_and_missing_features(spark):
    rows = spark.createDataFrame(
        [("control", 1.0, 1.0, None), ("control", 1.0, 2.0, 1.0), ("sms", 1.0, 5.0, 1.0), ("sms", 1.0, 6.0, 1.0), ("one", 1.0, 5.0, 1.0)],
        "treatment_group string, flat double, moved double, gaps double",
    )
    got = {(r.feature_name, r.comparison_group): r for r in X.group_comparability(rows, ["flat", "moved", "gaps"]).collect()}
    assert got["flat", "sms"].standardized_mean_difference is None and got["flat", "sms"].imbalance_flag == 0
    assert got["moved", "sms"].standardized_mean_difference == pytest.approx(4 / 0.5**0.5)
    assert got["moved", "one"].standardized_mean_difference is None  # one row has no deviation
    assert got["gaps", "sms"].missing_rate_gap == -0.5 and got["gaps", "sms"].imbalance_flag == 1


def test_feasibility_reasons(spark):
    rows = spark.createDataFrame(
        [("control", None, 0), ("sms", "sms", 1), ("voucher", "voucher", 1)],
        "treatment_group string, source_treatment_types string, treatment_flag long",
    )
    maturity = spark.createDataFrame([(0.94,)], "matured_share double")
    timing = spark.createDataFrame([("c", 0)], "check string, violation_rows long")
    flags = spark.createDataFrame([(0,), (0,), (0,), (1,)], "imbalance_flag long")
    row = X.feasibility(rows, maturity, timing, flags).first()
    assert row.has_control_group and not row.maturity_ok and row.timing_ok and not row.imbalance_ok
    assert row.imbalance_flag_rate == 0.25 and row.policy_evaluation_only
    assert row.reasons.split("; ") == [
        "outcome windows not complete", "groups differ before treatment", "not every channel combination present",
    ]
    good = X.feasibility(rows, maturity.select(F.lit(1.0).alias("matured_share")), timing, flags.where("imbalance_flag = 0")).first()
    assert good.true_uplift_feasible and not good.multi_treatment_uplift_feasible


def test_catalog_tells_comments_and_partition(spark, tmp_path):
    spark.sql(sinks.create_table_sql("told", "response_scores", str(tmp_path / "told")))
    told = {r.column_name: (r.data_type, r.comment, r.is_partition) for r in scans.catalog_inventory(spark, "told").collect()}
    spark.sql("DROP TABLE told")
    assert told["score_rank"] == ("bigint", "rank by score, best first", False)
    assert told["pt"] == ("string", "scored day, yyyymmdd", True)


def test_counting_a_partition_reads_no_column(spark, tmp_path):
    spark.range(10).selectExpr("id", "CAST(id % 2 AS STRING) AS pt").write.partitionBy("pt").parquet(str(tmp_path / "t"))
    table = spark.read.schema("id long, pt string").parquet(str(tmp_path / "t"))
    counted = scans.partition_row_count(table, "1")
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan and "PartitionFilters: [isnotnull(pt" in plan
    assert counted.first() == ("1", 5, True)
    assert scans.partition_row_count(table, "7").first() == ("7", 0, False)


@pytest.fixture
def tables(spark, tmp_path):
    """Bets of forty users on every day of January, and their customers."""
    rows = spark.range(40 * 30).selectExpr(
        "id AS event_id", "TIMESTAMP'2024-01-01' + make_dt_interval(CAST(id DIV 40 AS INT)) AS ts", "id % 40 AS user_id",
        "'purchase' AS event_type", "CAST(id % 9 AS DOUBLE) AS value", "concat('k', id) AS props",
    )
    rows.write.parquet(f"{tmp_path}/events.parquet")
    spark.range(40).selectExpr("id AS c_custkey", "'BUILDING' AS c_mktsegment").write.parquet(f"{tmp_path}/customer.parquet")
    return str(tmp_path)


def test_alerts_rank_the_partition_once_and_sort_written_rows(spark, tables, monkeypatch):
    sorted_from = []
    rank = C.rank_scores
    monkeypatch.setattr(C, "rank_scores", lambda rows: sorted_from.append(rows.inputFiles()) or rank(rows))
    alerts = {(r.mode, r.check_name) for r in monitoring_queries.alerts_table(spark, tables).collect()}
    assert ("daily", "duplicate_player_ids") in alerts and ("performance", "insufficient_rows") in alerts
    assert len(sorted_from) == 1
    assert not [f for f in sorted_from[0] if "events.parquet" in f]


def test_reference_rows_are_those_of_the_ranked_partition(spark, tables):
    counted = I.reference_row_count(spark, tables).first().reference_row_count
    assert counted == I.scores(spark, tables, I.REFERENCE_PT).count() == 40


def test_written_monitoring_makes_the_mart_once(spark, tables, monkeypatch):
    made, published = [], []
    mart, publish = fx.feature_mart, model_queries.scoring_run.publish
    monkeypatch.setattr(fx, "feature_mart", lambda *a, **k: made.append(a) or mart(*a, **k))
    monkeypatch.setattr(model_queries.scoring_run, "publish", lambda s, rows, *a, **k: published.append(rows.inputFiles()) or publish(s, rows, *a, **k))
    written = {r.table_name: r.row_count for r in model_queries.write_monitoring(spark, tables).collect()}
    assert written["monitoring_daily"] > 1 and written["monitoring_performance"] == 1
    assert len(made) == 1 and len(published) == 2
    assert not [f for files in published for f in files if "events.parquet" in f]


def test_replacing_rows_are_made_once(spark):
    """A frame that is looked at and then written is evaluated once: its rows are counted as they are made."""
    path, seen = fresh_path(spark, "alerts_once"), spark.sparkContext.accumulator(0)

    def told(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows = spark.createDataFrame([("warning", "a"), ("critical", "b")], "severity string, check_name string")
    sinks.replace_partition(rows.mapInPandas(told, rows.schema), path, MONITORING_ALERTS, "20240101")
    assert seen.value == 2
    assert {r.check_name for r in sinks.read_table(spark, path, MONITORING_ALERTS).collect()} == {"a", "b"}
