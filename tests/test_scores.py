from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from dayledger.operators import contracts as V
from dayledger.operators import scoring as C
from dayledger.operators.ordering import exact_quantiles, rank_rows, running_totals, value_histogram
from dayledger.plans import scoring_run
from dayledger.session import fresh_path
from dayledger.sources.schemas import RESPONSE_SCORES
from dayledger.workload import inputs as I

SLIM = "player_id string, snapshot_date date, vip_level string, predicted_response_score double"
RUN = dict(I.LINEAGE)


def slim(spark, scores):
    return spark.createDataFrame([(f"p{i:03d}", date(2024, 1, 25), "V1", s) for i, s in enumerate(scores)], SLIM)


def test_rank_is_a_permutation_under_ties_and_skew(spark):
    """A third of the rows share one score; ranks equal a plain window."""
    from pyspark.sql import Window

    rows = spark.range(20000).selectExpr(
        "CAST(id AS STRING) AS player_id",
        "CASE WHEN id % 3 = 0 THEN 0.5 ELSE round((id * 7919 % 1000) / 1000, 3) END AS predicted_response_score",
    )
    order = [F.desc("predicted_response_score"), F.asc("player_id")]
    got = rank_rows(rows, order, "r", "n")
    want = rows.withColumn("r", F.row_number().over(Window.orderBy(*order)).cast("bigint")).withColumn("n", F.lit(20000).cast("bigint"))
    assert got.select("player_id", "r", "n").exceptAll(want.select("player_id", "r", "n")).isEmpty()
    # the shared score spreads over several sorted slices instead of one task
    from dayledger.operators.ordering import sort_into_slices

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these rows are too few to stay apart
    try:
        shared = sort_into_slices(rows, order).where("predicted_response_score = 0.5")
        assert shared.select("slice_no").distinct().count() > 1
        spread = rank_rows(rows, order, "r", "n").select("player_id", "r", "n")
        assert spread.exceptAll(want.select("player_id", "r", "n")).isEmpty()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_single_row(spark):
    output, thresholds = C.score_output(slim(spark, [0.4]), "20240126", **RUN)
    row = output.first()
    assert (row.score_rank, row.score_percentile, row.response_priority_bucket) == (1, 1.0, "very_high")
    assert set(thresholds.values()) == {0.4}


def test_buckets_are_monotone_and_complete(spark):
    scores = [((i * 37) % 101) / 101 for i in range(101)]
    rows = C.score_output(slim(spark, scores), "20240126", **RUN)[0].orderBy("score_rank").collect()
    levels = [C.BUCKETS.index(r.response_priority_bucket) for r in rows]
    assert levels == sorted(levels, reverse=True)
    assert len(rows) == 101 and {r.score_rank for r in rows} == set(range(1, 102))


def test_actions(spark):
    rows = spark.createDataFrame(
        [("very_high", None), ("high", "V1"), ("medium", "V4"), ("medium", None), ("medium", "V1"), ("low", "V8")],
        "response_priority_bucket string, vip_level string",
    )
    got = [r[0] for r in rows.select(C.action_recommendation()).collect()]
    assert got == [
        "prioritize_for_campaign_review",
        "prioritize_for_campaign_review",
        "manual_review_high_value_medium_score",
        "standard_priority_review",
        "standard_priority_review",
        "deprioritize_aggressive_promo",
    ]


def test_quantiles_equal_the_builtin(spark):
    rows = spark.range(5003).selectExpr("CAST(id % 3 AS STRING) AS g", "(id * 31 % 997) / 997D AS v")
    points = {"a": 0.0, "b": 0.1, "c": 0.25, "d": 0.5, "e": 0.99, "f": 1.0}
    got = exact_quantiles(value_histogram(rows, "v", ["g"]), "v", "n", points, ["g"])
    want = rows.groupBy("g").agg(F.percentile("v", F.array(*[F.lit(p) for p in points.values()])).alias("p"))
    for row in got.join(want, "g").collect():
        assert [row[name] for name in points] == pytest.approx(row.p, abs=1e-12)


def test_running_totals_cross_slices(spark):
    rows = spark.range(3000).selectExpr("CAST(id % 2 AS STRING) AS g", "id AS k", "1L AS n")
    got = running_totals(rows, ["g"], [F.desc("k")], ["n"])
    bad = got.where("cum_n != 1500 - floor(k / 2) OR all_n != 1500")
    assert bad.isEmpty() and got.count() == 3000


def defects(spark):
    good = ("p", date(2024, 1, 26), "20240126", datetime(2024, 1, 27), date(2024, 1, 25), 0.5, 1, 1.0, "high", "a", "V1", "m", "v", "r", 0.5, "20240126")
    names = RESPONSE_SCORES.fieldNames()

    def row(player, **changes):
        return tuple({**dict(zip(names, good)), "player_id": player, **changes}[n] for n in names)

    score = C.SCORE
    return spark.createDataFrame(
        [
            row("dup"), row("dup"), row("  "), row(None), row(None),
            row("a", **{score: -0.1}), row("b", **{score: 1.1}), row("c", **{score: None}), row("d", **{score: float("nan")}),
            row("e", response_priority_bucket="x"), row("f", response_priority_bucket=None),
            row("g", scoring_pt="20240101"), row("h", vip_level=None),
        ],
        RESPONSE_SCORES,
    )


def test_repeated_players_in_three_senses(spark):
    row = V.count_violations(defects(spark), {}).first()
    assert row.duplicate_extra_rows == 2  # second "dup", second NULL
    assert row.duplicate_all_rows == 4
    assert row.duplicate_distinct_gap == 3  # NULL players are no distinct player
    assert row.duplicate_groups == 1


def test_contract_counts(spark):
    row = V.postwrite_contract(defects(spark), "20240126").first()
    assert row.score_missing_rows == 2 and row.score_out_of_range_rows == 2
    assert row.bucket_missing_rows == 1 and row.invalid_bucket_rows == 1
    assert row.player_id_missing_rows == 3 and row.scoring_pt_mismatch_rows == 1
    gate = V.prewrite_gate(defects(spark), "20240126").first()
    assert gate.invalid_score_rows == 4 and gate.invalid_bucket_rows == 2 and gate.null_vip_level == 1
    with pytest.raises(ValueError, match="invalid_score_rows"):
        V.require_clean(V.prewrite_gate(defects(spark), "20240126"), "gate")


def test_empty_output_is_refused(spark):
    empty = defects(spark).where("false")
    assert V.prewrite_contract(empty, "20240126").first().empty_output_violation_rows == 1
    with pytest.raises(ValueError, match="row_count"):
        V.require_clean(V.prewrite_gate(empty, "20240126"), "gate")


def test_publish_refuses_and_writes_nothing(spark):
    path = fresh_path(spark, "refused")
    rows = slim(spark, [0.1, 0.2]).unionByName(slim(spark, [0.3]))
    with pytest.raises(ValueError, match="duplicate_player_id_rows"):
        scoring_run.publish(spark, rows, "20240126", path, **RUN)
    with pytest.raises(Exception, match="(?i)not.*exist|PATH_NOT_FOUND"):
        spark.read.parquet(path).count()


def test_absent_segment_blocks_unless_allowed(spark):
    rows = slim(spark, [0.1, 0.2]).withColumn("vip_level", F.lit(None).cast("string"))
    with pytest.raises(ValueError, match="null_vip_level"):
        scoring_run.publish(spark, rows, "20240126", fresh_path(spark, "s"), **RUN)
    allowed = [c for c in V.CRITICAL_COLUMNS if c != "vip_level"]
    written, counts = scoring_run.publish(spark, rows, "20240126", fresh_path(spark, "s"), non_null=allowed, **RUN)
    assert written.count() == counts["rows_after"] == 2


def test_columns_and_leakage():
    assert V.leaking_columns(["label_x", "recent_bet_cnt_7d", "pt", "y_t+3", "churn_d7"]) == [
        ("pt", "excluded"), ("label_x", "^label_"), ("y_t+3", r"_t\+"), ("churn_d7", "churn_d[0-9]+$"),
    ]
    with pytest.raises(ValueError):
        V.require_no_leakage(["post_outcome"])
