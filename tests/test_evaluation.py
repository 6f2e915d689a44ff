import math
import random

import pytest
from pyspark.sql import functions as F

from dayledger.operators import evaluation as E

ROWS = "split string, vip_level string, target int, score double, pt string, player_id string, assignment_date date"


def frame(spark, pairs, split="test", segment="V1"):
    return spark.createDataFrame(
        [(split, segment, t, s, "20240101", f"p{i:05d}", None) for i, (t, s) in enumerate(pairs)], ROWS
    )


def brute_auc(pairs):
    pos, neg = [s for t, s in pairs if t], [s for t, s in pairs if not t]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def brute_ap(pairs):
    total, ap, seen, hits = sum(t for t, _ in pairs), 0.0, 0, 0
    for s in sorted({s for _, s in pairs}, reverse=True):
        here = [t for t, x in pairs if x == s]
        seen, hits = seen + len(here), hits + sum(here)
        ap += sum(here) / total * hits / seen
    return ap


def test_curves_equal_brute_force_with_ties(spark):
    rng = random.Random(3)
    pairs = [(int(rng.random() < 0.4), round(rng.random(), 1)) for _ in range(300)]
    row = E.split_metrics(frame(spark, pairs), 0.5).first()
    assert row.roc_auc == pytest.approx(brute_auc(pairs)) and row.pr_auc == pytest.approx(brute_ap(pairs))
    assert row.brier == pytest.approx(sum((s - t) ** 2 for t, s in pairs) / 300)
    mirrored = E.split_metrics(frame(spark, [(t, 1 - s) for t, s in pairs]), 0.5).first()
    assert mirrored.roc_auc == pytest.approx(1 - row.roc_auc)


def test_one_class_has_no_area(spark):
    row = E.split_metrics(frame(spark, [(1, 0.2), (1, 0.9)]), 0.5).first()
    assert row.roc_auc is None and row.pr_auc is None and row.rows == 2


def test_no_predicted_positives(spark):
    row = E.confusion_metrics(frame(spark, [(1, 0.2), (0, 0.1)]), 0.5).first()
    assert (row.precision, row.recall, row.f1, row.specificity) == (0.0, 0.0, 0.0, 1.0)


def test_recorded_confusion_counts(spark):
    """Counts of a recorded evaluation and the ratios published with them."""
    tp, tn, fp, fn = 468252, 478194, 215063, 263324
    counts = spark.createDataFrame([(tp, tp + fp, tp + fn, tp + tn + fp + fn)], "tp long, pp long, p long, n long")
    row = counts.select(*E.confusion_columns(*[F.col(c) for c in ("tp", "pp", "p", "n")])).first()
    got = (row.precision, row.recall, row.f1, row.specificity, row.negative_predictive_value)
    assert got == pytest.approx((0.685265, 0.640059, 0.661891, 0.689779, 0.644885), abs=1e-6)


def test_grid_step_is_exact_at_the_steps(spark):
    scores = [x for i in range(20) for x in (i / 20, math.nextafter(i / 20, 0), math.nextafter(i / 20, 1))] + [1.0]
    rows = spark.createDataFrame([(s,) for s in scores], "score double").withColumn("step", E.grid_step()).collect()
    for r in rows:
        assert r.step == max((i for i in range(-1, 21) if r.score >= i / 20), default=-1)


def test_grid_equals_rowwise_counts(spark):
    rng = random.Random(5)
    pairs = [(int(rng.random() < 0.5), rng.choice([rng.random(), 0.35, 0.5])) for _ in range(400)]
    grid = E.threshold_grid(frame(spark, pairs)).collect()
    assert len(grid) == 19
    for r in grid:
        assert r.true_positive_count == sum(t for t, s in pairs if s >= r.step / 20)
        assert r.true_positive_count + r.false_positive_count + r.true_negative_count + r.false_negative_count == 400


def test_policies(spark):
    # threshold step, precision, recall, f1 of a recorded validation table
    rows = [(6, 0.567949, 0.939630, 0.707972), (7, 0.593990, 0.882147, 0.709943), (9, 0.658236, 0.720728, 0.688066),
            (10, 0.693512, 0.629000, 0.659682), (11, 0.725398, 0.547665, 0.624125), (19, 0.968806, 0.003381, 0.006738)]
    grid = spark.createDataFrame(rows, "step int, precision double, recall double, f1 double")
    assert E.select_threshold(grid).first().selected_threshold == 0.5
    assert E.select_threshold(grid, "best_f1").first().selected_threshold == 0.35
    unreached = E.select_threshold(grid, minimum_recall=0.99).first()
    assert (unreached.selected_threshold, unreached.threshold_policy) == (0.95, "max_precision")
    tied = spark.createDataFrame([(4, 0.5, 0.7, 0.6), (8, 0.5, 0.7, 0.6)], grid.schema)
    picks = {p: E.select_threshold(tied, p).first().step for p in E.POLICY_KEYS}
    assert picks == {"max_precision_with_min_recall": 8, "max_precision": 8, "best_f1": 4}
    with pytest.raises(ValueError):
        E.select_threshold(grid, "coin_toss")


@pytest.mark.parametrize("n", [1, 9, 10, 33, 101])
def test_decile_sizes(spark, n):
    got = {r.decile: r.rows for r in E.score_deciles(frame(spark, [(1, i / n) for i in range(n)])).collect()}
    want = {}
    for rank in range(1, n + 1):
        d = 1 if n == 1 else max(1, math.ceil((rank - 1) * 10 / (n - 1)))
        want[d] = want.get(d, 0) + 1
    assert got == want


def test_recorded_decile_sizes(spark):
    """Sizes recorded for 1,424,833 rows: the extra rows lie in groups 1, 5 and 10."""
    n = 1424833
    sizes = spark.range(1, n + 1).selectExpr(f"greatest(1, (10 * (id - 1) + {n} - 2) div ({n} - 1)) AS d").groupBy("d").count()
    assert {r.d: r["count"] for r in sizes.collect()} == {d: 142484 if d in (1, 5, 10) else 142483 for d in range(1, 11)}


def test_segments(spark):
    rows = frame(spark, [(1, 0.9), (0, 0.1)], segment=None).unionByName(frame(spark, [(1, 0.4)] * 3, segment="UNKNOWN"))
    inventory = {r.segment_value: r.eligible_for_threshold_grid for r in E.segment_inventory(rows, 2, 1).collect()}
    assert inventory == {"__NULL__": True, "UNKNOWN": True}
    assert E.segment_threshold_grid(rows, 2, 1).where("sufficient").count() == 38
    assert E.segment_threshold_grid(rows, 2, 1, business_only=True).isEmpty()


def test_cohorts(spark):
    rows = frame(spark, [(1, i / 10) for i in range(10)]).withColumn("x", F.col("score") * 10)
    cohorts = E.ranked_cohorts(rows, ["x"])
    row = E.cohort_numeric(cohorts, ["x"]).first()
    assert (row.high_score_mean, row.low_score_mean) == pytest.approx((8.5, 0.5))


def test_champion(spark):
    rows = spark.createDataFrame([("a", 0.7), ("b", 0.7), ("c", None)], "model_name string, validation_pr_auc double")
    assert E.champion(rows).first().model_name == "a"
