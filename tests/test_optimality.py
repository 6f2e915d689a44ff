"""The proofs of a fit refuse models that are not optimal."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from dayledger.operators import models as M
from dayledger.operators import optimality as O
from dayledger.session import fresh_path
from dayledger.sources.schemas import NUMERIC_FEATURES


@pytest.fixture(scope="module")
def rows(spark):
    ids = spark.range(600).withColumn("r", F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0)
    features = {f: (F.pmod(F.xxhash64("id", F.lit(f)), F.lit(100)) / 10.0).alias(f) for f in NUMERIC_FEATURES}
    label = (F.col(NUMERIC_FEATURES[0]) + 4 * F.col("r") > 7).cast("int")
    made = ids.select("r", F.col("id").cast("string").alias("player_id"), F.lit(date(2024, 1, 1)).alias("assignment_date"), *features.values())
    level = F.when(F.col("r") < 0.3, "V1").when(F.col("r") < 0.5, None).otherwise("V2")
    return made.withColumn("vip_level", level).withColumn(M.TARGET, label).drop("r")


def test_gradient_vanishes_only_at_the_optimum(rows):
    good = O.logistic_gradient(M.fit_logistic_regression(rows), rows)
    assert good.agg(F.max(F.abs("gradient"))).first()[0] < 1e-4
    assert good.count() == len(NUMERIC_FEATURES) + 4  # intercept and three levels
    early = O.logistic_gradient(M.fit_logistic_regression(rows, max_iter=1), rows)
    assert early.agg(F.max(F.abs("gradient"))).first()[0] > 1e-3
    other = O.logistic_gradient(M.fit_logistic_regression(rows), rows, c=0.001)
    assert other.agg(F.max(F.abs("gradient"))).first()[0] > 1e-3  # the penalty is part of it


def test_linear_scores_are_recomputed(rows):
    scored = O.linear_scores(M.fit_logistic_regression(rows), rows)
    assert scored.agg(F.max(F.abs(F.col("score") - F.col("recomputed")))).first()[0] < 1e-12


def test_trees_are_audited_row_by_row(spark, rows):
    model = M.fit_boosted_trees(rows, rounds=6, depth=3)
    audit = O.tree_audit(model, rows, fresh_path(spark, "trees"), ["player_id"]).collect()
    assert [r.tree for r in audit] == list(range(6))
    assert all(r.smallest_leaf >= 50 and r.leaf_error < 1e-9 for r in audit)
    assert all(r.loss < r.loss_before for r in audit[1:]) and audit[-1].score_error < 1e-12
    # rows the trees were not fitted on: leaf means no longer hold, scores still do
    other = rows.where("cast(player_id as int) % 3 = 0")
    elsewhere = O.tree_audit(model, other, fresh_path(spark, "trees"), ["player_id"]).collect()
    assert max(r.leaf_error for r in elsewhere) > 1e-3 and elsewhere[-1].score_error < 1e-12


def test_routing_takes_categories_and_thresholds(spark):
    nodes = spark.createDataFrame(
        [(0, 0, 1, 2, 0.0, 0, [1.5], False), (0, 1, -1, -1, 10.0, -1, [], False), (0, 2, 3, 4, 0.0, 1, [2.0, 5.0], True), (0, 3, -1, -1, 20.0, -1, [], False), (0, 4, -1, -1, 30.0, -1, [], False)],
        "tree int, node int, left int, right int, value double, feature int, bounds array<double>, by_category boolean",
    )
    rows = spark.createDataFrame([(1, [1.5, 0.0]), (2, [1.6, 5.0]), (3, [1.6, 4.0])], "id int, x array<double>")
    assert {(r.id, r.value) for r in O.route(rows, nodes, 1, 2).collect()} == {(1, 10.0), (2, 20.0), (3, 30.0)}


def test_leaf_sums_agree_with_the_joined_routing(spark, rows):
    model = M.fit_boosted_trees(rows, rounds=4, depth=3)
    nodes = O.saved_nodes(model, fresh_path(spark, "trees"), spark)
    x = M.vector_to_array("features").alias("x")
    some = model.transform(M.fill_features(rows)).select(F.lit(1.0).alias("y"), F.lit(2.0).alias("w"), x, F.lit(0.5).alias("score"))
    sums = O.leaf_sums(some, nodes.collect(), [1.0] * 4, 3).select("tree", "node", "rows", "w")
    joined = O.route(some, nodes, 4, 3).groupBy("tree", "node").agg(F.count("*").alias("rows"), F.sum("w").alias("w"))
    assert sorted(sums.collect()) == sorted(joined.collect())


def test_leaf_sums_take_categories(spark):
    nodes = spark.createDataFrame(
        [(0, 0, 1, 2, 0.0, 0, [2.0, 5.0], True), (0, 1, -1, -1, 10.0, -1, [], False), (0, 2, -1, -1, 20.0, -1, [], False)],
        "tree int, node int, left int, right int, value double, feature int, bounds array<double>, by_category boolean",
    )
    rows = spark.createDataFrame([(1.0, 1.0, [v], 0.5) for v in (2.0, 4.0, 5.0)], "y double, w double, x array<double>, score double")
    assert {(r.node, r.rows) for r in O.leaf_sums(rows, nodes.collect(), [1.0], 1).collect()} == {(1, 2), (2, 1)}


def test_audit_counts_rows_that_share_a_key(spark, rows):
    model = M.fit_boosted_trees(rows, rounds=3, depth=2)
    shared = rows.withColumn("player_id", F.lit("p"))
    audit = O.tree_audit(model, shared, fresh_path(spark, "trees"), ["player_id"]).collect()
    assert all(r.leaf_error < 1e-9 for r in audit) and audit[-1].score_error < 1e-12


def test_trees_keep_no_node_ids(spark):
    assert not M.boosted_trees().getCacheNodeIds()
