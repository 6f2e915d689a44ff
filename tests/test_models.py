from datetime import datetime

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import Observation
from pyspark.sql import functions as F

from dayledger.operators import models as M
from dayledger.plans import training_run
from dayledger.session import fresh_path
from dayledger.sources.schemas import NUMERIC_FEATURES


@pytest.fixture(scope="module")
def rows(spark):
    """Labelled rows with one telling feature, a constant one, an unknown level outside training, and gaps."""
    x = "(id * 7919 % 1000) / 1000D"
    columns = [f"CASE WHEN id % 11 = 0 THEN NULL ELSE {x} END AS recent_bet_amt_7d"]
    columns += [f"0D AS {f}" for f in NUMERIC_FEATURES if f != "recent_bet_amt_7d"]
    return spark.range(1500).selectExpr(
        "CAST(id AS STRING) AS player_id", "DATE'2024-01-01' AS assignment_date", "'20240101' AS pt",
        "CASE WHEN id % 13 = 0 THEN NULL WHEN id >= 1400 THEN 'V9' ELSE concat('V', id % 3) END AS vip_level",
        f"CAST({x} + (id % 5) / 10 > 0.7 AS BIGINT) AS response_label_positive_3d",
        "CASE WHEN id < 900 THEN 'train' WHEN id < 1200 THEN 'validation' ELSE 'test' END AS split", *columns,
    )


def test_fit_score_record_reload(spark, rows):
    fitted = training_run.train(rows, rounds=3)
    for f in fitted:
        auc = {r.split: r.roc_auc for r in f.metrics.collect()}
        assert auc["test"] > 0.7 and f.scored.count() == 1500
        names = M.transformed_feature_names(f.model, f.scaled)
        assert set(names) == {*NUMERIC_FEATURES, "vip_level_V0", "vip_level_V1", "vip_level_V2", "vip_level___missing__"}
        width = f.model.stages[-1].numFeatures
        assert M.require_feature_contract(f.model, f.scaled, M.raw_feature_order(), width) == names
        with pytest.raises(ValueError, match="declared"):
            M.require_feature_contract(f.model, f.scaled, M.raw_feature_order()[::-1], width)
    folder = fresh_path(spark, "models")
    runs = training_run.record(
        spark, fitted, folder, run_id="r1", iteration_id="it", source_table="t", created_at=datetime(2024, 1, 1)
    )
    best = M.champion_run(runs).first()
    assert runs.count() == 2 and best.model_version == f"it__{best.model_name}__r1"
    same = next(f for f in fitted if f.name == best.model_name)
    again = M.score(PipelineModel.load(best.model_path), rows).select("player_id", F.col("score").alias("again"))
    assert again.join(same.scored, "player_id").where("abs(again - score) > 1e-12").isEmpty()

    gains = M.gbt_importance(fitted[1].model, M.transformed_feature_names(fitted[1].model, False), fresh_path(spark, "g"), spark)
    assert gains.first().feature == "recent_bet_amt_7d" and gains.where("feature = 'pre_bet_cnt_30d'").first().importance_split == 0
    weights = M.lr_importance(fitted[0].model, M.transformed_feature_names(fitted[0].model, True), spark)
    assert weights.first().feature == "recent_bet_amt_7d" and weights.where("abs(odds_ratio - exp(coefficient)) > 1e-12").isEmpty()


def test_one_class_is_refused(rows):
    with pytest.raises(ValueError, match="both classes"):
        M.balanced_weights(rows.where("response_label_positive_3d = 1"))


def test_balanced_weights_sum_to_the_rows(rows):
    weighted, n = M.balanced_weights(rows)
    assert weighted.agg(F.sum("class_weight")).first()[0] == pytest.approx(n)


def test_run_records(spark):
    good = {f: "x" for f in M.REQUIRED_RUN_FIELDS}
    with pytest.raises(ValueError, match="lacks"):
        M.record_run(spark, "/nowhere", {**good, "source_table": " "}, datetime(2024, 1, 1))
    with pytest.raises(ValueError, match="local"):
        M.record_run(spark, "/nowhere", {**good, "run_id": "local_1", "is_champion": True}, datetime(2024, 1, 1))
    with pytest.raises(ValueError):
        M.model_version("a", " ", "b")


def test_registered_fits_run_all_rounds(monkeypatch):
    from dayledger.workload import model_queries as Q

    class Stop(Exception):
        pass

    seen = []

    def stop_with(*args, **settings):
        seen.append((len(args), settings))
        raise Stop

    monkeypatch.setattr(Q, "_training_rows", lambda *_: None)
    monkeypatch.setattr(Q, "_train_only", lambda *_: None)
    monkeypatch.setattr(Q.training_run, "train", stop_with)
    monkeypatch.setattr(Q.M, "fit_boosted_trees", stop_with)
    monkeypatch.setattr(Q.M, "fit_logistic_regression", stop_with)
    for name in ("train_gbt", "score_splits", "gbt_importance", "feature_contract", "model_runs"):
        try:
            getattr(Q, name)(None, None)
        except Stop:
            pass
    # rows, and the names of models: no number of rounds or iterations
    assert seen == [(2, {}), (2, {}), (1, {}), (1, {}), (1, {})]


def test_linear_scores_reach_tasks_once_a_frame_was_observed(spark, rows):
    spark.range(3).observe(Observation(), F.count(F.lit(1)).alias("n")).collect()
    model = M.fit_logistic_regression(rows.where("split = 'train'"))
    assert M.score_splits(model, rows).where("score between 0 and 1").count() == 1500
