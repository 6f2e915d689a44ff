"""The champion pointer moves one step at a time and never to a run that scoring could not use."""

from datetime import datetime

import pytest

from dayledger.operators import models as M
from dayledger.session import fresh_path
from dayledger.sources import registry as R
from dayledger.sources.releases import _files

GOOD = {
    "run_id": "run1", "iteration_id": "it", "model_name": "lr", "model_version": "v1", "model_path": "/models/1", "selected_threshold": 0.5,
    "selected_score_variant": "p", "threshold_policy": "best_f1", "raw_feature_order": ["a"], "transformed_feature_names": ["a"],
    "source_table": "t", "target_column": "y", "is_champion": False,
}


@pytest.fixture()
def recorded(spark):
    folder = fresh_path(spark, "registry")
    rows = [GOOD, GOOD | {"run_id": "run2", "model_version": "v2"}, GOOD | {"run_id": "LOCAL_3", "model_version": "v3"}, GOOD | {"model_version": "v4", "threshold_policy": None}, GOOD | {"model_version": "v5", "model_path": "/m_local/"}]
    for row in rows:
        M.record_run(spark, f"{folder}/model_runs", row, datetime(2024, 1, 1))
    return folder, spark.read.schema(M.MODEL_RUNS).parquet(f"{folder}/model_runs")


def test_promotion_and_refusals(spark, recorded):
    folder, runs = recorded
    assert R.champion(spark, folder) is None
    R.promote(spark, folder, runs, "v1", None)
    assert R.champion(spark, folder) == {f: GOOD[f] for f in R.POINTER_FIELDS}
    for version, words in (("v3", "local"), ("v5", "local"), ("v4", "threshold_policy"), ("v9", "no recorded runs")):
        with pytest.raises(ValueError, match=words):
            R.promote(spark, folder, runs, version, "v1")
    with pytest.raises(RuntimeError, match="moved from None to v1"):
        R.promote(spark, folder, runs, "v2", None)  # looked before v1 was promoted
    assert R.champion(spark, folder)["model_version"] == "v1"
    R.promote(spark, folder, runs, "v2", "v1")
    assert [tuple(r) for r in R.history(spark, folder).orderBy("move").collect()] == [(1, "v1", "run1"), (2, "v2", "run2")]


def test_broken_and_incomplete_pointers(spark, recorded):
    folder, runs = recorded
    R.promote(spark, folder, runs, "v1", None)
    _files(spark).create(f"{folder}/champion/0000000002", '{"model_ver')
    assert R.champion(spark, folder)["model_version"] == "v1"
    _files(spark).create(f"{folder}/champion/0000000003", '{"model_version": "x"}')
    with pytest.raises(ValueError, match="lacks"):
        R.champion(spark, folder)
