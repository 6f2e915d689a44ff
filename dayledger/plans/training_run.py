"""Fit both classifiers on a time split, choose thresholds, pick the champion and record the run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluation as E
from ..operators import models as M
from ..session import cut_lineage


@dataclass
class Fitted:
    """A fitted model with its scored rows, threshold and metrics."""

    name: str
    model: PipelineModel
    scaled: bool
    scored: DataFrame
    threshold: float
    policy: str
    metrics: DataFrame


def evaluate(name: str, model: PipelineModel, scaled: bool, rows: DataFrame, policy: str = "max_precision_with_min_recall") -> Fitted:
    """Score every split once, choose the threshold on validation, and compute the split metrics."""
    scored = cut_lineage(M.score_splits(model, rows))
    grid = E.threshold_grid(scored.where(F.col("split") == "validation"))
    chosen = E.select_threshold(grid, policy).first()  # one row
    metrics = E.split_metrics(scored, chosen.selected_threshold).withColumn("model_name", F.lit(name))
    return Fitted(name, model, scaled, scored, chosen.selected_threshold, chosen.threshold_policy, metrics)


def train(rows: DataFrame, names: tuple[str, ...] = ("logistic_regression", "gradient_boosting"), rounds: int = 200) -> list[Fitted]:
    """`rows` carry features, label and split; they are written once and read by every pass of the fits."""
    rows = cut_lineage(rows)
    training = rows.where(F.col("split") == "train")
    fitted = []
    for name in names:
        if name == "logistic_regression":
            fitted.append(evaluate(name, M.fit_logistic_regression(training), True, rows))
        elif name == "gradient_boosting":
            fitted.append(evaluate(name, M.fit_boosted_trees(training, rounds=rounds), False, rows))
        else:
            raise ValueError(f"unknown model {name!r}")
    return fitted


def comparison(fitted: list[Fitted]) -> DataFrame:
    metrics = fitted[0].metrics
    for other in fitted[1:]:
        metrics = metrics.unionByName(other.metrics)
    return E.model_comparison(metrics)


def record(
    spark: SparkSession, fitted: list[Fitted], folder: str, *, run_id: str, iteration_id: str, source_table: str, created_at: datetime
) -> DataFrame:
    """Save every model, add one row each to the table of runs, and return the table."""
    best = E.champion(comparison(fitted)).first().model_name
    for f in fitted:
        path = f"{folder}/{run_id}__{f.name}"
        f.model.write().overwrite().save(path)
        M.record_run(
            spark,
            f"{folder}/model_runs",
            {
                "run_id": run_id,
                "iteration_id": iteration_id,
                "model_name": f.name,
                "model_version": M.model_version(iteration_id, f.name, run_id),
                "model_path": path,
                "selected_threshold": float(f.threshold),
                "selected_score_variant": "response_probability",
                "threshold_policy": f.policy,
                "raw_feature_order": M.raw_feature_order(),
                "transformed_feature_names": M.transformed_feature_names(f.model, f.scaled),
                "source_table": source_table,
                "target_column": M.TARGET,
                "is_champion": f.name == best,
            },
            created_at,
        )
    return spark.read.schema(M.MODEL_RUNS).parquet(f"{folder}/model_runs")
