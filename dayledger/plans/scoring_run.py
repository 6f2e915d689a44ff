"""Publish one scored partition behind its pre- and post-write gates."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import contracts as V
from ..operators import scoring as C
from ..operators.ordering import side_by_side
from ..sources import releases
from ..sources.schemas import RESPONSE_SCORES
from ..sources.sinks import read_table, write_partition


def publish(
    spark: SparkSession,
    scored: DataFrame,
    pt: str,
    path: str,
    *,
    scoring_ts: datetime,
    model_name: str,
    model_version: str,
    model_reference_path: str,
    selected_threshold: float,
    non_null: Sequence[str] = tuple(V.CRITICAL_COLUMNS),
) -> tuple[DataFrame, dict]:
    """Rank, bucket, gate, write, re-read and gate again. Returns the written partition and the run's counts.

    `scored` holds player_id, snapshot_date, vip_level and the score. Nothing is written when the first
    gate finds a violation.
    """
    lineage = {
        "model_name": model_name,
        "model_version": model_version,
        "model_reference_path": model_reference_path,
        "selected_threshold": selected_threshold,
    }
    output, thresholds = C.score_output(scored, pt, scoring_ts=scoring_ts, **lineage)
    before = V.require_clean(V.prewrite_gate(output, pt, non_null=non_null), "pre-write gate")
    write_partition(output, path, RESPONSE_SCORES, pt)
    spark.catalog.refreshByPath(path)
    written = read_table(spark, path, RESPONSE_SCORES).where(F.col("pt") == pt)
    gate = V.postwrite_gate(written, pt, before["row_count"], lineage, non_null=non_null)
    after = V.require_clean(gate, "post-write gate")
    return written, {"thresholds": thresholds, "rows_before": before["row_count"], "rows_after": after["row_count"]}


def publish_staged(
    spark: SparkSession, scored: DataFrame, pt: str, table: str, *, scoring_ts: datetime, non_null: Sequence[str] = tuple(V.CRITICAL_COLUMNS), **lineage
) -> tuple[DataFrame, releases.Release]:
    """As `publish`, but readers of `table` see the partition only once both gates have passed.

    The rows are staged, the staged files are read and held against the same counts and lineage, and then the manifest
    switches. Whatever fails on the way, readers stay on the release they had.
    """
    output, _ = C.score_output(scored, pt, scoring_ts=scoring_ts, **lineage)
    before = V.require_clean(V.prewrite_gate(output, pt, non_null=non_null), "pre-write gate")

    def gate(staged: DataFrame) -> None:
        V.require_clean(V.postwrite_gate(staged, pt, before["row_count"], lineage, non_null=non_null), "post-write gate")

    release = releases.publish(output, table, RESPONSE_SCORES, pt, gate)
    return releases.read_current(spark, table, RESPONSE_SCORES, [pt]), release


def run_summary(written: DataFrame, pt: str, threshold: float, counts: dict) -> DataFrame:
    """One row about a published partition."""
    volume = C.prediction_volume(written, threshold)
    lineage = written.agg(
        F.max("model_name").alias("model_name"),
        F.max("model_version").alias("model_version"),
        F.max("model_reference_path").alias("model_reference_path"),
        F.count(F.lit(1)).alias("scoring_population_size"),
    )
    return side_by_side(lineage, volume).select(
        F.lit(pt).alias("scoring_pt"),
        F.lit(float(threshold)).alias("selected_threshold"),
        "*",
        F.lit(counts["rows_before"]).cast("bigint").alias("row_count_before_write"),
        F.lit(counts["rows_after"]).cast("bigint").alias("row_count_after_write"),
    )
