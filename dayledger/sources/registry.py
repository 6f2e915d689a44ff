"""The champion pointer: which recorded run scores from now on.

The pointer is a series of small numbered files. A run moves it by creating the next one, and only if the champion is
still the one it compared itself with; so of two runs that finish together one is refused instead of undoing the other.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .releases import _files

#: What a scoring job needs to know of a champion, and the starts of run ids that never become one.
POINTER_FIELDS = [
    "run_id", "iteration_id", "model_name", "model_version", "model_path", "selected_threshold", "selected_score_variant",
    "threshold_policy", "raw_feature_order", "transformed_feature_names", "source_table", "target_column",
]
LOCAL_RUNS = ("local", "dev")


def _moves(spark: SparkSession, folder: str) -> list[dict]:
    """All complete moves of the pointer, oldest first."""
    files, out = _files(spark), []
    for name in files.names(f"{folder.rstrip('/')}/champion"):
        try:
            out.append(json.loads(files.text(f"{folder.rstrip('/')}/champion/{name}")))
        except ValueError:
            continue
    return out


def champion(spark: SparkSession, folder: str) -> dict | None:
    """The fields of the present champion; an error if one is missing, as scoring with half of them would go wrong."""
    moves = _moves(spark, folder)
    if not moves:
        return None
    lacking = [f for f in POINTER_FIELDS if moves[-1].get(f) in (None, "", [])]
    if lacking:
        raise ValueError(f"the champion pointer lacks {lacking}")
    return {f: moves[-1][f] for f in POINTER_FIELDS}


def promote(spark: SparkSession, folder: str, runs: DataFrame, model_version: str, expected: str | None) -> dict:
    """Point to the recorded run of `model_version`, unless the champion is no longer `expected` (a version, or None)."""
    rows = runs.where(F.col("model_version") == model_version).limit(2).collect()  # one row a version
    if len(rows) != 1:
        raise ValueError(f"{len(rows) or 'no'} recorded runs of version {model_version}")
    record = {f: rows[0][f] for f in POINTER_FIELDS}
    lacking = [f for f, v in record.items() if v in (None, "", [])]
    if lacking:
        raise ValueError(f"run record of {model_version} lacks {lacking}")
    local = record["run_id"].lower().startswith(LOCAL_RUNS) or record["model_path"].rstrip("/").lower().endswith("_local")
    if local:
        raise ValueError(f"run {record['run_id']} is local and cannot be champion")
    moves = _moves(spark, folder)
    present = moves[-1]["model_version"] if moves else None
    if present != expected:
        raise RuntimeError(f"the champion moved from {expected} to {present} since this run looked at it")
    taken = [int(n) for n in _files(spark).names(f"{folder.rstrip('/')}/champion") if n.isdigit()]
    _files(spark).create(f"{folder.rstrip('/')}/champion/{max(taken, default=0) + 1:010d}", json.dumps(record))
    return record


def history(spark: SparkSession, folder: str) -> DataFrame:
    """(move, model_version, run_id) of every champion so far: one row a promotion."""
    rows = [(i, m["model_version"], m["run_id"]) for i, m in enumerate(_moves(spark, folder), 1)]
    return spark.createDataFrame(rows, "move int, model_version string, run_id string")
