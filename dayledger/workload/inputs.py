"""Inputs of the registered queries, read from the given tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import shift_pt
from ..operators import dataset as D
from ..operators import scoring as C
from ..operators.splits import assign_splits, split_plan
from ..sources import fixtures as fx
from ..sources.schemas import NUMERIC_FEATURES, RESPONSE_SCORES

# Parameters of the registered queries.
AS_OF = fx.AS_OF
SCORING_PT, REFERENCE_PT, IMMATURE_PT = "20240126", "20240125", "20240128"
MATURE_PT = "20240126"
SPLIT_DAYS = (14, 4, 7)
THRESHOLD = 0.5
RUN_TS = datetime(2024, 1, 27, 2, 0, 0)
LINEAGE = {
    "scoring_ts": RUN_TS,
    "model_name": "fixed_logit",
    "model_version": "fixed__fixed_logit__v1",
    "model_reference_path": "models/fixed_logit",
    "selected_threshold": THRESHOLD,
}


def first_day(spark: SparkSession, sf: str) -> str:
    return fx.calendar(spark, sf)[0]


def mart(spark: SparkSession, sf: str, first: str | None = None, last: str | None = None) -> DataFrame:
    return fx.feature_mart(spark, sf, first, last)


def eligible_mart(spark: SparkSession, sf: str, first: str | None = None, last: str | None = None) -> DataFrame:
    return fx.feature_mart(spark, sf, first, last, eligible_only=True)


def base(spark: SparkSession, sf: str, first: str | None = None, last: str = MATURE_PT) -> DataFrame:
    first = first or first_day(spark, sf)
    return D.base_population(eligible_mart(spark, sf, first, last), first, last)


def bets_after(spark: SparkSession, sf: str, first: str, last: str, window_days: int = 3) -> DataFrame:
    return fx.bets(spark, sf, shift_pt(first, 1), shift_pt(last, window_days))


def response(spark: SparkSession, sf: str, first: str | None = None, last: str = MATURE_PT) -> DataFrame:
    first = first or first_day(spark, sf)
    return D.response_dataset(
        eligible_mart(spark, sf, first, last),
        fx.vouchers(spark, sf, first, last),
        fx.sms_sends(spark, sf, first, last),
        bets_after(spark, sf, first, last),
        first,
        last,
    )


def audited(spark: SparkSession, sf: str, first: str | None = None, last: str = MATURE_PT) -> DataFrame:
    first = first or first_day(spark, sf)
    return D.audit_dataset(response(spark, sf, first, last), bets_after(spark, sf, first, last, 7))


# --- scores --------------------------------------------------------------------------------


def audience(spark: SparkSession, sf: str, pt: str = SCORING_PT, table: DataFrame | None = None) -> DataFrame:
    """The scored population of one partition, without ranks. `table` may hold the mart of that day already."""
    rows = C.scoring_audience(eligible_mart(spark, sf, pt, pt) if table is None else table, pt)
    return rows.withColumn(C.SCORE, fx.fixed_score())


def scores(spark: SparkSession, sf: str, pt: str = SCORING_PT) -> DataFrame:
    """The publishable partition under the fixed score."""
    return C.score_output(audience(spark, sf, pt), pt, **LINEAGE)[0]


def flawed_scores(spark: SparkSession, sf: str, clean: DataFrame | None = None) -> DataFrame:
    """The same partition, whole, with one defect per user residue, so that every check finds something.

    `clean` may hold the partition already.
    """
    m = F.col("player_id").cast("bigint") % 29
    copies = F.explode(F.sequence(F.lit(1), F.when(m == 0, 2).otherwise(1)))
    doubled = (scores(spark, sf) if clean is None else clean).withColumn("m", m).withColumn("copy", copies)

    def spoil(column: str, *defects: tuple) -> Column:
        chain = F.col(column)
        for residue, value in defects:
            chain = F.when(F.col("m") == residue, value).otherwise(chain)
        return chain.alias(column)

    none = F.lit(None)
    changed = {
        "player_id": spoil("player_id", (1, none), (2, F.lit("  "))),
        "score_date": spoil("score_date", (11, none)),
        "scoring_pt": spoil("scoring_pt", (9, F.lit("20240101")), (10, none)),
        "scoring_ts": spoil("scoring_ts", (12, none)),
        "snapshot_date": spoil(
            "snapshot_date", (13, none), (23, F.date_sub("snapshot_date", 1)), (24, F.date_sub("snapshot_date", 2))
        ),
        C.SCORE: spoil(C.SCORE, (3, F.lit(-0.1)), (4, F.lit(1.1)), (5, none)),
        "score_rank": spoil("score_rank", (20, none)),
        "score_percentile": spoil("score_percentile", (21, F.lit(-0.1)), (22, F.lit(1.2))),
        "response_priority_bucket": spoil("response_priority_bucket", (6, F.lit("x")), (7, none), (8, F.lit(""))),
        "action_recommendation": spoil("action_recommendation", (18, F.lit(""))),
        "vip_level": spoil("vip_level", (19, none)),
        "model_name": spoil("model_name", (14, none)),
        "model_version": spoil("model_version", (15, F.lit(""))),
        "model_reference_path": spoil("model_reference_path", (16, none)),
        "selected_threshold": spoil("selected_threshold", (17, none)),
    }
    return doubled.select(*[changed.get(c, F.col(c)) for c in RESPONSE_SCORES.fieldNames()])


def observed(spark: SparkSession, sf: str, pt: str = SCORING_PT, scored: DataFrame | None = None) -> DataFrame:
    """Outcomes of a scored partition; `scored` may hold it already."""
    return D.observed_outcomes(scores(spark, sf, pt) if scored is None else scored, bets_after(spark, sf, pt, pt))


def reference_row_count(spark: SparkSession, sf: str, pt: str = REFERENCE_PT) -> DataFrame:
    """Rows of the scored reference partition: one for every member of its audience, whatever the scores and ranks."""
    return audience(spark, sf, pt).agg(F.count(F.lit(1)).alias("reference_row_count"))


# --- evaluation ----------------------------------------------------------------------------


def labelled_splits(spark: SparkSession, sf: str) -> DataFrame:
    """Population with outcome label, features and split."""
    rows = D.outcome_rollup(base(spark, sf), bets_after(spark, sf, first_day(spark, sf), MATURE_PT))
    plan = split_plan(fx.partition_days(spark, sf), AS_OF, *SPLIT_DAYS)
    return assign_splits(rows, plan)


def evaluation_rows(spark: SparkSession, sf: str, score: Column | None = None) -> DataFrame:
    """Labelled rows under the fixed score."""
    return labelled_splits(spark, sf).select(
        "player_id",
        "assignment_date",
        "pt",
        "vip_level",
        *NUMERIC_FEATURES,
        F.col("response_label_positive_3d").cast("int").alias("target"),
        (fx.fixed_score() if score is None else score).alias("score"),
        "split",
    )
