"""The response dataset: population, treatments, outcomes after the assignment day, and the label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import date_to_pt
from ..sources.schemas import LONG_FEATURES, NUMERIC_FEATURES, RESPONSE_DATASET

KEYS = ["player_id", "assignment_date"]


def base_population(mart: DataFrame, first_pt: str | None = None, last_pt: str | None = None) -> DataFrame:
    """Eligible players of label-mature days, typed; the partition is the assignment day."""
    rows = mart.where("is_eligible = 1 AND label_maturity_d3 = 1")
    if first_pt is not None:
        rows = rows.where(F.col("pt") >= first_pt)
    if last_pt is not None:
        rows = rows.where(F.col("pt") <= last_pt)
    return rows.selectExpr(
        "CAST(player_id AS STRING) AS player_id",
        "to_date(pt, 'yyyyMMdd') AS assignment_date",
        "CAST(snapshot_date AS DATE) AS feature_snapshot_date",
        *[f"CAST({f} AS {'BIGINT' if f in LONG_FEATURES else 'DOUBLE'}) AS {f}" for f in NUMERIC_FEATURES],
        "CAST(feature_create_time AS TIMESTAMP_NTZ) AS feature_create_time",
        "CAST(data_version AS STRING) AS data_version",
        "CAST(vip_level AS STRING) AS vip_level",
        "CAST(pt AS STRING) AS pt",
    )


#: Tasks among which rows without a player are dealt.
NULL_PARTS = 1024


def left_join_by_player(left: DataFrame, right: DataFrame, keys: Sequence[str] = tuple(KEYS)) -> DataFrame:
    """`left` with the columns of `right` for the same keys, the first of which names the player.

    Rows without a player match nothing, but a plain join would send all of them to one task. Here each gets a stand-in of
    its own for the join, dealt by the other values of the row, so that no task holds more of them than others. `right`
    has one row per key at most: it is combined by player and day before, so a busy player is a row a day there.
    """
    player, *rest = keys
    spread = F.pmod(F.xxhash64(*[c for c in left.columns if c != player]), F.lit(NULL_PARTS)).cast("string")
    stand_in = F.coalesce(F.col(player), F.concat(F.lit("\0"), spread))
    known = right.where(F.col(player).isNotNull()).withColumnRenamed(player, "_player")
    joined = left.withColumn("_player", stand_in).join(known, ["_player", *rest], "left")
    return joined.select(*left.columns, *[c for c in right.columns if c not in keys])


def require_unique_grain(base: DataFrame, keys: list[str] = KEYS) -> None:
    """Raise when a player-day occurs twice; joined rollups would otherwise describe it twice."""
    twice = base.groupBy(*keys).count().where("count > 1")
    found = twice.limit(3).collect()  # at most three keys, for the message
    if found:
        raise ValueError(f"population has repeated keys {keys}, for example {[tuple(r)[:-1] for r in found]}")


# --- treatments ----------------------------------------------------------------------------


def _touches(source: DataFrame, stamp: Column, channel: str) -> DataFrame:
    stamped = source.select(
        F.col("login_name").cast("string").alias("player_id"), stamp.cast("timestamp_ntz").alias("ts"), "pt"
    ).where(F.col("ts").isNotNull())
    return stamped.select(
        "pt",
        "player_id",
        F.col("ts").cast("date").alias("assignment_date"),
        "ts",
        F.lit(int(channel == "voucher")).cast("bigint").alias("voucher"),
        F.lit(int(channel == "sms")).cast("bigint").alias("sms"),
    )


def voucher_touches(vouchers: DataFrame) -> DataFrame:
    return _touches(vouchers, F.coalesce("release_datetime", "clamined_datetime"), "voucher")


def sms_touches(sends: DataFrame) -> DataFrame:
    delivered = sends.where(F.col("state").cast("string") == "3")
    return _touches(delivered, F.coalesce("send_time", "create_time"), "sms")


def voucher_rollup(vouchers: DataFrame) -> DataFrame:
    """Per source partition, player and day: first timestamp and number of vouchers."""
    return (
        voucher_touches(vouchers)
        .groupBy("pt", *KEYS)
        .agg(F.min("ts").alias("first_treatment_timestamp"), F.count(F.lit(1)).alias("voucher_event_count"))
    )


def sms_rollup(sends: DataFrame) -> DataFrame:
    """Per source partition, player and day: first timestamp and number of delivered messages."""
    return (
        sms_touches(sends)
        .groupBy("pt", *KEYS)
        .agg(F.min("ts").alias("first_treatment_timestamp"), F.count(F.lit(1)).alias("sms_event_count"))
    )


def treatments_by_player_day(vouchers: DataFrame, sends: DataFrame) -> DataFrame:
    """Both channels in one aggregation, so the population is joined once.

    A day's run reads that day's source partition only; events that fall on another day than their
    partition therefore treat nobody and are dropped before the shuffle.
    """
    touches = voucher_touches(vouchers).unionByName(sms_touches(sends))
    return (
        touches.where(F.col("pt") == date_to_pt("assignment_date"))
        .groupBy(*KEYS)
        .agg(
            F.min("ts").alias("treatment_timestamp"),
            F.sum("voucher").alias("voucher_event_count"),
            F.sum("sms").alias("sms_event_count"),
        )
    )


def treatment_rollup(base: DataFrame, vouchers: DataFrame, sends: DataFrame) -> DataFrame:
    """The base columns plus earliest treatment, flag, event count and channel flags."""
    v = F.coalesce("voucher_event_count", F.lit(0))
    s = F.coalesce("sms_event_count", F.lit(0))

    def flag(n: Column) -> Column:
        return F.when(n > 0, 1).otherwise(0).cast("bigint")

    joined = left_join_by_player(base, treatments_by_player_day(vouchers, sends))
    return joined.select(
        *base.columns,
        "treatment_timestamp",
        flag(v + s).alias("treatment_flag"),
        (v + s).cast("bigint").alias("raw_assignment_event_count"),
        flag(v).alias("has_voucher_treatment"),
        flag(s).alias("has_sms_treatment"),
    )


# --- outcomes ------------------------------------------------------------------------------


def outcome_daily(bets: DataFrame, site: Column | None = None) -> DataFrame:
    """Bets per player, day and site. `bets` is already limited to the partitions the windows need."""
    return bets.groupBy(
        F.col("login_name").cast("string").alias("player_id"),
        F.col("stat_date").cast("date").alias("stat_date"),
        (F.col("bet_site_id").cast("string") if site is None else site).alias("bet_site_id"),
    ).agg(
        F.sum(F.col("bet_amount").cast("double")).alias("bet_amount_1d"),
        F.sum(F.col("gross_gaming_revenue").cast("double")).alias("gross_ggr_1d"),
        F.count(F.lit(1)).alias("source_row_count_1d"),
    )


def assignment_days(stat_date: str, window_days: int) -> Column:
    """The days d whose window (d, d + window] holds the given day."""
    return F.sequence(F.date_sub(stat_date, window_days), F.date_sub(stat_date, 1))


def outcomes_by_assignment(bets: DataFrame, window_days: int = 3) -> DataFrame:
    """Outcome of every assignment day a bet can belong to.

    The window has a fixed width, so instead of an interval join each daily row is given to the
    `window_days` days it can follow, and the population is joined on equal keys. Sites are made
    non-NULL first: each daily row is then one distinct source key, and counting rows counts keys.
    """
    per_key = outcome_daily(bets, F.coalesce(F.col("bet_site_id").cast("string"), F.lit("")))
    spread = per_key.withColumn("assignment_date", F.explode(assignment_days("stat_date", window_days)))
    return spread.groupBy(*KEYS).agg(
        F.sum("bet_amount_1d").alias("gross_bet"),
        F.sum("gross_ggr_1d").alias("gross_ggr"),
        F.sum("source_row_count_1d").alias("source_rows"),
        F.count(F.lit(1)).alias("source_keys"),
        F.min("stat_date").alias("first_day"),
        F.max("stat_date").alias("last_day"),
    )


def outcome_rollup(base: DataFrame, bets: DataFrame, window_days: int = 3) -> DataFrame:
    """The base columns plus the outcome of (assignment_date, assignment_date + window]."""
    n = f"{window_days}d"
    joined = left_join_by_player(base, outcomes_by_assignment(bets, window_days))
    return joined.select(
        *base.columns,
        F.coalesce("gross_bet", F.lit(0.0)).alias(f"outcome_gross_bet_{n}_value"),
        F.coalesce("gross_ggr", F.lit(0.0)).alias(f"outcome_gross_ggr_{n}_value"),
        F.coalesce("source_rows", F.lit(0)).cast("bigint").alias(f"outcome_source_row_count_{n}"),
        F.coalesce("source_keys", F.lit(0)).cast("bigint").alias(f"outcome_distinct_source_keys_{n}"),
        F.col("first_day").alias("first_outcome_event_date"),
        F.col("last_day").alias("last_outcome_event_date"),
        F.when(F.coalesce("gross_bet", F.lit(0.0)) > 0, 1).otherwise(0).cast("bigint").alias(f"response_label_positive_{n}"),
    )


def response_dataset(
    mart: DataFrame,
    vouchers: DataFrame,
    sends: DataFrame,
    bets: DataFrame,
    first_pt: str | None = None,
    last_pt: str | None = None,
) -> DataFrame:
    """Population, treatments, outcomes and label in the column order of the table."""
    base = base_population(mart, first_pt, last_pt)
    return outcome_rollup(treatment_rollup(base, vouchers, sends), bets).select(*RESPONSE_DATASET.fieldNames())


# --- checks --------------------------------------------------------------------------------


def dataset_reconcile(actual: DataFrame, base: DataFrame, vouchers: DataFrame, sends: DataFrame, bets: DataFrame) -> DataFrame:
    """Labels recomputed from the raw bets, against the built dataset, per partition.

    Bets are added up by player and day before a day is given to the three assignment days it can follow.
    """
    player, day = F.col("login_name").cast("string"), F.col("stat_date").cast("date")
    daily = bets.groupBy(player.alias("player_id"), day.alias("stat_date")).agg(
        F.sum(F.col("bet_amount").cast("double")).alias("bet"), F.count(F.lit(1)).alias("n")
    )
    raw = daily.withColumn("assignment_date", F.explode(assignment_days("stat_date", 3)))
    expected = raw.groupBy(*KEYS).agg(F.sum("bet").alias("expected_bet"), F.sum("n").alias("expected_rows"))
    treated = treatments_by_player_day(vouchers, sends).select(*KEYS, F.lit(True).alias("treated"))
    rows = (
        actual.select("pt", *KEYS, F.col("response_label_positive_3d").cast("bigint").alias("label"))
        .join(base.select("pt", *KEYS), ["pt", *KEYS])
        .join(expected, KEYS, "left")
        .join(treated, KEYS, "left")
    )
    wanted = F.when(F.coalesce("expected_bet", F.lit(0.0)) > 0, 1).otherwise(0)
    return rows.groupBy("pt").agg(
        F.count(F.lit(1)).alias("base_rows"),
        F.count_if("treated").alias("treatment_rows"),
        F.count_if(F.col("expected_rows") > 0).alias("matched_outcome_rows"),
        F.count_if(F.col("expected_bet") > 0).alias("expected_positive_bet_rows"),
        F.sum("label").alias("actual_positive_labels"),
        F.avg(F.col("label").cast("double")).alias("actual_label_rate"),
        F.count_if(F.col("label") == wanted).alias("matching_label_rows"),
        F.count_if(F.col("label") != wanted).alias("mismatching_label_rows"),
    )


def treatment_source_audit(dataset: DataFrame) -> DataFrame:
    """Rows, players and mean flags by partition, treatment type and group."""
    return (
        dataset.groupBy("pt", "treatment_type", "treatment_group")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_distinct("player_id").alias("distinct_players"),
            F.avg(F.col("treatment_flag").cast("double")).alias("treatment_rate"),
            F.avg(F.col("outcome_paid_activity_3d_flag").cast("double")).alias("outcome_paid_activity_3d_rate"),
            F.avg(F.col("outcome_paid_activity_7d_flag").cast("double")).alias("outcome_paid_activity_7d_rate"),
        )
        .orderBy(F.desc("row_count"), "treatment_type", "treatment_group")
    )


def observed_outcomes(scores: DataFrame, bets: DataFrame, window_days: int = 3) -> DataFrame:
    """Scored players with the outcome observed in (score_date, score_date + window]."""
    n = f"{window_days}d"
    outcomes = outcomes_by_assignment(bets, window_days).withColumnRenamed("assignment_date", "score_date")
    return left_join_by_player(scores, outcomes, ["player_id", "score_date"]).select(
        "player_id",
        F.col("scoring_pt").alias("pt"),
        "predicted_response_score",
        "response_priority_bucket",
        "vip_level",
        "selected_threshold",
        "model_name",
        "model_version",
        F.coalesce("gross_bet", F.lit(0.0)).alias(f"observed_gross_bet_value_{n}"),
        F.coalesce("gross_ggr", F.lit(0.0)).alias(f"observed_gross_ggr_value_{n}"),
        F.when(F.coalesce("gross_bet", F.lit(0.0)) > 0, 1).otherwise(0).cast("bigint").alias(f"observed_response_label_positive_{n}"),
        F.coalesce("source_rows", F.lit(0)).cast("bigint").alias(f"observed_outcome_source_rows_{n}"),
        F.col("first_day").alias("first_observed_outcome_date"),
        F.col("last_day").alias("last_observed_outcome_date"),
    )


def audit_dataset(dataset: DataFrame, bets: DataFrame) -> DataFrame:
    """The dataset as the experiment audit reads it: treatment type and group, channel tokens, 3- and 7-day flags.

    `bets` reaches seven days past the last assignment day.
    """
    voucher, sms = F.col("has_voucher_treatment") == 1, F.col("has_sms_treatment") == 1
    kind = (
        F.when(voucher & sms, "voucher_and_sms").when(voucher, "voucher").when(sms, "sms").otherwise("none")
    )
    tokens = F.nullif(F.concat_ws("|", F.when(sms, "sms"), F.when(voucher, "voucher")), F.lit(""))

    def paid(value: str) -> Column:
        return F.when(F.col(value) > 0, 1).otherwise(0).cast("bigint")

    week = outcomes_by_assignment(bets, 7).select(*KEYS, F.col("gross_bet").alias("outcome_gross_bet_7d_value"))
    return left_join_by_player(dataset, week).select(
        *dataset.columns,
        kind.alias("treatment_type"),
        F.when(F.col("treatment_flag") == 0, "control").otherwise(kind).alias("treatment_group"),
        tokens.alias("source_treatment_types"),
        F.col("raw_assignment_event_count").alias("treatment_event_count"),
        (F.col("has_voucher_treatment") + F.col("has_sms_treatment")).alias("treatment_source_count"),
        paid("outcome_gross_bet_3d_value").alias("outcome_gross_bet_3d_flag"),
        paid("outcome_gross_bet_3d_value").alias("outcome_paid_activity_3d_flag"),
        paid("outcome_gross_bet_7d_value").alias("outcome_paid_activity_7d_flag"),
    )
