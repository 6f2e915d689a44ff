"""Strategy comparison dataset: one row per player and decision, its treatment, cost, context and later outcomes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import date_to_pt, ratio
from .timeline import MONEY, nearest, window_sums

GRAIN = ["player_id", "decision_timestamp"]

# Columns of the dataset in order.
COLUMNS = """
player_id decision_date decision_timestamp eligibility_flag strategy_group strategy_version selected_flag
selection_reason_code actual_treatment_flag treatment_type treatment_subtype treatment_source_event_id
treatment_timestamp treatment_cost_actual treatment_cost_fallback treatment_cost_currency treatment_cost_source
churn_score_at_decision selected_threshold_at_decision vip_level_at_decision vip_level_num_at_decision
value_segment_at_decision feature_snapshot_date gross_ggr_t_plus_3 gross_ggr_t_plus_7 gross_bet_amount_t_plus_3
gross_bet_amount_t_plus_7 net_value_t_plus_3 net_value_t_plus_7 label_ready_3d label_ready_7d
outcome_window_start_ts outcome_window_end_3d_ts outcome_window_end_7d_ts eligibility_source_table
strategy_source_table score_source_table treatment_source_table outcome_source_table feature_source_table
build_version build_timestamp pt
""".split()
SOURCES = ["eligibility", "strategy", "score", "treatment", "outcome", "feature"]
WINDOWS = (3, 7)
#: Where a cost comes from, by priority, and its column.
COSTS = {"actual": "treatment_cost_actual", "fallback": "treatment_cost_fallback"}


def chosen_cost(costs: Mapping[str, str], treated: Column) -> tuple[Column, Column]:
    """The first cost that is there, and its source: `missing` for a treatment without any, `none` without treatment.

    Without treatment the cost is 0; a treatment whose cost is missing has no known cost.
    """
    known = [F.col(c).cast(MONEY) for c in costs.values()]
    source = F.when(~treated, "none")
    for name, value in zip(costs, known):
        source = source.when(value.isNotNull(), name)
    return F.when(~treated, F.lit(0).cast(MONEY)).otherwise(F.coalesce(*known)), source.otherwise("missing")


def net_value(
    rows: DataFrame, gross: Mapping[str, str], *, costs: Mapping[str, str] = COSTS, treated: str = "actual_treatment_flag",
    cost: str = "treatment_cost", source: str = "treatment_cost_source",
) -> DataFrame:
    """`rows` with the chosen cost and its source, and per entry of `gross` the value less that cost.

    A net value is NULL where the value is, or where a treatment has no known cost: an unknown cost is not free.
    """
    value, kind = chosen_cost(costs, F.coalesce(F.col(treated) == 1, F.lit(False)))
    priced = rows.withColumns({cost: value, source: kind})
    return priced.withColumns({name: (F.col(g).cast(MONEY) - F.col(cost)).cast(MONEY) for name, g in gross.items()})


def return_on_cost(net: str | Column, cost: str | Column) -> Column:
    """Net value per unit of cost; NULL without a cost."""
    return ratio(net, cost)


def require_decisions(decisions: DataFrame) -> None:
    """Raise when a decision has no player or moment, or occurs twice: its outcomes would count twice."""
    bad = decisions.groupBy(*GRAIN).count().where("count > 1 OR player_id IS NULL OR decision_timestamp IS NULL")
    found = bad.limit(3).collect()  # at most three keys, for the message
    if found:
        raise ValueError(f"decisions without key or with a repeated one: {[tuple(r)[:-1] for r in found]}")


def with_treatment(decisions: DataFrame, treatments: DataFrame, attribution_days: int) -> DataFrame:
    """The first treatment from the decision on, before the player's next decision and within `attribution_days`.

    So a treatment belongs to one decision at most and never precedes it.
    """
    moments = decisions.select("player_id", F.col("decision_timestamp").alias("next_decision"))
    ahead = nearest(decisions, moments, at="decision_timestamp", fact_at="next_decision", into="_next", after=True, inclusive=False)
    found = nearest(ahead, treatments, at="decision_timestamp", fact_at="treatment_timestamp", into="_treatment", after=True)
    made = F.col("_treatment.treatment_timestamp")
    own = (made <= F.col("decision_timestamp") + F.expr(f"INTERVAL {attribution_days} DAYS")) & (
        F.col("_next").isNull() | (made < F.col("_next.next_decision"))
    )
    return found.withColumn("_treatment", F.when(own, F.col("_treatment"))).drop("_next")


def strategy_dataset(
    decisions: DataFrame, treatments: DataFrame, bets: DataFrame, snapshots: DataFrame, scores: DataFrame, *,
    observed_through: datetime, build_version: str, build_timestamp: datetime, sources: Mapping[str, str],
    windows: Sequence[int] = WINDOWS, attribution_days: int = 3, net_of: str = "gross_ggr",
) -> DataFrame:
    """Decisions with treatment, cost, features and score known by then, and outcomes of (start, start + n days].

    decisions: player_id, decision_timestamp, strategy_group, strategy_version, selected_flag, selection_reason_code;
    treatments: player_id, treatment_timestamp, treatment_type, treatment_subtype, treatment_source_event_id and costs;
    bets: player_id, event_ts, bet_amount, ggr; snapshots: player_id, snapshot_date, is_eligible, vip_level,
    value_segment; scores: player_id, scoring_ts, score, selected_threshold. The window starts at the treatment, else at
    the decision. A snapshot counts from the day after it, a score from its moment. A window is ready once all of it
    lies before `observed_through`; until then its sums hold what has been seen.
    """
    require_decisions(decisions)
    rows = with_treatment(decisions, treatments, attribution_days)
    known = snapshots.withColumn("_from", F.date_add("snapshot_date", 1).cast("timestamp_ntz"))
    rows = nearest(rows, known, at="decision_timestamp", fact_at="_from", into="_features")
    rows = nearest(rows, scores, at="decision_timestamp", fact_at="scoring_ts", into="_score")
    anchored = rows.withColumn("outcome_window_start_ts", F.coalesce("_treatment.treatment_timestamp", "decision_timestamp"))
    sums = window_sums(
        anchored, bets, keys=GRAIN, start="outcome_window_start_ts", fact_at="event_ts",
        measures={"gross_bet_amount_t_plus": "bet_amount", "gross_ggr_t_plus": "ggr"}, days=windows,
    )
    stamp = F.lit(build_timestamp.isoformat(sep=" ")).cast("timestamp_ntz")
    seen = F.lit(observed_through.isoformat(sep=" ")).cast("timestamp_ntz")
    flat = anchored.join(sums, GRAIN, "left").withColumns(
        {
            "decision_date": F.col("decision_timestamp").cast("date"),
            "eligibility_flag": F.coalesce(F.col("_features.is_eligible").cast("bigint"), F.lit(0).cast("bigint")),
            "actual_treatment_flag": F.col("_treatment").isNotNull().cast("bigint"),
            **{c: F.col(f"_treatment.{c}") for c in ("treatment_type", "treatment_subtype", "treatment_source_event_id", "treatment_timestamp")},
            **{c: F.col(f"_treatment.{c}").cast(MONEY) for c in COSTS.values()},
            "treatment_cost_currency": F.col("_treatment.treatment_cost_currency"),
            "churn_score_at_decision": F.col("_score.score"),
            "selected_threshold_at_decision": F.col("_score.selected_threshold"),
            "vip_level_at_decision": F.col("_features.vip_level"),
            "vip_level_num_at_decision": F.regexp_extract("_features.vip_level", "([0-9]+)$", 1).try_cast("bigint"),
            "value_segment_at_decision": F.col("_features.value_segment"),
            "feature_snapshot_date": F.col("_features.snapshot_date"),
            **{f"outcome_window_end_{n}d_ts": F.col("outcome_window_start_ts") + F.expr(f"INTERVAL {n} DAYS") for n in windows},
            **{f"{s}_source_table": F.lit(sources[s]) for s in SOURCES},
            "build_version": F.lit(build_version),
            "build_timestamp": stamp,
        }
    )
    flat = flat.withColumns(
        {f"label_ready_{n}d": (F.col(f"outcome_window_end_{n}d_ts") < seen).cast("bigint") for n in windows} | {"pt": date_to_pt("decision_date")}
    )
    priced = net_value(flat, {f"net_value_t_plus_{n}": f"{net_of}_t_plus_{n}" for n in windows})
    return priced.select(*COLUMNS)


def strategy_comparison(dataset: DataFrame, window: int = 3) -> DataFrame:
    """Decisions, treatments, outcomes and return per strategy and selection, over rows whose window is ready."""
    ready = dataset.where(F.col(f"label_ready_{window}d") == 1)
    cost, _ = chosen_cost(COSTS, F.col("actual_treatment_flag") == 1)
    net = F.col(f"net_value_t_plus_{window}")
    grouped = ready.withColumn("_cost", cost).groupBy("strategy_group", "selected_flag").agg(
        F.count(F.lit(1)).alias("decisions"),
        F.sum("actual_treatment_flag").alias("treated"),
        F.count_if(F.col("treatment_cost_source") == "missing").alias("unknown_costs"),
        F.sum(f"gross_bet_amount_t_plus_{window}").cast(MONEY).alias("gross_bet_amount"),
        F.sum(f"gross_ggr_t_plus_{window}").cast(MONEY).alias("gross_ggr"),
        F.sum(F.when(net.isNotNull(), F.col("_cost"))).cast(MONEY).alias("known_cost"),
        F.sum(net).cast(MONEY).alias("net_value"),
    )
    return grouped.withColumn("return_on_cost", return_on_cost("net_value", "known_cost"))
