"""Label maturity and time-based splits. Everything here works on partition listings: one row a day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import date_to_pt, pt_to_date


def runtime_window(listing: DataFrame, as_of: date, response_window_days: int = 3, buffer_days: int = 1) -> DataFrame:
    """One row: first and last partition, the maturity cutoff, and the last partition not after it."""
    cutoff = date_to_pt(F.date_sub(F.lit(as_of), response_window_days + buffer_days))
    bounds = listing.agg(
        F.min("pt").alias("min_pt"),
        F.max("pt").alias("max_pt"),
        F.max(F.when(F.col("pt") <= cutoff, F.col("pt"))).alias("modeling_end_pt"),
    )
    return bounds.select("min_pt", "max_pt", cutoff.alias("maturity_end_pt"), "modeling_end_pt")


def require_mature_window(window: DataFrame) -> dict:
    row = window.first().asDict()  # one row of four partition names
    if row["min_pt"] is None:
        raise ValueError("the table has no partitions")
    if row["modeling_end_pt"] is None:
        raise ValueError(f"no partition is mature: cutoff {row['maturity_end_pt']}, table starts at {row['min_pt']}")
    return row


def split_plan(
    listing: DataFrame,
    as_of: date,
    train_days: int = 30,
    validation_days: int = 7,
    test_days: int = 14,
    response_window_days: int = 3,
    buffer_days: int = 1,
) -> DataFrame:
    """(pt, split) for the latest mature partitions: oldest train, then validation, then test."""
    cutoff = date_to_pt(F.date_sub(F.lit(as_of), response_window_days + buffer_days))
    mature = listing.select("pt").distinct().where(F.col("pt") <= cutoff)
    # one row per listed day, so the window without a partition key stays small
    age = F.row_number().over(Window.orderBy(F.desc("pt")))
    split = (
        F.when(F.col("age") <= test_days, "test")
        .when(F.col("age") <= test_days + validation_days, "validation")
        .otherwise("train")
    )
    total = train_days + validation_days + test_days
    return mature.withColumn("age", age).where(F.col("age") <= total).select("pt", split.alias("split"))


def split_windows(plan: DataFrame) -> DataFrame:
    """First and last partition and partition count of each split."""
    return plan.groupBy("split").agg(
        F.min("pt").alias("start_pt"), F.max("pt").alias("end_pt"), F.count(F.lit(1)).alias("partitions")
    )


def require_complete_plan(plan: DataFrame, days: int, contiguous: bool = True) -> None:
    """Raise unless the plan has the wanted number of partitions, without gaps when asked."""
    span = F.datediff(F.max(pt_to_date("pt")), F.min(pt_to_date("pt"))) + 1
    row = plan.agg(F.count(F.lit(1)).alias("n"), span.alias("span")).first()
    if row.n < days:
        raise ValueError(f"not enough mature partitions: {days} wanted, {row.n} available")
    if contiguous and row.span != row.n:
        raise ValueError(f"mature partitions have gaps: {row.n} partitions over {row.span} days")


def assign_splits(frame: DataFrame, plan: DataFrame) -> DataFrame:
    """Add `split` to the rows of planned partitions. The plan has one row a day, hence the broadcast."""
    return frame.join(F.broadcast(plan.select("pt", "split")), "pt").select(*frame.columns, "split")


def require_same_partitions(frame: DataFrame, plan: DataFrame) -> None:
    """Raise unless the loaded partitions are exactly the planned ones."""
    loaded = frame.select("pt").distinct().withColumn("loaded", F.lit(True))
    gaps = (
        loaded.join(plan.select("pt", F.lit(True).alias("planned")), "pt", "full")
        .where(F.col("loaded").isNull() | F.col("planned").isNull())
        .select("pt")
        .orderBy("pt")
        .limit(5)
        .collect()
    )
    if gaps:
        raise ValueError(f"loaded and planned partitions differ at {[r.pt for r in gaps]}")


def label_maturity(
    listing: DataFrame, as_of: date, label_maturity_days: int = 4, response_window_days: int = 3
) -> DataFrame:
    """Per scored partition: the day its labels mature and whether they are mature on `as_of`."""
    day = pt_to_date("pt")
    matured_on = F.date_add(day, label_maturity_days)
    return listing.select(
        F.col("pt").alias("scoring_pt"),
        day.alias("score_date"),
        F.date_add(day, response_window_days).alias("observed_outcome_end_date"),
        matured_on.alias("matured_on_date"),
        F.lit(as_of).alias("as_of_date"),
        (F.lit(as_of) >= matured_on).alias("labels_mature"),
    )


def outcome_maturity(dataset: DataFrame, windows: dict[str, int], as_of: date) -> DataFrame:
    """Rows with a complete outcome window, per window, counted in one pass."""
    def matured(days: int):
        return F.coalesce(F.date_add("assignment_date", days) <= F.lit(as_of), F.lit(False))

    counts = dataset.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(matured(d)).alias(name) for name, d in windows.items()]
    )
    rows = [
        F.struct(
            F.lit(name).alias("outcome_window"),
            F.lit(days).cast("bigint").alias("window_days"),
            F.lit(as_of).alias("as_of_date"),
            F.col(name).alias("matured_rows"),
            (F.col("n") - F.col(name)).alias("incomplete_rows"),
            F.coalesce(F.try_divide(F.col(name).cast("double"), F.col("n")), F.lit(0.0)).alias("matured_share"),
        )
        for name, days in windows.items()
    ]
    return counts.select(F.inline(F.array(*rows)))


def outcome_maturity_flags(dataset: DataFrame, windows: dict[str, int], as_of: date) -> DataFrame:
    """Per player-day one 0/1 flag per window."""
    return dataset.select(
        "player_id",
        "assignment_date",
        *[
            F.coalesce((F.date_add("assignment_date", days) <= F.lit(as_of)).cast("bigint"), F.lit(0))
            .cast("bigint")
            .alias(f"outcome_{name}_matured_flag")
            for name, days in windows.items()
        ],
    )
