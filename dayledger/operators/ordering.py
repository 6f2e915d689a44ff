"""Ranks, running totals and exact quantiles over data of any size and skew.

A window without a partition key would pull all rows into one task. Here Spark's own range-partitioned
sort does the ordering: its sampled bounds cover the whole sort key, so equal scores are split by the
tie-break. Each row keeps its slice and its position in the slice; per-slice totals (one row a slice)
give the offset of the slice. The sorted rows are written to the shared folder once, because slice
numbers may not be computed twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_SLICE, _POS = "slice_no", "slice_pos"


def sort_into_slices(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """`df` sorted, with the number of the sorted slice and the 0-based position in it."""
    stamped = df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id())
    return cut_lineage(
        stamped.select(
            *df.columns,
            # upper bits: partition number, lower 33 bits: position in the partition
            F.shiftright("_at", 33).alias(_SLICE),
            F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)).alias(_POS),
        )
    )


def rank_rows(df: DataFrame, order: Sequence[str | Column], rank: str, total: str) -> DataFrame:
    """Add the 1-based rank under `order` and the row count."""
    sliced = sort_into_slices(df, order)
    sizes = sliced.groupBy(_SLICE).agg(F.count(F.lit(1)).alias("_n"))
    # one row per sorted slice: at most the number of shuffle partitions
    before = Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        _SLICE,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy()).alias(total),
    )
    ranked = sliced.join(F.broadcast(offsets), _SLICE)
    return ranked.select(*df.columns, (F.col("_before") + F.col(_POS) + 1).alias(rank), total)


def running_totals(
    df: DataFrame, group: Sequence[str], order: Sequence[str | Column], measures: Sequence[str]
) -> DataFrame:
    """Add `cum_<m>` (running total up to the row) and `all_<m>` (total of the group) for each measure.

    Group keys must not be NULL. A group may span many slices, so no group has to fit one task.
    """
    sliced = sort_into_slices(df, [*group, *order])
    within = Window.partitionBy(*group, _SLICE).orderBy(_POS).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sliced.groupBy(*group, _SLICE).agg(*[F.sum(m).alias(f"_{m}") for m in measures])
    # rows: groups times the slices they span
    before = Window.partitionBy(*group).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *group,
        _SLICE,
        *[F.coalesce(F.sum(f"_{m}").over(before), F.lit(0)).alias(f"_before_{m}") for m in measures],
        *[F.sum(f"_{m}").over(Window.partitionBy(*group)).alias(f"all_{m}") for m in measures],
    )
    local = sliced.select("*", *[F.sum(m).over(within).alias(f"_local_{m}") for m in measures])
    return local.join(offsets, [*group, _SLICE]).select(
        *df.columns,
        *[(F.col(f"_before_{m}") + F.col(f"_local_{m}")).alias(f"cum_{m}") for m in measures],
        *[f"all_{m}" for m in measures],
    )


def exact_quantiles(
    histogram: DataFrame, value: str, weight: str, points: dict[str, float], group: Sequence[str] = ()
) -> DataFrame:
    """Quantiles with linear interpolation, one row per group, from (group, value, weight) with distinct values.

    The quantile at p lies at position p * (n - 1) of the sorted rows; its two neighbours are the smallest
    values whose running weight passes the position, found in one aggregation over the running totals.
    """
    running = running_totals(histogram.select(*group, value, weight), group, [value], [weight])
    cum, total = F.col(f"cum_{weight}"), F.col(f"all_{weight}")
    bounds = []
    for name, p in points.items():
        at = F.lit(p) * (total - 1)
        for side, index in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            bounds.append(F.min(F.when(cum > index, F.col(value))).alias(f"_{name}_{side}"))
    found = running.groupBy(*group).agg(F.max(total).alias("_n"), *bounds)
    out = []
    for name, p in points.items():
        at = F.lit(p) * (F.col("_n") - 1)
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        out.append((lo + (hi - lo) * (at - F.floor(at))).alias(name))
    return found.select(*group, *out)


def side_by_side(*rows: DataFrame) -> DataFrame:
    """One-row frames with different columns as one row: stacked, then the known value of each column; no join."""
    stacked = rows[0]
    for other in rows[1:]:
        stacked = stacked.unionByName(other, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def value_histogram(df: DataFrame, value: str, group: Sequence[str] = (), weight: str = "n") -> DataFrame:
    """Rows per (group, value); rows without a number are left out."""
    numbers = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value)))
    return numbers.groupBy(*group, value).agg(F.count(F.lit(1)).alias(weight))
