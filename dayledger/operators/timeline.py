"""Events around the moments of a player: the nearest one, and sums over windows anchored at a timestamp.

A player's history is looked at in two steps, so that a busy player is dealt out by day: within the day of a moment
over the events of that day, beyond it over one row a day. Nothing joins moments with all events of the same player.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MONEY = "decimal(20,6)"


def nearest(
    moments: DataFrame, facts: DataFrame, *, at: str, fact_at: str, into: str, after: bool = False, inclusive: bool = True,
    player: str = "player_id",
) -> DataFrame:
    """`moments` plus a struct `into`: the fact of the same player nearest before (or `after`) the moment, else NULL.

    Of facts at the same instant the largest by its other columns counts (the smallest for `after`). A moment or player
    that is NULL has no fact.
    """
    fields = [fact_at, *(c for c in facts.columns if c not in (fact_at, player))]
    named = facts.where(F.col(player).isNotNull() & F.col(fact_at).isNotNull())
    left = moments.select(F.col(player).alias("_p"), F.col(at).alias("_at"), F.lit(int(inclusive)).alias("_kind"), F.struct("*").alias("_row"))
    right = named.select(F.col(player).alias("_p"), F.col(fact_at).alias("_at"), F.lit(1 - int(inclusive)).alias("_kind"), F.struct(*fields).alias("_fact"))
    both = left.unionByName(right, allowMissingColumns=True).withColumn("_day", F.col("_at").cast("date"))
    turn = F.desc if after else F.asc
    within = Window.partitionBy("_p", "_day").orderBy(turn("_at"), "_kind", turn("_fact")).rowsBetween(Window.unboundedPreceding, 0)
    same_day = both.withColumn("_near", F.last("_fact", ignorenulls=True).over(within))
    pick = F.min("_fact") if after else F.max("_fact")
    days = both.groupBy("_p", "_day").agg(pick.alias("_fact"))
    beyond = Window.partitionBy("_p").orderBy(turn("_day")).rowsBetween(Window.unboundedPreceding, -1)
    days = days.select("_p", "_day", F.last("_fact", ignorenulls=True).over(beyond).alias("_far"))
    found = same_day.where(F.col("_row").isNotNull()).join(days, ["_p", "_day"], "left")
    return found.select("_row.*", F.coalesce("_near", "_far").alias(into))


def window_sums(
    anchors: DataFrame, facts: DataFrame, *, keys: Sequence[str], start: str, fact_at: str, measures: Mapping[str, str],
    days: Sequence[int], player: str = "player_id",
) -> DataFrame:
    """Per key the sums over (start, start + n days] as `<measure>_<n>`, exact to six decimals, zero without facts.

    `measures` maps result names to columns of `facts`. Every anchor asks for running totals at its start and ends: the
    total of whole days before that day plus the total within it, so a window is a difference of two.
    """
    spans = [0, *days]
    ends = F.explode(F.array(*[F.struct(F.lit(n).alias("_n"), (F.col(start) + F.expr(f"INTERVAL {n} DAYS")).alias("_at")) for n in spans]))
    asked = anchors.select(F.col(player).alias("_p"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], ends.alias("_e"))
    asked = asked.select("_p", *[f"_k{i}" for i in range(len(keys))], "_e.*")
    named = facts.where(F.col(player).isNotNull() & F.col(fact_at).isNotNull())
    seen = named.select(F.col(player).alias("_p"), F.col(fact_at).alias("_at"), *[F.col(c).cast(MONEY).alias(m) for m, c in measures.items()])
    both = asked.unionByName(seen, allowMissingColumns=True).withColumn("_day", F.col("_at").cast("date"))
    # facts at the very instant belong to what lies before it
    order = [F.col("_at"), F.col("_n").isNotNull()]
    within = Window.partitionBy("_p", "_day").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    running = both.withColumns({f"_in_{m}": F.sum(m).over(within) for m in measures})
    before = Window.partitionBy("_p").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    whole = both.groupBy("_p", "_day").agg(*[F.sum(m).alias(m) for m in measures])
    whole = whole.select("_p", "_day", *[F.sum(m).over(before).alias(f"_to_{m}") for m in measures])
    told = running.where(F.col("_n").isNotNull()).join(whole, ["_p", "_day"], "left")

    def total(measure: str, n: int) -> Column:
        value = F.coalesce(f"_in_{measure}", F.lit(0)) + F.coalesce(f"_to_{measure}", F.lit(0))
        return F.max(F.when(F.col("_n") == n, value))

    sums = [(total(m, n) - total(m, 0)).cast(MONEY).alias(f"{m}_{n}") for m in measures for n in days]
    return told.groupBy(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)]).agg(*sums)
