"""Distinct values as one text, for columns that should have few of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Values of one list; a column with more is refused.
MOST_VALUES = 1_000


def few_values(values: DataFrame, key: Sequence[str], value: str, most: int = MOST_VALUES) -> DataFrame:
    """`values` (one row per key and value), unless a key has over `most` values: then the query fails, naming the key.

    A task looks at `most` + 1 rows of a key at most, so a column with a value for every row fails before it is listed.
    """
    place = F.row_number().over(Window.partitionBy(*key).orderBy(value))
    first = values.withColumn("_place", place).where(F.col("_place") <= most + 1)
    told = F.concat(F.lit(f"over {most} different values of {value} for "), F.concat_ws(", ", *[F.col(k).cast("string") for k in key]))
    checked = F.when(F.col("_place") > most, F.raise_error(told)).otherwise(F.lit(True))
    return first.where(checked).drop("_place")


def joined_values(df: DataFrame, columns: Sequence[str], most: int = MOST_VALUES) -> DataFrame:
    """One row: of each column the single distinct value, or all of them sorted and comma-joined, or NULL.

    Values are made distinct by key before anything is listed, with map-side combination, in one pass for all columns.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns])
    distinct = df.select(F.inline(pairs)).where("value IS NOT NULL").groupBy("name", "value").agg(F.lit(1).alias("_one")).drop("_one")
    lists = few_values(distinct, ["name"], "value", most).groupBy("name").agg(F.array_join(F.array_sort(F.collect_list("value")), ",").alias("text"))
    # one row a column
    return lists.agg(*[F.nullif(F.max(F.when(F.col("name") == c, F.col("text"))), F.lit("")).alias(c) for c in columns])
