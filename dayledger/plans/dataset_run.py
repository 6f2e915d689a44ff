"""Build the response dataset for a range of days and check it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import shift_pt
from ..operators import dataset as D
from ..sources.schemas import RESPONSE_DATASET
from ..sources.sinks import read_table, write_dataset


def build(
    spark: SparkSession,
    path: str,
    mart: DataFrame,
    vouchers: DataFrame,
    sends: DataFrame,
    bets: DataFrame,
    first_pt: str,
    last_pt: str,
) -> DataFrame:
    """Replace the day partitions of the table at `path` and return the reconciliation per partition.

    Sources are cut to the partitions the days need, so their scans prune: treatments of the same days, bets
    of the three days after each.
    """
    days = F.col("pt").between(first_pt, last_pt)
    vouchers, sends = vouchers.where(days), sends.where(days)
    bets = bets.where(F.col("pt").between(shift_pt(first_pt, 1), shift_pt(last_pt, 3)))
    base = D.base_population(mart, first_pt, last_pt)
    D.require_unique_grain(base)
    write_dataset(D.response_dataset(mart, vouchers, sends, bets, first_pt, last_pt), path, RESPONSE_DATASET)
    written = read_table(spark, path, RESPONSE_DATASET).where(days)
    return D.dataset_reconcile(written, base, vouchers, sends, bets)
