"""Scans of day-partitioned tables and questions answered from their partitions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan(
    table: DataFrame,
    columns: Iterable[str],
    equals: Mapping[str, object] | None = None,
    predicates: Iterable[Column] = (),
) -> DataFrame:
    """Projection (each column once) under equality filters and further predicates; None filters are left out."""
    for name, value in (equals or {}).items():
        if value is not None:
            table = table.where(F.col(name) == F.lit(value))
    for predicate in predicates:
        table = table.where(predicate)
    return table.select(*dict.fromkeys(columns))


def scan_partition(
    table: DataFrame, pt: str, columns: Iterable[str], predicates: Iterable[Column] = ()
) -> DataFrame:
    return scan(table, columns, {"pt": pt}, predicates)


def scan_pt_range(table: DataFrame, first_pt: str, last_pt: str, columns: Iterable[str]) -> DataFrame:
    """Rows of a partition range. `pt` is fixed-width text, so text order is day order."""
    return scan(table, columns, predicates=[F.col("pt").between(first_pt, last_pt)])


def load_dataset(table: DataFrame, columns: Iterable[str], pt: str | None = None) -> DataFrame:
    """Columns of the dataset for an audit, of one partition when given; raises when there are no rows."""
    rows = scan(table, columns, {"pt": pt})
    if rows.isEmpty():
        raise ValueError(f"the dataset has no rows for partition {pt}" if pt else "the dataset has no rows")
    return rows


def list_partitions(table: DataFrame) -> DataFrame:
    return table.select("pt").distinct().orderBy("pt")


def catalog_partitions(spark: SparkSession, table_name: str) -> DataFrame:
    """Partition values of a catalog table, from metadata alone."""
    listed = spark.sql(f"SHOW PARTITIONS {table_name}")
    return listed.select(F.regexp_extract("partition", "pt=([^/]+)", 1).alias("pt")).distinct().orderBy("pt")


def latest_partition(listing: DataFrame, wanted: str | None = None) -> DataFrame:
    """One row: the wanted partition, which must be listed, else the latest one."""
    latest = F.max("pt")
    if wanted is None:
        return listing.agg(latest.alias("pt")).where(F.col("pt").isNotNull())
    found = listing.agg(F.max(F.when(F.col("pt") == wanted, F.col("pt"))).alias("pt"), latest.alias("latest"))
    missing = F.concat(F.lit(f"partition {wanted} is not listed; latest is "), F.coalesce("latest", F.lit("none")))
    return found.select(F.when(F.col("pt").isNull(), F.raise_error(missing)).otherwise(F.col("pt")).alias("pt"))


def reference_partition(listing: DataFrame, current_pt: str, wanted: str | None = None) -> DataFrame:
    """One row: the wanted reference, else the latest partition before the current one (NULL if none)."""
    before = F.max(F.when(F.col("pt") < current_pt, F.col("pt")))
    return listing.agg((before if wanted is None else F.lit(wanted)).alias("reference_pt"))


def partition_row_count(table: DataFrame, pt: str) -> DataFrame:
    """Rows of one partition, and whether it has any: only the partition's files are opened, and no column is read."""
    counted = table.where(F.col("pt") == pt).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select(F.lit(pt).alias("pt"), "row_count", (F.col("row_count") > 0).alias("partition_exists"))


def split_row_counts(table: DataFrame, windows: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Rows per named partition range, counted in one pass over one scan; empty ranges count zero."""
    lo = min(first for first, _ in windows.values())
    hi = max(last for _, last in windows.values())
    counts = table.where(F.col("pt").between(lo, hi)).agg(
        *[F.count_if(F.col("pt").between(first, last)).alias(name) for name, (first, last) in windows.items()]
    )
    pairs = [F.struct(F.lit(name).alias("split"), F.col(name).alias("row_count")) for name in windows]
    return counts.select(F.inline(F.array(*pairs)))


def schema_inventory(schema: T.StructType, partition_columns: Iterable[str] = ("pt",)) -> list[tuple[str, str, str, bool]]:
    """(column, type, comment, is_partition) of every column, in table order."""
    partitions = set(partition_columns)
    return [
        (f.name, f.dataType.simpleString(), (f.metadata or {}).get("comment", ""), f.name in partitions)
        for f in schema.fields
    ]


def catalog_inventory(spark: SparkSession, name: str) -> DataFrame:
    """(column_name, data_type, comment, is_partition) of a catalog table, as the catalog tells it; one row a column."""
    rows = [(c.name, c.dataType, c.description or "", c.isPartition) for c in spark.catalog.listColumns(name)]
    return spark.createDataFrame(rows, "column_name string, data_type string, comment string, is_partition boolean")


def sample_rows(table: DataFrame, pt: str, rows: int = 5) -> DataFrame:
    """A few rows of one partition, the same ones on every run."""
    return table.where(F.col("pt") == pt).orderBy("player_id").limit(rows)
