"""Writes of day-partitioned tables: typed, one partition replaced at a time, no row through the driver."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import parse_pt, pt_to_date
from ..session import cut_lineage
from .schemas import LIFECYCLE_DAYS, TABLES


def align_to_schema(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, dict[str, list[str]]]:
    """Sink columns in sink order and type; absent ones NULL, others dropped. Also says which were which."""
    wanted = schema.fieldNames()
    report = {
        "extra_columns": [c for c in df.columns if c not in wanted],
        "missing_columns": [c for c in wanted if c not in df.columns],
    }
    aligned = df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )
    return aligned, report


def _write(df: DataFrame, path: str, mode: str) -> None:
    df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("pt").parquet(path)


def write_dataset(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Replace every partition present in `df`, leave the others."""
    aligned, _ = align_to_schema(df, schema)
    # one shuffle puts each day into whole files; AQE splits days too large for one task
    _write(aligned.hint("rebalance", "pt"), path, "overwrite")


def write_partition(df: DataFrame, path: str, schema: T.StructType, pt: str, mode: str = "overwrite") -> dict:
    """Write `df` as partition `pt`. An empty frame writes nothing and leaves the partition as it was."""
    if mode not in ("append", "overwrite"):
        raise ValueError(f"write mode must be append or overwrite, not {mode!r}")
    parse_pt(pt)
    aligned, report = align_to_schema(df.withColumn("pt", F.lit(pt)), schema)
    _write(aligned, path, mode)
    return report


def replace_partition(df: DataFrame, path: str, schema: T.StructType, pt: str) -> dict:
    """As an overwrite, but an empty frame leaves an empty partition: results of an earlier run do not survive.

    Earlier rows go only once the new ones are written, or once it is known that there are none. `df` is looked at and
    then written, so its rows are made once, aside.
    """
    aligned, report = align_to_schema(df.withColumn("pt", F.lit(pt)), schema)
    rows = cut_lineage(aligned, "replacing")
    if rows.isEmpty():
        drop_partitions(df.sparkSession, path, [pt])
    else:
        write_partition(rows, path, schema, pt)
    return report


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def drop_partitions(spark: SparkSession, path: str, pts: list[str]) -> list[str]:
    """Remove partition folders through the file system that holds the table."""
    jvm = spark._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    dropped = []
    for pt in pts:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/pt={pt}")
        fs = folder.getFileSystem(conf)
        if fs.exists(folder) and fs.delete(folder, True):
            dropped.append(pt)
    spark.catalog.refreshByPath(path)
    return dropped


def expired_partitions(listing: DataFrame, as_of: date, lifecycle_days: int) -> DataFrame:
    """Listed partitions older than the table keeps."""
    age = F.datediff(F.lit(as_of), pt_to_date("pt"))
    return (
        listing.select("pt", age.cast("bigint").alias("age_days")).where(F.col("age_days") > lifecycle_days).orderBy("pt")
    )


def drop_expired(spark: SparkSession, path: str, listing: DataFrame, as_of: date, lifecycle_days: int) -> list[str]:
    pts = [row.pt for row in expired_partitions(listing, as_of, lifecycle_days).collect()]  # day names only
    return drop_partitions(spark, path, pts)


def create_table_sql(name: str, table: str, location: str | None = None) -> str:
    """DDL of one of the produced tables with its column comments, registered in the catalog under `name`."""
    def column(field: T.StructField) -> str:
        note = (field.metadata or {}).get("comment", "").replace("'", "\\'")
        return f"{field.name} {field.dataType.simpleString()}" + (f" COMMENT '{note}'" if note else "")

    columns = ",\n  ".join(map(column, TABLES[table].fields))
    where = f"\nLOCATION '{location}'" if location else ""
    return (
        f"CREATE TABLE IF NOT EXISTS {name} (\n  {columns}\n) USING parquet\nPARTITIONED BY (pt){where}\n"
        f"TBLPROPERTIES ('lifecycle_days' = '{LIFECYCLE_DAYS[table]}')"
    )


def write_extract(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """A result table as CSV (with header) or parquet."""
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"extracts are csv or parquet, not {fmt!r}")
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
