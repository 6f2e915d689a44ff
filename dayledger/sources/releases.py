"""Staged writes of one partition: staged, looked at, and only then switched to, with values that a cast would lose counted.

A table is a folder with `staged/<pt>/<release>` and `manifest/<pt>/<number>`. A release is written once and never
changed. A manifest entry is a small file created under the next free number, which fails if another run was faster; the
highest complete entry names the release that readers see. So a run that dies at any point, or whose gate refuses the
staged rows, leaves readers on the release they had.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import parse_pt
from ..session import remove_path

#: What happens to a value that does not fit its column: the write fails, its row is kept aside, or it becomes NULL.
MODES = ("raise", "aside", "null")


@dataclass(frozen=True)
class Release:
    """A staged partition: rows kept, rows put aside, and values lost by column."""

    pt: str
    name: str
    path: str
    kept: int
    rejected: int
    lost: dict[str, int]


def _lost(df: DataFrame, schema: T.StructType) -> dict[str, Column]:
    """Per column of the sink: whether a value is there that its type cannot hold."""
    kinds = dict(df.dtypes)
    shared = [f for f in schema.fields if f.name in kinds and kinds[f.name] != f.dataType.simpleString()]
    return {f.name: F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull() for f in shared}


def stage(df: DataFrame, table: str, schema: T.StructType, pt: str, on_lost: str = "raise") -> Release:
    """Write `df` as a release of partition `pt` that no reader sees yet.

    One pass writes the rows and counts the lost values. Rows put aside keep their values as JSON, and the names of the
    columns at fault. In mode `raise` a lost value fails the write and leaves nothing staged.
    """
    if on_lost not in MODES:
        raise ValueError(f"values that do not fit are handled by {MODES}, not {on_lost!r}")
    parse_pt(pt)
    spark, name = df.sparkSession, uuid.uuid4().hex
    path = f"{table.rstrip('/')}/staged/{pt}/{name}"
    rows = df.withColumn("pt", F.lit(pt))
    lost = _lost(rows, schema)
    names = F.array_compact(F.array(*[F.when(bad, F.lit(c)) for c, bad in lost.items()])) if lost else F.array().cast("array<string>")
    aside = (F.size("_lost") > 0) if on_lost == "aside" else F.lit(False)
    typed = [(F.col(f.name).try_cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields]
    marked = rows.select("*", names.alias("_lost"))
    counted = Observation()
    out = marked.select(
        *typed, F.when(F.size("_lost") > 0, F.to_json(F.struct(*df.columns))).alias("_row"), "_lost", F.when(aside, "rejected").otherwise("kept").alias("_state")
    ).observe(
        counted,
        F.count_if(F.col("_state") == "kept").alias("kept"),
        F.count_if(F.col("_state") == "rejected").alias("rejected"),
        *[F.count_if(F.array_contains("_lost", c)).alias(f"lost {c}") for c in lost],
    )
    out.write.partitionBy("_state").parquet(path)
    found = counted.get
    values = {c: found[f"lost {c}"] for c in lost if found[f"lost {c}"]}
    if values and on_lost == "raise":
        remove_path(spark, path)
        raise ValueError(f"partition {pt} holds values that do not fit their columns: {values}")
    return Release(pt, name, path, found["kept"], found["rejected"], values)


def staged_rows(spark: SparkSession, release: Release, schema: T.StructType) -> DataFrame:
    """The rows of a release, seen by readers or not."""
    return _read(spark, [release.path], schema)


def rejected_rows(spark: SparkSession, release: Release) -> DataFrame:
    """(row, lost) of the rows put aside: the values as JSON, and the columns at fault."""
    if not release.rejected:
        return spark.createDataFrame([], "row string, lost array<string>")
    found = spark.read.schema("_row string, _lost array<string>").parquet(f"{release.path}/_state=rejected")
    return found.select(F.col("_row").alias("row"), F.col("_lost").alias("lost"))


def _read(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    files = _files(spark)
    kept = [f"{p}/_state=kept" for p in paths if files.exists(f"{p}/_state=kept")]
    if not kept:  # nothing released, or releases without rows
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*kept)


class _files:
    """The few file operations that a manifest needs, through the file system that holds the table."""

    def __init__(self, spark: SparkSession):
        self.path, self.conf = spark._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        there = self.path(path)
        return there, there.getFileSystem(self.conf)

    def exists(self, path: str) -> bool:
        there, system = self._at(path)
        return system.exists(there)

    def names(self, path: str) -> list[str]:
        there, system = self._at(path)
        return sorted(s.getPath().getName() for s in system.listStatus(there)) if system.exists(there) else []

    def create(self, path: str, text: str) -> None:
        """Create the file; an error if it exists."""
        there, system = self._at(path)
        stream = system.create(there, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def text(self, path: str) -> str:
        there, system = self._at(path)
        stream = system.open(there)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


def _entries(spark: SparkSession, table: str, pt: str) -> list[tuple[int, dict]]:
    """The complete manifest entries of a partition, oldest first; one broken off while it was written does not count."""
    files, folder, out = _files(spark), f"{table.rstrip('/')}/manifest/{pt}", []
    for name in files.names(folder):
        try:
            out.append((int(name), json.loads(files.text(f"{folder}/{name}"))))
        except ValueError:
            continue
    return out


def current(spark: SparkSession, table: str, pts: list[str] | None = None) -> dict[str, str]:
    """The release that readers see, by partition: names only."""
    known = _files(spark).names(f"{table.rstrip('/')}/manifest")
    entries = {pt: _entries(spark, table, pt) for pt in known if pts is None or pt in pts}
    return {pt: found[-1][1]["release"] for pt, found in entries.items() if found}


def switch(spark: SparkSession, table: str, release: Release, expected: str | None) -> None:
    """Make `release` the one that readers see, unless another than `expected` has become it meanwhile."""
    folder = f"{table.rstrip('/')}/manifest/{release.pt}"
    entries = _entries(spark, table, release.pt)
    seen = entries[-1][1]["release"] if entries else None
    if seen != expected:
        raise RuntimeError(f"partition {release.pt} moved from {expected} to {seen} since this run looked at it")
    taken = [int(n) for n in _files(spark).names(folder) if n.isdigit()]
    entry = {"release": release.name, "rows": release.kept, "rejected": release.rejected, "lost": release.lost}
    _files(spark).create(f"{folder}/{max(taken, default=0) + 1:010d}", json.dumps(entry))


def publish(
    df: DataFrame, table: str, schema: T.StructType, pt: str, gate: Callable[[DataFrame], None], on_lost: str = "raise"
) -> Release:
    """Stage `df`, let `gate` look at the staged rows (it raises to refuse them), then switch readers to them."""
    spark = df.sparkSession
    expected = current(spark, table, [pt]).get(pt)
    release = stage(df, table, schema, pt, on_lost)
    gate(staged_rows(spark, release, schema))
    switch(spark, table, release, expected)
    return release


def read_current(spark: SparkSession, table: str, schema: T.StructType, pts: list[str] | None = None) -> DataFrame:
    """The rows that readers see, of all partitions or of some."""
    seen = current(spark, table, pts)
    return _read(spark, [f"{table.rstrip('/')}/staged/{pt}/{name}" for pt, name in seen.items()], schema)


def remove_unseen(spark: SparkSession, table: str, pt: str) -> list[str]:
    """Remove the staged releases of a partition that readers do not see; readers that began earlier must have ended."""
    seen = current(spark, table, [pt]).get(pt)
    folder = f"{table.rstrip('/')}/staged/{pt}"
    gone = [name for name in _files(spark).names(folder) if name != seen]
    for name in gone:
        remove_path(spark, f"{folder}/{name}")
    return gone
