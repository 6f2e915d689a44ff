"""Session settings the jobs rely on, and the shared folder used to cut lineage."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # `pt` is text such as 20240126; inference would read it back as an integer
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # otherwise every column expression built in Python also records its call site, at the price of the call itself
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # checkpoint files go away with the frames that own them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str, app_name: str = "dayledger", **extra: str) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    for key, value in {**ENGINE_CONF, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`, else the context's own.

    Where neither is set, a single-process (local) master gets a fresh folder of its own. Any other master is
    refused: its executors would each write to their own disk.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    current = context._jsc.sc().getCheckpointDir()
    if current.isEmpty():
        if not named and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="dayledger-checkpoint-"))
        current = context._jsc.sc().getCheckpointDir()
    return named or current.get()


def run_folder(spark: SparkSession) -> str:
    """The part of the shared folder that this application writes its tables to; removed when the driver ends."""
    app = spark.sparkContext.applicationId
    if app not in _RUNS:
        _RUNS[app] = f"{shared_folder(spark).rstrip('/')}/tables/{app}-{uuid.uuid4().hex[:8]}"
        atexit.register(_end_run, spark, app)
    return _RUNS[app]


_RUNS: dict[str, str] = {}


def _end_run(spark: SparkSession, app: str) -> None:
    if spark.sparkContext._jsc is not None and spark.sparkContext.applicationId == app:
        remove_path(spark, _RUNS[app])


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused location in the shared folder for a table written by this run."""
    return f"{run_folder(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write `df` as parquet to the shared folder and go on from the files, so a lost executor costs a re-read.

    Files are compressed, hold sizes for the planner, and are read by column, unlike those of `checkpoint()`.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder through the file system that holds it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def remove_cut(df: DataFrame) -> None:
    """Remove the files of a frame made by `cut_lineage` that nothing reads any more."""
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        if f"/tables/{df.sparkSession.sparkContext.applicationId}-" in folder:
            remove_path(df.sparkSession, folder)
