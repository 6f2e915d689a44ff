"""Classifiers with pyspark.ml: preprocessing, fit, scores, importances, and the record of a run."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import MISSING_IN_MONITORING, labelled
from ..session import fresh_path, remove_path, shared_folder
from ..sources.schemas import CATEGORICAL_FEATURES, MODEL_RUNS, NUMERIC_FEATURES
from .contracts import require_no_leakage

TARGET = "response_label_positive_3d"
# Fixed value: where a run is only local, its model may not become the champion.
LOCAL_RUN_PREFIXES = ("local", "dev")
REQUIRED_RUN_FIELDS = ["run_id", "iteration_id", "model_name", "model_version", "model_path", "source_table", "target_column"]


def fill_features(
    rows: DataFrame,
    numeric: Sequence[str] = tuple(NUMERIC_FEATURES),
    categorical: Sequence[str] = tuple(CATEGORICAL_FEATURES),
) -> DataFrame:
    """Absent numbers become 0, absent categories their own level; text that is no number counts as absent."""
    filled = {f: F.coalesce(F.col(f).try_cast("double"), F.lit(0.0)) for f in numeric}
    filled |= {c: labelled(c, MISSING_IN_MONITORING) for c in categorical}
    return rows.withColumns(filled)


def preprocessing(
    scale: bool,
    numeric: Sequence[str] = tuple(NUMERIC_FEATURES),
    categorical: Sequence[str] = tuple(CATEGORICAL_FEATURES),
) -> list:
    """Stages from filled columns to `features`: every known level gets a slot, unknown levels none.

    With `scale` the numeric part is centred and scaled (for the linear model); trees take it as it is.
    """
    require_no_leakage([*numeric, *categorical])
    stages: list = []
    parts = []
    if categorical:
        stages.append(
            StringIndexer(
                inputCols=list(categorical),
                outputCols=[f"{c}_index" for c in categorical],
                stringOrderType="alphabetAsc",
                handleInvalid="keep",
            )
        )
        stages.append(
            OneHotEncoder(
                inputCols=[f"{c}_index" for c in categorical],
                outputCols=[f"{c}_levels" for c in categorical],
                dropLast=True,
            )
        )
        parts = [f"{c}_levels" for c in categorical]
    if numeric and scale:
        stages.append(VectorAssembler(inputCols=list(numeric), outputCol="numeric_raw"))
        stages.append(StandardScaler(inputCol="numeric_raw", outputCol="numeric", withMean=True, withStd=True))
        parts = ["numeric", *parts]
    else:
        parts = [*numeric, *parts]
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return stages


def balanced_weights(train: DataFrame, target: str = TARGET) -> tuple[DataFrame, int]:
    """Add `class_weight` = rows / (2 * rows of the class); also the row count. Two counts come to the driver."""
    counts = {int(r["y"]): r["n"] for r in train.groupBy(F.col(target).alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    if set(counts) != {0, 1}:
        raise ValueError(f"training rows need both classes, found {counts}")
    weight = F.when(F.col(target) == 1, total / (2 * counts[1])).otherwise(total / (2 * counts[0]))
    return train.withColumn("class_weight", weight).withColumn("label", F.col(target).cast("double")), total


def logistic_regression(rows: int, c: float = 1.0, max_iter: int = 1000) -> LogisticRegression:
    """L2 penalty of strength 1 / (C * n): balanced weights sum to n, and the loss here is a mean."""
    return LogisticRegression(
        featuresCol="features",
        labelCol="label",
        weightCol="class_weight",
        regParam=1.0 / (c * rows),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
    )


def boosted_trees(rounds: int = 200, step: float = 0.05, depth: int = 5, seed: int = 42) -> GBTClassifier:
    """Depth 5 holds up to 32 leaves. Every row is used in each round, four fifths of the features per split."""
    return GBTClassifier(
        featuresCol="features",
        labelCol="label",
        weightCol="class_weight",
        maxIter=rounds,
        stepSize=step,
        maxDepth=depth,
        minInstancesPerNode=50,
        featureSubsetStrategy="0.8",
        subsamplingRate=1.0,
        seed=seed,
        # a row finds its node by five comparisons; a stored id per row and level costs more than that
        cacheNodeIds=False,
        # what is left to explain goes to files of the shared folder, so long runs survive lost executors
        checkpointInterval=10,
    )


def fit_logistic_regression(train: DataFrame, **params) -> PipelineModel:
    weighted, rows = balanced_weights(fill_features(train))
    estimator = logistic_regression(rows, **params)
    return without_summary(Pipeline(stages=[*preprocessing(scale=True), estimator]).fit(weighted))


def without_summary(model: PipelineModel) -> PipelineModel:
    """The model with its last stage saved and loaded again, which leaves the training summary behind.

    The summary holds the session, and scores cannot be sent to tasks with it once any frame of the session was observed.
    """
    spark = SparkSession.active()
    path = fresh_path(spark, "fitted")
    model.stages[-1].write().save(path)
    loaded = LogisticRegressionModel.load(path)
    remove_path(spark, path)
    return PipelineModel([*model.stages[:-1], loaded])


def fit_boosted_trees(train: DataFrame, **params) -> PipelineModel:
    shared_folder(train.sparkSession)
    weighted, _ = balanced_weights(fill_features(train))
    return Pipeline(stages=[*preprocessing(scale=False), boosted_trees(**params)]).fit(weighted)


def score(model: PipelineModel, rows: DataFrame, output: str = "score") -> DataFrame:
    """The rows with the probability of a positive response."""
    scored = model.transform(fill_features(rows))
    probability = vector_to_array("probability")[1]
    return scored.withColumn(output, probability)


def score_splits(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Evaluation rows: keys, split, segment, target and score."""
    kept = ["player_id", "assignment_date", "pt", "split"]
    scored = score(model, rows.withColumn("_segment", F.col("vip_level")))
    return scored.select(*kept, F.col("_segment").alias("vip_level"), F.col(TARGET).cast("int").alias("target"), "score")


# --- names and importances -----------------------------------------------------------------


def raw_feature_order(
    numeric: Sequence[str] = tuple(NUMERIC_FEATURES), categorical: Sequence[str] = tuple(CATEGORICAL_FEATURES)
) -> list[str]:
    return [*numeric, *categorical]


def transformed_feature_names(model: PipelineModel, scale: bool) -> list[str]:
    """Name of every slot of the `features` vector, in vector order."""
    names: list[str] = []
    indexers = {o: labels for s in model.stages if s.__class__.__name__ == "StringIndexerModel"
                for o, labels in zip(s.getOutputCols(), s.labelsArray)}
    last = [s for s in model.stages if s.__class__.__name__ == "VectorAssembler"][-1]
    numeric = [s for s in model.stages if s.__class__.__name__ == "VectorAssembler"][0].getInputCols() if scale else None
    for part in last.getInputCols():
        if part == "numeric":
            names += list(numeric)
        elif part.endswith("_levels"):
            source = part.removesuffix("_levels")
            names += [f"{source}_{level}" for level in indexers[f"{source}_index"]]
        else:
            names.append(part)
    return names


def require_feature_contract(model: PipelineModel, scale: bool, declared: Sequence[str], width: int) -> list[str]:
    """Raise unless the fitted pipeline reads the declared columns and its output has one name per slot."""
    assemblers = [s for s in model.stages if s.__class__.__name__ == "VectorAssembler"]
    indexed = [c for s in model.stages if s.__class__.__name__ == "StringIndexerModel" for c in s.getInputCols()]
    read = [c for c in assemblers[0].getInputCols() if not c.endswith("_levels")] + indexed
    if read != list(declared):
        raise ValueError(f"model reads {read}, declared features are {list(declared)}")
    names = transformed_feature_names(model, scale)
    if len(names) != width:
        raise ValueError(f"model has {width} inputs, {len(names)} names")
    return names


def _named(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Replace `index` by the feature name. The lookup has one entry a feature."""
    lookup = F.array(*[F.lit(n) for n in names])
    return df.withColumn("feature", F.element_at(lookup, (F.col("index") + 1).cast("int"))).drop("index")


def lr_importance(model: PipelineModel, features: Sequence[str], spark: SparkSession) -> DataFrame:
    """Coefficient, its size and odds ratio per feature, largest first."""
    rows = [(name, float(c)) for name, c in zip(features, model.stages[-1].coefficients, strict=True)]
    frame = spark.createDataFrame(rows, "feature string, coefficient double")
    return frame.select(
        "feature",
        "coefficient",
        F.abs("coefficient").alias("absolute_coefficient"),
        F.exp("coefficient").alias("odds_ratio"),
    ).orderBy(F.desc("absolute_coefficient"))


def gbt_importance(model: PipelineModel, features: Sequence[str], path: str, spark: SparkSession) -> DataFrame:
    """Total gain and number of splits per feature, from the saved trees; features without a split get zeros."""
    model.stages[-1].write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("nodeData.*").where(F.col("leftChild") >= 0)
    found = nodes.groupBy(F.col("split.featureIndex").alias("index")).agg(
        F.sum("gain").alias("importance_gain"), F.count(F.lit(1)).alias("importance_split")
    )
    everything = spark.range(len(features)).select(F.col("id").cast("int").alias("index"))
    joined = everything.join(found, "index", "left").fillna({"importance_gain": 0.0, "importance_split": 0})
    return _named(joined, features).select("feature", "importance_gain", "importance_split").orderBy(
        F.desc("importance_gain"), "feature"
    )


# --- run records ---------------------------------------------------------------------------


def model_version(iteration_id: str, model_name: str, run_id: str) -> str:
    """Version text holding the whole run id, so that two runs never share one."""
    parts = [p.strip() for p in (iteration_id, model_name, run_id)]
    if not all(parts):
        raise ValueError("a model version needs an iteration, a model name and a run id")
    return "__".join(parts)


def record_run(spark: SparkSession, path: str, record: dict, created_at: datetime) -> None:
    """Save one row about a fitted model to the table of runs."""
    missing = [f for f in REQUIRED_RUN_FIELDS if not str(record.get(f) or "").strip()]
    if missing:
        raise ValueError(f"run record lacks {missing}")
    local = record["run_id"].lower().startswith(LOCAL_RUN_PREFIXES) or record["model_path"].rstrip("/").lower().endswith("_local")
    if record.get("is_champion") and local:
        raise ValueError(f"run {record['run_id']} is local and cannot be champion")
    row = {**dict.fromkeys(MODEL_RUNS.fieldNames()), **record, "created_at": created_at}
    spark.createDataFrame([row], MODEL_RUNS).write.mode("append").parquet(path)


def champion_run(runs: DataFrame) -> DataFrame:
    """The latest run marked as champion. The table has one row a run."""
    return runs.where("is_champion").orderBy(F.desc("created_at"), F.desc("run_id")).limit(1)
