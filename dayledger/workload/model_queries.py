"""Queries that fit models or write tables. Fits have no SQL; writes are compared through the re-read table."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.stat import Summarizer
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import contracts as V
from ..operators import evaluation as E
from ..operators import models as M
from ..operators import optimality as O
from ..operators import profiling as P
from ..plans import dataset_run, monitoring_run, scoring_run, training_run
from ..session import cut_lineage, fresh_path
from ..sources import fixtures as fx
from ..sources import registry, releases, sinks
from ..sources.schemas import (
    CATEGORICAL_FEATURES,
    MONITORING_ALERTS,
    MONITORING_DAILY,
    MONITORING_PERFORMANCE,
    NUMERIC_FEATURES,
    RESPONSE_DATASET,
    RESPONSE_SCORES,
)
from . import inputs as I
from .dataset_queries import RECONCILE_SQL
from .oracle_views import with_views
from .registry import query, rounded

# the tables hold players without a segment, which would block the publish
MAY_BE_NULL = ["vip_level"]
NON_NULL = [c for c in V.CRITICAL_COLUMNS if c not in MAY_BE_NULL]

# --- writes --------------------------------------------------------------------------------

_PER_PT = """SELECT pt, count(*) AS row_count, sum(response_label_positive_3d)::BIGINT AS positives,
   round(sum(outcome_gross_bet_3d_value) + 1e-9, 6) AS bet FROM v_response GROUP BY pt"""


def _per_pt(table):
    return rounded(
        table.groupBy("pt").agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum("response_label_positive_3d").alias("positives"),
            F.sum("outcome_gross_bet_3d_value").alias("bet"),
        )
    )


@query("write_dataset", _PER_PT)
def write_dataset(spark, sf):
    path = fresh_path(spark, "response_dataset")
    sinks.write_dataset(I.response(spark, sf), path, RESPONSE_DATASET)
    return _per_pt(sinks.read_table(spark, path, RESPONSE_DATASET))


@query(
    "build_dataset",
    "SELECT * FROM (" + with_views(RECONCILE_SQL) + ") whole WHERE pt BETWEEN '20240110' AND '20240112'",
)
def build_dataset(spark, sf):
    """Three days rebuilt into the table and reconciled."""
    first, last = "20240110", "20240112"
    result = dataset_run.build(
        spark,
        fresh_path(spark, "response_dataset"),
        I.eligible_mart(spark, sf, first, last),
        fx.vouchers(spark, sf, first, last),
        fx.sms_sends(spark, sf, first, last),
        I.bets_after(spark, sf, first, last),
        first,
        last,
    )
    return rounded(result)


@query(
    "write_partition",
    """SELECT pt, count(*) AS row_count, count(DISTINCT player_id) AS players FROM v_audience
       WHERE pt IN ('20240125', '20240126') GROUP BY pt""",
)
def write_partition(spark, sf):
    """Two partitions written, one of them twice: the second write replaces it and leaves the other."""
    path = fresh_path(spark, "response_scores")
    for pt in (I.SCORING_PT, I.REFERENCE_PT, I.SCORING_PT):
        sinks.write_partition(I.audience(spark, sf, pt), path, RESPONSE_SCORES, pt)
    table = sinks.read_table(spark, path, RESPONSE_SCORES)
    return table.groupBy("pt").agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("player_id").alias("players"))


@query(
    "write_extract",
    """SELECT coalesce(vip_level, '<null>') AS vip_level, count(*) AS row_count FROM v_response GROUP BY coalesce(vip_level, '<null>')""",
)
def write_extract(spark, sf):
    path = fresh_path(spark, "extract")
    result = P.value_distribution(I.response(spark, sf), "vip_level")
    sinks.write_extract(result, path, "csv")
    return spark.read.schema(result.schema).option("header", True).csv(path).select("vip_level", "row_count")


def _publish(spark, sf):
    return scoring_run.publish(
        spark, I.audience(spark, sf), I.SCORING_PT, fresh_path(spark, "response_scores"), non_null=NON_NULL, **I.LINEAGE
    )


@query(
    "publish_scores",
    "SELECT * REPLACE (round(score_percentile + 1e-9, 6) AS score_percentile) FROM v_scores",
)
def publish_scores(spark, sf):
    written, _ = _publish(spark, sf)
    return rounded(written)


@query(
    "postwrite_gate",
    "SELECT count(*) AS row_count, 0::BIGINT AS violations FROM v_scores",
)
def postwrite_gate(spark, sf):
    written, counts = _publish(spark, sf)
    lineage = {k: v for k, v in I.LINEAGE.items() if k != "scoring_ts"}
    gate = V.postwrite_gate(written, I.SCORING_PT, counts["rows_before"], lineage, non_null=NON_NULL)
    zero = F.lit(0)
    for name in gate.columns:
        zero = zero if name == "row_count" else zero + F.abs(F.col(name))
    return gate.select("row_count", zero.cast("bigint").alias("violations"))


@query(
    "scoring_run_summary",
    """SELECT '20240126' AS scoring_pt, 0.5::DOUBLE AS selected_threshold, 'fixed_logit' AS model_name,
       'fixed__fixed_logit__v1' AS model_version, 'models/fixed_logit' AS model_reference_path,
       count(*) AS scoring_population_size, count(*) FILTER (WHERE predicted_response_score >= 0.5) AS positive_prediction_count,
       count(*) FILTER (WHERE predicted_response_score < 0.5) AS negative_prediction_count,
       round(count(*) FILTER (WHERE predicted_response_score >= 0.5) / count(*) + 1e-9, 6) AS predicted_positive_rate,
       round(1 - count(*) FILTER (WHERE predicted_response_score >= 0.5) / count(*) + 1e-9, 6) AS predicted_negative_rate,
       count(*) AS row_count_before_write, count(*) AS row_count_after_write FROM v_scores""",
)
def scoring_run_summary(spark, sf):
    written, counts = _publish(spark, sf)
    return rounded(scoring_run.run_summary(written, I.SCORING_PT, I.THRESHOLD, counts))


@query(
    "write_monitoring",
    """SELECT 'monitoring_daily' AS table_name, '20240126' AS pt, 1 + count(DISTINCT coalesce(vip_level, '__missing__')) AS row_count FROM v_scores WHERE pt = '20240126'
       UNION ALL SELECT 'monitoring_performance', '20240126', 1
       UNION ALL SELECT 'monitoring_alerts', '20240126', alerts FROM (
           SELECT (abs(n / before - 1) >= 0.1 AND n < before OR n / before - 1 >= 0.15)::BIGINT + (top < 0.01 OR top > 0.7)::BIGINT + (bare > 0.05)::BIGINT
                + (n < 1000)::BIGINT + (positives < 25)::BIGINT + (rate <= 0.01)::BIGINT + (gap >= 0.08)::BIGINT AS alerts
           FROM (SELECT count(*) AS n, avg((response_priority_bucket IN ('very_high', 'high'))::INT) AS top, avg((vip_level IS NULL)::INT) AS bare FROM v_scores WHERE pt = '20240126') s,
                (SELECT count(*) AS before FROM fx_feature_mart WHERE pt = '20240125' AND is_eligible = 1) r,
                (SELECT sum(label) AS positives, avg(label) AS rate, abs(avg(predicted_response_score) - avg(label)) AS gap FROM v_observed) o) c WHERE alerts > 0""",
)
def write_monitoring(spark, sf):
    """Both partitions published, the later one monitored, the three tables read back."""
    folder = fresh_path(spark, "monitoring")
    scores = f"{folder}/response_scores"
    # both days are published and looked at again by the monitor: their mart is made once
    mart = cut_lineage(I.eligible_mart(spark, sf, I.REFERENCE_PT, I.SCORING_PT), "mart")
    for pt in (I.REFERENCE_PT, I.SCORING_PT):
        scoring_run.publish(spark, I.audience(spark, sf, pt, mart), pt, scores, non_null=NON_NULL, **I.LINEAGE)
    paths = monitoring_run.run(
        spark,
        folder,
        I.SCORING_PT,
        scores=sinks.read_table(spark, scores, RESPONSE_SCORES),
        mart=mart,
        bets=I.bets_after(spark, sf, I.SCORING_PT, I.SCORING_PT),
        as_of=I.AS_OF,
        run_ts=I.RUN_TS,
        run_label="monitoring_20240126",
    )
    schemas = {
        "monitoring_daily": MONITORING_DAILY,
        "monitoring_performance": MONITORING_PERFORMANCE,
        "monitoring_alerts": MONITORING_ALERTS,
    }
    counted = [
        sinks.read_table(spark, paths[name], schema).groupBy(F.lit(name).alias("table_name"), "pt").agg(
            F.count(F.lit(1)).alias("row_count")
        )
        for name, schema in schemas.items()
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


# --- feature checks ------------------------------------------------------------------------


def _filled_sql(columns: list[str], extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name{extra.format(c=c)}, count({c}) AS known_rows FROM v_base" for c in columns
    )


def _known_rows(rows, names):
    counts = rows.agg(*[F.count(c).alias(c) for c in names])
    return counts.unpivot([], list(names), "column_name", "known_rows")


@query("numeric_features", _filled_sql(NUMERIC_FEATURES))
def numeric_features(spark, sf):
    """Configured features that are present and numeric, with their known rows."""
    rows = I.base(spark, sf)
    configured = [*NUMERIC_FEATURES, "vip_level", "not_there"]
    return _known_rows(rows, V.numeric_features(rows, configured))


@query(
    "leakage_columns",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS known_rows FROM v_response" for c in V.EXCLUDED_COLUMNS
    ),
)
def leakage_columns(spark, sf):
    """Columns of the dataset that may not be model inputs, with their known rows."""
    rows = I.response(spark, sf)
    return _known_rows(rows, list(dict.fromkeys(c for c, _ in V.leaking_columns(rows.columns))))


@query("schema_contract", "SELECT count(*) AS row_count, count(DISTINCT player_id) AS players FROM v_scores")
def schema_contract(spark, sf):
    """Rows of a partition whose columns are exactly those of the score table, in order."""
    rows = I.scores(spark, sf)
    V.require_columns(rows, RESPONSE_SCORES.fieldNames(), "scores", ordered=True)
    return rows.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("player_id").alias("players"))


_SPOILT = "CAST(player_id AS BIGINT) % 29 = 3", "CAST(player_id AS BIGINT) % 31 = 5"


@query(
    "publish_release",
    f"""SELECT '20240126' AS pt, count(*) FILTER (NOT ({_SPOILT[0]} OR {_SPOILT[1]})) AS kept, count(*) FILTER ({_SPOILT[0]} OR {_SPOILT[1]}) AS rejected,
        count(*) FILTER ({_SPOILT[0]}) AS lost_scores, count(*) FILTER ({_SPOILT[1]}) AS lost_ranks,
        count(*) FILTER (NOT ({_SPOILT[0]} OR {_SPOILT[1]})) AS seen, round(sum(predicted_response_score) FILTER (NOT ({_SPOILT[0]} OR {_SPOILT[1]})) + 1e-9, 6) AS seen_scores,
        true AS refused_left_readers_alone FROM v_scores WHERE pt = '20240126'""",
)
def publish_release(spark, sf):
    """A partition whose scores and ranks come as text, some of them unreadable: good rows are released behind the gate,
    the others kept aside with their values; a later release that the gate refuses changes nothing for readers."""
    table = fresh_path(spark, "released_scores")
    clean = I.scores(spark, sf)
    text = clean.withColumns(
        {
            "predicted_response_score": F.when(F.expr(_SPOILT[0]), "n/a").otherwise(F.col("predicted_response_score").cast("string")),
            "score_rank": F.when(F.expr(_SPOILT[1]), "12x").otherwise(F.col("score_rank").cast("string")),
        }
    )
    ordered = lambda rows: V.require_columns(rows, RESPONSE_SCORES.fieldNames(), "scores", ordered=True)
    done = releases.publish(text, table, RESPONSE_SCORES, I.SCORING_PT, ordered, on_lost="aside")

    def refuse(rows):
        raise ValueError("refused")

    try:
        releases.publish(clean, table, RESPONSE_SCORES, I.SCORING_PT, refuse)
        alone = False
    except ValueError as error:
        alone = str(error) == "refused" and releases.current(spark, table) == {I.SCORING_PT: done.name}
    seen = releases.read_current(spark, table, RESPONSE_SCORES).agg(F.count(F.lit(1)).alias("seen"), F.sum("predicted_response_score").alias("seen_scores"))
    told = {"kept": done.kept, "rejected": done.rejected, "lost_scores": done.lost.get("predicted_response_score", 0), "lost_ranks": done.lost.get("score_rank", 0)}
    facts = {"pt": F.lit(done.pt), **{k: F.lit(v).cast("bigint") for k, v in told.items()}, "refused_left_readers_alone": F.lit(alone)}
    return rounded(seen.withColumns(facts))


# --- fits ----------------------------------------------------------------------------------


def _training_rows(spark, sf):
    kept = ["player_id", "assignment_date", "pt", *NUMERIC_FEATURES, *CATEGORICAL_FEATURES, M.TARGET, "split"]
    return I.labelled_splits(spark, sf).select(*kept)


def _slot_statistics(spark, sf, scale):
    """Mean and variance of every slot of the feature vector over the training rows."""
    train = M.fill_features(_train_only(spark, sf))
    fitted = Pipeline(stages=M.preprocessing(scale)).fit(train)
    stats = fitted.transform(train).select(Summarizer.metrics("mean", "variance").summary(F.col("features")).alias("s"))
    row = stats.select("s.mean", "s.variance").first()  # two vectors of feature width
    names = M.transformed_feature_names(fitted, scale)
    values = [(n, float(m), float(v)) for n, m, v in zip(names, row["mean"], row["variance"], strict=True)]
    return rounded(spark.createDataFrame(values, "feature string, mean double, variance double"))


_TRAIN = "(SELECT * FROM v_splits WHERE split = 'train') t"
_LEVELS = ", ".join(f"('{v}')" for v in ("V1", "V2", "V3", "V4", "V5", "UNKNOWN", "__missing__"))
_LEVEL_SQL = f"""SELECT concat('vip_level_', l.v) AS feature, round(avg((coalesce(vip_level, '__missing__') = l.v)::INT) + 1e-9, 6) AS mean,
   round(var_samp((coalesce(vip_level, '__missing__') = l.v)::INT) + 1e-9, 6) AS variance
   FROM {_TRAIN}, (VALUES {_LEVELS}) AS l(v) GROUP BY l.v HAVING bool_or(coalesce(vip_level, '__missing__') = l.v)"""
_LR_SQL = " UNION ALL ".join(
    [
        f"SELECT '{f}' AS feature, 0.0::DOUBLE AS mean, CASE WHEN var_samp(coalesce({f}, 0)) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS variance FROM {_TRAIN}"
        for f in NUMERIC_FEATURES
    ]
    + [_LEVEL_SQL]
)
_GBT_SQL = " UNION ALL ".join(
    [
        f"SELECT '{f}' AS feature, round(avg(coalesce({f}, 0)) + 1e-9, 6) AS mean, round(var_samp(coalesce({f}, 0)) + 1e-9, 6) AS variance FROM {_TRAIN}"
        for f in NUMERIC_FEATURES
    ]
    + [_LEVEL_SQL]
)


@query("preprocess_lr", _LR_SQL)
def preprocess_lr(spark, sf):
    return _slot_statistics(spark, sf, scale=True)


@query("preprocess_gbt", _GBT_SQL)
def preprocess_gbt(spark, sf):
    return _slot_statistics(spark, sf, scale=False)


def _fit(spark, sf, name):
    return training_run.train(_training_rows(spark, sf), (name,))[0]


@query("train_lr")
def train_lr(spark, sf):
    """Split metrics of the fitted linear model at its chosen threshold."""
    return _fit(spark, sf, "logistic_regression").metrics


@query("train_gbt")
def train_gbt(spark, sf):
    """Split metrics of the fitted trees at their chosen threshold."""
    return _fit(spark, sf, "gradient_boosting").metrics


def _train_only(spark, sf):
    return cut_lineage(_training_rows(spark, sf).where(F.col("split") == "train"))


@query("lr_importance")
def lr_importance(spark, sf):
    model = M.fit_logistic_regression(_train_only(spark, sf))
    return M.lr_importance(model, M.transformed_feature_names(model, scale=True), spark)


@query("gbt_importance")
def gbt_importance(spark, sf):
    model = M.fit_boosted_trees(_train_only(spark, sf))
    names = M.transformed_feature_names(model, scale=False)
    return M.gbt_importance(model, names, fresh_path(spark, "trees"), spark)


_NUMERIC_SLOTS = ", ".join(f"({i}, '{f}')" for i, f in enumerate(NUMERIC_FEATURES))


@query(
    "feature_contract",
    f"""SELECT slot::INT AS slot, feature FROM (VALUES {_NUMERIC_SLOTS}) AS n(slot, feature)
        UNION ALL SELECT ({len(NUMERIC_FEATURES)} + row_number() OVER (ORDER BY level COLLATE C) - 1)::INT, concat('vip_level_', level)
        FROM (SELECT DISTINCT coalesce(vip_level, '__missing__') AS level FROM {_TRAIN}) levels""",
)
def feature_contract(spark, sf):
    """Names of the model inputs in vector order, after checking the fitted pipeline against the declared features."""
    model = M.fit_logistic_regression(_train_only(spark, sf))
    names = M.require_feature_contract(model, True, M.raw_feature_order(), model.stages[-1].numFeatures)
    return spark.createDataFrame(list(enumerate(names)), "slot int, feature string")


# --- proofs of the fits: what holds at an optimum, recomputed from the rows ------------------

_SLOTS = f"""SELECT '(intercept)' AS feature UNION ALL SELECT feature FROM (VALUES {_NUMERIC_SLOTS}) AS n(slot, feature)
   UNION ALL SELECT DISTINCT concat('vip_level_', coalesce(vip_level, '__missing__')) FROM {_TRAIN}"""
#: How far from zero the gradient of the mean loss may be: the fitter stops by the change of the loss.
GRADIENT_TOLERANCE = 5e-5


@query("lr_optimality", f"SELECT feature, true AS optimal, true AS penalty_balances_data FROM ({_SLOTS}) s")
def lr_optimality(spark, sf):
    """Every slot of the fitted linear model: the gradient vanishes, as the data pull as much as the penalty holds."""
    train = _train_only(spark, sf)
    slots = O.logistic_gradient(M.fit_logistic_regression(train), train)
    near = F.abs(F.col("data_gradient") + F.col("penalty")) <= GRADIENT_TOLERANCE
    return slots.select("feature", (F.abs("gradient") <= GRADIENT_TOLERANCE).alias("optimal"), near.alias("penalty_balances_data"))


@query(
    "score_splits_checked",
    """SELECT split, count(*) AS row_count, sum(target)::BIGINT AS positives, count(DISTINCT (player_id, assignment_date)) AS distinct_rows,
       true AS scores_are_probabilities, true AS scores_follow_from_coefficients FROM v_splits GROUP BY split""",
)
def score_splits_checked(spark, sf):
    """Scores of all splits by the fitted linear model, against intercept and coefficients by the inputs of each row."""
    rows = cut_lineage(_training_rows(spark, sf))
    model = M.fit_logistic_regression(rows.where("split = 'train'"))
    scored = O.linear_scores(model, rows)
    return scored.groupBy("split").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(M.TARGET).alias("positives"),
        F.count_distinct("player_id", "assignment_date").alias("distinct_rows"),
        F.min(F.col("score").between(0.0, 1.0)).alias("scores_are_probabilities"),
        (F.max(F.abs(F.col("score") - F.col("recomputed"))) < 1e-9).alias("scores_follow_from_coefficients"),
    )


@query(
    "gbt_audit",
    """SELECT range::INT AS tree, true AS leaves_hold_rows_enough, true AS leaves_hold_means, true AS loss_falls, true AS splits_agree, true AS scores_agree
       FROM range(200)""",
)
def gbt_audit(spark, sf):
    """Every tree of the fitted ensemble, after routing all training rows through the saved nodes."""
    train = _train_only(spark, sf)
    model = M.fit_boosted_trees(train)
    path = fresh_path(spark, "trees")
    names = M.transformed_feature_names(model, scale=False)
    trees = O.tree_audit(model, train, path, ["player_id", "assignment_date"])
    # a split more per leaf but one; all splits of all trees are those the importances count
    counted = M.gbt_importance(model, names, f"{path}-importance", spark).agg(F.sum("importance_split").alias("all_splits"))
    total = F.sum(F.col("leaves") - 1).over(Window.partitionBy())  # one row a tree
    return trees.withColumns({"splits": total, "all_splits": counted.scalar()}).select(
        F.col("tree").cast("int").alias("tree"),
        (F.col("smallest_leaf") >= 50).alias("leaves_hold_rows_enough"),
        (F.col("leaf_error") < 1e-9).alias("leaves_hold_means"),
        (F.col("loss_before").isNull() | (F.col("loss") <= F.col("loss_before"))).alias("loss_falls"),
        (F.col("splits") == F.col("all_splits")).alias("splits_agree"),
        (F.coalesce("score_error", F.lit(0.0)) < 1e-9).alias("scores_agree"),
    )


@query("score_splits")
def score_splits(spark, sf):
    """Every labelled row with the score of the fitted linear model."""
    return _fit(spark, sf, "logistic_regression").scored


@query("model_runs")
def model_runs(spark, sf):
    """Both models fitted, compared, saved and recorded; the champion's row is read back."""
    fitted = training_run.train(_training_rows(spark, sf))
    runs = training_run.record(
        spark,
        fitted,
        fresh_path(spark, "models"),
        run_id="response_20240130T000000Z",
        iteration_id="response_model",
        source_table="response_dataset",
        created_at=I.RUN_TS,
    )
    return M.champion_run(runs)


@query(
    "champion_pointer",
    f"""SELECT 'logistic_regression' AS model_name, 'response_model__logistic_regression__response_20240130T000000Z' AS model_version, 1 AS moves,
        (SELECT string_agg(feature, ',' ORDER BY slot) FROM (VALUES {_NUMERIC_SLOTS}, ({len(NUMERIC_FEATURES)}, 'vip_level')) AS n(slot, feature)) AS raw_feature_order,
        '{M.TARGET}' AS target_column, (SELECT count(*) FROM v_splits WHERE split = 'validation') AS scored_by_saved_model,
        true AS stale_run_refused, true AS saved_model_scores_alike""",
)
def champion_pointer(spark, sf):
    """A fitted model recorded, promoted, loaded through the pointer and used; a run that looked earlier is refused."""
    from pyspark.ml import PipelineModel

    rows = cut_lineage(_training_rows(spark, sf))
    fitted = training_run.train(rows, ("logistic_regression",))
    folder = fresh_path(spark, "models")
    settings = {"run_id": "response_20240130T000000Z", "iteration_id": "response_model", "source_table": "response_dataset", "created_at": I.RUN_TS}
    runs = training_run.record(spark, fitted, folder, **settings)
    version = runs.first().model_version  # one model was recorded
    registry.promote(spark, folder, runs, version, None)
    try:
        registry.promote(spark, folder, runs, version, None)
        refused = False
    except RuntimeError:
        refused = True
    told = registry.champion(spark, folder)
    again = M.score_splits(PipelineModel.load(told["model_path"]), rows.where("split = 'validation'")).withColumnRenamed("score", "loaded")
    both = again.join(fitted[0].scored.select("player_id", "assignment_date", "score"), ["player_id", "assignment_date"])
    return both.agg(
        F.count(F.lit(1)).alias("scored_by_saved_model"), (F.max(F.abs(F.col("loaded") - F.col("score"))) < 1e-12).alias("saved_model_scores_alike")
    ).withColumns(
        {
            **{c: F.lit(told[c]) for c in ("model_name", "model_version", "target_column")},
            "raw_feature_order": F.lit(",".join(told["raw_feature_order"])),
            "moves": F.lit(registry.history(spark, folder).count()).cast("int"),
            "stale_run_refused": F.lit(refused),
        }
    )


@query("score_with_champion")
def score_with_champion(spark, sf):
    """The champion, loaded from its record, scores and publishes the partition."""
    from pyspark.ml import PipelineModel

    run = model_runs(spark, sf).first()
    scored = M.score(PipelineModel.load(run.model_path), I.audience(spark, sf).withColumn("_segment", F.col("vip_level")))
    rows = scored.select(
        "player_id", "snapshot_date", F.col("_segment").alias("vip_level"), F.col("score").alias("predicted_response_score")
    )
    written, _ = scoring_run.publish(
        spark,
        rows,
        I.SCORING_PT,
        fresh_path(spark, "response_scores"),
        non_null=NON_NULL,
        scoring_ts=I.RUN_TS,
        model_name=run.model_name,
        model_version=run.model_version,
        model_reference_path=run.model_path,
        selected_threshold=run.selected_threshold,
    )
    return written


@query("segment_metrics_fitted")
def segment_metrics_fitted(spark, sf):
    """Segment metrics of the fitted linear model."""
    fitted = _fit(spark, sf, "logistic_regression")
    return rounded(E.segment_metrics(fitted.scored, fitted.threshold))
