"""Proof of a fit from its training rows: the conditions that hold at the optimum, recomputed without the fitter.

For the linear model the gradient of the penalised loss vanishes in every slot. For boosted trees every row is routed
through the saved trees: each leaf holds the weighted mean of what was left to explain there, has rows enough, and the
loss falls from round to round. Only one row per slot or tree leaves the aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from .models import balanced_weights, fill_features, transformed_feature_names


def logistic_gradient(model: PipelineModel, train: DataFrame, c: float = 1.0) -> DataFrame:
    """Per slot: coefficient, mean weighted residual times input, penalty, and their sum, which an optimum has at 0."""
    weighted, rows = balanced_weights(fill_features(train))
    fitted = model.stages[-1]
    names = transformed_feature_names(model, scale=True)
    scored = model.transform(weighted).select(
        (F.col("class_weight") * (vector_to_array("probability")[1] - F.col("label"))).alias("residual"),
        vector_to_array("features").alias("x"),
        "class_weight",
    )
    sums = [F.sum(F.col("residual") * F.col("x")[j]).alias(f"g{j}") for j in range(len(names))]
    totals = scored.agg(F.sum("class_weight").alias("w"), F.sum("residual").alias("g"), *sums)

    def slot(name: str, coefficient: float, data: str, penalty: float) -> Column:
        mean = F.col(data) / F.col("w")
        return F.struct(
            F.lit(name).alias("feature"), F.lit(coefficient).alias("coefficient"), mean.alias("data_gradient"),
            F.lit(penalty).alias("penalty"), (mean + penalty).alias("gradient"),
        )

    strength = 1.0 / (c * rows)
    slots = [slot("(intercept)", float(fitted.intercept), "g", 0.0)]
    slots += [slot(n, float(b), f"g{j}", strength * float(b)) for j, (n, b) in enumerate(zip(names, fitted.coefficients, strict=True))]
    return totals.select(F.inline(F.array(*slots)))


def linear_scores(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """`rows` with the model's score and `recomputed`: the logistic function of intercept plus coefficients by inputs."""
    fitted = model.stages[-1]
    scored = model.transform(fill_features(rows))
    x = vector_to_array("features")
    margin = F.lit(float(fitted.intercept))
    for j, b in enumerate(fitted.coefficients):
        margin = margin + F.lit(float(b)) * x[j]
    return scored.withColumns({"score": vector_to_array("probability")[1], "recomputed": 1 / (1 + F.exp(-margin))})


def saved_nodes(model: PipelineModel, path: str, spark: SparkSession) -> DataFrame:
    """Nodes of the saved trees: tree, node, children (-1 at a leaf), split and value; rounds x 2^(depth + 1) rows at most."""
    model.stages[-1].write().overwrite().save(path)
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), F.col("nodeData.id").alias("node"), F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"), F.col("nodeData.prediction").alias("value"),
        F.col("nodeData.split.featureIndex").alias("feature"), F.col("nodeData.split.leftCategoriesOrThreshold").alias("bounds"),
        (F.col("nodeData.split.numCategories") > 0).alias("by_category"),
    )


def route(rows: DataFrame, nodes: DataFrame, trees: int, depth: int) -> DataFrame:
    """`rows` (with an array `x`) once a tree, with the leaf they end in and its value; joins with the small node table only."""
    routed = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")).withColumn("node", F.lit(0))
    for _ in range(depth):
        # a bounded table: the node count of the model
        step = routed.join(F.broadcast(nodes.drop("value")), ["tree", "node"])
        at = F.element_at("x", F.col("feature") + 1)
        lower = F.when(F.col("by_category"), F.array_contains("bounds", at)).otherwise(at <= F.col("bounds")[0])
        following = F.when(F.col("left") < 0, F.col("node")).when(lower, F.col("left")).otherwise(F.col("right"))
        routed = step.withColumn("node", following).drop("left", "right", "feature", "bounds", "by_category")
    leaves = nodes.select("tree", "node", "value")
    return routed.join(F.broadcast(leaves), ["tree", "node"])


_SUMS = ["rows", "w", "wr", "loss", "score_error"]
_LEAVES = "tree int, node int, rows bigint, w double, wr double, loss double, score_error double"


def _routing_tables(nodes: list[Row], trees: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, dict]:
    """Per tree and node: children (-1 at a leaf), feature, threshold, value; categories of the nodes that split by them."""
    width = max(n.node for n in nodes) + 1
    left, right, feature = (np.full((trees, width), -1, dtype=np.int64) for _ in range(3))
    threshold, value, categories = np.zeros((trees, width)), np.zeros((trees, width)), {}
    for n in nodes:
        left[n.tree, n.node], right[n.tree, n.node], value[n.tree, n.node] = n.left, n.right, n.value
        if n.left >= 0:
            feature[n.tree, n.node], threshold[n.tree, n.node] = n.feature, np.nan if n.by_category else n.bounds[0]
            if n.by_category:
                categories[n.tree, n.node] = np.array(n.bounds)
    return left, right, feature, threshold, value, categories


def leaf_sums(rows: DataFrame, nodes: list[Row], weights: Sequence[float], depth: int) -> DataFrame:
    """Per tree and leaf: rows, weight, weighted rest to explain, loss after the tree, distance of the scores (last tree).

    `rows` (y, w, x, score) go through all trees where they are; one row a tree and leaf leaves each batch. `nodes` are
    those of the model, so their number is bounded by its size.
    """
    left, right, feature, threshold, value, categories = _routing_tables(nodes, len(weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            y, w, score = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w", "score"))
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            every, so_far, parts = np.arange(n), np.zeros(n), []
            for tree, weight in enumerate(weights):
                node = np.zeros(n, dtype=np.int64)
                for _ in range(depth):
                    lower = x[every, feature[tree, node]] <= threshold[tree, node]
                    for at in (k for t, k in categories if t == tree):
                        here = node == at
                        lower[here] = np.isin(x[here, feature[tree, at]], categories[tree, at])
                    node = np.where(left[tree, node] < 0, node, np.where(lower, left[tree, node], right[tree, node]))
                rest = y if tree == 0 else 4 * y / (1 + np.exp(2 * y * so_far))
                so_far = so_far + weight * value[tree, node]
                loss = w * 2 * np.log1p(np.exp(-2 * y * so_far))
                found = np.bincount(node)
                leaves = np.flatnonzero(found)
                error = np.full(len(leaves), np.nan)
                if tree == len(weights) - 1:
                    apart = np.abs(1 / (1 + np.exp(-2 * so_far)) - score)
                    error = np.array([apart[node == leaf].max() for leaf in leaves])
                sums = [np.bincount(node, c)[leaves] for c in (w, w * rest, loss)]
                parts.append((np.full(len(leaves), tree), leaves, found[leaves], *sums, error))
            tree, node, *rest = (np.concatenate(c) for c in zip(*parts))
            columns = [pa.array(tree.astype(np.int32)), pa.array(node.astype(np.int32)), *map(pa.array, rest[:-1])]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(rest[-1], from_pandas=True)], ["tree", "node", *_SUMS])

    partial = rows.select("y", "w", "score", "x").mapInArrow(run, _LEAVES)
    sums = [(F.max if c == "score_error" else F.sum)(c).alias(c) for c in _SUMS]
    return partial.groupBy("tree", "node").agg(*sums)


def tree_audit(model: PipelineModel, train: DataFrame, path: str, keys: Sequence[str] = ()) -> DataFrame:
    """Per tree: leaves, rows of the smallest leaf, largest distance of a leaf from the mean it should hold, loss after the
    tree, and (last tree) the largest distance of a recomputed score from the model's. Rows need no key of
    their own: none leaves its batch (`keys` stays for callers)."""
    fitted = model.stages[-1]
    weights = [float(w) for w in fitted.treeWeights]
    depth = max(t.depth for t in fitted.trees)
    weighted, _ = balanced_weights(fill_features(train))
    scored = model.transform(weighted).select(
        (2 * F.col("label") - 1).alias("y"), F.col("class_weight").alias("w"), vector_to_array("features").alias("x"),
        vector_to_array("probability")[1].alias("score"),
    )
    nodes = saved_nodes(model, path, train.sparkSession)
    found = nodes.collect()  # the model: rounds x 2^(depth + 1) rows at most
    sums = leaf_sums(scored, found, weights, depth)
    leaves = sums.join(F.broadcast(nodes.select("tree", "node", "value")), ["tree", "node"])
    per_tree = leaves.groupBy("tree").agg(
        F.count(F.lit(1)).alias("leaves"), F.min("rows").alias("smallest_leaf"), F.max(F.abs(F.col("value") - F.col("wr") / F.col("w"))).alias("leaf_error"),
        (F.sum("loss") / F.sum("w")).alias("loss"), F.max("score_error").alias("score_error"),
    )
    # one row a tree
    earlier = Window.orderBy("tree")
    return per_tree.withColumn("loss_before", F.lag("loss").over(earlier)).orderBy("tree")
