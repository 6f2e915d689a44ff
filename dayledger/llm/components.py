"""Connected components of a link table, by hooking, pointer jumping and contraction in Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, remove_cut


def _flatten(parents: DataFrame) -> DataFrame:
    """`parents` (node, parent) with every parent replaced by its root; paths halve in each round."""
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("root"))
        jumped = cut_lineage(
            parents.join(up, "parent", "left").select(
                "node", F.coalesce("root", "parent").alias("parent"), (F.col("root") != F.col("parent")).alias("moved")
            ),
            "jump",
        )
        moved = not jumped.where("moved").isEmpty()
        remove_cut(parents)
        parents = jumped.select("node", "parent")
        if not moved:
            return parents


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (u, v): component is the smallest node that can be reached.

    Each round hooks every node to its smallest neighbour, follows the hooks to their roots and contracts the links
    to the roots, so that the table shrinks from round to round. No component is gathered anywhere: a node with many
    links only takes part in sums that Spark combines before the shuffle.

    Defined cases: no links give no rows; links of a node with itself and repeated links change nothing; links with a
    NULL end are left out.
    """
    edges = cut_lineage(links.where("u != v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    labels = None
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hooks = both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("u"), F.min("v")).alias("parent"))
        roots = _flatten(cut_lineage(hooks, "hooks"))
        if labels is None:
            labels = roots
        else:
            to = roots.select(F.col("node").alias("parent"), F.col("parent").alias("root"))
            older, labels = labels, cut_lineage(
                labels.join(to, "parent", "left").select("node", F.coalesce("root", "parent").alias("parent")), "labels"
            )
            remove_cut(older)
        root_u = roots.select(F.col("node").alias("u"), F.col("parent").alias("ru"))
        root_v = roots.select(F.col("node").alias("v"), F.col("parent").alias("rv"))
        left = edges.join(root_u, "u").join(root_v, "v").where("ru != rv")
        contracted = cut_lineage(left.select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v")).distinct(), "edges")
        remove_cut(edges)
        edges = contracted
        if edges.isEmpty():
            return labels.select("node", F.col("parent").alias("component"))
