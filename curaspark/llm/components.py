"""Connected components of a table of links, by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curaspark.llm import common


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): each linked node and the smallest node that links reach from it.

    Nodes are of any type that has an order. Every round takes the smallest label among the neighbours and then
    the label's own label, so chains shorten by half; rounds end when no label changes. Each round is a table in
    the shared folder, so neither lineage nor plans grow. Self links and repeated links change nothing; no
    links, no rows.
    """
    one = links.select(F.col(a).alias("src"), F.col(b).alias("dst")).filter("src <> dst")
    edges = common.stored(one.union(one.select("dst", "src")).distinct())
    labels = common.stored(edges.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("low")).select("node", F.least("node", "low").alias("label")))
    while True:
        near = edges.join(labels.select(F.col("node").alias("dst"), "label"), "dst").groupBy(F.col("src").alias("node")).agg(F.min("label").alias("low"))
        lower = common.stored(labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "low").alias("label")))
        tops = lower.select(F.col("node").alias("label"), F.col("label").alias("top"))
        step = common.stored(lower.join(tops, "label").select("node", "was", F.least("label", "top").alias("label")))
        if not step.filter("label <> was").limit(1).count():
            return step.select("node", F.col("label").alias("component"))
        labels = step.select("node", "label")
