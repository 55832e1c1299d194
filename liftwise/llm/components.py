"""Connected components of a table of links, all in DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftwise.llm.batches import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of links (a, b): the smallest node it can reach.

    Each round takes the smallest label among neighbours and then jumps to that label's own
    label, so labels travel far in few rounds. Labels are stored each round; a hub's links
    are combined before they are shuffled, and its join is an ordinary skewed one.
    """
    links = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")),
        "labels",
    )
    while True:
        seen = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(
            F.min("label").alias("near")
        )
        closer = stored(
            labels.join(seen, labels["node"] == seen["a"], "left").select(
                "node", "label", F.least("label", "near").alias("near")
            ),
            "labels",
        )
        far = closer.select(F.col("node").alias("at"), F.col("near").alias("far"))
        jumped = stored(
            closer.join(far, closer["near"] == far["at"], "left").select(
                "node", F.least("near", "far").alias("label"),
                (F.col("label") > F.least("near", "far")).alias("moved"),
            ),
            "labels",
        )
        labels = jumped.select("node", "label")
        if jumped.where("moved").isEmpty():
            return labels


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels of components() with further links (a, b): only links between different
    components count, each pair of components once. Nodes without a label are alone."""
    own = [
        labels.select(F.col("node").alias(f"node{k}"), F.col("label").alias(f"label{k}"))
        for k in (1, 2)
    ]
    named = links.join(own[0], links["a"] == F.col("node1"), "left").join(
        own[1], links["b"] == F.col("node2"), "left"
    )
    between = stored(
        named.select(F.coalesce("label1", "a").alias("a"), F.coalesce("label2", "b").alias("b"))
        .where("a <> b").distinct(),
        "between",
    )
    if between.isEmpty():
        return labels
    tops = components(between).select(F.col("node").alias("at"), F.col("label").alias("top"))
    moved = labels.join(tops, labels["label"] == tops["at"], "left").select(
        "node", F.coalesce("top", "label").alias("label")
    )
    alone = tops.join(labels, tops["at"] == labels["node"], "left_anti")
    return stored(moved.union(alone.select("at", "top")), "labels")
