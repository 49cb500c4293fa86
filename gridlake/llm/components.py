"""Connected components of an edge table by smallest labels, with written tables between rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every end of ``edges`` (``a, b``); the label is the smallest node of the component.

    A round passes each node the smallest label around it, then replaces labels by their own labels, so that the rounds
    grow with the logarithm of a path. Messages are reduced to one per node before they are shuffled.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(both.filter("a <> b").distinct(), "edges")
    labels = written(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("label")),
        "labels",
    )
    while True:
        sent = both.join(labels, both["a"] == labels["node"]).groupBy(F.col("b").alias("to")).agg(F.min("label").alias("got"))
        passed = labels.join(sent, labels["node"] == sent["to"]).select(
            "node", F.col("label").alias("old"), F.least("label", "got").alias("label")
        )
        passed = written(passed, "labels")
        roots = passed.select(F.col("node").alias("root"), F.col("label").alias("jump"))
        jumped = passed.join(roots, passed["label"] == roots["root"]).select(
            "node", F.least("label", "jump").alias("label"), "old"
        )
        jumped = written(jumped, "labels")
        labels = jumped.select("node", "label")
        if jumped.filter("label <> old").isEmpty():
            return labels
