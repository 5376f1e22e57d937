"""Connected components of a link table by minimum labels and pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.storage import stored


def connected(links: DataFrame) -> DataFrame:
    """(node, label) for every node of `links(a, b)`, both long; label is the smallest node reachable.

    Each round takes the smallest label among a node and its neighbours, then jumps to the label's
    own label, so that a path of length n needs about log n rounds. Rounds are written to the shared
    folder. Nodes with many links are met by joins, which Spark splits, and by sums with partial
    aggregates; no group is gathered. Null ends are left out; no links give no rows.
    """
    both = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    both = stored(both.select("a", "b").union(both.select("b", "a")).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        hooked = labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        own = labels.select(F.col("node").alias("label"), F.col("label").alias("jump"))
        step = stored(hooked.join(own, "label").select("node", "was", F.least("label", "jump").alias("label")), "labels")
        labels = step.select("node", "label")
        if step.where("was <> label").isEmpty():
            return labels
