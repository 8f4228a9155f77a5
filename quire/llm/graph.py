"""Connected components of a table of links, by Spark jobs only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import materialise


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b), longs, any order, repeats allowed -> (node, root):
    the smallest node reachable, for every node that has a link.

    Each round takes the smallest label among a node's neighbours and then
    follows the label's own label (pointer jumping), so a chain of n links
    needs about log n rounds. Labels are checkpointed each round; only a
    count of changed rows reaches the driver."""
    both = materialise(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                         .select("node", F.least("node", "m").alias("root")))
    while True:
        near = (both.join(labels, F.col("b") == F.col("node"))
                .groupBy("a").agg(F.min("root").alias("m")))
        hooked = (labels.join(near, F.col("node") == F.col("a"))
                  .select("node", F.col("root").alias("old"), F.least("root", "m").alias("root")))
        hooked = materialise(hooked)
        up = hooked.select(F.col("node").alias("up"), F.col("root").alias("top"))
        labels_next = materialise(
            hooked.join(up, F.col("root") == F.col("up"))
            .select("node", "old", F.least("root", "top").alias("root")))
        changed = labels_next.where(F.col("old") != F.col("root")).limit(1).count()
        labels = labels_next.select("node", "root")
        if not changed:
            return labels
