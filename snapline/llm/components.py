"""Connected components of a graph given as a table of links, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapline.llm.common import stored


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, label): the smallest node that each linked node reaches. ``links``: stored rows (a, b).

    Labels start as the node itself. A round gives every node the least label among itself and its neighbours, then replaces
    each label by the label of that label, so that chains halve. Minima are taken before the shuffle, so a hub costs no more
    than its links; every round is stored.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.distinct(), f"{name}-links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), f"{name}-0")
    rounds = 0
    while True:
        rounds += 1
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        least = labels.join(near, F.col("node") == F.col("a")).select("node", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        least = stored(least, f"{name}-{rounds}a")
        jump = least.select(F.col("node").alias("_node"), F.col("label").alias("_label"))
        new = least.join(jump, F.col("label") == F.col("_node"), "left").select("node", F.coalesce("_label", "label").alias("label"), "old")
        new = stored(new, f"{name}-{rounds}b")
        if new.filter("label <> old").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")
