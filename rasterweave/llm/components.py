"""Connected components of a links table, by DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterweave.llm.common import removed, saved


def components(links: DataFrame) -> DataFrame:
    """node and label, the least node of its component, for every node of links (a, b).

    Each round, every node takes the least label among itself and its neighbours, then the label of its label, so the number of rounds
    follows the logarithm of a component's diameter. A round is written to the shared folder, which cuts lineage. Groups are
    combined before the shuffle, so a node with very many links costs its task no more than others. Links of a node with itself or with null, and repeated
    ones, change nothing; no links make no rows.
    """
    both = saved(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "links")
    label = saved(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        near = both.join(label, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("m"))
        hooked = label.join(near, F.col("node") == F.col("a"), "left").select("node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        up = label.select(F.col("node").alias("up"), F.col("label").alias("above"))
        following = saved(hooked.join(up, F.col("label") == F.col("up"), "left").select("node", "old", F.least("label", "above").alias("label")), "labels")
        removed(label)
        if following.where("old <> label").isEmpty():
            removed(both)
            return following.select("node", "label")
        label = following
