"""Connected components of a table of links, by rounds of small joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.keys import join_facts
from siltstone.session import settle


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node that can be reached, for every node of links (a, b) of longs.

    Every round joins all nodes of a link to the smallest label next to it and
    then follows labels to their own label, so that chains halve. A label only
    ever becomes smaller and ends when no link joins two labels. Nodes with many
    links are joined by broadcast.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = settle(both.where("a <> b").distinct())
    total = both.count()
    degrees = both.groupBy("a").agg(F.count(F.lit(1)).alias("_n"), F.least(F.col("a"), F.min("b")).alias("label"))
    labels = settle(degrees.select(F.col("a").alias("node"), "label", "_n"))
    while total:
        # The smallest label among neighbours; the neighbour is the side that may be hot.
        offered = (
            join_facts(both.select("a", F.col("b").alias("node")), labels, ["node"], "_n", total)
            .groupBy("a").agg(F.min("label").alias("near"))
        )
        pulled = labels.join(offered.withColumnRenamed("a", "node"), "node").select(
            "node", "_n", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        # The old label is a node too: it follows the smallest label that its own members have found.
        hooks = pulled.groupBy(F.col("old").alias("node")).agg(F.min("label").alias("hook"))
        hooked = pulled.join(hooks, "node", "left").select(
            "node", "_n", "old", F.least("label", F.coalesce("hook", "label")).alias("label"))
        hooked = settle(hooked)
        # Follow the label's own label once.
        ends = hooked.select(F.col("node").alias("label"), F.col("label").alias("end"))
        sizes = hooked.groupBy("label").agg(F.count(F.lit(1)).alias("_members"))
        nodes = hooked.count()
        jumped = settle(join_facts(hooked, ends.join(sizes, "label"), ["label"], "_members", nodes).select(
            "node", "_n", "old", F.least("label", "end").alias("label")))
        moved = jumped.where("label <> old").limit(1).count()
        labels = jumped.select("node", "label", "_n")
        if not moved:
            break
    return labels.select("node", "label")
