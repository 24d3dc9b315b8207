"""Connected components of a table of links, by labels that jump to their label's label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationfield.llm.common import hot_join, stored


def components(links: DataFrame) -> DataFrame:
    """(a, b) to (node, label): the smallest node that each linked node reaches.

    Each round takes the smallest label among the neighbours (added up before the shuffle) and
    then the label of the label, and is written to the shared folder; a chain of n nodes takes
    about log n rounds. A node that very many are linked with, and a label that very many nodes have,
    are no hot keys: their rows are joined where they lie.
    """
    both = stored(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(),
        "links",
    )
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label"), F.count("*").alias("degree")), "labels"
    )
    n_links, n_nodes = both.count(), labels.count()
    while True:
        told = labels.select(F.col("node").alias("b"), "label", "degree")
        heard = hot_join(both, told, "b", "degree", n_links).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("heard"))
        near = labels.join(heard, "node", "left").select(
            "node", "degree", F.col("label").alias("old"), F.least("label", F.coalesce("heard", "label")).alias("label")
        )
        near = stored(near, "labels-near")
        used = near.groupBy("label").agg(F.count("*").alias("nodes"))
        jump = stored(used.join(near.select(F.col("node").alias("label"), F.col("label").alias("next")), "label"), "labels-jump")
        after = hot_join(near, jump, "label", "nodes", n_nodes).select(
            "node", "degree", "old", F.least("label", F.coalesce("next", "label")).alias("label")
        )
        after = stored(after, "labels")
        labels = after.select("node", "degree", "label")
        if after.where("old <> label").isEmpty():
            return labels.select("node", "label")
