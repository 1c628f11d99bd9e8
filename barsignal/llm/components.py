"""Connected components of links, by labels that spread and jump."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsignal.llm.common import shared


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every end of the links (a, b); component is its smallest node.

    Each round takes the smallest label among a node's neighbours, then the
    label's own label, so chains shorten by halves. Labels and links stay in
    written tables: joins on a hub's many links read two plain scans, which
    adaptive execution may split. Null ends link nothing.
    """
    pairs = links.select("a", "b").where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    edges = shared(pairs.union(pairs.select("b", "a")).distinct().toDF("src", "dst"), "edges")
    labels = shared(
        edges.groupBy("src").agg(F.min("dst").alias("m")).select(F.col("src").alias("node"), F.least("src", "m").alias("label")), "labels"
    )
    while True:
        near = edges.join(labels.select(F.col("node").alias("src"), "label"), "src").groupBy("dst").agg(F.min("label").alias("m"))
        spread = shared(
            labels.join(near, labels["node"] == near["dst"], "left")
            .select("node", F.col("label").alias("was"), F.least("label", "m").alias("label")), "spread",
        )
        above = spread.select(F.col("node").alias("label"), F.col("label").alias("root"))
        labels = shared(spread.join(above, "label").select("node", "was", F.col("root").alias("label")), "labels")
        if labels.where("label <> was").isEmpty():
            return labels.select("node", F.col("label").alias("component"))
        labels = labels.select("node", "label")
