"""Connected components by contraction: hook every node to its smallest neighbour, flatten, contract, repeat.

Only tables move; no group of links meets in one task unsummed, and nothing comes to the driver but counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.llm.common import saved


def _flattened(parent: DataFrame) -> DataFrame:
    """Pointer jumping on (node, parent) until every parent is a root."""
    while True:
        up = parent.select(F.col("node").alias("up"), F.col("parent").alias("grand"))
        jumped = saved(
            parent.join(up, parent["parent"] == up["up"], "left").select(
                "node", F.coalesce("grand", "parent").alias("parent"), (F.col("grand") != F.col("parent")).alias("moved")
            ),
            "jump",
        )
        parent = jumped.select("node", "parent")
        if jumped.where("moved").isEmpty():
            return parent


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected ``links`` (a, b); root is the smallest node of the component.

    Self links, repeated links and links with a null end count as none. A round at least halves the nodes that still
    have links, so the number of rounds is logarithmic in the largest component.
    """
    links = saved(
        links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links"
    )
    label = None
    while not links.isEmpty():
        ends = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a"))
        hooked = ends.groupBy("node").agg(F.least("node", F.min("other")).alias("parent"))
        root = _flattened(saved(hooked, "hooks"))
        if label is None:
            label = root.withColumnRenamed("parent", "root")
        else:
            label = saved(
                label.join(root, label["root"] == root["node"], "left").select(
                    label["node"], F.coalesce(root["parent"], label["root"]).alias("root")
                ),
                "labels",
            )
        left = root.select(F.col("node").alias("a"), F.col("parent").alias("ra"))
        right = root.select(F.col("node").alias("b"), F.col("parent").alias("rb"))
        links = saved(
            links.join(left, "a").join(right, "b").where("ra != rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(),
            "links",
        )
    if label is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return label
