"""Connected components of large link tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hypercell.llm.common import durable


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node reachable, of every node in ``links`` (columns ``a`` and ``b``; null ends and
    loops are left out, repeated links count once). No links give no rows.

    Each round points every node to its smallest neighbour and follows the pointers to their ends by doubling, then contracts
    the links, of which those between different ends go on. Nothing is gathered in the driver, and a node's neighbours are
    only ever reduced to a minimum.
    """
    edges = durable(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    label = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = durable(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("u"), F.least("a", "low").alias("p")))
        while True:
            up = point.select(F.col("u").alias("p"), F.col("p").alias("pp"))
            jumped = durable(point.join(up, "p").select("u", "p", "pp"))
            point = jumped.select("u", F.col("pp").alias("p"))
            if jumped.where("p <> pp").isEmpty():
                break
        if label is None:
            label = point.select(F.col("u").alias("node"), F.col("p").alias("label"))
        else:
            later = point.withColumnRenamed("u", "label")
            label = label.join(later, "label", "left").select("node", F.coalesce("p", "label").alias("label"))
        left, right = point.select(F.col("u").alias("a"), F.col("p").alias("pa")), point.select(F.col("u").alias("b"), F.col("p").alias("pb"))
        moved = edges.join(left, "a").join(right, "b").where("pa <> pb")
        edges = durable(moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct())
    if label is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return durable(label)
