"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.scale import materialise


def _lowest(edges: DataFrame, by: str, other: str) -> DataFrame:
    """Smallest neighbour of each node, itself included; pre-aggregated before the shuffle."""
    return edges.groupBy(F.col(by).alias("hub")).agg(F.min(other).alias("low")).select(
        "hub", F.least("hub", "low").alias("low")
    )


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of the links (src, dst); ``root`` is the component's smallest node.

    In a round each node hands its larger neighbours, then its smaller ones, to the smallest
    node it knows, until nothing changes: about log2 of the longest path's rounds. Hub
    nodes are met by joins that Spark can split, never gathered. Each round is written to
    the shared folder. Links may repeat, point either way or to their own node.
    """
    a, b = F.greatest("src", "dst"), F.least("src", "dst")
    edges = materialise(links.where("src <> dst").select(a.alias("u"), b.alias("v")).distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_lowest(both, "u", "v"), F.col("u") == F.col("hub"))
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("low").alias("v"))
            .distinct()
        )
        low = _lowest(large, "u", "v")
        small = (
            large.join(low, F.col("u") == F.col("hub"))
            .select(F.col("v").alias("u"), F.col("low").alias("v"))
            .unionByName(low.select(F.col("hub").alias("u"), F.col("low").alias("v")))
            .where("u <> v")
            .distinct()
        )
        edges = materialise(small, "edges")
        mark, before = _mark(edges), mark
        if mark == before:
            break
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long")), F.bit_xor(F.xxhash64("u", "v"))).first())
