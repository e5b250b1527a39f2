"""Connected components of a link table, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import saved


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links`` (columns ``u``, ``v``); a component is named by its smallest node.

    Alternating star contraction: each round hangs every node's larger neighbours below its smallest one, then its smaller
    ones. Minima are aggregated per task before the shuffle and written before they are joined back, so that the links of a node
    with very many come to the join by a shuffle of their own, which Spark can split. Each step is a written table, and only a
    count and a checksum reach the driver.
    """
    edges = saved(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    state = _fingerprint(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = saved(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = saved(large.distinct(), "large")
        least = saved(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = saved(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        before, state = state, _fingerprint(edges)
        if state == before:
            break
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
