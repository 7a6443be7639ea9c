"""Connected components of a link table, by alternating large and small stars.

Every round hangs each node's larger neighbours, then its smaller ones, on the smallest node
it knows. Both are joins of a link table with its minima by node, which combine before
their shuffle; the rounds needed grow with the logarithm of the nodes. Each round's links
are written, so the plan stays short and outlives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node in ``links`` (a, b) but the components' smallest nodes themselves."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    before = None
    while True:
        edges = written(edges, "links")
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = rest.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
