"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from propensity.session import materialize


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Connect each node's larger (or smaller, and itself) neighbours to its smallest neighbour."""
    if large:
        around = links.union(links.select("b", "a")).toDF("u", "v")
    else:
        around = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = around.join(least, "u")
    if large:
        out = joined.where("v > u").select("v", "m")
    else:
        out = joined.select("v", "m").union(least.select("u", "m"))
    return out.toDF("a", "b").where("a != b").distinct()


def _settled(links: DataFrame) -> bool:
    """Whether ``links`` are stars: each ``a`` has one ``b``, and no ``b`` is an ``a``."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(links.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up = 1 and down = 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b: longs); root is the smallest node it reaches.

    Rows with a null end or equal ends link nothing. Each step is written to the shared folder,
    so a lost executor costs one step. The number of steps grows with the logarithm of the nodes.
    """
    links = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    while True:
        links = materialize(_stars(_stars(links, True), False), "components")
        if _settled(links):
            return links.toDF("node", "root").union(links.select("b", "b").distinct())
