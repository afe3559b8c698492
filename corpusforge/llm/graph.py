"""Connected components of a link table, by alternating stars.

Each round replaces links so that nodes point at smaller neighbours (large
star), then at the smallest of those (small star); after a few rounds every
component is a star around its smallest node.  Links live in tables under the
shared checkpoint folder; the driver sees one checksum row per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.operators.plan_utils import materialize


def _least(links: DataFrame) -> DataFrame:
    """``u, m``: the smallest v of every u.

    Written, so that the join with it reads both sides by plain shuffles:
    Spark can then split the links of a node that a third of all have, or
    broadcast this side if it is small.
    """
    return materialize(links.groupBy("u").agg(F.min("v").alias("m")), "least")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # v > u: v moves from u to the smallest of u's neighbourhood
    moved = both.filter("v > u").join(_least(both), "u")
    return moved.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    # every link points from the larger to the smaller node
    low = _least(links)
    moved = links.join(low, "u").filter("v <> m")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` (the smallest node reachable) for every linked node.

    Nulls and self-links are ignored; an empty table gives an empty table;
    repeated links count once.
    """
    links = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    links = materialize(links, "links")
    seen = None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state[0] == 0 or state == seen:
            break
        seen = state
        links = materialize(_small_star(materialize(_large_star(links), "links")), "links")
    leaves = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(leaves.select(F.col("component").alias("node"), "component").distinct())
