"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored, tidy


#: Parts into which a hub's edges fall while its least neighbour is found and told to them.
PARTS = 64


def _with_least(edges: DataFrame) -> DataFrame:
    """u, v, least: the least of u and its neighbours. It is found by parts of a hub's edges, then of the parts, and told to the parts, so no task gets all edges of a hub."""
    own = edges.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(PARTS)))
    parts = own.groupBy("u", "part").agg(F.min("v").alias("least"))
    least = parts.groupBy("u").agg(F.min("least").alias("least")).select("u", F.least("u", "least").alias("least"))
    return own.join(parts.select("u", "part").join(least.hint("merge"), "u").hint("merge"), ["u", "part"]).select("u", "v", "least")


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("least").alias("v")).filter("u <> v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    x = _with_least(down)
    return x.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(x.select("u", F.col("least").alias("v"))).filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """node and component (the least node reachable) for each node of the links (columns u, v: long); nodes without links aren't there.

    Nothing but two sums per step reaches the driver; each step's table is stored. A star of any
    size settles in one step, a chain of n nodes in about log n.
    """
    edges = stored(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    while True:
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_000_007).alias("s")).first()
        if tuple(now) == mark or not now["n"]:
            break
        mark = tuple(now)
        now_edges = stored(_small(_large(edges)))
        discard(edges)
        edges = now_edges
        tidy(edges.sparkSession)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
