"""Connected components of a table of links, by alternating stars.

In the large step every node sends its larger neighbours to its smallest one, in the small
step its smaller neighbours and itself; both are a minimum per node, summed up before the
shuffle, and an equi-join back, so a node with very many links is no single task's work. After
a few rounds each component is a star around its smallest node. Every round is written to the
shared folder, which keeps plans short and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from followgraph.llm.common import discard, stored


def _with_least(edges: DataFrame) -> DataFrame:
    """(u, v, m): m is the least of u and its neighbours."""
    least = edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    # dealt anew, so that the join shuffles both sides and a hub's rows can be split in it
    return edges.join(least.repartition(F.xxhash64("u")), "u")


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    known = _with_least(down)
    own = known.select("u", F.col("m").alias("v"))
    return known.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own)


def _mark(edges: DataFrame):
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).collect()[0]
    return row["n"], row["x"]


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that is in a link between two different nodes;
    `links` has the columns a and b, both long. A component is named by its least node."""
    now = stored(links.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(), "links")
    mark = _mark(now)
    while mark[0]:
        after = stored(_small(_large(now)).where("u <> v").distinct(), "links")
        new = _mark(after)
        discard(now)
        now = after
        if new == mark:
            break
        mark = new
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
