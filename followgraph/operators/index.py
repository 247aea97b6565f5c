"""Adjacency lists stored as an index, which later queries probe without moving it.

The lists of a graph are written once, as a table bucketed by (node, part): all rows of a bucket are
in one file. A relation that looks up nodes is sent to the buckets, and the index is read where
it lies; so the more often a graph is asked, the more of its shuffles are saved. A folder holds
the lists, the few nodes whose lists have several parts, and one row about the index. It can
be opened by another session.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from followgraph.operators.edges import in_parts, multiplicity, valid
from followgraph.plans.route import Limits, route
from followgraph.plans.skew import all_slots, long, pick_slot

#: Edges that a bucket is to hold, and most buckets that a table may have by Spark's default.
BUCKET_EDGES = 5_000_000
MOST_BUCKETS = 100_000


@dataclass(frozen=True)
class AdjacencyIndex:
    """``lists``: ``node, part, followees, copies`` with two arrays of the same length, in the order of
    followees. ``parted``: ``long_node, parts`` of the ``n_parted`` nodes that have several parts."""

    path: str
    buckets: int
    n_parted: int
    lists: DataFrame
    parted: DataFrame

    def with_part(self, rows: DataFrame, key: str, limits: Limits = Limits()) -> DataFrame:
        """Each row once for every part of the list of ``key``, numbered in ``part``."""
        if not self.n_parted:
            # a row of its own and not a literal, which would drop out of the join's keys, so that they
            # would no longer be those of the buckets
            return rows.withColumn("part", all_slots(long(1)))
        # broadcast only within a bound that was counted when the index was made
        parted = F.broadcast(self.parted) if self.n_parted <= limits.max_share else self.parted
        joined = rows.join(parted, F.col(key) == F.col("long_node"), "left")
        return joined.select(*rows.columns, all_slots(F.coalesce("parts", long(1))).alias("part"))


def save_adjacency(
    edges: DataFrame, path: str, *, buckets: int | None = None, limits: Limits = Limits(), edge_rows: int | None = None
) -> AdjacencyIndex:
    """Writes the adjacency lists of ``edges`` as an index into the folder ``path``, which must not exist.

    Lists are cut like those of ``adjacency``: at ``limits.list_size`` followees. One shuffle brings
    edges to their bucket, and a bucket is written by one task.
    """
    spark = edges.sparkSession
    way = route(edges, "auto", limits, edge_rows)
    if buckets is None:
        shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
        buckets = min(MOST_BUCKETS, max(shuffles, way.edge_rows // BUCKET_EDGES))
    entries = F.array_sort(F.collect_list(F.struct("followee", "multiplicity"))).alias("entries")
    lists = (
        in_parts(edges, way)
        .select(F.col("follower").alias("node"), "part", "followee", "multiplicity")
        .repartition(buckets, "node", "part")
        .groupBy("node", "part")
        .agg(entries)
        .selectExpr("node", "part", "entries.followee AS followees", "entries.multiplicity AS copies")
    )
    name = f"adjacency_{uuid.uuid4().hex}"
    writer = lists.write.format("parquet").bucketBy(buckets, "node", "part").sortBy("node", "part")
    writer.option("path", f"{path}/lists").saveAsTable(name)
    parts = spark.table(name).filter("part > 0").groupBy("node").agg((F.max("part") + 1).alias("parts"))
    parts.withColumnRenamed("node", "long_node").write.parquet(f"{path}/parted")
    about = spark.read.parquet(f"{path}/parted").agg(F.count(F.lit(1)).alias("n_parted"))
    kind = lists.schema["node"].dataType.simpleString()
    about.select(F.lit(buckets).alias("buckets"), F.lit(kind).alias("kind"), "n_parted").write.parquet(f"{path}/about")
    spark.sql(f"DROP TABLE {name}")  # the name only: the files are outside the warehouse
    return open_adjacency(spark, path)


def open_adjacency(spark: SparkSession, path: str) -> AdjacencyIndex:
    """The index in a folder, under a new table name of this session."""
    about = spark.read.parquet(f"{path}/about").first()
    name = f"adjacency_{uuid.uuid4().hex}"
    place = f"{path}/lists".replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} (node {about.kind}, part BIGINT, followees ARRAY<{about.kind}>, copies ARRAY<BIGINT>) USING parquet"
        f" CLUSTERED BY (node, part) SORTED BY (node, part) INTO {about.buckets} BUCKETS LOCATION '{place}'"
    )
    return AdjacencyIndex(path, about.buckets, about.n_parted, spark.table(name), spark.read.parquet(f"{path}/parted"))


def followees_of(nodes: DataFrame, index: AdjacencyIndex, *, limits: Limits = Limits()) -> DataFrame:
    """``node, followee, copies`` for each different ``node`` of a table that is in the index."""
    asked = nodes.select("node").filter("node IS NOT NULL").distinct()
    # sort-merge: a hash join or a broadcast could take the lists as the side that is kept in memory
    found = index.with_part(asked, "node", limits).join(index.lists.hint("merge"), ["node", "part"])
    return found.select("node", F.expr("inline(arrays_zip(followees, copies))")).toDF("node", "followee", "copies")


def paths_by_index(edges: DataFrame, index: AdjacencyIndex, *, loops: bool = True, limits: Limits = Limits()) -> DataFrame:
    """``start_node, mid_node, end_node, copies``: every different 2-path from an edge a->b of ``edges``
    to an edge b->c of the index, with the number of its copies.

    Repeated edges are merged first. The paths of each list, its length times the edges that ask for it,
    are added up without moving the index. A list that makes more of them than
    ``limits.task_paths`` (or two millionths of all, which bounds the number of such lists) is
    sent to slots, over which the edges that ask for it are spread; all others are met in their bucket.
    """
    asking = multiplicity(edges).select(
        F.col("follower").alias("start_node"), F.col("followee").alias("mid_node"), F.col("multiplicity").alias("times")
    )
    lists = index.lists.withColumnRenamed("node", "mid_node")
    keys = ["mid_node", "part"]
    askers = valid(edges).groupBy(F.col("followee").alias("mid_node")).agg(F.count(F.lit(1)).alias("n"))
    sizes = lists.select(*keys, F.size("followees").cast("bigint").alias("length"))
    work = index.with_part(askers, "mid_node", limits).join(sizes.hint("merge"), keys)
    work = work.withColumn("paths", F.col("n").cast("double") * F.col("length"))
    total, most = work.agg(F.coalesce(F.sum("paths"), F.lit(0.0)), F.coalesce(F.max("paths"), F.lit(0.0))).first()
    limit = max(limits.task_paths, 2 * total / limits.max_share)
    rows = index.with_part(asking, "mid_node", limits)
    if most <= limit:
        met = rows.join(lists.hint("merge"), keys)
    else:
        crowded = work.filter(F.col("paths") > limit).select(
            *keys, F.least(F.col("n"), F.ceil(F.col("paths") / limit)).cast("bigint").alias("slots")
        )
        rows = rows.join(F.broadcast(crowded), keys, "left")
        spread = rows.filter("slots IS NOT NULL").withColumn("slot", pick_slot(F.col("slots"), "start_node")).drop("slots")
        sent = lists.join(F.broadcast(crowded), keys).withColumn("slot", all_slots(F.col("slots"))).drop("slots")
        met = (
            rows.filter("slots IS NULL").drop("slots").join(lists.hint("merge"), keys)
            .unionByName(spread.join(sent.hint("merge"), [*keys, "slot"]).drop("slot"))
        )
    paths = met.select(
        "start_node", "mid_node", "times", F.expr("inline(arrays_zip(followees, copies))")
    ).select("start_node", "mid_node", F.col("followees").alias("end_node"), (F.col("times") * F.col("copies")).alias("copies"))
    return paths if loops else paths.filter("start_node <> end_node")
