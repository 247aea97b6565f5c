"""Operators from edge tables to edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from followgraph.functions import below, both_ends
from followgraph.operators.degrees import degrees
from followgraph.plans.route import Limits, Route, route
from followgraph.plans.skew import (
    all_slots,
    hot_keys,
    in_blocks,
    long,
    pick_slot,
    slots_for,
    with_slots,
)


def valid(edges: DataFrame) -> DataFrame:
    """Edges that have both ends."""
    return edges.filter(both_ends())


def under_max(edges: DataFrame, max_id: int | None) -> DataFrame:
    """Edges with both ends strictly below ``max_id``; ``None`` keeps all."""
    return edges if max_id is None else edges.filter(below(max_id))


def reverse(edges: DataFrame) -> DataFrame:
    """Every edge turned round: who was followed follows."""
    return edges.select(F.col("followee").alias("follower"), F.col("follower").alias("followee"))


def multiplicity(edges: DataFrame) -> DataFrame:
    """Distinct edges with the number of times each occurs.

    The key is the whole edge and counts are combined before the shuffle, so neither a hub nor
    an edge repeated without end makes a large partition.
    """
    return valid(edges).groupBy("follower", "followee").agg(F.count(F.lit(1)).alias("multiplicity"))


def copies_in_blocks(distinct: DataFrame, most: int) -> DataFrame:
    """``multiplicity`` rows cut so that no row stands for more than ``most`` edges.

    Adds ``block`` and ``copies``. A hash that includes ``block`` can then spread even the
    copies of one single edge.
    """
    size = long(most)
    last = F.call_function("div", F.col("multiplicity") - 1, size)
    return in_blocks(distinct, last).select(
        "follower",
        "followee",
        "block",
        F.least(size, F.col("multiplicity") - F.col("block") * size).alias("copies"),
    )


def keep_core(edges: DataFrame, way: Route) -> DataFrame:
    """``core`` on a given route."""
    in_core = "in_degree > 0 AND out_degree > 0"
    ends = [("follower", "followee", "out_degree"), ("followee", "follower", "in_degree")]
    if not way.split:
        members = degrees(edges).filter(in_core)
        kept = edges
        for end, _, _ in ends:
            there = members.select(F.col("node").alias(end))
            kept = kept.join(way.mark(there), [end], "left_semi")
        return kept.select("follower", "followee")
    distinct = multiplicity(edges)
    sizes = degrees(distinct, weight="multiplicity")
    hot = hot_keys(sizes, "node", ["in_degree", "out_degree"], way.hot_limit)
    members = sizes.filter(in_core)
    kept = copies_in_blocks(distinct, way.limits.copies)
    for end, other, size in ends:
        side = with_slots(kept, end, hot, way.counted).withColumn(
            "slot", pick_slot(F.col(f"{size}_slots"), other, "block")
        )
        there = members.select(
            F.col("node").alias(end), all_slots(slots_for(size, way.hot_limit)).alias("slot")
        )
        kept = side.join(way.mark(there), [end, "slot"], "left_semi").select(kept.columns)
    return kept.select(
        "follower", "followee", F.explode(F.sequence(long(1), F.col("copies"))).alias("copy")
    ).drop("copy")


def core(
    edges: DataFrame,
    *,
    strategy: str = "auto",
    limits: Limits = Limits(),
    edge_rows: int | None = None,
) -> DataFrame:
    """Edges whose ends both follow somebody and are followed by somebody.

    No other edge can be part of a closed walk.
    """
    return keep_core(edges, route(edges, strategy, limits, edge_rows))


def in_parts(edges: DataFrame, way: Route) -> DataFrame:
    """``multiplicity`` with the ``part`` of the follower's list that an edge belongs to: 0 unless the
    follower has more than ``limits.list_size`` distinct followees."""
    limits = way.limits
    distinct = multiplicity(edges)
    if way.edge_rows <= limits.list_size:
        return distinct.withColumn("part", long(0))
    # count_if and not count, which would leave the multiplicities out of this use of the
    # distinct edges and so cost a second shuffle of them
    n = F.count_if(F.col("multiplicity") > 0).alias("n")
    sizes = distinct.groupBy("follower").agg(n)
    parts = F.ceil(F.col("n") / limits.list_size).alias("parts")
    long_lists = sizes.filter(F.col("n") > limits.list_size)
    if way.split:
        long_lists = long_lists.select(
            "follower", parts, all_slots(slots_for("n", way.hot_limit)).alias("slot")
        )
        parted = (
            with_slots(distinct, "follower", hot_keys(sizes, "follower", ["n"], way.hot_limit), way.counted)
            .withColumn("slot", pick_slot(F.col("n_slots"), "followee"))
            .join(way.mark(long_lists), ["follower", "slot"], "left")
        )
    else:
        long_lists = long_lists.select("follower", parts)
        parted = distinct.join(way.mark(long_lists), "follower", "left")
    return parted.withColumn("part", pick_slot(F.coalesce(F.col("parts"), long(1)), "followee"))


def adjacency(
    edges: DataFrame, *, limits: Limits = Limits(), edge_rows: int | None = None
) -> DataFrame:
    """Adjacency lists: ``follower, part, followees: array<struct<followee, multiplicity>>``.

    A follower with more than ``limits.list_size`` distinct followees gets several rows, told
    apart by ``part``, so no list grows with the data. Repeated edges are kept as a number.
    """
    way = route(edges, "auto", limits, edge_rows)
    return in_parts(edges, way).groupBy("follower", "part").agg(
        F.collect_list(F.struct("followee", "multiplicity")).alias("followees")
    )
