"""Cycles by meeting neighbour lists.

Pairs of nodes point from the lower- to the higher-ranked end (see ``cycles``). Every node has one
row with all neighbours above it, in the order of their ids. A cycle x, y, z (ranked in this
order) is found where the list of x, sent along the pair x, y, meets the list of y: both hold z.
So a shuffle moves two numbers for a 2-path, inside one row for each pair, where the join of
pairs moves a row for each. The lists are made by the one shuffle by lower end, and stay there for
the others to meet them.

No list grows without bound. In a large graph the neighbours of a node fall into groups of
``Limits.wedge_rows``; x has a row for every two groups, y one for each group, and a list on its
way to y is cut by the groups of y. A node y to which very many lists are sent has slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from followgraph.plans.route import Route
from followgraph.plans.skew import all_slots, long, pick_slot, slots_for


def _groups(degree: str, way: Route) -> Column:
    """Groups of the neighbours above a node, known from its degree at both ends of a pair."""
    return F.least(long(way.wedge_groups), slots_for(degree, way.limits.wedge_rows))


def _lists(rows: DataFrame, keys: list[str], *also: str) -> DataFrame:
    """The neighbours above each key as one array in the order of ids."""
    entry = F.struct(F.col("high").alias("node"), F.col("high_degree").alias("degree"), "up", "down", *also)
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("above"))


def _sent(lists: DataFrame, pairs_up: str) -> DataFrame:
    """The lists on their way, ``kept`` being the nodes z of a list that rank above y.

    A walk x->y->z->x needs edges x->y and z->x, a walk x->z->y->x edges x->z and y->x; ``forth``
    says which edge between y and z closes it, ``times`` is the number of edges between x and y.
    ``pairs_up`` tells whether two entries ``to`` and ``z`` meet in this row.
    """

    def row(forth: bool, first: str, last: str) -> Column:
        higher = "(z.degree > to.degree OR (z.degree = to.degree AND z.node > to.node))"
        kept = F.expr(
            f"IF(to.{first} > 0, transform(filter(above, z -> {higher} AND z.{last} > 0 AND {pairs_up}),"
            f" z -> struct(z.node AS node, z.{last} AS n)), NULL)"
        )
        return F.struct(F.lit(forth).alias("forth"), F.col(f"to.{first}").alias("times"), kept.alias("kept"))

    return (
        lists.withColumn("to", F.explode("above"))
        .select(
            *[c for c in lists.columns if c != "above"],
            F.col("to.node").alias("y"),
            F.col("to.degree").alias("y_degree"),
            F.inline(F.array(row(True, "up", "down"), row(False, "down", "up"))),
        )
        .filter("size(kept) > 0")
    )


def _packed(sent: DataFrame, *keys: str) -> DataFrame:
    """Lists as two arrays of numbers, which take a third of the room of an array of structs."""
    return sent.select(
        *keys, "forth", "times", F.expr("kept.node").alias("zs"), F.expr("kept.n").alias("ways")
    )


def _met(kind: str) -> Column:
    """The sum over the nodes in both lists of the ways that reach them times the edges that close
    these. Both lists are in the order of ids: they are merged, and equal neighbours multiplied."""
    merged = (
        "array_sort(concat("
        f"transform(zs, (z, i) -> struct(z AS node, CAST(ways[i] AS {kind}) AS n)),"
        f" transform(above, z -> struct(z.node AS node, CAST(IF(forth, z.up, z.down) AS {kind}) AS n))))"
    )
    zero = f"CAST(0 AS {kind})"
    start = f"struct(CAST(NULL AS BIGINT) AS node, {zero} AS n, {zero} AS total)"
    total = f"CAST(s.total + IF(s.node <=> e.node, s.n * e.n, {zero}) AS {kind})"
    return F.expr(f"aggregate({merged}, {start}, (s, e) -> struct(e.node AS node, e.n AS n, {total} AS total), s -> s.total)")


def cycles_by_lists(ranked: DataFrame, way: Route, kind: str) -> DataFrame:
    """One row ``n``: cycles over three different nodes, each counted once, as a ``kind``."""
    if not way.split:
        keys = ["y"]
        lists = _lists(ranked, ["low"])
        sent = _packed(_sent(lists, "true"), *keys)
        there = lists.select(F.col("low").alias("y"), "above")
    else:
        keys = ["y", "group", "slot"]
        most = way.limits.rows
        grouped = ranked.withColumn("group", pick_slot(_groups("low_degree", way), "high"))
        cells = grouped.withColumn("with", all_slots(_groups("low_degree", way))).select(
            "*", F.least("group", "with").alias("cell_i"), F.greatest("group", "with").alias("cell_j")
        )
        cell = ["low", "cell_i", "cell_j"]
        # the groups of y, of which only those on the list get a part of it
        cut = _sent(_lists(cells, cell, "group"), "(cell_i = cell_j OR z.group <> to.group)").withColumn("groups", _groups("y_degree", way))
        of_y = "pmod(xxhash64(z.node), groups)"
        cut = cut.withColumn("group", F.explode(F.expr(f"array_distinct(transform(kept, z -> {of_y}))")))
        cut = cut.withColumn("kept", F.expr(f"filter(kept, z -> {of_y} = group)"))
        sent = _packed(cut.withColumn("slot", pick_slot(slots_for("y_degree", most), *cell)), *keys)
        there = _lists(grouped, ["low", "low_degree", "group"]).select(
            F.col("low").alias("y"), "group", all_slots(slots_for("low_degree", most)).alias("slot"), "above"
        )
    n = F.col("times").cast(kind) * _met(kind)
    return sent.join(way.mark(there), keys).agg(F.coalesce(F.sum(n), F.lit(0)).alias("n"))
