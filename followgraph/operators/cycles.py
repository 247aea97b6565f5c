"""Closed walks of three edges a->b->c->a, listed or counted.

Three policies decide which closed walks count:

``closed``   all of them, also those that visit a node twice over a self-loop
``no_loop``  those whose 2-path a->b->c does not end where it started
``strict``   those over three different nodes

A triangle shows up as three closed walks, one from each of its nodes, so a triangle count is
a third of a walk count, in whole numbers. Repeated edges multiply the walks they are part of.

How a strict walk is found. All edges between two nodes are first merged into one row. Nodes
are ranked by their number of neighbours, ties by id, and each 2-path is only made at the
lowest-ranked node of its triangle. A hub then makes next to no paths: with m rows, no node
has more than sqrt(2m) neighbours ranked above it. Walks over a self-loop need no join at all
when they are counted: their number follows from per-node sums.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from followgraph.functions import whole_thirds
from followgraph.functions.columns import WIDE
from followgraph.operators.degrees import degrees
from followgraph.operators.edges import keep_core, valid
from followgraph.operators.lists import cycles_by_lists
from followgraph.plans.route import Limits, Route, route
from followgraph.plans.skew import (
    all_slots,
    hot_keys,
    long,
    pick_slot,
    repeat_rows,
    slots_for,
    with_slots,
)

WALKS = ("closed", "no_loop", "strict")
METHODS = ("pairs", "lists")


def _check(walks: str) -> None:
    if walks not in WALKS:
        raise ValueError(f"walks must be one of {WALKS}, not {walks!r}")


def _pairs(edges: DataFrame) -> DataFrame:
    """One row per unordered pair ``a <= b``: edges a->b (``ab``), b->a (``ba``), and, where
    both ends are the same node, ``own``.

    Every use below reads all five columns and filters on counts only, so that the plans stay
    alike up to this shuffle and Spark runs it once. For the same reason ``a`` and ``b`` are
    tested for null here, as the joins on them would do.
    """
    a, b = F.col("follower"), F.col("followee")
    return (
        valid(edges)
        .select(a, b, F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
        .filter("a IS NOT NULL AND b IS NOT NULL")
        .groupBy("a", "b")
        .agg(
            F.count_if(a < b).alias("ab"),
            F.count_if(a > b).alias("ba"),
            F.count_if(a == b).alias("own"),
        )
    )


def _neighbours(pairs: DataFrame) -> DataFrame:
    """``node, degree`` (different neighbours), and whether it has edges in and out."""
    ends = pairs.filter("own = 0").select(
        F.expr("stack(2, a, ba > 0, ab > 0, b, ab > 0, ba > 0) AS (node, has_in, has_out)")
    )
    return ends.groupBy("node").agg(
        F.count(F.lit(1)).alias("degree"),
        F.max("has_in").alias("has_in"),
        F.max("has_out").alias("has_out"),
    )


def _ranked(pairs: DataFrame, way: Route) -> DataFrame:
    """Pairs turned to point from the lower- to the higher-ranked node: ``low, high`` with
    their degrees, edges low->high (``up``) and high->low (``down``).

    Nodes that only follow or are only followed cannot be on a cycle; their pairs are dropped.
    """
    nodes = _neighbours(pairs)
    cyclic = nodes.filter("has_in AND has_out").select("node", "degree")
    keys = ["node"]
    if way.split:
        # true of every node; with all columns in use, both uses of ``nodes`` share a shuffle
        hot = hot_keys(nodes.filter("has_in OR has_out"), "node", ["degree"], way.hot_limit)
        cyclic = cyclic.withColumn("slot", all_slots(slots_for("degree", way.hot_limit)))
        keys.append("slot")
    ranked = pairs.filter("own = 0").drop("own")
    for end, other in (("a", "b"), ("b", "a")):
        left = ranked.withColumn("node", F.col(end))
        if way.split:
            left = with_slots(left, end, hot, way.counted).withColumn(
                "slot", pick_slot(F.col("degree_slots"), other)
            )
        ranked = left.join(way.mark(cyclic), keys).select(
            *ranked.columns, F.col("degree").alias(f"{end}_degree")
        )
    a_low = F.col("a_degree") <= F.col("b_degree")  # a < b breaks ties

    def pick(yes: str, no: str):
        return F.when(a_low, F.col(yes)).otherwise(F.col(no))

    return ranked.select(
        pick("a", "b").alias("low"),
        pick("b", "a").alias("high"),
        pick("a_degree", "b_degree").alias("low_degree"),
        pick("b_degree", "a_degree").alias("high_degree"),
        pick("ab", "ba").alias("up"),
        pick("ba", "ab").alias("down"),
    )


def _wedges(ranked: DataFrame, way: Route) -> DataFrame:
    """Pairs of neighbours ``y``, ``z`` above a node ``x``, y ranked below z, that some cycle
    through x may join: ``via_y`` counts z->x->y, ``via_z`` counts y->x->z.

    In a large graph, nodes with many neighbours put them into groups, and there is a cell for
    every two groups and for each group with itself. Neighbours go to all cells of their group,
    those of the same group pair up in its own cell. Both sides of the join are the same rows,
    so they are computed and shuffled once.
    """
    keys = ["low"]
    if way.split:
        most = way.limits
        groups = F.least(long(way.wedge_groups), slots_for("low_degree", most.wedge_rows))
        ranked = (
            ranked.withColumn("group", pick_slot(groups, "high"))
            .withColumn("with", all_slots(groups))
            .withColumn("cell_i", F.least("group", "with"))
            .withColumn("cell_j", F.greatest("group", "with"))
        )
        keys += ["cell_i", "cell_j"]
    p, q = ranked.alias("p"), way.mark(ranked).alias("q")
    meet = [F.col(f"p.{k}") == F.col(f"q.{k}") for k in keys]
    if way.split:
        meet.append(
            F.expr("p.group <> q.group OR (p.group = p.`with` AND q.group = q.`with`)")
        )
    meet.append(
        F.expr(
            "p.high_degree < q.high_degree OR (p.high_degree = q.high_degree AND p.high < q.high)"
        )
    )
    meet.append(F.expr("(p.up > 0 AND q.down > 0) OR (p.down > 0 AND q.up > 0)"))
    return p.join(q, meet).select(
        F.col("p.low").alias("x"),
        F.col("p.high").alias("y"),
        F.col("q.high").alias("z"),
        F.col("p.high_degree").alias("y_degree"),
        (F.col("p.up") * F.col("q.down")).alias("via_y"),
        (F.col("p.down") * F.col("q.up")).alias("via_z"),
    )


def _widen(df: DataFrame, columns: list[str], wide: bool) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(WIDE) for c in columns}) if wide else df


def _strict_count(pairs: DataFrame, way: Route, wide: bool) -> DataFrame:
    """One row ``n``: cycles over three different nodes, each counted once.

    When rows are sent by key, the 2-paths between the same two nodes are added up before the
    shuffle, so two hubs with all their neighbours in common do not make a hot key. The sums
    are keyed like the pairs are, which therefore close the cycles without being moved again.
    """
    ranked = _widen(_ranked(pairs, way), ["up", "down"], wide)
    wedges = _wedges(ranked, way)
    if way.broadcast:
        closing = ranked.select(F.col("low").alias("y"), F.col("high").alias("z"), "up", "down")
        closed = wedges.join(way.mark(closing), ["y", "z"])
        n = F.col("via_y") * F.col("up") + F.col("via_z") * F.col("down")
    else:
        y_first = F.col("y") < F.col("z")
        sums = (
            wedges.select(
                F.least("y", "z").alias("a"),
                F.greatest("y", "z").alias("b"),
                F.when(y_first, F.col("via_y")).otherwise(F.col("via_z")).alias("need_ab"),
                F.when(y_first, F.col("via_z")).otherwise(F.col("via_y")).alias("need_ba"),
            )
            .groupBy("a", "b")
            .agg(F.sum("need_ab").alias("need_ab"), F.sum("need_ba").alias("need_ba"))
        )
        closed = sums.join(way.mark(pairs.filter("own = 0")), ["a", "b"])
        n = F.col("need_ab") * F.col("ab") + F.col("need_ba") * F.col("ba")
    return closed.agg(F.coalesce(F.sum(n), F.lit(0)).alias("n"))


def _loop_sums(pairs: DataFrame, wide: bool) -> DataFrame:
    """One row: ``back``, walks that use one self-loop and go to a neighbour and back, and
    ``own``, walks that use one self-loop three times."""
    pairs = _widen(pairs, ["ab", "ba", "own"], wide)
    zero = F.lit(0).cast(WIDE if wide else "bigint")
    back = F.col("ab") * F.col("ba")

    def row(node: str, back_column, own_column):
        return F.struct(
            F.col(node).alias("node"),
            back_column.alias("back"),
            own_column.alias("own"),
        )

    per_node = (
        pairs.filter("own > 0 OR (ab > 0 AND ba > 0)")
        .select(
            F.inline(
                F.when(F.col("own") > 0, F.array(row("a", zero, F.col("own")))).otherwise(
                    F.array(row("a", back, zero), row("b", back, zero))
                )
            )
        )
        .groupBy("node")
        .agg(F.sum("back").alias("back"), F.sum("own").alias("own"))
    )
    return per_node.agg(
        F.coalesce(F.sum(F.col("own") * F.col("back")), F.lit(0)).alias("back"),
        F.coalesce(F.sum(F.col("own") * F.col("own") * F.col("own")), F.lit(0)).alias("own"),
    )


#: Edges from which on it is worth a look at the degrees how many of them can be on a walk.
MANY_EDGES = 1_000_000


def _on_walks(edges: DataFrame, way: Route) -> DataFrame:
    """The edges without those that cannot be on a walk. Where whole relations may be broadcast, they
    are dropped before anything is shuffled. In a large graph they are if they are half of all or
    more: not only they go, but their ends' degrees, too, which the cells of wedges follow."""
    if way.broadcast:
        return keep_core(edges, way)
    if way.edge_rows <= MANY_EDGES or not way.counted:
        return edges
    on = (F.col("in_degree") > 0) & (F.col("out_degree") > 0)
    # edges that leave, and that enter, a node which has both: no more can be on a walk
    most = degrees(edges).agg(
        F.least(F.sum(F.when(on, F.col("out_degree")).otherwise(0)), F.sum(F.when(on, F.col("in_degree")).otherwise(0)))
    ).first()[0]
    return keep_core(edges, way) if 2 * (most or 0) <= way.edge_rows else edges


def _start(edges: DataFrame, strategy: str, limits: Limits, edge_rows: int | None):
    """The merged pairs and the route."""
    way = route(edges, strategy, limits, edge_rows)
    return _pairs(_on_walks(edges, way)), way


#: Small graphs: the same sums as a single statement, which takes a fraction of the time to
#: analyse. Every use of ``p`` needs all its columns, so that Spark makes its rows once.
_SMALL_TOTALS = """
WITH e AS (SELECT follower AS f, followee AS g FROM {edges} WHERE follower IS NOT NULL AND followee IS NOT NULL),
m AS (
  SELECT node FROM (SELECT stack(2, f, false, true, g, true, false) AS (node, i, o) FROM e)
  GROUP BY node HAVING max(i) AND max(o)
),
p AS (
  SELECT /*+ BROADCAST(m1), BROADCAST(m2) */ least(f, g) AS a, greatest(f, g) AS b,
    count_if(f < g) AS ab, count_if(f > g) AS ba, count_if(f = g) AS own
  FROM e LEFT SEMI JOIN m m1 ON f = m1.node LEFT SEMI JOIN m m2 ON g = m2.node
  GROUP BY least(f, g), greatest(f, g)
),
d AS (
  SELECT node, count(1) AS degree
  FROM (SELECT stack(2, a, ba > 0, ab > 0, b, ab > 0, ba > 0) AS (node, i, o) FROM p WHERE own = 0)
  GROUP BY node HAVING max(i) AND max(o)
),
t AS (
  SELECT /*+ BROADCAST(x), BROADCAST(y) */ a, b, ab, ba, x.degree AS da, y.degree AS db
  FROM p JOIN d x ON a = x.node JOIN d y ON b = y.node WHERE own = 0
),
r AS (
  SELECT if(da <= db, a, b) AS low, if(da <= db, b, a) AS high, if(da <= db, db, da) AS degree,
    if(da <= db, ab, ba) AS up, if(da <= db, ba, ab) AS down
  FROM t
),
s AS (
  SELECT /*+ BROADCAST(v), BROADCAST(c) */
    coalesce(sum(u.up * v.down * c.up + u.down * v.up * c.down), 0) AS cycles
  FROM r u
  JOIN r v ON u.low = v.low AND (u.degree < v.degree OR (u.degree = v.degree AND u.high < v.high))
    AND ((u.up > 0 AND v.down > 0) OR (u.down > 0 AND v.up > 0))
  JOIN r c ON c.low = u.high AND c.high = v.high
),
l AS (
  SELECT node, sum(back) AS back, sum(own) AS own
  FROM (SELECT inline(if(own > 0, array(struct(a AS node, 0L AS back, own AS own)),
      array(struct(a AS node, ab * ba AS back, 0L AS own), struct(b AS node, ab * ba AS back, 0L AS own))))
    FROM p WHERE own > 0 OR (ab > 0 AND ba > 0))
  GROUP BY node
)
SELECT coalesce(sum(cycles), 0L) AS cycles, coalesce(sum(back), 0L) AS back, coalesce(sum(own), 0L) AS own FROM (
  SELECT cycles, 0L AS back, 0L AS own FROM s
"""
_SMALL_LOOPS = "  UNION ALL SELECT 0L, sum(own * back), sum(own * own * own) FROM l\n"


def _count_terms(
    edges: DataFrame, walks: str, strategy: str, limits: Limits, edge_rows: int | None, wide: bool, method: str
):
    """One row of sums (see ``_totals``), on the route that the size of the graph asks for."""
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}, not {method!r}")
    way = route(edges, strategy, limits, edge_rows)
    if way.broadcast and not wide and method == "pairs":
        statement = _SMALL_TOTALS + ("" if walks == "strict" else _SMALL_LOOPS) + ")"
        return edges.sparkSession.sql(statement, edges=edges)
    return _totals(_pairs(_on_walks(edges, way)), way, walks, wide, method)


def _totals(pairs: DataFrame, way: Route, walks: str, wide: bool, method: str) -> DataFrame:
    """One row of sums: ``cycles``, and ``back`` and ``own`` as far as ``walks`` needs them."""
    to_type = WIDE if wide else "bigint"
    zero = F.lit(0).cast(to_type)
    by_lists = method == "lists"
    cycles = cycles_by_lists(_ranked(pairs, way), way, to_type) if by_lists else _strict_count(pairs, way, wide)
    terms = [
        cycles.select(
            F.col("n").cast(to_type).alias("cycles"), zero.alias("back"), zero.alias("own")
        )
    ]
    if walks != "strict":
        terms.append(
            _loop_sums(pairs, wide).select(
                zero.alias("cycles"), F.col("back").cast(to_type), F.col("own").cast(to_type)
            )
        )
    return reduce(DataFrame.unionAll, terms).agg(
        *[F.sum(c).cast(to_type).alias(c) for c in ("cycles", "back", "own")]
    )


def walk_counts(
    edges: DataFrame,
    *,
    strategy: str = "auto",
    limits: Limits = Limits(),
    edge_rows: int | None = None,
    wide: bool = False,
    method: str = "pairs",
) -> DataFrame:
    """One row: ``closed_walks, no_loop_walks, strict_walks``."""
    totals = _count_terms(edges, "closed", strategy, limits, edge_rows, wide, method)
    strict = 3 * F.col("cycles")
    counts = {
        "closed_walks": strict + 3 * F.col("back") + F.col("own"),
        "no_loop_walks": strict + 2 * F.col("back"),
        "strict_walks": strict,
    }
    to_type = WIDE if wide else "bigint"
    return totals.select(*[c.cast(to_type).alias(name) for name, c in counts.items()])


def triangle_count(
    edges: DataFrame,
    walks: str = "no_loop",
    *,
    strategy: str = "auto",
    limits: Limits = Limits(),
    edge_rows: int | None = None,
    wide: bool = False,
    method: str = "pairs",
) -> DataFrame:
    """One row, ``triangle_count``: closed walks of the policy divided by three.

    BIGINT, and an error above 2^63 - 1; ``wide`` gives ``decimal(38,0)``. ``method="pairs"`` joins
    pairs of nodes to 2-paths, ``"lists"`` lets neighbour lists meet: up to half the shuffled
    bytes for more processor time, where few 2-paths that a task makes have both ends in common.
    """
    _check(walks)
    totals = _count_terms(edges, walks, strategy, limits, edge_rows, wide, method)
    cycles, back, own = F.col("cycles"), F.col("back"), F.col("own")
    if walks == "strict":
        count = cycles
    elif walks == "no_loop":
        count = cycles + whole_thirds(2 * back, wide)
    else:
        count = cycles + back + whole_thirds(own, wide)
    return totals.select(count.cast(WIDE if wide else "bigint").alias("triangle_count"))


def _strict_walks(pairs: DataFrame, way: Route) -> DataFrame:
    """``n1, n2, n3, walks``: every strict walk, from each of its three nodes.

    Two hubs may have a hot number of 2-paths between them, and here each is a row of its own.
    The lower degree of the two bounds that number and both sides know it, so it also gives the
    slots of the closing join.
    """
    ranked = _ranked(pairs, way)
    wedges = _wedges(ranked, way)
    closing = ranked.select(
        F.col("low").alias("y"), F.col("high").alias("z"), "low_degree", "up", "down"
    )
    keys = ["y", "z"]
    if way.split:
        most = way.limits.rows
        wedges = wedges.withColumn("slot", pick_slot(slots_for("y_degree", most), "x"))
        closing = closing.withColumn("slot", all_slots(slots_for("low_degree", most)))
        keys.append("slot")

    def walk(n1: str, n2: str, n3: str, count):
        return F.struct(
            F.col(n1).alias("n1"),
            F.col(n2).alias("n2"),
            F.col(n3).alias("n3"),
            count.alias("walks"),
        )

    one_way = F.col("via_y") * F.col("up")
    other_way = F.col("via_z") * F.col("down")
    return (
        wedges.join(way.mark(closing), keys)
        .filter(one_way + other_way > 0)
        .select(
            F.inline(
                F.array(
                    walk("x", "y", "z", one_way),
                    walk("y", "z", "x", one_way),
                    walk("z", "x", "y", one_way),
                    walk("x", "z", "y", other_way),
                    walk("z", "y", "x", other_way),
                    walk("y", "x", "z", other_way),
                )
            )
        )
        .filter("walks > 0")
    )


def _loop_walks(pairs: DataFrame, way: Route, walks: str) -> DataFrame:
    """``n1, n2, n3, walks`` for the walks over a self-loop."""
    # ab and ba are always 0 here; naming them keeps the plan of the pairs the same (see _pairs)
    own = pairs.filter("own > 0 AND ab = 0 AND ba = 0").select(F.col("a").alias("node"), F.col("own").alias("loops"))
    mutual = pairs.filter("own = 0 AND ab > 0 AND ba > 0").select(
        F.expr("stack(2, a, b, b, a) AS (node, other)"), (F.col("ab") * F.col("ba")).alias("back")
    )
    looped, keys = own, ["node"]
    if way.split:
        nodes = _neighbours(pairs).filter("has_in OR has_out")
        hot = hot_keys(nodes, "node", ["degree"], way.hot_limit)
        mutual = with_slots(mutual, "node", hot, way.counted).withColumn(
            "slot", pick_slot(F.col("degree_slots"), "other")
        )
        looped = with_slots(own, "node", hot, way.counted).withColumn("slot", all_slots(F.col("degree_slots")))
        keys.append("slot")
    turns = [("node", "node", "other"), ("other", "node", "node")]
    if walks == "closed":
        turns.append(("node", "other", "node"))
    there_and_back = mutual.join(way.mark(looped), keys).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        *[F.col(c).alias(f"n{i}") for i, c in enumerate(turn, 1)],
                        (F.col("back") * F.col("loops")).alias("walks"),
                    )
                    for turn in turns
                ]
            )
        )
    )
    if walks == "no_loop":
        return there_and_back
    thrice = own.select(
        *[F.col("node").alias(n) for n in ("n1", "n2", "n3")],
        (F.col("loops") * F.col("loops") * F.col("loops")).alias("walks"),
    )
    return there_and_back.unionAll(thrice)


def closed_walks(
    edges: DataFrame,
    walks: str = "no_loop",
    *,
    strategy: str = "auto",
    limits: Limits = Limits(),
    edge_rows: int | None = None,
) -> DataFrame:
    """``n1, n2, n3, walks``: each closed walk n1->n2->n3->n1 once, with its number of copies."""
    _check(walks)
    pairs, way = _start(edges, strategy, limits, edge_rows)
    found = _strict_walks(pairs, way)
    return found if walks == "strict" else found.unionAll(_loop_walks(pairs, way, walks))


def triangles(
    edges: DataFrame,
    walks: str = "no_loop",
    *,
    strategy: str = "auto",
    limits: Limits = Limits(),
    edge_rows: int | None = None,
) -> DataFrame:
    """``n1, n2, n3``: one row per closed walk, so three rows per triangle, times its copies."""
    found = closed_walks(edges, walks, strategy=strategy, limits=limits, edge_rows=edge_rows)
    return repeat_rows(found, "walks", ["n1", "n2", "n3"], limits.repeats)
