"""Listing and counting 2-paths, within one edge relation or from one into another."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from followgraph.functions.columns import WIDE
from followgraph.operators.degrees import degrees
from followgraph.operators.edges import copies_in_blocks, multiplicity, valid
from followgraph.plans.route import Limits, Route, route
from followgraph.plans.skew import all_slots, hot_keys, in_blocks, long, pick_slot, slots_for, with_slots


def _with_grid(rows: DataFrame, other: str, size: str, grid: DataFrame, hot: DataFrame, way: Route) -> DataFrame:
    """Rows keyed by ``mid_node`` with the grid of that node: ``in_slots`` times ``out_slots``
    cells. A node with very many rows is itself met in slots, as elsewhere."""
    keys = ["mid_node"]
    columns = rows.columns
    if way.split:
        rows = with_slots(rows, "mid_node", hot, way.counted).withColumn(
            "slot", pick_slot(F.col(f"{size}_slots"), other, "block")
        )
        grid = grid.withColumn("slot", all_slots(slots_for(size, way.hot_limit)))
        keys.append("slot")
    if not way.broadcast and way.edge_rows > TASK_ROWS:
        rows = rows.repartition(_tasks_for_rows(way), *keys)
    return rows.join(way.mark(grid), keys, "left").select(
        *columns, *[F.coalesce(c, long(1)).alias(c) for c in ("in_slots", "out_slots")]
    )


#: Rows that one task is to hold in memory, where there are many. Adaptive execution would merge
#: partitions by their compressed size, which for ids is a small part of what they take there.
TASK_ROWS = 500_000
#: Tasks up to which their number follows the number of paths.
MANY_TASKS = 1_000


def _tasks_for_rows(way: Route) -> int:
    return min(way.limits.tasks, way.edge_rows // TASK_ROWS + 1)


def tasks_for(edges: DataFrame, paths: float, limits: Limits) -> int:
    """Tasks that list so many 2-paths.

    Every task reports to the driver, and every task before it names a size for each. Beyond
    ``MANY_TASKS`` their number therefore grows as the square root of the paths, and so does what
    each one lists; it streams what it lists, and its input is 2 / path_rows of that.
    """
    shuffles = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = int(paths // limits.task_paths) + 1
    if wanted > MANY_TASKS:
        wanted = math.isqrt(MANY_TASKS * wanted)
    return max(shuffles, min(limits.tasks, wanted))


def is_light(most_paths: float, most_rows: int, limits: Limits) -> bool:
    """Whether no node is in the middle of more paths than one task is to list, nor has more edges,
    copies included, than one merged row may stand for: then there is nothing to merge or split."""
    return most_paths <= limits.task_paths and most_rows <= limits.copies


def meet_at_light(first: DataFrame, second: DataFrame, tasks: int) -> DataFrame:
    """``start_node, mid_node, end_node`` for every two edges as they are (and ``copies``, if edges are
    merged), where all middle nodes are light: edges are sent by them, and nothing is split."""
    merged = ["multiplicity"] if "multiplicity" in first.columns else []
    a = first.select(F.col("follower").alias("start_node"), F.col("followee").alias("mid_node"), *merged)
    b = second.select(F.col("follower").alias("mid_node"), F.col("followee").alias("end_node"), *merged)
    a, b = a.repartition(tasks, "mid_node").alias("a"), b.repartition(tasks, "mid_node").hint("merge").alias("b")
    copies = [(F.col(f"a.{c}") * F.col(f"b.{c}")).alias("copies") for c in merged]
    return a.join(b, F.col("a.mid_node") == F.col("b.mid_node")).select("a.start_node", "a.mid_node", "b.end_node", *copies)


def meet_in_cells(first: DataFrame, second: DataFrame, sizes: DataFrame, way: Route, tasks: int) -> DataFrame:
    """``start_node, mid_node, end_node, copies`` for every row of ``first`` (``start_node,
    mid_node, block, copies``) and of ``second`` (``end_node, mid_node, block, copies``) with the
    same middle node; ``sizes`` has the ``in_degree`` and ``out_degree`` of every ``node``.

    A node with i edges in and o out is in the middle of i * o paths, so what a task has to
    write is not seen from the size of its input. Every such node gets a grid of
    ceil(i / path_rows) times ceil(o / path_rows) cells: an incoming edge picks a row of the grid
    and is sent to all columns, an outgoing edge picks a column and is sent to all rows. A cell
    then makes about path_rows**2 paths whatever the degrees, and the copies sent are 2/path_rows
    of the output. Cells are dealt to a stated number of tasks.
    """
    limits = way.limits
    grid = (
        sizes.filter((F.col("in_degree") > limits.path_rows) | (F.col("out_degree") > limits.path_rows))
        .filter("in_degree > 0 AND out_degree > 0")
        .select(
            F.col("node").alias("mid_node"),
            "in_degree",
            "out_degree",
            slots_for("in_degree", limits.path_rows).alias("in_slots"),
            slots_for("out_degree", limits.path_rows).alias("out_slots"),
        )
    )
    hot = hot_keys(sizes, "node", ["in_degree", "out_degree"], way.hot_limit)
    first = in_blocks(
        _with_grid(first, "start_node", "in_degree", grid, hot, way).withColumn(
            "in_slot", pick_slot(F.col("in_slots"), "start_node", "block")
        ),
        F.col("out_slots") - 1,
        "out_slot",
    )
    second = in_blocks(
        _with_grid(second, "end_node", "out_degree", grid, hot, way).withColumn(
            "out_slot", pick_slot(F.col("out_slots"), "end_node", "block")
        ),
        F.col("in_slots") - 1,
        "in_slot",
    )
    # dealt to a stated number of tasks, which adaptive execution leaves as it is: it would merge
    # partitions by the size of their input
    keys = ["mid_node", "in_slot", "out_slot"]
    a = first.repartition(tasks, *keys).alias("a")
    b = way.mark(second if way.broadcast else second.repartition(tasks, *keys)).alias("b")
    meet = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]
    return a.join(b, meet).select(
        "a.start_node", "a.mid_node", "b.end_node", (F.col("a.copies") * F.col("b.copies")).alias("copies")
    )


def _repeated(paths: DataFrame, loops: bool) -> DataFrame:
    if not loops:
        paths = paths.filter("start_node <> end_node")
    # no array is made for a path that is there once
    copies = F.when(F.col("copies") == 1, F.array(long(1))).otherwise(F.sequence(long(1), F.col("copies")))
    return paths.select("start_node", "mid_node", "end_node", F.explode(copies).alias("copy")).drop("copy")


def steps_in(merged: DataFrame, limits: Limits) -> DataFrame:
    """Merged edges as the first steps of paths."""
    return copies_in_blocks(merged, min(limits.copies, limits.path_rows)).select(
        F.col("follower").alias("start_node"), F.col("followee").alias("mid_node"), "block", "copies"
    )


def steps_out(merged: DataFrame, limits: Limits) -> DataFrame:
    """Merged edges as the second steps of paths."""
    return copies_in_blocks(merged, min(limits.copies, limits.path_rows)).select(
        F.col("followee").alias("end_node"), F.col("follower").alias("mid_node"), "block", "copies"
    )


def two_paths(
    edges: DataFrame,
    *,
    loops: bool = True,
    strategy: str = "auto",
    limits: Limits = Limits(),
) -> DataFrame:
    """``start_node, mid_node, end_node`` for every pair of edges a->b, b->c.

    ``loops=False`` leaves out the paths that end where they started. Repeated edges are joined
    once and repeated in the result; middle nodes are split into cells (``meet_in_cells``), dealt
    to as many tasks as the number of paths asks for, which is known from the degrees before
    anything is joined. In a graph small enough to be broadcast in which no node passes
    ``path_rows`` on both sides there is nothing to split, and edges are joined as they are. So
    they are, under ``auto``, in a larger one where no node makes more than ``task_paths`` paths
    or has more than ``copies`` edges, copies included.
    """
    through = F.col("in_degree").cast("double") * F.col("out_degree")
    # from the edges as they are: next to nothing of them is left before the shuffle
    n, paths, most_paths, most, hubs = degrees(edges).agg(
        F.coalesce(F.sum("in_degree"), long(0)),
        F.coalesce(F.sum(through), F.lit(0.0)),
        F.coalesce(F.max(through), F.lit(0.0)),
        F.coalesce(F.max(F.greatest("in_degree", "out_degree")), long(0)),
        F.count_if((F.col("in_degree") > 0) & (F.col("out_degree") > limits.path_rows)),
    ).first()
    way = route(edges, strategy, limits, counted=n)
    if way.broadcast and not hubs:
        return _probe(valid(edges), valid(edges), loops)
    if strategy == "auto" and not way.broadcast and is_light(most_paths, most, limits):
        found = meet_at_light(valid(edges), valid(edges), tasks_for(edges, paths, limits))
        return found if loops else found.filter("start_node <> end_node")
    distinct = multiplicity(edges)
    sizes = degrees(distinct, weight="multiplicity")
    found = meet_in_cells(steps_in(distinct, limits), steps_out(distinct, limits), sizes, way, tasks_for(edges, paths, limits))
    return _repeated(found, loops)


def _probe(first: DataFrame, side: DataFrame, loops: bool) -> DataFrame:
    """Paths by a broadcast of the side relation: the first is streamed, neither merged nor moved."""
    a = first.select(F.col("follower").alias("start_node"), F.col("followee").alias("mid_node"))
    b = F.broadcast(side.select(F.col("follower").alias("mid_node"), F.col("followee").alias("end_node")))
    meet = F.col("a.mid_node") == F.col("b.mid_node")
    if not loops:
        meet &= F.col("a.start_node") != F.col("b.end_node")
    return a.alias("a").join(b.alias("b"), meet).select("start_node", "a.mid_node", "end_node")


def _ends_between(first: DataFrame, second: DataFrame, weight: str = "1L") -> DataFrame:
    ends = first.selectExpr("followee AS node", f"{weight} AS i", "0L AS o").unionAll(
        second.selectExpr("follower AS node", "0L AS i", f"{weight} AS o")
    )
    return ends.filter("node IS NOT NULL").groupBy("node").agg(F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree"))


def sizes_between(first: DataFrame, second: DataFrame, weight: str = "1L") -> DataFrame:
    """``node, in_degree, out_degree``: edges of the first relation into, and of the second out of,
    every node that has both."""
    return _ends_between(first, second, weight).filter("in_degree > 0 AND out_degree > 0")


def two_paths_between(
    first: DataFrame,
    second: DataFrame,
    *,
    loops: bool = True,
    strategy: str = "auto",
    limits: Limits = Limits(),
) -> DataFrame:
    """``start_node, mid_node, end_node`` for every edge a->b of ``first`` and b->c of ``second``.

    The second relation is the side relation. It is counted by itself, and if it has at most
    ``limits.broadcast_rows`` edges and, under ``auto``, at most ``limits.path_rows`` out of any
    node, it is sent to all tasks and the first is streamed past it, whatever its size, without
    being counted, merged or shuffled. Otherwise both relations meet in cells of the middle
    node, sized by the first relation's edges in and the second's out. If no middle node has, copies
    included, more than ``limits.copies`` of either or ``limits.task_paths`` paths, edges meet as they are.
    """
    first, second = valid(first), valid(second)
    if strategy != "shuffle":
        out = second.groupBy("follower").agg(F.count(F.lit(1)).alias("n"))
        side, most = out.agg(F.coalesce(F.sum("n"), long(0)), F.coalesce(F.max("n"), long(0))).first()
        if side <= limits.broadcast_rows and (strategy == "broadcast" or most <= limits.path_rows):
            return _probe(first, second, loops)
    larger = F.greatest("in_degree", "out_degree")
    through = F.col("in_degree").cast("double") * F.col("out_degree")
    n, paths, most_paths, most = _ends_between(first, second).agg(
        F.coalesce(F.sum(F.when((F.col("in_degree") > 0) & (F.col("out_degree") > 0), larger)), long(0)),
        F.coalesce(F.sum(through), F.lit(0.0)),
        F.coalesce(F.max(through), F.lit(0.0)),
        F.coalesce(F.max(larger), long(0)),  # also of nodes that are on no path: their edges are sent, too
    ).first()
    if is_light(most_paths, most, limits):
        found = meet_at_light(first, second, tasks_for(first, paths, limits))
        return found if loops else found.filter("start_node <> end_node")
    # only edges with a middle node in common take part; they never are more than twice n
    way = route(first, "shuffle", limits, counted=2 * n)
    if way.edge_rows > TASK_ROWS and most <= way.hot_limit:
        # no edge is there more often than a node has edges: they can be sent before copies are merged
        first, second = (e.repartition(_tasks_for_rows(way), "follower", "followee") for e in (first, second))
    one, other = multiplicity(first), multiplicity(second)
    sizes = sizes_between(one, other, "multiplicity")
    found = meet_in_cells(steps_in(one, limits), steps_out(other, limits), sizes, way, tasks_for(first, paths, limits))
    return _repeated(found, loops)


def two_path_count_between(first: DataFrame, second: DataFrame, *, loops: bool = True, wide: bool = False) -> DataFrame:
    """One row, ``two_path_count``: pairs of an edge a->b of ``first`` and an edge b->c of ``second``,
    from the degrees alone. With ``loops=False`` the pairs a->b, b->a are taken off."""
    first, second = valid(first), valid(second)
    to_type = WIDE if wide else "bigint"
    sizes = sizes_between(first, second)
    terms = sizes.select((F.col("in_degree").cast(to_type) * F.col("out_degree").cast(to_type)).cast(to_type).alias("n"))
    if not loops:
        both = first.selectExpr("follower AS a", "followee AS b", "1L AS i", "0L AS o").unionAll(
            second.selectExpr("followee AS a", "follower AS b", "0L AS i", "1L AS o")
        )
        back = both.groupBy("a", "b").agg(F.sum("i").cast(to_type).alias("i"), F.sum("o").cast(to_type).alias("o"))
        terms = terms.unionAll(back.select((-F.col("i") * F.col("o")).cast(to_type).alias("n")))
    return terms.agg(F.coalesce(F.sum("n"), F.lit(0)).cast(to_type).alias("two_path_count"))
