"""Counts per node, and 2-path counts that follow from them without listing a path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from followgraph.functions import below, both_ends, divisible_by, high_low, product_limbs, sum_limbs
from followgraph.functions.columns import WIDE


def follower_count(edges: DataFrame, modulus: int | None = 100) -> DataFrame:
    """``followee, follower_count`` for followees divisible by ``modulus`` (all for ``None``)."""
    edges = edges.filter(both_ends())
    if modulus is not None:
        edges = edges.filter(divisible_by("followee", modulus))
    return edges.groupBy("followee").agg(F.count(F.lit(1)).alias("follower_count"))


def follower_group_size(edges: DataFrame, modulus: int | None = 100, *, distinct: bool = True) -> DataFrame:
    """``followee, n_followers, n_distinct_followers``: the size of each group of followers.

    Groups are not built. Counts are taken per edge first, then per followee;
    ``distinct=False`` leaves out the second number and with it the shuffle of whole edges.
    """
    edges = edges.filter(both_ends())
    if not distinct:
        return follower_count(edges, modulus).withColumnRenamed("follower_count", "n_followers")
    if modulus is not None:
        edges = edges.filter(divisible_by("followee", modulus))
    per_edge = edges.groupBy("followee", "follower").agg(F.count("follower").alias("n"))
    return per_edge.groupBy("followee").agg(
        F.sum("n").alias("n_followers"), F.count("follower").alias("n_distinct_followers")
    )


def _ends(edges: DataFrame, *columns: str, weight: str = "1L") -> DataFrame:
    """Two rows per edge: one for the follower with ``out`` = weight, one for the followee with
    ``in`` = weight. One scan, where a union of two projections would make two."""
    extra = "".join(f", {c}" for c in columns)
    names = ", ".join(["node", "`in`", "`out`", *columns])
    ends = f"stack(2, follower, 0L, {weight}{extra}, followee, {weight}, 0L{extra}) AS ({names})"
    return edges.filter(both_ends()).select(F.expr(ends)).filter("node IS NOT NULL")


def degrees(edges: DataFrame, *, weight: str = "1L") -> DataFrame:
    """``node, in_degree, out_degree`` for every node of an edge.

    ``weight`` names the column that holds how often an edge occurs, if edges are merged.
    """
    return _ends(edges, weight=weight).groupBy("node").agg(
        F.sum("in").alias("in_degree"), F.sum("out").alias("out_degree")
    )


def _product(wide: bool, incoming: str = "in_degree", outgoing: str = "out_degree") -> Column:
    if wide:
        return (F.col(incoming).cast(WIDE) * F.col(outgoing).cast(WIDE)).cast(WIDE)
    return F.col(incoming) * F.col(outgoing)


def degree_product(edges: DataFrame, *, wide: bool = False) -> DataFrame:
    """``node, degree_product``: the number of 2-paths through each node.

    BIGINT, and an error above 2^63 - 1; ``wide`` gives ``decimal(38,0)``.
    """
    return degrees(edges).select("node", _product(wide).alias("degree_product"))


def two_path_count(
    edges: DataFrame,
    max_id: int | None = None,
    *,
    loops: bool = True,
    wide: bool = False,
) -> DataFrame:
    """One row, ``two_path_count``: pairs of edges a->b, b->c among edges under ``max_id``.

    A node with i incoming and o outgoing edges is in the middle of i * o paths. With
    ``loops=False`` the back-and-forth paths a->b->a are taken off: an unordered pair of nodes
    with f edges one way and r the other makes f * r of them from each end.
    """
    if max_id is not None:
        edges = edges.filter(below(max_id))
    paths = degree_product(edges, wide=wide).select(F.col("degree_product").alias("n"))
    if not loops:
        to_type = WIDE if wide else "bigint"
        forth = F.count_if(F.col("follower") < F.col("followee")).cast(to_type)
        back = F.count_if(F.col("follower") > F.col("followee")).cast(to_type)
        same = F.count_if(F.col("follower") == F.col("followee")).cast(to_type)
        pairs = edges.groupBy(
            F.least("follower", "followee").alias("a"), F.greatest("follower", "followee").alias("b")
        ).agg(forth.alias("forth"), back.alias("back"), same.alias("same"))
        paths = paths.unionAll(
            pairs.select((-2 * F.col("forth") * F.col("back") - F.col("same") * F.col("same")).alias("n"))
        )
    total = F.coalesce(F.sum("n"), F.lit(0)).cast(WIDE if wide else "bigint")
    return paths.agg(total.alias("two_path_count"))


def two_path_count_by_max(edges: DataFrame, max_ids: list[int]) -> DataFrame:
    """``max_id, two_path_count`` for several cut-offs in one scan and one shuffle."""
    top = edges.withColumn("top", F.greatest("follower", "followee"))
    per_node = _ends(top, "top").groupBy("node").agg(
        *[
            F.sum(F.when(F.col("top") < m, F.col(way)).otherwise(0)).alias(f"{way}_{i}")
            for i, m in enumerate(max_ids)
            for way in ("in", "out")
        ]
    )
    totals = per_node.agg(
        *[
            F.coalesce(F.sum(F.col(f"in_{i}") * F.col(f"out_{i}")), F.lit(0)).alias(f"n_{i}")
            for i in range(len(max_ids))
        ]
    )
    rows = F.array(
        *[
            F.struct(F.lit(m).cast("bigint").alias("max_id"), F.col(f"n_{i}").alias("two_path_count"))
            for i, m in enumerate(max_ids)
        ]
    )
    return totals.select(F.inline(rows))


def _weight_limbs(edges: DataFrame, weight: str) -> DataFrame:
    weighted = edges.select("follower", "followee", F.coalesce(F.col(weight).cast("bigint"), F.lit(0)).alias("weight"))
    sums = degrees(weighted, weight="weight")
    return sums.select("node", *product_limbs(F.col("in_degree"), F.col("out_degree")))


def two_path_weights(edges: DataFrame, weight: str) -> DataFrame:
    """``node, weight_high, weight_low``: over the 2-paths a->b->c through each node b, the sum of
    the products of their edges' weights (whole numbers), exactly: high * 10^18 + low.

    No path is listed: it is the weight that comes in times the weight that goes out. A null weight
    counts as zero; a node with 2^56 or more on one side is an error.
    """
    return high_low(_weight_limbs(edges, weight), "weight")


def two_path_weight(edges: DataFrame, weight: str) -> DataFrame:
    """One row, ``weight_high, weight_low``: the same over all 2-paths (0, 0 without any)."""
    return high_low(_weight_limbs(edges, weight).agg(*sum_limbs()), "weight")
