import re

import pytest
from pyspark.sql import functions as F

import followgraph as fg
from followgraph.plans.route import route
from followgraph.plans.skew import hot_keys

SF = "/root/testdata/sf0.001"


@pytest.fixture
def lp(spark):
    return fg.from_table(spark.read.parquet(f"{SF}/lineitem.parquet"), "l_partkey", "l_suppkey")


def plan(df):
    return fg.plan_text(df, "simple")


def test_only_needed_columns_are_read(lp):
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in plan(fg.triangle_count(lp))


def test_cut_off_reaches_the_scan(lp):
    text = plan(fg.two_path_count(lp, 60))
    assert "LessThan(l_partkey,60)" in text and "LessThan(l_suppkey,60)" in text


def test_counts_are_combined_before_the_shuffle(lp):
    text = plan(fg.follower_count(lp))
    assert text.count("hashpartitioning") == 1 and "partial_count" in text


def test_degrees_scan_once(lp):
    assert plan(fg.degrees(lp)).count("FileScan") == 1


def test_two_path_count_joins_nothing(lp):
    text = plan(fg.two_path_count(lp)) + plan(fg.two_path_count(lp, loops=False))
    assert "Join" not in text


@pytest.mark.parametrize("strategy", ["auto", "shuffle", "broadcast"])
def test_no_nested_loops_and_no_python(lp, strategy):
    for df in (
        fg.two_paths(lp, strategy=strategy),
        fg.triangles(lp, "closed", strategy=strategy),
        fg.triangle_count(lp, strategy=strategy),
    ):
        text = plan(df)
        assert not re.search("NestedLoop|Cartesian|Python|Window", text)


def test_shuffle_strategy_sends_edges_by_key(lp):
    text = plan(fg.two_paths(lp, strategy="shuffle"))
    assert "SortMergeJoin" in text and "in_slot" in text and "in_degree_slots" not in text
    text = plan(fg.two_paths(lp, strategy="shuffle", limits=fg.Limits(rows=1000)))
    assert "SortMergeJoin" in text and "in_slot" in text and "in_degree_slots" in text


def test_broadcast_strategy_joins_without_sorting(lp):
    text = plan(fg.two_paths(lp, strategy="broadcast", limits=fg.Limits(path_rows=5)))
    assert "SortMergeJoin" not in text and "in_slot" in text
    # no middle node with many edges out: nothing to split, so nothing is moved
    text = plan(fg.two_paths(lp, strategy="broadcast"))
    assert "SortMergeJoin" not in text and "in_slot" not in text and "Exchange hashpartitioning" not in text


@pytest.mark.parametrize("how", [{"strategy": "shuffle"}, {"strategy": "auto"}, {"strategy": "shuffle", "limits": fg.Limits(broadcast_rows=0, rows=1000)}])
def test_no_task_lists_a_hub(spark, how):
    """3,000 followers of one node and 3,000 it follows make 9 million of 9.2 million paths."""
    into = spark.range(3000).select((F.col("id") + 10).alias("follower"), F.lit(0).cast("long").alias("followee"))
    out = into.select(F.col("followee").alias("follower"), (F.col("follower") + 10_000).alias("followee"))
    rest = spark.range(200_000).select(
        (F.xxhash64("id") % 100_000 + 200_000).alias("follower"), (F.xxhash64("id", "id") % 100_000 + 200_000).alias("followee")
    )
    paths = fg.two_paths(into.union(out).union(rest), **how)
    sizes = [r["count"] for r in paths.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) > 9_000_000 and max(sizes) <= 0.05 * sum(sizes)


def test_blocks_have_no_long_arrays(spark):
    from followgraph.plans.skew import in_blocks

    got = in_blocks(spark.range(2), F.when(F.col("id") == 0, 0).otherwise(70_000)).groupBy("id").agg(
        F.count("*").alias("n"), F.countDistinct("block").alias("d"), F.max("block").alias("top")
    )
    assert sorted(tuple(r) for r in got.collect()) == [(0, 1, 1, 0), (1, 70_001, 70_001, 70_000)]
    # 3e12 copies in blocks of 1,000 are more than one array can hold; the first ones come at once
    first = in_blocks(spark.range(1), F.lit(3 * 10**9 - 1).cast("long")).limit(5)
    assert first.count() == 5


def test_a_wrong_number_of_edges_broadcasts_nothing(spark, lp):
    n = lp.count()
    way = route(lp, "auto", fg.Limits(broadcast_rows=n - 1), edge_rows=1)
    assert not way.broadcast and way.edge_rows == n
    with pytest.warns(UserWarning, match="too many"):
        route(lp, "broadcast", fg.Limits(broadcast_rows=n - 1))


@pytest.mark.parametrize("limits", [fg.Limits(), fg.Limits(broadcast_rows=0, rows=100, list_size=5)])
@pytest.mark.parametrize(
    "build",
    [
        lambda e, **how: fg.triangle_count(e, strategy="shuffle", **how),
        lambda e, **how: fg.triangles(e, "closed", strategy="shuffle", **how),
        lambda e, **how: fg.two_paths(e, strategy="shuffle", **how),
        fg.adjacency,
        fg.core,
    ],
    ids=["triangle_count", "triangles", "two_paths", "adjacency", "core"],
)
def test_edges_are_merged_once(lp, build, limits):
    """All uses of the merged edges share one scan and one shuffle of them."""
    df = build(lp, limits=limits)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    # where nothing can be hot, core reads the edges once for the degrees and once more
    assert final.count("FileScan") == (2 if build is fg.core and limits == fg.Limits() else 1)


@pytest.mark.parametrize("limits", [fg.Limits(), fg.Limits(broadcast_rows=0, rows=100)])
def test_ranked_pairs_are_shuffled_once_for_both_sides(lp, limits):
    df = fg.triangle_count(lp, strategy="shuffle", limits=limits)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    made = re.findall(r"(?<!Reused)Exchange hashpartitioning\(low", final)
    reused = [line for line in final.splitlines() if "ReusedExchange" in line and "(low#" in line]
    assert len(made) - len(reused) == 1 and len(reused) == 1


def test_hot_keys_are_few(spark, lp):
    n = lp.count()
    limits = fg.Limits(broadcast_rows=0, rows=1, max_share=20)
    way = route(lp, "auto", limits)
    assert way.split and way.edge_rows == n
    sizes = fg.degrees(lp)
    hot = hot_keys(sizes, "node", ["in_degree", "out_degree"], way.hot_limit)
    assert 0 < hot.count() < 20
    assert hot.filter("in_degree_slots > 1").count() == hot.count()
    # ten thousand times the data, the same bound
    assert route(lp, "auto", limits, edge_rows=n * 10_000).hot_limit > 10_000 * (n // 20)


def test_a_known_number_of_edges_is_not_counted_again(spark, lp):
    broken = lp.filter(F.raise_error(F.lit("scanned")).isNull())
    fg.triangle_count(broken, edge_rows=10**7)
    with pytest.raises(Exception, match="scanned"):
        fg.triangle_count(broken)


def test_routes(lp):
    n = lp.count()
    small = fg.Limits(broadcast_rows=n - 1, rows=n)
    assert route(lp, "auto", fg.Limits()).broadcast
    assert not route(lp, "shuffle", fg.Limits()).broadcast
    for strategy in ("auto", "broadcast"):
        way = route(lp, strategy, small)
        assert not way.broadcast and not way.split
