import pytest
from conftest import brute_walks, random_edges

import followgraph as fg

SPLITS = {
    "whole": {},
    "shuffle": {"strategy": "shuffle"},
    "wide": {"wide": True},
    "split": {"limits": fg.Limits(broadcast_rows=0, rows=5, max_share=1_000, wedge_rows=2)},
}


@pytest.mark.parametrize("how", SPLITS)
@pytest.mark.parametrize("walks", fg.WALKS)
def test_counts_by_lists(graph, walks, how):
    for seed in (1, 2) if how == "split" else (1,):
        pairs = random_edges(seed, nodes=12, edges=70)
        got = fg.triangle_count(graph(pairs), walks, method="lists", **SPLITS[how]).collect()
        assert [tuple(r) for r in got] == [(len(brute_walks(pairs, walks)) // 3,)]


def test_all_counts_by_lists(graph):
    pairs = random_edges(5, nodes=10, edges=60)
    got = fg.walk_counts(graph(pairs), method="lists", limits=SPLITS["split"]["limits"]).first()
    assert tuple(got) == tuple(len(brute_walks(pairs, w)) for w in ("closed", "no_loop", "strict"))


def test_no_cycles(spark, graph):
    for pairs in ([], [(1, 2), (2, 3)], [(1, None), (None, 1)]):
        for how in SPLITS.values():
            assert fg.triangle_count(graph(pairs), method="lists", **how).first()[0] == 0


def test_unknown_method(graph):
    with pytest.raises(ValueError):
        fg.triangle_count(graph([(1, 2)]), method="matrix")


def shuffled(plan):
    """Bytes written by the exchanges of a plan that has run."""
    name = plan.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        return shuffled(plan.executedPlan())
    if name.endswith("QueryStage"):
        return shuffled(plan.plan())
    if name == "ReusedExchange":
        return 0
    own = plan.metrics().get("shuffleBytesWritten").get().value() if name == "Exchange" else 0
    return own + sum(shuffled(plan.children().apply(i)) for i in range(plan.children().size()))


def test_lists_shuffle_less(spark):
    """A graph of 120,000 edges between 3,000 nodes, one of which has a third of the edges: enough nodes for
    most 2-paths of a task to have ends of their own, so that adding them up before the shuffle saves little."""
    end = "IF(pmod(xxhash64(id, {0}), 100) < 18, 0, pmod(xxhash64(id, {1}), 3000))"
    edges = spark.range(120_000).selectExpr(f"{end.format(1, 2)} AS follower", f"{end.format(3, 4)} AS followee")
    size, found = {}, {}
    for method in ("pairs", "lists"):
        counted = fg.triangle_count(edges, method=method, strategy="shuffle")
        found[method] = counted.collect()
        size[method] = shuffled(counted._jdf.queryExecution().executedPlan())
    assert found["pairs"] == found["lists"]
    assert size["lists"] < size["pairs"], size
