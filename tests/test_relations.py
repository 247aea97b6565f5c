"""Paths and walks over different relations, against brute force."""

import random
from collections import Counter

import pytest

import followgraph as fg
from conftest import rows

SPLIT = fg.Limits(broadcast_rows=0, rows=20, max_share=1_000, path_rows=3, task_paths=50, copies=2, repeats=2)
CLOSED = {"closed": lambda a, b, c: True, "no_loop": lambda a, b, c: a != c, "strict": lambda a, b, c: len({a, b, c}) == 3}


def relation(seed, edges=60, nodes=12):
    rng = random.Random(seed)
    pick = lambda: 0 if rng.random() < 0.3 else rng.randrange(nodes)
    return [(pick(), pick()) for _ in range(edges)]


def brute_between(one, two, loops=True):
    return sorted((a, b, d) for a, b in one for c, d in two if b == c and (loops or a != d))


def brute_closed(one, two, three, walks):
    found = Counter((a, b, d) for a, b, d in brute_between(one, two) for e, f in three if e == d and f == a)
    return sorted((*w, n) for w, n in found.items() if CLOSED[walks](*w))


@pytest.mark.parametrize("how", [{}, {"strategy": "broadcast"}, {"strategy": "shuffle"}, {"limits": SPLIT}, {"limits": fg.Limits(path_rows=2)}])
@pytest.mark.parametrize("loops", [True, False])
def test_two_paths_between(graph, how, loops):
    one, two = relation(1), relation(2, 40)
    a, b = graph(one + [(None, 1), (1, None)]), graph(two + [(None, None)])
    assert rows(fg.two_paths_between(a, b, loops=loops, **how)) == brute_between(one, two, loops)


@pytest.mark.parametrize("loops", [True, False])
@pytest.mark.parametrize("wide", [True, False])
def test_two_path_count_between(graph, loops, wide):
    one, two = relation(1), relation(2, 40)
    got = fg.two_path_count_between(graph(one + [(None, 1)]), graph(two + [(1, None)]), loops=loops, wide=wide)
    assert rows(got) == [(len(brute_between(one, two, loops)),)]


def test_the_side_relation_is_counted_by_itself(graph):
    """A large relation is streamed past a small one without a shuffle, a side hub goes to cells."""
    large, side = graph([(i, i % 7) for i in range(300)]), graph([(i, i + 100) for i in range(7)])
    few = fg.Limits(broadcast_rows=7)
    plan = fg.plan_text(fg.two_paths_between(large, side, limits=few))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert "BroadcastHashJoin" not in fg.plan_text(fg.two_paths_between(side, large, limits=few))
    hub = graph([(3, i) for i in range(200)])
    assert "rangepartitioning" not in fg.plan_text(fg.two_paths_between(large, hub))
    assert "SortMergeJoin" in fg.plan_text(fg.two_paths_between(large, hub, strategy="auto"))
    assert fg.two_paths_between(large, hub).count() == 200 * 43


@pytest.mark.parametrize("turn, walks", list(enumerate(CLOSED)))
@pytest.mark.parametrize("how", [{}, {"strategy": "shuffle"}, {"limits": SPLIT}])
def test_closed_walks_between(graph, turn, walks, how):
    lists = [relation(3), relation(4, 50), relation(5, 40)]
    three = lists[turn:] + lists[:turn]
    assert rows(fg.closed_walks_between(*map(graph, three), walks, **how)) == brute_closed(*three, walks)


def hubs(seed, size=40):
    """Relations in which every pair of them makes many paths through hubs and few walks close."""
    rng = random.Random(seed)
    ends = [(i, 0) for i in range(1, size)] + [(0, i) for i in range(1, size)]
    return ends + [(rng.randrange(size), rng.randrange(size)) for _ in range(size)]


@pytest.mark.parametrize("limits", [fg.Limits(task_paths=1), fg.Limits(broadcast_rows=0, rows=15, max_share=1_000, path_rows=5, task_paths=30)])
def test_heavy_middle_nodes(graph, limits):
    lists = [hubs(6), hubs(7), hubs(8)]
    got = rows(fg.closed_walks_between(*map(graph, lists), limits=limits))
    assert got == brute_closed(*lists, "closed")


def test_walks_over_one_relation_are_its_closed_walks(graph):
    e = graph(relation(9))
    assert rows(fg.closed_walks_between(e, e, e, "no_loop")) == rows(fg.closed_walks(e, "no_loop"))


@pytest.mark.parametrize("walks, how", [("closed", {}), ("no_loop", {"strategy": "shuffle"}), ("strict", {"limits": SPLIT}), ("closed", {"limits": SPLIT})])
def test_close_paths(spark, graph, walks, how):
    rng = random.Random(11)
    paths = [(0, rng.randrange(40), 1) for _ in range(60)] + [(rng.randrange(5), rng.randrange(5), rng.randrange(5)) for _ in range(60)]
    edges = relation(12, 50, 6) + [(1, 0)] * 3
    given = spark.createDataFrame(paths + [(None, 1, 2), (1, None, 0)], "start_node long, mid_node long, end_node long")
    want = sorted(p for p in paths for c, a in edges if (c, a) == (p[2], p[0]) and CLOSED[walks](*p))
    assert rows(fg.close_paths(given, graph(edges), walks, **how)) == want


def test_saved_paths_close_to_the_triangles(spark, graph, tmp_path):
    e = graph(relation(13))
    fg.write_tsv(fg.two_paths(e), str(tmp_path / "paths"))
    saved = fg.read_walks(spark, str(tmp_path / "paths"), ["start_node", "mid_node", "end_node"])
    assert rows(fg.close_paths(saved, e)) == rows(fg.triangles(e))


def test_empty_relations(graph):
    e, none = graph(relation(14)), graph([(1, 1)]).limit(0)
    assert fg.two_paths_between(none, e).count() == fg.two_paths_between(e, none).count() == 0
    assert rows(fg.two_path_count_between(e, none)) == [(0,)]
    for three in ([none, e, e], [e, none, e], [none, none, none]):
        assert fg.closed_walks_between(*three).count() == 0
    assert fg.close_paths(fg.two_paths(none), e).count() == 0
