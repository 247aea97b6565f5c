from collections import Counter
from decimal import Decimal

import pytest
from conftest import TOY, TOY2, brute_paths, brute_walks, random_edges, rows

import followgraph as fg

STRATEGIES = ["auto", "shuffle", "broadcast"]

# Every splitting rule at work on a handful of rows.
TINY = fg.Limits(
    rows=2, max_share=50, wedge_rows=1, path_rows=2, task_paths=3, copies=2, repeats=2, list_size=2, broadcast_rows=0
)


@pytest.mark.parametrize("strategy", STRATEGIES)
@pytest.mark.parametrize("loops", [True, False])
def test_two_paths(graph, strategy, loops):
    assert rows(fg.two_paths(graph(TOY2), loops=loops, strategy=strategy)) == brute_paths(TOY2, loops)


def test_two_paths_of_the_sample(graph):
    e = fg.under_max(graph(TOY), 6)
    assert rows(fg.two_paths(e)) == [
        (1, 2, 1), (1, 2, 3), (1, 3, 2), (2, 1, 2), (2, 1, 3), (2, 3, 2), (3, 2, 1), (3, 2, 3),
    ]


@pytest.mark.parametrize("seed", range(2))
def test_two_paths_with_split_groups(graph, seed):
    pairs = random_edges(seed)
    for loops in (True, False):
        got = rows(fg.two_paths(graph(pairs), loops=loops, strategy="shuffle", limits=TINY))
        assert got == brute_paths(pairs, loops)


def test_broadcast_beyond_the_bound_turns_into_a_shuffle(graph):
    e = graph(TOY)
    within = fg.plan_text(fg.two_paths(e, strategy="broadcast", limits=fg.Limits(broadcast_rows=len(TOY))))
    beyond = fg.plan_text(fg.two_paths(e, strategy="broadcast", limits=fg.Limits(broadcast_rows=len(TOY) - 1)))
    assert "SortMergeJoin" not in within
    assert "SortMergeJoin" in beyond
    got = fg.two_paths(e, strategy="broadcast", limits=fg.Limits(broadcast_rows=1))
    assert rows(got) == brute_paths(TOY)
    assert rows(fg.triangle_count(e, strategy="broadcast", limits=fg.Limits(broadcast_rows=1))) == [(2,)]


@pytest.mark.parametrize("strategy", STRATEGIES)
@pytest.mark.parametrize("walks, walk_rows, count", [("closed", 17, 5), ("no_loop", 12, 4), ("strict", 6, 2)])
def test_triangles_toy2(graph, strategy, walks, walk_rows, count):
    e = graph(TOY2)
    got = rows(fg.triangles(e, walks, strategy=strategy))
    assert got == brute_walks(TOY2, walks)
    assert len(got) == walk_rows
    counted = fg.triangle_count(e, walks, strategy=strategy)
    assert counted.dtypes == [("triangle_count", "bigint")]
    assert rows(counted) == [(count,)]


@pytest.mark.parametrize("max_id, count", [(6, 1), (10_000, 2), (2, 0)])
def test_triangle_count_of_the_sample(graph, max_id, count):
    e = fg.under_max(graph(TOY), max_id)
    for walks in fg.WALKS:
        assert rows(fg.triangle_count(e, walks)) == [(count,)]


@pytest.mark.parametrize("seed", range(4))
def test_walks_of_random_multigraphs(graph, seed):
    pairs = random_edges(seed)
    e = graph(pairs)
    expected = {w: brute_walks(pairs, w) for w in fg.WALKS}
    assert [tuple(r) for r in fg.walk_counts(e, limits=TINY).collect()] == [
        tuple(len(expected[w]) for w in fg.WALKS)
    ]
    for walks in fg.WALKS:
        n = len(expected[walks]) // 3
        assert rows(fg.triangle_count(e, walks, strategy="shuffle", limits=TINY)) == [(n,)]
        assert rows(fg.triangle_count(e, walks, wide=True)) == [(Decimal(n),)]
        assert rows(fg.triangles(e, walks, strategy="shuffle", limits=TINY)) == expected[walks]


def test_weighted_walks(graph):
    pairs = random_edges(7)
    got = {tuple(r)[:3]: r.walks for r in fg.closed_walks(graph(pairs), "closed").collect()}
    assert got == Counter(brute_walks(pairs, "closed"))


def test_identities(graph):
    pairs = random_edges(11, nodes=6, edges=60)
    m = Counter(pairs)
    nodes = {n for p in pairs for n in p}
    loop_back = sum(m[a, a] * m[a, b] * m[b, a] for a in nodes for b in nodes if a != b)
    thrice = sum(m[a, a] ** 3 for a in nodes)
    closed, no_loop, strict = fg.walk_counts(graph(pairs)).first()
    assert closed == strict + 3 * loop_back + thrice
    assert no_loop == strict + 2 * loop_back
    assert strict % 3 == 0


def test_empty_graph(graph):
    e = graph([])
    assert rows(fg.two_paths(e)) == []
    assert rows(fg.triangles(e, "closed")) == []
    assert rows(fg.walk_counts(e)) == [(0, 0, 0)]
    assert rows(fg.two_path_count(e)) == [(0,)]
    for walks in fg.WALKS:
        assert rows(fg.triangle_count(e, walks)) == [(0,)]
    assert rows(fg.two_path_count_by_max(e, [5])) == [(5, 0)]


def test_unknown_arguments(graph):
    e = graph(TOY)
    with pytest.raises(ValueError, match="walks"):
        fg.triangle_count(e, "loose")
    with pytest.raises(ValueError, match="strategy"):
        fg.two_paths(e, strategy="nested_loop")


def test_core(graph):
    pairs = random_edges(3, nodes=30, edges=40)
    follow, followed = {a for a, _ in pairs}, {b for _, b in pairs}
    expected = sorted((a, b) for a, b in pairs if a in followed and b in follow)
    assert rows(fg.core(graph(pairs))) == expected
    assert rows(fg.core(graph(pairs), limits=TINY)) == expected


def test_adjacency_lists_are_whole_and_short(graph):
    pairs = random_edges(5, nodes=40, edges=300)
    lists = fg.adjacency(graph(pairs), limits=TINY).collect()
    got = Counter()
    for r in lists:
        for item in r.followees:
            got[r.follower, item.followee] += item.multiplicity
    assert got == Counter(pairs)
    assert max(len(r.followees) for r in lists) < 10
    assert len(fg.adjacency(graph(pairs)).collect()) == len({a for a, _ in pairs})


def test_a_hub_with_a_third_of_all_edges(spark, graph):
    """Against SQL on a graph too large to try all triples."""
    import random

    import duckdb
    import pyarrow as pa

    rng = random.Random(5)
    pairs = []
    for _ in range(12_000):
        a, b, kind = rng.randrange(1, 800), rng.randrange(1, 800), rng.random()
        pairs.append((0, b) if kind < 0.3 else (a, 0) if kind < 0.4 else (7, 9) if kind < 0.45 else (a, b))
    e = graph(pairs)
    limits = fg.Limits(broadcast_rows=0, rows=500, max_share=100, wedge_rows=50, copies=10, repeats=7)
    table = pa.table({"follower": [a for a, _ in pairs], "followee": [b for _, b in pairs]})
    con = duckdb.connect()
    con.register("e", table)
    expected = con.execute(
        """SELECT count(*), count(*) FILTER (WHERE a.follower <> b.followee),
                  count(*) FILTER (WHERE a.follower <> b.followee AND a.follower <> a.followee
                                   AND b.follower <> b.followee)
           FROM e a JOIN e b ON a.followee = b.follower
           JOIN e c ON b.followee = c.follower AND c.followee = a.follower"""
    ).fetchone()
    for strategy in ("auto", "shuffle"):
        assert tuple(fg.walk_counts(e, strategy=strategy, limits=limits).first()) == expected
    assert fg.triangles(e, "closed", limits=limits).count() == expected[0]
