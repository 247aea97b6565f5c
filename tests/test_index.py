"""Adjacency lists stored as an index and probed."""

import re
from collections import Counter

import pytest

import followgraph as fg
from conftest import brute_paths, random_edges, rows

SPLIT = fg.Limits(broadcast_rows=0, rows=5, max_share=1_000, list_size=3, task_paths=10)


@pytest.mark.parametrize("limits", [fg.Limits(), SPLIT], ids=["whole", "split"])
@pytest.mark.parametrize("loops", [True, False])
def test_paths(graph, tmp_path, limits, loops):
    pairs = random_edges(3, nodes=12, edges=60)
    index = fg.save_adjacency(graph(pairs), str(tmp_path / "i"), limits=limits)
    assert (index.n_parted > 0) == (limits is SPLIT)
    got = rows(fg.paths_by_index(graph(pairs), index, loops=loops, limits=limits))
    assert got == sorted((*p, n) for p, n in Counter(brute_paths(pairs, loops)).items())


def test_lists(graph, tmp_path):
    pairs = random_edges(4, nodes=12, edges=80)
    index = fg.save_adjacency(graph(pairs), str(tmp_path / "i"), limits=SPLIT, buckets=3)
    found = Counter()
    for row in index.lists.collect():
        assert row.followees == sorted(row.followees) and len(row.followees) == len(row.copies)
        found.update({(row.node, f): n for f, n in zip(row.followees, row.copies)})
    assert found == Counter(pairs)


def test_lookups(spark, graph, tmp_path):
    pairs = random_edges(5, nodes=12, edges=80)
    index = fg.save_adjacency(graph(pairs), str(tmp_path / "i"), limits=SPLIT)
    nodes = spark.createDataFrame([(0, "x"), (0, "y"), (3, "x"), (99, "z"), (None, "n")], "node bigint, part string")
    want = sorted((a, b, n) for (a, b), n in Counter(pairs).items() if a in (0, 3))
    assert rows(fg.followees_of(nodes, index)) == want


def test_the_index_is_not_moved(spark, graph, tmp_path):
    """Only the asking side is shuffled to the buckets, also where a session opens the index again."""
    pairs = random_edges(6, nodes=30, edges=90)
    fg.save_adjacency(graph(pairs), str(tmp_path / "i"), buckets=5)
    index = fg.open_adjacency(spark, str(tmp_path / "i"))
    assert len(list((tmp_path / "i" / "lists").glob("*.parquet"))) <= 5
    plan = fg.plan_text(fg.paths_by_index(graph(pairs), index), "formatted")
    assert "Bucketed: true" in plan
    tree = plan[: plan.index("\n\n")].split("\n")
    scan = next(i for i, line in enumerate(tree) if "Scan parquet" in line)
    depth = lambda line: re.search(r"[A-Z]", line).start()
    above, level = [], depth(tree[scan])
    for line in reversed(tree[:scan]):
        if re.search(r"[A-Z]", line) and depth(line) < level:
            above.append(line)
            level = depth(line)
    join = next(i for i, line in enumerate(above) if "SortMergeJoin" in line)
    assert not any("Exchange" in line for line in above[:join])


def test_odd_graphs(spark, graph, tmp_path):
    for number, pairs in enumerate([[], [(1, None), (None, 2)], [(7, 7)] * 5]):
        index = fg.save_adjacency(graph(pairs), str(tmp_path / f"i{number}"), limits=SPLIT)
        want = [(7, 7, 7, 25)] if number == 2 else []
        assert rows(fg.paths_by_index(graph(pairs), index, limits=SPLIT)) == want
        assert fg.paths_by_index(graph(pairs), index, loops=False, limits=SPLIT).count() == 0


def test_text_ids(spark, tmp_path):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("b", "c")], "follower string, followee string")
    index = fg.save_adjacency(e, str(tmp_path / "i"))
    assert rows(fg.paths_by_index(e, index)) == [("a", "b", "c", 2)]
