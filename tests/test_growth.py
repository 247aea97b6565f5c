"""What must not grow faster than the input: tasks, rows moved, relations made again."""

import re
from pathlib import Path

import pytest
from conftest import brute_paths, brute_walks, random_edges, rows

import __spark_entry__ as entry
import followgraph as fg
from followgraph.operators import closing, cycles, paths
from followgraph.operators.paths import MANY_TASKS, tasks_for

LARGE = fg.Limits(broadcast_rows=0, path_rows=2)


def final_plan(df):
    df.collect()
    return fg.plan_text(df, "simple").split("== Initial Plan ==")[0]


def test_tasks_of_a_listing_grow_slower_than_paths(graph):
    e, limits = graph([(1, 2)]), fg.Limits()
    assert tasks_for(e, 900 * limits.task_paths, limits) == 901
    one, ten = (tasks_for(e, n * MANY_TASKS * limits.task_paths, limits) for n in (10, 100))
    assert one < 4 * MANY_TASKS and ten < 3.2 * one


@pytest.mark.parametrize("loops", [True, False])
def test_edges_at_light_nodes_are_neither_merged_nor_split(graph, loops):
    one, two = random_edges(3), random_edges(4)
    want = sorted((a, b, d) for a, b in one for c, d in two if b == c and (loops or a != d))
    df = fg.two_paths_between(graph(one), graph(two), loops=loops, limits=LARGE)
    assert rows(df) == want
    text = final_plan(df)
    assert "SortMergeJoin" in text and "Aggregate" not in text and "in_slot" not in text
    df = fg.two_paths(graph(one), loops=loops, limits=LARGE)
    assert rows(df) == brute_paths(one, loops)
    assert "Aggregate" not in final_plan(df)


@pytest.mark.parametrize("few", [20, 60])
def test_memory_of_a_task_is_bounded_where_nodes_are_split(graph, monkeypatch, few):
    """Partitions of a stated number are not merged: cells alone, or also the rows that meet grids."""
    one, two = random_edges(13), random_edges(14)
    limits = fg.Limits(broadcast_rows=0, rows=few, max_share=1_000, path_rows=3, task_paths=50, copies=2)
    want = sorted((a, b, d) for a, b in one for c, d in two if b == c)
    stated = []
    for size in (500_000, 10):
        monkeypatch.setattr(paths, "TASK_ROWS", size)
        df = fg.two_paths_between(graph(one), graph(two), limits=limits)
        assert rows(df) == want
        stated.append(len(re.findall("REPARTITION_BY_NUM", final_plan(df))))
    assert stated[1] > stated[0]


def test_sizes_of_three_relations_are_taken_at_once(spark, graph, monkeypatch):
    three = [random_edges(seed) for seed in (5, 6, 7)]
    merged = [fg.multiplicity(graph(e)) for e in three]
    m, through, light, ends = closing._sizes_in_turn(merged, fg.Limits())
    sets = [set(e) for e in three]
    for k in range(3):
        one, two = sets[k], sets[(k + 1) % 3]
        assert m[k] == len(one)
        assert through[k] == sum(b == c for _, b in one for c, _ in two)
        out = max(sum(a == n for a, _ in one) for n in range(9))
        into = max(sum(b == n for _, b in two) for n in range(9))
        assert ends[k] == min(out, into) and light[k]
    assert closing._sizes_in_turn(merged, fg.Limits(copies=1))[2] == [False] * 3
    text = final_plan(fg.closed_walks_between(*map(graph, three), strategy="shuffle"))
    assert "in_slot" not in text and len(re.findall(r"(?<!Reused)Exchange hashpartitioning", text)) <= 7


@pytest.mark.parametrize("how", [{}, {"strategy": "shuffle"}])
def test_only_paths_that_may_close_are_moved(spark, graph, how):
    """Of 100,000 paths three have a start that some edge leads to."""
    e = graph([(1, 2), (2, 3), (3, 1), (3, 1)])
    paths = spark.range(100_000).selectExpr("IF(id < 3, id + 1, id + 10) AS start_node", "id % 3 + 1 AS mid_node", "(id + 2) % 3 + 1 AS end_node")
    paths = paths.unionAll(paths.filter("start_node = 1"))
    closed = fg.close_paths(paths, e, "closed", **how)
    listed = [tuple(r) for r in paths.collect()]
    edges = [(1, 2), (2, 3), (3, 1), (3, 1)]
    assert rows(closed) == sorted(p for p in listed for f, g in edges if (f, g) == (p[2], p[0]))
    text = final_plan(closed)
    assert text.index("BroadcastHashJoin") > text.index("Aggregate")  # plans are printed from the end


def test_ids_of_saved_walks_are_parsed_once(spark, tmp_path):
    fg.write_tsv(spark.sql("SELECT 1 AS a, 2 AS b, 3 AS c"), str(tmp_path / "w"))
    saved = fg.read_walks(spark, str(tmp_path / "w"), ["a", "b", "c"]).filter("a <> c AND b IS NOT NULL")
    assert rows(saved) == [(1, 2, 3)]
    assert "split(" not in "".join(re.findall(r"Filter .*", final_plan(saved)))


def test_a_line_is_split_once_for_all_its_ids(spark, tmp_path):
    fg.write_tsv(spark.sql("SELECT 1 AS a, 2 AS b, 3 AS c"), str(tmp_path / "w"))
    saved = fg.read_walks(spark, str(tmp_path / "w"), ["a", "b", "c"])
    assert rows(saved) == [(1, 2, 3)]
    assert len(re.findall(r"\bsplit\(", final_plan(saved))) == 1


@pytest.mark.parametrize("strategy", ["auto", "shuffle"])
def test_paths_are_moved_once_unless_ends_are_crowded(spark, graph, strategy):
    """Where no two ends have more paths than a task is to hold, paths go straight to the edges; a path
    that is there very often is merged first, and ends that are shared by many get slots."""
    edges = [(n, n % 7) for n in range(40)]
    few = [(n % 7, n, n) for n in range(40)] + [(1, 5, 9)] * 3 + [(0, 3, 0), (None, 1, 2)]
    for paths, slots in (few, False), (few + [(0, 1, 7)] * 100, True), (few + [(0, n, 7) for n in range(100)], True):
        given = spark.createDataFrame(paths, "start_node long, mid_node long, end_node long")
        limits = fg.Limits(broadcast_rows=0, rows=50)
        closed = fg.close_paths(given, graph(edges), "closed", strategy=strategy, limits=limits)
        assert rows(closed) == sorted(p for p in paths if (p[2], p[0]) in edges)
        assert ("slot" in final_plan(closed)) == slots


def test_saved_paths_are_packed(spark, graph, tmp_path, monkeypatch):
    """2-paths are many times the edges; shuffle files of the job that saves them don't stay."""
    e = graph([(a, b) for a in range(60) for b in range(60)])
    paths = fg.two_paths(e, loops=False)
    size = lambda name: sum(p.stat().st_size for p in (tmp_path / name).glob("part-*"))
    fg.write_tsv(paths, str(tmp_path / "plain"))
    fg.write_tsv(paths, str(tmp_path / "packed"), compression="gzip")
    assert size("plain") > 3 * size("packed")
    read = lambda name: fg.read_walks(spark, str(tmp_path / name), ["start_node", "mid_node", "end_node"])
    assert rows(read("packed")) == rows(read("plain"))
    saved = []
    monkeypatch.setattr(entry.fg, "write_tsv", lambda *a, write=fg.write_tsv, **how: saved.append(a[1]) or write(*a, **how))
    spark.sql("SELECT 1L AS l_partkey, 2L AS l_suppkey UNION ALL SELECT 2L, 3L UNION ALL SELECT 3L, 1L").write.parquet(str(tmp_path / "lineitem.parquet"))
    assert rows(entry.queries()["close_saved_paths"](spark, str(tmp_path))) == [(1, 2, 3), (2, 3, 1), (3, 1, 2)]
    files = list(Path(saved[0].removeprefix("file:")).glob("part-*"))
    assert files and all(p.suffix == ".gz" for p in files)


@pytest.mark.parametrize("walks", cycles.WALKS)
@pytest.mark.parametrize("limits", [fg.Limits(broadcast_rows=0), fg.Limits(broadcast_rows=0, rows=5, max_share=50, wedge_rows=1, path_rows=2, copies=2, repeats=2)])
def test_edges_that_are_on_no_walk_go_first(graph, monkeypatch, walks, limits):
    monkeypatch.setattr(cycles, "MANY_EDGES", 10)
    core = random_edges(8) + [(1, 2), (2, 1), (3, 3)]
    pairs = core + [(n % 9, n) for n in range(100, 300)]
    e = graph(pairs)
    taken = []
    monkeypatch.setattr(cycles, "keep_core", lambda *a, keep=cycles.keep_core: taken.append(1) or keep(*a))
    assert rows(fg.triangles(e, walks, limits=limits)) == brute_walks(pairs, walks)
    for method in cycles.METHODS:
        got = fg.triangle_count(e, walks, method=method, limits=limits).first()[0]
        assert got == len(brute_walks(pairs, walks)) // 3
    assert len(taken) == 3
    # where all are on a cycle of nodes, nothing is looked for
    fg.triangle_count(graph(core), walks, limits=limits)
    assert len(taken) == 3
