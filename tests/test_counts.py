from collections import Counter
from decimal import Decimal

import pytest
from conftest import TOY, TOY2, brute_paths, random_edges, rows

import followgraph as fg


def test_follower_count(graph):
    e = graph([(1, 100), (2, 100), (2, 100), (1, 0), (1, -100), (1, 150), (1, 99)])
    assert rows(fg.follower_count(e)) == [(-100, 1), (0, 1), (100, 3)]
    assert rows(fg.follower_count(e, 50)) == [(-100, 1), (0, 1), (100, 3), (150, 1)]
    assert rows(fg.follower_count(e, None)) == [(-100, 1), (0, 1), (99, 1), (100, 3), (150, 1)]


def test_follower_count_of_the_sample_is_empty(graph):
    assert rows(fg.follower_count(graph(TOY))) == []


def test_follower_group_size(graph):
    e = graph([(1, 100), (2, 100), (2, 100), (3, 7)])
    assert rows(fg.follower_group_size(e)) == [(100, 3, 2)]
    assert rows(fg.follower_group_size(e, None)) == [(7, 1, 1), (100, 3, 2)]


def test_degrees(graph):
    assert rows(fg.degrees(graph(TOY))) == [(1, 1, 2), (2, 3, 2), (3, 2, 2), (11, 1, 1)]
    assert rows(fg.degrees(graph(TOY2))) == [(1, 1, 3), (2, 5, 3), (3, 2, 2), (5, 1, 1), (11, 1, 1)]


def test_degree_product_keeps_nodes_without_one_side(graph):
    assert rows(fg.degree_product(graph([(1, 2)]))) == [(1, 0), (2, 0)]
    assert rows(fg.degree_product(graph(TOY2))) == [(1, 3), (2, 15), (3, 4), (5, 1), (11, 1)]


@pytest.mark.parametrize(
    "pairs, max_id, loops, expected",
    [
        (TOY, 6, True, 8),
        (TOY, 6, False, 4),
        (TOY, 10_000, True, 13),
        (TOY, 10_000, False, 9),
        (TOY2, None, True, 24),
        (TOY2, None, False, 16),
        (TOY, -5, True, 0),
        (TOY, -5, False, 0),
    ],
)
def test_two_path_count(graph, pairs, max_id, loops, expected):
    counted = fg.two_path_count(graph(pairs), max_id, loops=loops)
    assert rows(counted) == [(expected,)]
    assert counted.dtypes == [("two_path_count", "bigint")]
    wide = fg.two_path_count(graph(pairs), max_id, loops=loops, wide=True)
    assert rows(wide) == [(Decimal(expected),)]


@pytest.mark.parametrize("seed", range(3))
def test_two_path_count_is_the_number_of_paths(graph, seed):
    pairs = random_edges(seed)
    for loops in (True, False):
        expected = len(brute_paths(pairs, loops))
        assert rows(fg.two_path_count(graph(pairs), loops=loops)) == [(expected,)]


def test_two_path_count_by_max(graph):
    pairs = random_edges(4, nodes=20)
    expected = sorted(
        (m, len(brute_paths([p for p in pairs if max(p) < m]))) for m in (-1, 3, 10, 100)
    )
    assert rows(fg.two_path_count_by_max(graph(pairs), [-1, 3, 10, 100])) == expected


def test_cut_off_is_strict_and_covers_both_ends(graph):
    assert rows(fg.under_max(graph([(5, 6), (6, 5), (5, 5), (-7, 5)]), 6)) == [(-7, 5), (5, 5)]
    assert fg.under_max(graph(TOY), None).count() == len(TOY)


def test_big_products_raise_unless_wide(spark, graph):
    hub = spark.sql(
        "SELECT * FROM VALUES (CAST(4000000000 AS BIGINT), CAST(4000000000 AS BIGINT)) d(i, o)"
    )
    from followgraph.operators.degrees import _product

    with pytest.raises(Exception, match="ARITHMETIC_OVERFLOW"):
        hub.select(_product(False, "i", "o")).collect()
    assert hub.select(_product(True, "i", "o")).first()[0] == 16 * 10**18


def test_string_ids(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "a"), ("a", "01")], "follower string, followee string")
    assert rows(fg.degrees(e)) == [("01", 1, 0), ("a", 1, 2), ("b", 1, 1)]
    assert rows(fg.two_path_count(e)) == [(3,)]


def test_multiplicity_and_reverse(graph):
    e = graph(TOY2)
    assert rows(fg.multiplicity(e)) == sorted((a, b, n) for (a, b), n in Counter(TOY2).items())
    assert fg.reverse(e).columns == ["follower", "followee"]
    assert rows(fg.reverse(e)) == sorted((b, a) for a, b in TOY2)
    assert rows(fg.reverse(fg.reverse(e))) == sorted(TOY2)
    assert rows(fg.degrees(fg.reverse(e))) == sorted((n, o, i) for n, i, o in rows(fg.degrees(e)))


def test_null_ends_count_nowhere(graph):
    e = graph([(1, 2), (None, 2), (3, None)])
    assert rows(fg.follower_count(e, None)) == [(2, 1)]
    assert rows(fg.follower_group_size(e, None)) == [(2, 1, 1)]
    assert rows(fg.follower_group_size(e, None, distinct=False)) == [(2, 1)]
    assert rows(fg.degrees(e)) == [(1, 0, 1), (2, 1, 0)]


def test_two_path_weights_are_exact(spark):
    """Products and sums beyond BIGINT, negative weights, nulls, no rows."""
    big = 1 << 54
    edges = [(1, 2, big - 1), (2, 3, big - 3), (2, 3, 5), (3, 1, -7), (1, 1, 12345678901), (4, 2, None), (None, 2, 9), (5, 6, 1 << 30)]
    df = spark.createDataFrame(edges, "follower long, followee long, w long")
    into, out = Counter(), Counter()
    for a, b, w in edges:
        if a is not None:
            into[b] += w or 0
            out[a] += w or 0
    exact = {n: into[n] * out[n] for n in {*into, *out}}
    got = {r.node: r.weight_high * 10**18 + r.weight_low for r in fg.two_path_weights(df, "w").collect()}
    assert got == exact and max(exact.values()) > 1 << 63 and min(exact.values()) < 0
    (total,) = rows(fg.two_path_weight(df, "w"))
    assert total[0] * 10**18 + total[1] == sum(exact.values())
    assert rows(fg.two_path_weight(df.limit(0), "w")) == [(0, 0)]


def test_two_path_weights_refuse_what_limbs_cannot_hold(spark):
    df = spark.createDataFrame([(1, 2, 1 << 56), (2, 3, 1)], "follower long, followee long, w long")
    with pytest.raises(Exception, match="2\\^56"):
        fg.two_path_weight(df, "w").collect()
