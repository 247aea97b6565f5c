import random
import sys
from itertools import product
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TOY = [(1, 2), (1, 3), (2, 1), (2, 3), (3, 2), (3, 11), (11, 2)]
TOY2 = TOY + [(1, 2), (2, 2), (5, 5)]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("followgraph-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def graph(spark):
    """Edge DataFrame from a list of pairs."""
    return lambda pairs: spark.createDataFrame(pairs, "follower bigint, followee bigint")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def random_edges(seed, nodes=9, edges=45):
    """A multigraph with self-loops, repeated edges and one node in about a third of them."""
    rng = random.Random(seed)
    pick = lambda: 0 if rng.random() < 0.2 else rng.randrange(nodes)
    return [(pick(), pick()) for _ in range(edges)]


def brute_paths(pairs, loops=True):
    return sorted(
        (a, b, d) for (a, b), (c, d) in product(pairs, pairs) if b == c and (loops or a != d)
    )


def brute_walks(pairs, walks):
    found = []
    for (a, b), (b2, c), (c2, a2) in product(pairs, pairs, pairs):
        if b != b2 or c != c2 or a != a2:
            continue
        if walks != "closed" and a == c:
            continue
        if walks == "strict" and (a == b or b == c):
            continue
        found.append((a, b, c))
    return sorted(found)
