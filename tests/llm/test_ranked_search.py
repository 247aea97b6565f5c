import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from followgraph.llm import ranked_search as S

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, most=20):
    counted = [(i, Counter(split(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in counted:
            m = 100 - 25 + (25 * sum(c.values()) * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t in split(text)
                if t in c
            )
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, rank, f[3], -f[0]) for rank, f in enumerate(sorted(found)[:most], 1)]
    return sorted(out, key=str)


def corpus(seed, docs=300, items=12):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["É", "a1", "Über"]
    pick = lambda: words[min(int(rng.expovariate(0.12)), len(words) - 1)]
    made = []
    for i in range(docs):
        own = [pick() for _ in range(rng.choice([1, 5, 20, 60]))]
        made.append((i, rng.choice([" ", ", ", "\n", "-"]).join(own)))
        if rng.random() < 0.3:
            made.append((rng.randrange(10_000, 20_000), made[-1][1]))  # exact copies: ties
    return made, [(k, " ".join(pick().upper() for _ in range(rng.randrange(1, 25)))) for k in range(items)]


@pytest.mark.parametrize("seed, tree_docs, tree_terms, least", [(1, 1 << 15, 1 << 20, 24), (2, 40, 1 << 20, 2), (3, 1 << 15, 200, 2), (4, 100, 500, 3)])
def test_against_brute_force(spark, monkeypatch, seed, tree_docs, tree_terms, least):
    docs, items = corpus(seed)
    monkeypatch.setattr(S, "TREE_DOCS", tree_docs)
    monkeypatch.setattr(S, "TREE_TERMS", tree_terms)
    monkeypatch.setattr(S, "LEAST_DOCS", least)
    got = S.ranked_search(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items)


def test_items_in_blocks(spark, monkeypatch):
    docs, items = corpus(7)
    monkeypatch.setattr(S, "BLOCK_TERMS", 20)
    got = S.ranked_search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), most=3)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items, 3)


def trees(docs, least):
    vocabulary = {t: k for k, (t, _) in enumerate(Counter(t for _, x in docs for t in set(split(x))).most_common())}
    rows = [(i, sorted(Counter(vocabulary[t] for t in split(x)).items()), len(split(x))) for i, x in docs]
    starts = np.concatenate([[0], np.cumsum([len(v) for _, v, _ in rows])])
    term = np.array([t for _, v, _ in rows for t, _ in v])
    tf = np.array([f for _, v, _ in rows for _, f in v])
    ids = np.array([i for i, _, _ in rows], object)
    m = np.array([75 + n for _, _, n in rows])
    return S.Tree(S.Vectors(ids, m, starts, term, tf), len(vocabulary), least), vocabulary, dict((i, (dict(v), 75 + n)) for i, v, n in rows)


@pytest.mark.parametrize("least", [2, 5, 24])
def test_nodes_are_shared_beginnings_with_maxima_and_minima(least):
    docs, _ = corpus(5)
    tree, vocabulary, vectors = trees(docs, least)

    def below(unit):
        if 0 <= unit < tree.docs:
            return [unit]
        return [d for c in tree.children(unit) for d in below(c)]

    assert sorted(below(-1)) == list(range(tree.docs))
    nodes = range(tree.docs, len(tree.least))
    assert len(nodes) > 3
    for node in nodes:
        docs_below = below(node)
        assert len(docs_below) >= least
        assert tree.least[node] == min(tree.least[d] for d in docs_below)
        own = tree.keys[tree.keys // tree.terms == node] % tree.terms
        most = dict(zip(own.tolist(), tree.tf[tree.keys // tree.terms == node].tolist()))
        want: dict = {}
        for d in docs_below:
            for t, f in vectors[tree.ids[d]][0].items():
                want[t] = max(want.get(t, 0), f)
        assert most == want
        # all begin with the same term
        assert len({min(vectors[tree.ids[d]][0]) for d in docs_below}) == 1


def test_bounds_hold_and_prune():
    docs, items = corpus(6, docs=2000)
    tree, vocabulary, _ = trees(docs, 8)
    everything = np.arange(len(tree.least))
    for _, text in items:
        wanted = np.array(sorted({vocabulary[t] for t in split(text) if t in vocabulary}))
        weights = np.arange(1, len(wanted) + 1) * 50
        bounds = tree.bounds(everything, wanted, weights)
        for node in range(tree.docs, len(tree.least)):
            assert all(bounds[c] <= bounds[node] for c in tree.children(node))
        best, looked = S.search_tree(tree, wanted, weights, [])
        assert [s for s, _ in best] == sorted(bounds[: tree.docs][bounds[: tree.docs] > 0].tolist(), reverse=True)[:20]
        assert looked < len(tree.least)


def test_odd_input(spark):
    docs = [(1, None), (2, ""), (3, " .,;\x00"), (None, "alpha beta"), (5, "Alpha beta"), (5, "Alpha beta"), (6, "beta " * 20000), (7, "gamma x")]
    items = [(1, None), (2, ""), (3, "ALPHA"), (3, "ALPHA"), (None, "beta alpha beta"), (4, "missing"), (5, "gamma")]
    df = spark.createDataFrame(docs, DOCS).selectExpr("*", "'a' AS id", "1 AS n", "2 AS score")
    wanted = spark.createDataFrame(items, ITEMS).selectExpr("*", "'a' AS id", "1 AS item")
    got = S.ranked_search(df, wanted)
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and dict(got.dtypes)["rank"] == "int"
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items)
    none = spark.createDataFrame([], DOCS)
    assert S.ranked_search(none, wanted).count() == 0
    assert S.ranked_search(df, spark.createDataFrame([], ITEMS)).count() == 0


def test_ids_of_text(spark):
    docs = [("b", "x y"), ("a", "x y"), ("c", "x"), ("d", "z")]
    got = S.ranked_search(spark.createDataFrame(docs, "doc_id string, text string"), spark.createDataFrame([("q", "x y")], "item_id string, text string"))
    assert [r.doc_id for r in got.orderBy("rank").collect()] == ["a", "b", "c"]
