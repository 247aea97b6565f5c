import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from followgraph.llm import minhash_dedup as M
from followgraph.llm.components import components

SCHEMA = "doc_id long, text string"


def brute(rows, percent):
    sets = {}
    for i, text in rows:
        w = bytes(text or "", "utf-8").lower().split()
        s = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
        sets.setdefault(i, []).append(s)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations(sorted(sets), 2):
        if any(a and b and 100 * len(a & b) >= percent * len(a | b) for a in sets[i] for b in sets[j]):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return sorted((i, len(s), find(i)) for i, all_ in sets.items() for s in all_)


def family(rng, size, words, edits):
    """A text and changed copies of it, each with up to `edits` changed words."""
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(size):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("percent", [80, 85])
def test_against_brute_force(spark, percent):
    rng = random.Random(percent)
    texts = family(rng, 120, 100, 6) + family(rng, 40, 60, 2) + family(rng, 30, 300, 25)
    texts += [texts[0]] * 5 + [texts[1].upper()] + ["a b c", "A  B\tc", "a b", "", None, " \n"]
    rng.shuffle(texts)
    rows = list(enumerate(texts, 5))
    got = M.near_duplicates(spark.createDataFrame(rows, SCHEMA), percent=percent).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(1, text), (2, text), (2, text), (3, "other words here"), (3, text), (None, text), (None, None), (4, "Other words here")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("component", F.lit("clash")).withColumn("n", F.lit(0))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in M.near_duplicates(df).collect()), key=str)
    want = [(1, 46, 1, True), (2, 46, 1, False), (2, 46, 1, False), (3, 1, 1, False), (3, 46, 1, False), (4, 1, 1, False)]
    want += [(None, 46, None, True), (None, 0, None, True)]
    assert got == sorted(want, key=str)
    assert M.near_duplicates(df.limit(0)).count() == 0


def test_bayesian_bounds():
    assert M.band_rows(85) == 5 and M.band_rows(80) == 4
    assert all((1 - (p / 100) ** M.band_rows(p)) ** (120 // M.band_rows(p)) <= 1e-6 for p in range(50, 100))
    table = M.least_matches(0.85, 1e-6)
    assert [n for n, _ in table] == [24, 48, 72, 96, 120]
    assert all(0 < m < n * 0.85 for n, m in table)
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**32, (2000, M.MINIMA), dtype=np.uint32)
    b = np.where(rng.random(a.shape) < 0.85, a, a + 1).astype(np.uint32)
    c = np.where(rng.random(a.shape) < 0.4, a, a + 1).astype(np.uint32)
    assert len(M.alive(a, b, 0.85)) == len(a)
    assert len(M.alive(a, c, 0.85)) < 5


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (300, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(60)} | {300: 200, 200: 200}


def test_shared_ids_of_different_texts_with_half_similar_partners(spark):
    """An id that stands for two classes in buckets whose candidates are no links."""
    rng = random.Random(12)
    rows = []
    for k in range(0, 400, 10):
        for text in family(rng, 1, 90, 0) + family(rng, 1, 90, 0):
            rows.append((k, text))
            for i in range(1, 4):
                words = text.split()
                for at in rng.sample(range(90), i + 2):
                    words[at] = f"y{rng.randrange(10**6)}"
                rows.append((k + i + rng.randrange(3), " ".join(words)))
    rng.shuffle(rows)
    got = M.near_duplicates(spark.createDataFrame(rows, SCHEMA), percent=80).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, 80)


def test_what_the_pivot_has_settled_is_not_compared_again(spark):
    """Of a bucket of two nothing is left, of a larger one only classes beside the pivot."""
    rows = [(1, 10, 100, 10), (1, 11, 110, 10)]  # a pair without a link
    rows += [(2, 20, 200, 20), (2, 21, 210, 20), (2, 22, 220, 20)]  # 21 and 22 are linked to each other
    rows += [(3, 30, 300, 30), (3, 31, 310, 30), (3, 32, 320, 30), (3, 33, 330, 30)]  # 31 with 32, 33 alone
    members = spark.createDataFrame(rows, "band long, id long, mark long, pivot long")
    known = spark.createDataFrame([(21, 21), (22, 21), (31, 31), (32, 31)], "node long, component long")
    got = sorted((r.band, r.id, r.n, r.rest) for r in M._open_members(members, known).collect())
    assert got == [(3, 31, 3, False), (3, 32, 3, False), (3, 33, 3, True)]


def test_links_that_only_the_rest_of_a_bucket_shows(spark, monkeypatch):
    """Every candidate of the pivot is rejected; the others are linked among themselves, in
    several blocks."""
    monkeypatch.setattr(M, "BLOCK", 8)
    rng = random.Random(4)
    rows = [(i, text) for i, text in enumerate(family(rng, 60, 80, 9))]
    df = spark.createDataFrame(rows, SCHEMA)
    got = M.near_duplicates(df, percent=80).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, 80)


def test_spent_tables_are_deleted(spark):
    from pathlib import Path
    from urllib.parse import urlparse

    from followgraph.llm.common import shared_dir

    folder = Path(urlparse(shared_dir(spark)).path)
    before = set(folder.iterdir()) if folder.exists() else set()  # other sessions may share it
    M.near_duplicates(spark.createDataFrame([(i, f"a b c d e {i % 3}") for i in range(9)], SCHEMA)).count()
    left = {p.name.split("-")[0] for p in set(folder.iterdir()) - before}
    assert "signatures" in left and not left & {"members", "pairs", "open", "partners", "survivors"}
