import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from followgraph.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_counts(rows):
    counts = defaultdict(Counter)
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for n in range(1, 6):
                for i in range(len(words) - n + 1):
                    counts[lang or "und"][tuple(words[i : i + n])] += 1
    return counts


def brute(rows, least, most):
    out = []
    for lang, f in brute_counts(rows).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        found = []
        for p, a in candidates.items():
            inside = any(
                len(q) > len(p) and 100 * candidates[q] >= 100 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q in candidates
            )
            if inside:
                continue
            score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, rank, p.decode(), -a, l, r, n, -s) for rank, (s, a, p, l, r) in enumerate(sorted(found)[:most], 1)]
    return sorted(out)


def corpus(seed, docs=120):
    rng = random.Random(seed)
    words = ["the", "of", "New", "York", "city", "é", "ÉA", "x-y", "#", "a b"] + [f"w{k}" for k in range(20)]
    fixed = ["new york city hall of", "the of the of the", "san juan de la", "q q q q q q q"]
    rows = []
    for i in range(docs):
        parts = []
        for _ in range(rng.randrange(30)):
            parts.append(rng.choice(fixed) if rng.random() < 0.2 else words[min(int(rng.expovariate(0.2)), len(words) - 1)])
            parts.append(rng.choice([" "] * 8 + ["\t", ", ", ".", "\n", " \x0c", "!?"]))
        rows.append((i, "".join(parts), rng.choice(["en", "en", "en", "de", None, "und"])))
    return rows


@pytest.mark.parametrize("seed, least, most, held", [(1, 8, 2000, 1 << 21), (2, 3, 2000, 50), (3, 25, 5, 200), (4, 1, 2000, 1 << 21)])
def test_against_brute_force(spark, monkeypatch, seed, least, most, held):
    monkeypatch.setattr(C, "HELD", held)
    monkeypatch.setattr(C, "CHUNK", 300)
    rows = corpus(seed)
    got = C.collocations(spark.createDataFrame(rows, SCHEMA).repartition(3), least=least, most=most)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, least, most)


@pytest.mark.parametrize("bits, fan", [(7, 3), (9, 2), (5, 8)])
def test_levels_of_the_exchange(spark, monkeypatch, bits, fan):
    monkeypatch.setattr(C, "FAN", fan)
    monkeypatch.setattr(C, "partition_bits", lambda volume: bits)
    rows = corpus(8)
    got = C.collocations(spark.createDataFrame(rows, SCHEMA).repartition(4), least=6)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 6, 2000)


def test_a_full_table_of_survivors_costs_time_only(spark, monkeypatch):
    monkeypatch.setattr(C, "BITS", 14)
    monkeypatch.setattr(C, "HELD_PHRASES", 40)
    rows = corpus(9, docs=600)
    got = C.collocations(spark.createDataFrame(rows, SCHEMA), least=6)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 6, 2000)


@pytest.mark.parametrize("seed", range(6))
def test_merged_summaries_keep_what_is_frequent(seed):
    """However the counters are cut into summaries and merged, what occurs `least` times is left,
    with no more counters than the capacity."""
    rng = np.random.default_rng(seed)
    least = 20
    items = (rng.zipf(1.2, 6000) % 3000).astype(np.uint64)
    mass = len(items)
    capacity = mass // least + 1
    held, off = (np.empty(0, np.uint64), np.empty(0, np.int64)), 0
    for piece in np.array_split(items, rng.integers(2, 40)):
        h, c = C.summed(piece)
        h, c = C.summed(np.concatenate([held[0], h]), np.concatenate([held[1], c]))
        h, c, took = C.shrunk(h, c, capacity)
        held, off = (h, c), off + took
        assert len(h) <= capacity
    assert off < least
    true = Counter(items.tolist())
    left = dict(zip(held[0].tolist(), held[1].tolist()))
    assert {k for k, v in true.items() if v >= least} <= {k for k, v in left.items() if v + off >= least}
    assert all(v - off <= left.get(k, 0) <= v for k, v in true.items())


def test_odd_input(spark):
    rows = [(1, None, None), (2, "", "en"), (3, " \t.", "en"), (None, "a b", "en"), (3, "a b", "en"), (3, "A  b\tc", "en"), (4, "a b", None)]
    rows.append((5, "long tail " * 20000, "xx"))
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS phrase", "2 AS stratum", "3 AS f")
    got = C.collocations(df, least=2)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 2, 2000)
    assert got.columns == ["stratum", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert C.collocations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_products_beyond_64_bits(spark, monkeypatch):
    big = 3_000_000_000_000
    phrases = spark.createDataFrame(
        [("en", 1, "a", big + 1), ("en", 1, "b", big + 7), ("en", 2, "a b", big)], "stratum string, words int, phrase string, f long"
    )
    sums = spark.createDataFrame([("en", 9 * big)], "stratum string, n long")
    monkeypatch.setattr(C, "frequent_phrases", lambda *a: (phrases, sums))
    row = C.collocations(phrases).collect()[0]
    assert row.score == 1000 * big * 9 * big // ((big + 1) * (big + 7))
