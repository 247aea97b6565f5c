import random

import pytest
from pyspark.sql import functions as F

from followgraph.llm import substring_dedup as R

SCHEMA = "doc_id long, text string"


def brute(rows, window):
    first = {}
    split = [(i, (t or "").split()) for i, t in rows]
    order = lambda i: -(2**63) if i is None else i
    for i, w in split:
        for k in range(len(w) - window + 1):
            g = tuple(w[k : k + window])
            first[g] = min(first.get(g, (order(i), k)), (order(i), k))
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < (order(i), k):
                gone |= set(range(k, k + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("window, chunk", [(20, 8 << 20), (20, 500), (7, 300), (4, 8 << 20)])
def test_against_brute_force(spark, monkeypatch, window, chunk):
    monkeypatch.setattr(R, "CHUNK", chunk)
    rng = random.Random(window)
    shared = [[f"s{rng.randrange(50)}" for _ in range(rng.choice([window - 1, window, window + 3, 60]))] for _ in range(6)]
    rows = []
    for i in range(60):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(80))]
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = rng.choice(shared)
        rows.append((rng.randrange(1000), rng.choice([" ", "\n", "\t "]).join(words)))
    rows += [(5000 + i, " ".join(shared[3])) for i in range(30)] + [(7000, "x " * 100), (7001, "a b " * 60), (7002, None), (7003, ""), (7004, "A B " * 30)]
    rows += [rows[0], rows[1], (rows[2][0], rows[3][1]), (None, rows[4][1]), (None, " ".join(shared[5])), (6, "y " * 50_000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit("clash")).withColumn("slot", F.lit(1)).withColumn("runs", F.lit("x"))
    got = R.remove_repeats(df, window).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str) == brute(rows, window)


def test_empty(spark):
    df = spark.createDataFrame([(1, "a b")], SCHEMA)
    assert R.remove_repeats(df.limit(0)).count() == 0
    assert [tuple(r) for r in R.remove_repeats(df).collect()] == [(1, 2, 0, "a b")]
