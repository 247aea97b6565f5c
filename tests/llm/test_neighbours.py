import math

import numpy as np

from followgraph.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, k, step):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v, _ in rows if i is not None and v is not None and len(v) == 24
          and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for q, x in {(q, tuple(x)) for q, x in ok if q % step == 0}:
        near = []
        for i, y in ok:
            if i != q:
                s = 0.0
                for a, b in zip(x, y):
                    s += a * b
                near.append((-s, i))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(near)[:k])]
    return sorted(out)


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vectors, "ROWS", 64)
    monkeypatch.setattr(vectors, "QUERIES", 8)
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(24).tolist(), "x") for i in range(300)]
    rows += [(1000 + i, rows[20][1], None) for i in range(40)] + [(40, rows[40][1], "again"), (60, rows[61][1], "same id")]
    bad = [None, [0.0] * 24, [float("nan")] + [1.0] * 23, [float("inf")] + [1.0] * 23, [None] + [1.0] * 23, [1.0] * 23, []]
    rows += [(2000 + i, v, "bad") for i, v in enumerate(bad)] + [(None, rows[1][1], "bad")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = vectors.search(df, df.where("vec_id % 20 = 0"), k=20).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute(rows, 20, 20)
    few = spark.createDataFrame(rows[:4], SCHEMA)
    assert vectors.search(few, few.where("vec_id = 0"), k=20).count() == 3
    assert vectors.search(df.limit(0), df).count() == 0
    assert vectors.search(df, df.limit(0)).count() == 0


def test_estimates_are_within_the_bound():
    rng = np.random.default_rng(6)
    v = rng.standard_normal((4000, 100))
    model = vectors.RotatedCodes(100, tuple(v.mean(axis=0)))
    codes, length, aligned = model.encode(v)
    assert codes.shape == (4000, 2) and (aligned > 0.6).all()
    rotated = (v - v.mean(axis=0)) @ model.rotation.T
    assert np.allclose(np.linalg.norm(rotated, axis=1), length)
    q = rng.standard_normal((50, 100))
    # recall at a small error bound is still high; the default bound is stricter
    hits = 0
    for i in range(50):
        got = vectors.search_block(model, np.array([-1]), q[i : i + 1], np.arange(4000), v, codes, length, aligned, 20, 2.0)
        hits += len({*got[1].tolist()} & {*np.argsort(-(v @ q[i]))[:20].tolist()})
    assert hits >= 0.9 * 50 * 20
