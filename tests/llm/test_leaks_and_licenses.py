import random
import re

import pytest
from pyspark.sql import functions as F

from followgraph.llm import decontamination as D
from followgraph.llm import license_scan as L
from followgraph.llm import queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(docs, items, width=10):
    grams = {}
    for i, text in items:
        w = WORD.findall(low(text))
        for k in range(max(len(w) - width, 0) + 1 if w else 0):
            grams.setdefault(tuple(w[k : k + width]), set()).add(i)
    out = []
    for i, text in docs:
        w, hit, who = WORD.findall(low(text)), set(), set()
        for g, ids in grams.items():
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k : k + len(g)]) == g:
                    hit |= set(range(k, k + len(g)))
                    who |= ids
        out.append((i, len(w), sorted(hit), sorted(str(x) for x in who if x is not None)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(8)
    words = "the a of É é straße 42 x1 longest-word inthe middle und".split() + [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([3, 9, 10, 11, 30])))) for i in range(12)]
    items += [(3, items[0][1]), (50, items[4][1].upper()), (51, None), (52, "..."), (None, items[5][1]), (53, "Zz")]
    docs = []
    for i in range(40):
        body = [rng.choice(words) for _ in range(rng.randrange(60))]
        if i % 2:
            body[5:5] = re.split(r"[ ]", items[rng.randrange(12)][1])
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(body).title() if i % 3 else " ".join(body)))
    docs += [(40, None), (41, ""), (42, "ZZ zz, zZ!"), (7, docs[7][1]), (None, items[1][1]), (43, "w1 " * 30000)]
    return docs, items


def frames(spark, cases):
    docs, items = cases
    return (
        spark.createDataFrame(docs, "doc_id long, text string").withColumn("words", F.lit("clash")).withColumn("item", F.lit(1)),
        spark.createDataFrame(items, "item_id long, text string"),
    )


@pytest.mark.parametrize("most", [10, 200_000])
def test_leaks(spark, cases, most):
    docs, items = frames(spark, cases)
    got = D.report(docs, items, most=most).collect()
    assert sorted(((r.doc_id, r.n_words, r.hit, r["items"]) for r in got), key=str) == brute(*cases)
    assert all(r.contaminated == bool(r.hit) for r in got)


def test_removal(spark, cases):
    docs, items = frames(spark, cases)
    hit = {(i, t) for (i, t) in cases[0] for b in [brute([(i, t)], cases[1])[0]] if b[2]}
    left = D.decontaminate(docs, items)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted([c for c in cases[0] if c not in hit], key=str)
    cut = D.decontaminate(docs, items, remove="spans").collect()
    assert len(cut) == len(cases[0])
    before = {i: (t, brute([(i, t)], cases[1])[0][2]) for i, t in cases[0]}
    for r in cut:
        text, gone = before[r.doc_id]
        if text is None:
            assert r.text is None
        else:
            assert [w for k, w in enumerate(WORD.findall(low(text))) if k not in set(gone)] == WORD.findall(low(r.text))
    assert D.report(docs.limit(0), items).count() == 0
    assert D.report(docs, items.limit(0)).where("contaminated").count() == 0
    with pytest.raises(ValueError):
        D.decontaminate(docs, items, remove="all")


LICENSED = {
    "Licensed under CC BY-NC 4.0.": ("cc-by", "cc-by,cc-by-nc-4.0"),
    "This work is licensed under the GNU General Public License, version 3.": ("gpl", "gpl,gpl-3.0"),
    "GNU General Public License version 2 or any later version": ("gpl", "gpl,gpl-2.0-or-later"),
    "Released under the MIT License.": ("", "mit"),
    "Licensed under the Apache License, Version 2.0.": ("", "apache-2.0"),
    "Mozilla Public License 2.0": ("", "mpl-2.0"),
    "ALL RIGHTS RESERVED, all rights  reserved": ("reserved", "reserved"),
    "der Mann mit der Lizenz": ("", ""),
    "a cc bye general public licenses": ("", ""),
    "SPDX-License-Identifier: BSD-3-Clause": ("", None),
}


def test_licenses(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(LICENSED)] + [(100, None), (101, ""), (0, "Licensed under CC BY-NC 4.0."), (102, "w " * 40000 + "cc by")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("line", F.lit("x")).withColumn("label", F.lit("x"))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op8(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i, (text, (base, labels)) in enumerate(LICENSED.items()):
        assert by_id[i].base_labels == base, text
        assert labels is None or by_id[i].labels == labels, text
        assert by_id[i].n_words == len(WORD.findall(low(text)))
        places = [k for p in L.BASE for w in [WORD.findall(low(text))] for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        assert (by_id[i].n_base, by_id[i].first_word, by_id[i].last_word) == (len(places), min(places, default=None), max(places, default=None))
        assert (by_id[i].score > 0) == bool(by_id[i].labels)
    assert (by_id[102].first_word, by_id[102].n_words, by_id[100].n_words, by_id[100].labels) == (40000, 40002, 0, "")
    assert L.scan(df.limit(0)).count() == 0


def test_rules_contain_their_keyword():
    table = L.rules()
    assert len(table) > 200 and table == sorted(table, key=lambda r: (-r.priority, r.label, r.pattern))


def expanded(pattern):
    """Every text of a pattern's alternatives and options; repeats once, `.` as x."""
    from re import _parser

    def of(parsed):
        out = [""]
        for op, value in parsed:
            name = str(op)
            if name == "LITERAL":
                new = [chr(value)]
            elif name == "ANY":
                new = ["x"]
            elif name == "IN":
                new = [chr(v) if str(o) == "LITERAL" else chr(v[0]) for o, v in value]
            elif name == "BRANCH":
                new = [x for branch in value[1] for x in of(branch)]
            elif name == "SUBPATTERN":
                new = of(value[3])
            else:
                assert name in ("MAX_REPEAT", "MIN_REPEAT"), name
                new = ([""] if value[0] == 0 else []) + of(value[2])
            out = [a + b for a in out for b in new]
        return out

    return of(_parser.parse(pattern))


def test_every_match_contains_a_keyword_of_its_rule():
    """Rules of several keywords stand in the table once for each of them."""
    keywords = {}
    for r in L.rules():
        keywords.setdefault((r.label, r.pattern), set()).add(r.keyword)
    for (label, pattern), own in keywords.items():
        for text in expanded(pattern):
            assert any(k in text for k in own), (label, text, own)


def test_mit_x11_is_mit(spark):
    got = L.scan(spark.createDataFrame([(1, "Under the MIT X11 License.")], "doc_id long, text string")).first()
    assert "mit" in {d.label for d in got.detections}
