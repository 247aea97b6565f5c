import math
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from followgraph.llm import quality_rules as R

SCHEMA = "doc_id long, text string, lang string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


ODD = [None, "", " ", "\n\n", "a\n a\na\na b", "x " * 7, "x " * 8, "x " * 9, "a b c d e f g h " * 3, "é\x0bü\x1cß\tö#|<>", "w\n" * 30]


def test_counts_by_brute_force():
    rng = random.Random(3)
    texts = list(ODD)
    for _ in range(150):
        words = [rng.choice("abcdefghij") * rng.randrange(1, 3) for _ in range(rng.randrange(120))]
        for _ in range(rng.randrange(3)):
            at, size = rng.randrange(len(words) + 1), rng.randrange(7, 14)
            words += words[at : at + size]
        texts.append("".join(w + rng.choice([" ", " ", "\n", "\t"]) for w in words))
    got = R.text_counts(texts)
    want = [brute(t) for t in texts]
    for name in R.COUNTS:
        assert got[name].tolist() == [w[name] for w in want], name
    # the end of one text and the start of the next make no window
    assert R.text_counts(["a b c d", "e f g h a b c d", "e f g h"])["n_repeat_words"].tolist() == [0, 0, 0]


def test_strictness_by_hand():
    rng = np.random.default_rng(1)
    values = np.stack([rng.choice(np.concatenate([R.GRIDS[r], R.GRIDS[r] * 1.01]), 50) for r in R.RULES], axis=1)
    steps = R.strictness(values)
    for k, rule in enumerate(R.RULES):
        assert (np.diff(R.GRIDS[rule]) < 0).all()
        for v, s in zip(values[:, k], steps[:, k]):
            assert s == sum(v <= c for c in R.GRIDS[rule])


@pytest.mark.parametrize("n, k, p", [(10, 0, 0.05), (40, 3, 0.05), (100, 100, 0.3), (60, 59, 0.9)])
def test_binomial_tail_is_exact(n, k, p):
    q = Fraction(p)
    want = sum(math.comb(n, i) * q**i * (1 - q) ** (n - i) for i in range(k + 1))
    assert math.isclose(R.binomial_tail(k, n, p), float(want), rel_tol=1e-9)


def test_tests_end_at_the_first_that_fails_and_pass_on_their_level():
    n, alpha = 300, 0.05
    assert R.certified_slack(n, [20, 5, 0], alpha, 0.05) == 1
    assert R.certified_slack(n, [0, 20, 0], alpha, 0.05) == 2
    assert R.certified_slack(n, [0, 0, 20], alpha, 0.05) is None
    # 8 of 300 pass at 0.05 and not at 0.05 / 2
    assert 0.025 < R.binomial_tail(8, n, alpha) < 0.05
    assert R.holm({"a": (n, [8])}, alpha, 0.05) == {"a": 0}
    assert R.holm({"a": (n, [8]), "b": (n, [8])}, alpha, 0.05) == {}
    assert R.holm({"a": (n, [8]), "b": (n, [0])}, alpha, 0.05) == {"a": 0, "b": 0}


def test_false_rejections_are_limited():
    """Where every cutoff rejects too much, the chance to certify any of them is under delta."""
    rng = np.random.default_rng(5)
    n, alpha, delta, runs = 200, 0.05, 0.1, 400
    wrong = 0
    for _ in range(runs):
        strata = {}
        for name in "abcd":
            depth = rng.binomial(1, 0.06, n) * rng.integers(1, 4, n)  # 6 % of good texts are rejected even at the largest slack
            strata[name] = (n, [int((depth > 0).sum())] * 3)
        wrong += bool(R.holm(strata, alpha, delta))
    assert wrong / runs <= delta + 3 * math.sqrt(delta * (1 - delta) / runs)


def corpus():
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(1200):
        good = rng.random() < 0.7
        words = ["".join(rng.choice("etaoinshr") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(30, 90))]
        docs.append((i, " ".join(words if good else [w + "###" for w in words]), rng.choice(["en", "en", "en", None])))
        labels.append((i, int(good)))
    return docs, labels


def test_rules_keep_the_good_and_reject_the_bad(spark):
    docs, labels = corpus()
    df = spark.createDataFrame(docs, SCHEMA)
    counts = R.rule_statistics(df)
    rules = R.fit_rules(counts, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert set(rules.steps) == {"en", "und"} and rules.holdout["en"][1] == 0
    assert 0 < rules.cutoffs("en")["symbol_share"] < 0.5 and rules.cutoffs("xx") == {}
    got = {r.id: r for r in R.apply_rules(counts, rules).collect()}
    assert all(got[i].kept == bool(good) for i, good in labels)
    # the verdict from the cutoffs as plain numbers
    for i, text, lang in docs:
        share = brute(text)["n_symbols"] / brute(text)["word_chars"]
        assert (("symbol_share" in got[i].broken) == (share > rules.cutoffs(lang or "und")["symbol_share"]))


def test_too_few_labels_certify_nothing(spark):
    docs, labels = corpus()
    counts = R.rule_statistics(spark.createDataFrame(docs[:60], SCHEMA))
    rules = R.fit_rules(counts, spark.createDataFrame(labels[:60], "doc_id long, quality int"))
    assert rules.steps == {}
    assert all(r.kept for r in R.apply_rules(counts, rules).collect())


def test_many_strata_share_the_last_one(spark, monkeypatch):
    monkeypatch.setattr(R, "MAX_STRATA", 2)
    docs, labels = corpus()
    counts = R.rule_statistics(spark.createDataFrame(docs, SCHEMA))
    rules = R.fit_rules(counts, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert rules.named == ("en",) and set(rules.steps) == {"en", ""}


def test_odd_input(spark):
    rows = [(i if i % 4 else None, t, None) for i, t in enumerate(ODD)] + [(1, "a " * 40, "en"), (1, "a " * 40, "en")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS steps", "2 AS stratum", "3 AS id")
    labels = spark.createDataFrame([(1, 1), (1, 1), (None, 0), (2, None), (3, 7)], "doc_id long, quality int")
    counts = R.rule_statistics(df)
    got = R.apply_rules(counts, R.fit_rules(counts, labels)).collect()
    assert len(got) == len(rows)
    by_words = {(r.n_words, r.n_repeat_words): r for r in got}
    assert by_words[(40, 40)].base_failed and not by_words[(40, 40)].kept
    assert all(not r.kept for r in got)
    none = R.rule_statistics(spark.createDataFrame([], SCHEMA))
    assert R.apply_rules(none, R.fit_rules(none, labels)).count() == 0
    assert R.apply_rules(counts, R.fit_rules(counts, labels.where("false"))).count() == len(rows)
