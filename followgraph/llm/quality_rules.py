"""Quality rules whose cutoffs are selected under a bound on false rejections.

1. `rule_statistics`: counts of every whole text, and for each rule how many of its cutoffs
   (GRIDS, from lenient to strict, fixed beforehand) the text passes unharmed.
2. `fit_rules`: labelled rows fall into two halves by a hash of their id. The first proposes,
   in every stratum, a cutoff for each rule: the one that rejects the most bad rows, a good row
   counting for PRICE bad ones. Slack t stands for all proposals of a stratum drawn back by t
   steps of their grids.
3. The second half (the holdout) certifies: for t from SLACK down to 0 the good holdout rows
   that the rules reject are counted, and the hypothesis "at least `alpha` of good texts are
   rejected" is tested by the exact binomial tail P(Binomial(n, alpha) <= k). Within a stratum
   the tests go from lenient to strict and end at the first that fails, so they share one
   level; over strata the levels are corrected by Holm's rule (a stratum certified to the end
   gives its level to the others). With a chance of 1 - `delta` no stratum rejects `alpha` of
   its good texts or more. A stratum without a certified t rejects by no rule.
4. `apply_rules`: the base rules, then the certified cutoffs of the text's stratum.

Only counts per stratum reach the driver, at most MAX_STRATA strata with the most labelled
rows; all others are one stratum together.

Defined results for odd input: null and empty texts have no words, fail the base rules and are
not kept; a null stratum is `und`; labels other than 0 and 1 are not used; a repeated label
counts as often as it is there, a null id matches no label; rows that share an id each get
their own counts; without labels nothing but the base rules rejects; an empty table gives an
empty table. Columns of the input other than id, text and stratum are never read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from followgraph.llm.common import chunks, stored

CHUNK = 4 << 20
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30
PRICE = 20
SLACK = 6
MAX_STRATA = 256
STEPS = 30

_SPACES = b" \t\n\r\x0b\x0c"
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))

#: Cutoffs of each rule, from lenient to strict; a text is rejected if its value is above one.
_SHARES = 0.9 * 0.8 ** np.arange(STEPS)
GRIDS = {
    "symbol_share": _SHARES,
    "upper_share": _SHARES,
    "dup_line_share": _SHARES,
    "repeat_share": _SHARES,
    "long_words": 40.0 * 0.93 ** np.arange(STEPS),
    "short_words": -(1.0 + 0.12 * np.arange(STEPS)),
    "sameness": -(0.3 + 0.022 * np.arange(STEPS)),
}
RULES = tuple(GRIDS)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


class _Ids(dict):
    """Numbers of words in the order they are met."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def repeated_words(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How many words of each text lie in a window of WINDOW words that the text has twice or
    more. Windows are named exactly, by doubling (equal names are equal words of one text), and
    only what occurs twice is carried on, as a repeated window consists of repeated parts."""
    total, texts = len(ids), len(starts) - 1
    out = np.zeros(texts, np.int64)
    if total < WINDOW:
        return out
    text = np.repeat(np.arange(texts), np.diff(starts))

    def twice(places: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        _, name, count = np.unique(keys, return_inverse=True, return_counts=True)
        keep = count[name] > 1
        return places[keep], name[keep]

    places, found = twice(np.arange(total), text * (int(ids.max()) + 1) + ids)
    width = 1
    while width < WINDOW and len(places):
        names = np.full(total + width, -1, np.int64)
        names[places] = found
        places = places[names[places + width] >= 0]
        if len(places):
            places, found = twice(places, names[places] * (int(found.max()) + 1) + names[places + width])
        width *= 2
    change = np.zeros(total + 1, np.int64)
    change[places] += 1
    change[places + WINDOW] -= 1
    covered = np.cumsum(change[:-1]) > 0
    return np.bincount(text[covered], minlength=texts)


def _lines(data: bytes) -> tuple[int, int]:
    """Lines that hold a word, and how many of them equal an earlier one."""
    lines = [line for line in data.split(b"\n") if line.strip(_SPACES)]
    return len(lines), len(lines) - len(set(lines))


def text_counts(texts) -> dict[str, np.ndarray]:
    """The counts that rules are made of, an array entry for each text."""
    numbers, ids, starts, rows = _Ids(), [], [0], []
    for text in texts:
        data = text.encode("utf-8", "surrogatepass") if text else b""
        words = data.split()
        own = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        ids.append(own)
        starts.append(starts[-1] + len(own))
        spaces = len(data) - len(data.translate(None, _SPACES))
        lines, again = _lines(data)
        rows.append(
            (
                len(words),
                len(text or "") - spaces,
                len(data) - len(data.translate(None, _SYMBOLS)),
                again,
                lines,
                len(data) - len(data.translate(None, _UPPER)),
                len(np.unique(own)),
            )
        )
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_upper", "n_different")
    columns = np.array(rows, np.int64).reshape(-1, len(names)).T
    repeated = repeated_words(np.concatenate([np.empty(0, np.int64), *ids]), np.array(starts))
    return dict(zip(names, columns)) | {"n_repeat_words": repeated}


def rule_values(counts: dict[str, np.ndarray]) -> np.ndarray:
    """A column for each rule; a higher value is worse. A text without words has zeros."""
    words, chars = np.maximum(counts["n_words"], 1), np.maximum(counts["word_chars"], 1)
    filled = counts["n_words"] > 0
    mean = counts["word_chars"] / words
    values = {
        "symbol_share": counts["n_symbols"] / chars,
        "upper_share": counts["n_upper"] / chars,
        "dup_line_share": counts["n_dup_lines"] / np.maximum(counts["n_lines"], 1),
        "repeat_share": counts["n_repeat_words"] / words,
        "long_words": mean,
        "short_words": np.where(filled, -mean, GRIDS["short_words"][-1] - 1),
        "sameness": -np.log(counts["n_different"] + 5) / np.log(words + 5),
    }
    return np.stack([values[rule] for rule in RULES], axis=1)


def strictness(values: np.ndarray) -> np.ndarray:
    """How many cutoffs of each rule's grid the texts pass unharmed, from the lenient end."""
    passed = [np.searchsorted(-GRIDS[rule], -values[:, k], side="right") for k, rule in enumerate(RULES)]
    return np.stack(passed, axis=1)


def rule_statistics(docs: DataFrame, id_column: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """id, stratum, the COUNTS, and `steps` (for each rule how many cutoffs the text passes) of every row."""
    rows = docs.select(
        F.col(id_column).alias("id"),
        F.col(text).cast("string").alias("text"),
        F.coalesce(F.col(stratum).cast("string"), F.lit("und")).alias("stratum"),
    )
    kind = dict(rows.dtypes)["id"]

    def run(batches):
        for part in chunks(batches, "text", CHUNK):
            counts = text_counts(part["text"])
            steps = strictness(rule_values(counts))
            yield pd.DataFrame(
                {"id": part["id"], "stratum": part["stratum"], **{c: counts[c] for c in COUNTS}, "steps": list(steps.astype(np.int32))}
            )

    columns = ", ".join(f"{c} long" for c in COUNTS)
    return rows.mapInPandas(run, f"id {kind}, stratum string, {columns}, steps array<int>")


def base_failed():
    """The fixed rules: too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(Binomial(n, p) <= k), summed term by term in logarithms."""
    if k >= n:
        return 1.0
    total = 0.0
    for i in range(k + 1):
        total += math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p))
    return min(total, 1.0)


def certified_slack(n: int, rejected: list[int], alpha: float, level: float) -> int | None:
    """The least slack certified at `level`: rejected[t] of n good rows are rejected at slack t.
    Tests go from the largest slack down and end at the first that fails."""
    best = None
    for t in range(len(rejected) - 1, -1, -1):
        if binomial_tail(rejected[t], n, alpha) > level:
            break
        best = t
    return best


def holm(strata: dict[str, tuple[int, list[int]]], alpha: float, delta: float) -> dict[str, int]:
    """The certified slack of each stratum that has one. A stratum certified down to slack 0
    leaves its share of `delta` to those that are not yet."""
    open_, done = dict(strata), {}
    while open_:
        level = delta / len(open_)
        found = {name: certified_slack(*of, alpha, level) for name, of in open_.items()}
        full = [name for name, t in found.items() if t == 0]
        if not full:
            return done | {name: t for name, t in found.items() if t is not None}
        for name in full:
            done[name] = 0
            del open_[name]
    return done


@dataclass(frozen=True)
class QualityRules:
    """For each certified stratum the step of each rule's grid (STEPS: the rule is off), and the
    strata that have names of their own; any other is ''."""

    steps: dict = field(default_factory=dict)
    named: tuple = ()
    #: stratum -> (good holdout rows, good holdout rows rejected at the certified slack)
    holdout: dict = field(default_factory=dict)

    def cutoffs(self, stratum: str) -> dict[str, float]:
        """The values above which texts of the stratum are rejected."""
        steps = self.steps.get(stratum if stratum in self.named else "", [STEPS] * len(RULES))
        return {rule: float(GRIDS[rule][s]) for rule, s in zip(RULES, steps) if s < STEPS}


def _stratum(named: tuple):
    return F.when(F.col("stratum").isin(*named), F.col("stratum")).otherwise("") if named else F.lit("")


def fit_rules(
    statistics: DataFrame,
    labels: DataFrame,
    alpha: float = 0.05,
    delta: float = 0.05,
    id_column: str = "doc_id",
    label: str = "quality",
) -> QualityRules:
    """Cutoffs from the labelled rows that the base rules leave."""
    marks = labels.where(F.col(label).isin(0, 1)).select(F.col(id_column).alias("id"), (F.col(label) == 1).alias("good"))
    half = F.crc32(F.concat(F.lit("holdout:"), F.col("id").cast("string")).cast("binary")) % 2
    known = stored(
        statistics.where(~base_failed()).select("id", "stratum", "steps").join(marks, "id").select("stratum", "steps", "good", half.alias("half")),
        "labelled",
    )
    largest = known.groupBy("stratum").count().orderBy(F.desc("count"), "stratum").limit(MAX_STRATA - 1).collect()
    named = tuple(sorted(row["stratum"] for row in largest))
    rows = known.withColumn("stratum", _stratum(named))

    # at most MAX_STRATA * 2 * len(RULES) * (STEPS + 1) rows
    first = rows.where("half = 0").select("stratum", "good", F.posexplode("steps").alias("rule", "step"))
    counted = first.where(F.col("step") < STEPS).groupBy("stratum", "good", "rule", "step").count().collect()
    gain: dict[str, np.ndarray] = {}
    for row in counted:
        table = gain.setdefault(row["stratum"], np.zeros((len(RULES), STEPS)))
        # a text that passes s cutoffs is rejected by the cutoff s and all stricter ones
        table[row["rule"], row["step"] :] += -PRICE * row["count"] if row["good"] else row["count"]
    proposed = {name: [int(np.argmax(g)) if g.max() > 0 else STEPS for g in table] for name, table in gain.items()}
    proposed = {name: steps for name, steps in proposed.items() if min(steps) < STEPS}
    if not proposed:
        return QualityRules({}, named)

    # a good holdout row is rejected at slack t if it passes fewer than step - t cutoffs of some rule
    second = rows.where("half = 1 AND good").groupBy("stratum", "steps").count()

    def depth(batches):
        for frame in batches:
            frame = frame[frame["stratum"].isin(list(proposed))]
            if len(frame):
                own = np.stack(frame["steps"].to_numpy())
                limit = np.array([proposed[name] for name in frame["stratum"]])
                gap = np.where(limit < STEPS, limit - own, -1).max(axis=1)
                yield pd.DataFrame({"stratum": frame["stratum"], "gap": np.clip(gap, -1, SLACK), "count": frame["count"]})

    gaps = second.mapInPandas(depth, "stratum string, gap int, count long")
    strata: dict[str, tuple[int, list[int]]] = {name: (0, [0] * (SLACK + 1)) for name in proposed}
    for row in gaps.groupBy("stratum", "gap").agg(F.sum("count").alias("n")).collect():
        n, rejected = strata[row["stratum"]]
        for t in range(min(row["gap"], SLACK) + 1):
            rejected[t] += row["n"]
        strata[row["stratum"]] = (n + row["n"], rejected)
    # strata that no outcome could certify take no share of the level
    able = {name: of for name, of in strata.items() if of[0] and binomial_tail(0, of[0], alpha) <= delta}
    slack = holm(able, alpha, delta)
    # a rule drawn back beyond its most lenient cutoff is off
    steps = {name: [s - t if t <= s < STEPS else STEPS for s in proposed[name]] for name, t in slack.items()}
    return QualityRules(steps, named, {name: (able[name][0], able[name][1][t]) for name, t in slack.items()})


def apply_rules(statistics: DataFrame, rules: QualityRules) -> DataFrame:
    """Adds base_failed, broken (names of the rules whose cutoff the text exceeds) and kept."""
    name, broken = _stratum(rules.named), F.array().cast("array<string>")
    for stratum, steps in rules.steps.items():
        over = [F.when(F.get("steps", F.lit(k)) <= s, F.lit(RULES[k])) for k, s in enumerate(steps) if s < STEPS]
        broken = F.when(name == stratum, F.array_compact(F.array(*over))).otherwise(broken)
    return (
        statistics.withColumn("base_failed", base_failed())
        .withColumn("broken", broken)
        .withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))
    )
