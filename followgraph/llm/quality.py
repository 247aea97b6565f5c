"""Quality classifier: a regularised quadratic discriminant over document statistics.

1. `document_statistics`: one fixed-length vector per text, from bytes, words and repeated
   five-word windows, each part transformed to be roughly symmetric.
2. `fit_quality`: counts, sums and cross products per class, added up by Spark over every
   labelled row that is not held out; from them come class means and covariances, drawn
   towards the pooled covariance and towards a sphere, and their Cholesky factors.
3. `score_quality` / `score_column`: the difference of the two log densities (Mahalanobis
   distance by the cached factor, log determinant, log prior) through a logistic curve, which is
   fitted to the log-odds of labelled rows by models fitted without them (`calibrated`).

Only the text enters a score. Defined results for odd input: null and empty texts have
no counts at all and get the score of such a vector; a label that is neither 0 nor 1 (null
included) is not used; a row of `labels` that is repeated counts as often as it is there; a
null id matches no label and lies in no fold (`held_out` is null and it isn't used for
fitting). Without rows of both classes every score is 0.5. Columns of the input other than
id and text are never read, so their names don't matter.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from followgraph.llm.common import WordHashes, chunks, fold, window_hashes

STATISTICS = (
    "symbol_share",
    "upper_share",
    "digit_share",
    "mean_word_length",
    "word_length_spread",
    "variety",
    "top_word_share",
    "short_word_share",
    "repeated_windows",
    "sentence_marks",
    "odd_endings",
    "line_breaks",
)
THRESHOLD = 0.7

_SPACES = b" \t\n\r\x0b\x0c"
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_MARKS = b".,;:?'\"-()"
_SYMBOLS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and c not in _MARKS)
#: Symbols become '#', white space a blank: then an odd word ending is '# '.
_SHAPES = bytes(35 if c in _SYMBOLS else 32 if c in _SPACES else 120 for c in range(256))
#: Every text is read as if so many words of plain prose stood before it: short texts carry
#: little evidence. What such prose has of each count, for one word.
_PRIOR_WORDS = 20.0
_PRIOR = {"bytes": 6.0, "symbols": 0.01, "upper": 0.15, "digits": 0.01, "marks": 0.15, "lines": 0.02, "odd": 0.005, "short": 0.4}


def _rate(count: np.ndarray, total: np.ndarray, prior: float, prior_total: float) -> np.ndarray:
    return (count + _PRIOR_WORDS * prior) / (total + _PRIOR_WORDS * prior_total)


def statistics(texts, hashes: WordHashes | None = None) -> np.ndarray:
    """A row of STATISTICS for each text."""
    hashes = WordHashes() if hashes is None else hashes
    raw = np.zeros((len(texts), 13))
    for i, text in enumerate(texts):
        data = text.encode("utf-8", "surrogatepass") + b" " if text else b""
        words = data.lower().split()
        if not words:
            continue
        size = len(data)
        length = np.fromiter(map(len, words), np.int64, len(words))
        hashed = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
        windows = window_hashes(hashed, 5)
        windows.sort()
        hashed.sort()
        runs = np.flatnonzero(np.concatenate([[True], hashed[1:] != hashed[:-1], [True]]))
        raw[i] = (
            size,
            len(words),
            size - len(data.translate(None, _SYMBOLS)),
            size - len(data.translate(None, _UPPER)),
            size - len(data.translate(None, _DIGITS)),
            size - len(data.translate(None, _MARKS)),
            data.count(b"\n"),
            data.translate(_SHAPES).count(b"# "),
            np.count_nonzero(length <= 3),
            length.std(),
            len(runs) - 1,
            np.diff(runs).max(),
            np.count_nonzero(windows[1:] == windows[:-1]),
        )
    size, n, symbols, upper, digits, marks, lines, odd, short, spread, distinct, top, repeated = raw.T
    p, w = _PRIOR, _PRIOR_WORDS
    return np.stack(
        [
            np.log(_rate(symbols, size, p["symbols"], p["bytes"])),
            np.log(_rate(upper, size, p["upper"], p["bytes"])),
            np.log(_rate(digits, size, p["digits"], p["bytes"])),
            np.log(_rate(size, n, p["bytes"], 1.0)),
            np.log((spread * n + 3.0 * w) / (n + w)),
            np.log(distinct + w) / np.log(n + w),
            np.sqrt((top + 2.0) / (n + 2 * w)),
            np.sqrt(_rate(short, n, p["short"], 1.0)),
            np.log((repeated + 0.4) / (n + 2 * w)),
            np.log(_rate(marks, n, p["marks"], 1.0)),
            np.log(_rate(odd, n, p["odd"], 1.0)),
            np.log(_rate(lines, n, p["lines"], 1.0)),
        ],
        axis=1,
    )


def document_statistics(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """id and statistics (array of double) of every row."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text"))
    kind = dict(rows.dtypes)["id"]

    def run(batches):
        hashes = WordHashes()
        for part in chunks(batches, "text", 4 << 20):
            yield pd.DataFrame({"id": part["id"], "statistics": list(statistics(part["text"], hashes))})

    return rows.mapInPandas(run, f"id {kind}, statistics array<double>")


@dataclass(frozen=True)
class QualityModel:
    """Means, inverse Cholesky factors and constants of the classes 0 and 1."""

    means: tuple = ()
    inverses: tuple = ()
    constants: tuple = ()
    #: Where they are given, the score is the logistic function of slope * asinh(log-odds) + shift:
    #: the statistics of one text aren't independent enough for raw odds. See `calibrated`.
    slope: float | None = None
    shift: float = 0.0

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        logs = [
            constant - 0.5 * (((x - mean) @ inverse.T) ** 2).sum(axis=1)
            for mean, inverse, constant in zip(self.means, self.inverses, self.constants, strict=True)
        ]
        return logs[1] - logs[0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.means:
            return np.full(len(x), 0.5)
        odds = self.log_odds(x)
        if self.slope is not None:
            odds = self.slope * np.arcsinh(odds) + self.shift
        return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def _model(sums: np.ndarray, pooled: float, sphere: float) -> QualityModel:
    """The model of the two classes' counts, sums and cross products."""
    d = len(STATISTICS)
    n = sums[:, 0]
    if n.min() < 2:
        return QualityModel()
    means = sums[:, 1 : d + 1] / n[:, None]
    own = [sums[k, d + 1 :].reshape(d, d) / n[k] - np.outer(means[k], means[k]) for k in (0, 1)]
    both = (n[0] * own[0] + n[1] * own[1]) / n.sum()
    scale = np.sqrt(np.maximum(np.diag(both), 1e-9))
    inverses, constants = [], []
    for k in (0, 1):
        z = ((1 - pooled) * own[k] + pooled * both) / np.outer(scale, scale)
        z = (1 - sphere) * z + sphere * np.eye(d) * max(np.trace(z) / d, 1e-6)
        factor = np.linalg.cholesky(z)
        inverses.append(np.linalg.inv(factor) / scale)
        constants.append(np.log(n[k] / n.sum()) - np.log(np.diag(factor)).sum())
    return QualityModel(tuple(means), tuple(inverses), tuple(constants))


def fit_quality(
    statistics_of: DataFrame,
    labels: DataFrame,
    held_out: tuple[int, int] | None = (4, 2),
    pooled: float = 0.1,
    sphere: float = 0.02,
    id_column: str = "doc_id",
    label: str = "quality",
    calibrate: bool = False,
) -> QualityModel:
    """A model from the rows whose crc32(id as text) mod held_out[0] is not held_out[1].

    `pooled` and `sphere` are the weights of the pooled covariance and of its mean variance.
    `calibrate` fits a curve from log-odds to scores as well (`calibrated`); without it scores are
    the raw posterior."""
    use = F.col(label).isin(0, 1)
    if held_out:
        use &= fold(F.col(id_column), held_out[0]) != held_out[1]
    marked = labels.where(use).select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("label"))
    # the folds of cross-fitting; one id is in one of them, however often it is there
    inner = F.pmod(F.xxhash64(F.col("id")), F.lit(_FOLDS)).cast("int").alias("fold")
    rows = statistics_of.join(marked, "id").select("label", inner, "statistics")
    d = len(STATISTICS)

    def add_up(batches):
        sums = {}
        for frame in batches:
            for key, part in frame.groupby(["label", "fold"]):
                x = np.stack(part["statistics"].to_numpy())
                got = np.concatenate([[len(x)], x.sum(axis=0), (x.T @ x).ravel()])
                sums[key] = sums.get(key, 0) + got
        for (value, k), total in sums.items():
            yield pd.DataFrame({"label": value, "fold": k, "place": np.arange(len(total)), "amount": total})

    parts = rows.mapInPandas(add_up, "label int, fold int, place int, amount double")
    # 2 * folds * (1 + d + d * d) rows, whatever the size of the tables
    totals = parts.groupBy("label", "fold", "place").agg(F.sum("amount").alias("amount")).collect()
    sums = np.zeros((_FOLDS, 2, 1 + d + d * d))
    for row in totals:
        sums[row["fold"], row["label"], row["place"]] = row["amount"]
    whole = sums.sum(axis=0)
    model = _model(whole, pooled, sphere)
    if not calibrate or not model.means:
        return model
    return calibrated(model, rows, [_model(whole - own, pooled, sphere) for own in sums])


#: Folds of cross-fitting, and the steps of asinh(log-odds) by which these are counted.
_FOLDS = 4
_STEPS = 64


def calibrated(model: QualityModel, rows: DataFrame, without: list[QualityModel]) -> QualityModel:
    """The model with the curve that makes its scores probabilities.

    Log-odds of texts reach thousands where a score of 0.99 is earned, so the curve is logistic in
    their asinh, which grows with their logarithm and keeps their order. Each row (`label`, `fold`,
    `statistics`) is judged by the model that was fitted without its fold; Spark counts by label and
    fixed steps of asinh, some 5,500 rows at most, and the curve is fitted to the counts. As targets it has
    (n1 + 1) / (n1 + 2) and 1 / (n0 + 2) in place of 1 and 0, so that classes without overlap get a
    finite slope. If a fold cannot be judged, or the slope isn't positive, the model stays raw."""
    if not all(m.means for m in without):
        return model

    def count(batches):
        found = {}
        for frame in batches:
            for (value, k), part in frame.groupby(["label", "fold"]):
                odds = without[k].log_odds(np.stack(part["statistics"].to_numpy()))
                steps = np.rint(np.arcsinh(np.clip(odds, -1e9, 1e9)) * _STEPS).astype(int)
                for step, n in zip(*np.unique(steps, return_counts=True), strict=True):
                    found[value, step] = found.get((value, step), 0) + int(n)
        yield pd.DataFrame([(v, s, n) for (v, s), n in found.items()], columns=["label", "step", "n"])

    counts = rows.mapInPandas(count, "label int, step int, n long").groupBy("label", "step").agg(F.sum("n").alias("n"))
    label, step, n = np.array([tuple(r) for r in counts.orderBy("label", "step").collect()], dtype=float).T
    size = [n[label == k].sum() for k in (0, 1)]
    target = np.where(label == 1, (size[1] + 1) / (size[1] + 2), 1 / (size[0] + 2))
    slope, shift = _logistic(step / _STEPS, target, n)
    return replace(model, slope=slope, shift=shift) if np.isfinite(slope) and slope > 0 else model


def _logistic(x: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve of least log loss: Newton's steps, halved until they help."""

    def loss(at):
        z = at[0] * x + at[1]
        return float((weight * (np.logaddexp(0, z) - target * z)).sum())

    at = np.array([1.0, 0.0])
    design = np.stack([x, np.ones_like(x)], axis=1)
    best = loss(at)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(design @ at, -700, 700)))
        slope = design.T @ (weight * (p - target))
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-9 * weight.sum() * np.eye(2)
        step = np.linalg.solve(curve, slope)
        while loss(at - step) > best and np.abs(step).max() > 1e-12:
            step /= 2
        at = at - step
        now = loss(at)
        if best - now <= 1e-10 * max(1.0, best):
            break
        best = now
    return float(at[0]), float(at[1])


def score_quality(statistics_of: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """id, score, predicted of every row of `document_statistics`."""
    kind = dict(statistics_of.dtypes)["id"]

    def run(batches):
        for frame in batches:
            if len(frame):
                score = model.scores(np.stack(frame["statistics"].to_numpy()))
                yield pd.DataFrame({"id": frame["id"], "score": score})

    scored = statistics_of.select("id", "statistics").mapInPandas(run, f"id {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def statistics_column(text: Column) -> Column:
    """The statistics of a text column, a few MB of text at a time."""

    @F.pandas_udf("array<double>")
    def measured(series: pd.Series) -> pd.Series:
        hashes, found = WordHashes(), []
        for part in chunks([series.to_frame("text")], "text", 4 << 20):
            found += list(statistics(part["text"], hashes))
        return pd.Series(found, dtype=object)

    return measured(text.cast("string"))


def score_of(model: QualityModel, measured: Column) -> Column:
    """The score of a column of statistics."""

    @F.pandas_udf("double")
    def score(series: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.stack(series.to_numpy())) if len(series) else [], dtype="float64")

    return score(measured)


def score_column(model: QualityModel, text: Column) -> Column:
    """The score of a text column, without another table."""
    return score_of(model, statistics_column(text))
