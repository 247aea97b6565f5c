"""Secret scans: three fixed patterns, and a battery of randomness tests over other tokens.

The patterns (`assign`, `access`, `hex`) give spans that always stay. Beside them every run of
16 or more key characters is a candidate of the kind `random`:

* dashes are taken out of it (UUIDs, keys in groups), and its parts of 16 or more characters
  between signs are candidates too, for where only a part is a key;
* its encoding is inferred from its characters (decimal, hex, letters, base32, base36, base62,
  base64); what has no lower-case letter is read as if in lower case;
* three tests ask whether it could be uniform random text of that encoding: chi-squared
  uniformity over the alphabet, runs of character classes, and serial correlation;
* the log-likelihood ratio of uniform text of the encoding to prose is held against its null:
  prose is a chain of kinds of characters (vowel, consonant, capital, digit, sign) that draws
  letters by their use. The chance of so large a ratio under prose is the candidate's p-value. It
  is tabulated for each encoding and length by weighted draws, so it has no floor; decimal
  digits are as even in numbers as in keys, so their ratio says nothing and p is 1;
* Benjamini-Hochberg over the candidates of a text keeps the expected share of false spans
  below `fdr`; what one of the randomness tests rejects is not taken.

Spans are code points, end exclusive. Defined results for odd input: a null or empty text has
no spans; candidates that overlap a pattern's span are left to the pattern; very long texts are
scanned whole; repeated rows give repeated rows. `secret_spans` reads the text column only, so
other columns may have any name; the columns that `redact` writes replace the text column.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "random")

# Fixed patterns: what is found must equal these definitions.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST = 6

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
PART = re.compile(r"[A-Za-z0-9]{16,}")
_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")

#: Relative frequencies of characters in prose of Latin script: letters by use, digits rare.
_LETTER_USE = dict(zip("etaoinshrdlcumwfgypbvkjxqz", [12.7, 9.1, 8.2, 7.5, 7.0, 6.7, 6.3, 6.1, 6.0, 4.3, 4.0, 2.8, 2.8, 2.4, 2.4, 2.2, 2.0, 2.0, 1.9, 1.5, 1.0, 0.8, 0.2, 0.2, 0.1, 0.1]))
_ENCODINGS = (
    ("decimal", "0123456789"),
    ("hex", "0123456789abcdef"),
    ("letters", "abcdefghijklmnopqrstuvwxyz"),
    ("base32", "abcdefghijklmnopqrstuvwxyz234567"),
    ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base62", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "+/0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz-_"),
)
#: Chances of the next kind of character in prose, names and numbers: after a vowel, a consonant,
#: a capital, a digit, a sign, and at the start.
_STEPS = np.array(
    [
        [0.15, 0.72, 0.03, 0.04, 0.06],
        [0.50, 0.37, 0.03, 0.04, 0.06],
        [0.30, 0.35, 0.25, 0.04, 0.06],
        [0.03, 0.05, 0.04, 0.78, 0.10],
        [0.25, 0.30, 0.15, 0.15, 0.15],
        [0.30, 0.40, 0.15, 0.10, 0.05],
    ]
)
#: Draws for a table of the null, and the length beyond which the bound exp(-ratio) serves.
_DRAWS, _LONGEST = 20_000, 64


def _kind(c: str) -> int:
    return 2 if c.isupper() else 3 if c.isdigit() else 4 if not c.isalpha() else 0 if c in "aeiouy" else 1


class _Encoding:
    def __init__(self, name: str, alphabet: str):
        self.name, self.size = name, len(alphabet)
        self.place = {c: i for i, c in enumerate(alphabet)}
        self.kinds = np.array([_kind(c) for c in alphabet])
        use = np.array([_LETTER_USE.get(c.lower(), 1.0) for c in alphabet])
        own = np.bincount(self.kinds, use, 5)
        steps = _STEPS * (own > 0)
        steps /= steps.sum(axis=1, keepdims=True)
        #: log ratio of a character, given the kind before it
        self.ratio = -np.log(self.size * steps[:, self.kinds] * use / own[self.kinds])
        if name == "decimal":
            self.ratio[:] = 0.0
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def log_ratio(self, values: np.ndarray) -> np.ndarray:
        """Of uniform text to prose; tokens of one length in the last axis."""
        before = np.concatenate([np.full((*values.shape[:-1], 1), 5), self.kinds[values[..., :-1]]], axis=-1)
        return self.ratio[before, values].sum(axis=-1)

    def p_prose(self, values: np.ndarray) -> float:
        """Chance of a ratio as large as that of these values under prose."""
        found, n = float(self.log_ratio(values)), len(values)
        bound = math.exp(-max(found, 0.0))  # Markov's inequality
        if n > _LONGEST or found <= 0:
            return bound
        if n not in self.tables:
            # a draw from the uniform counts exp(-ratio) under prose
            drawn = np.random.default_rng([n, self.size]).integers(0, self.size, (_DRAWS, n), dtype=np.int8)
            ratios = np.sort(np.concatenate([self.log_ratio(part) for part in np.array_split(drawn, 10)]))
            self.tables[n] = ratios, np.cumsum(np.exp(-ratios[::-1]))[::-1] / _DRAWS
        ratios, tail = self.tables[n]
        at = int(np.searchsorted(ratios, found))
        return min(bound, float(tail[at])) if at < _DRAWS - 20 else bound


_TABLE = [_Encoding(*e) for e in _ENCODINGS]


def _upper_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def infer_encoding(token: str) -> _Encoding | None:
    """The smallest alphabet that has all the characters."""
    used = set(token)
    return next((e for e in _TABLE if used <= e.place.keys()), None)


def randomness(token: str) -> tuple[float, float]:
    """(p under prose, smallest p of the three randomness tests) of a token."""
    token = token.rstrip("=")
    bare = token.replace("-", "")
    token = bare if len(bare) >= 16 else token
    if token.upper() == token:
        token = token.lower()
    encoding = infer_encoding(token)
    n = len(token)
    if encoding is None or n < 16:
        return 1.0, 0.0
    values = np.array([encoding.place[c] for c in token])
    counts = np.bincount(values, minlength=encoding.size)
    a = encoding.size
    chi = ((counts - n / a) ** 2).sum() * a / n
    # Wilson and Hilferty's cube root makes the chi-squared value nearly normal
    p_chi = _upper_tail(((chi / (a - 1)) ** (1 / 3) - (1 - 2 / (9 * (a - 1)))) / math.sqrt(2 / (9 * (a - 1))))
    high = values >= a / 2
    ones = int(high.sum())
    runs = 1 + int((high[1:] != high[:-1]).sum())
    mean = 1 + 2 * ones * (n - ones) / n
    var = (mean - 1) * (mean - 2) / (n - 1)
    p_runs = 2 * _upper_tail(abs(runs - mean) / math.sqrt(var)) if var > 0 else 0.0
    centred = values - values.mean()
    power = float((centred * centred).sum())
    p_serial = 2 * _upper_tail(abs(float((centred[1:] * centred[:-1]).sum()) / power) * math.sqrt(n)) if power else 0.0
    return encoding.p_prose(values), min(p_chi, p_runs, p_serial)


def _parts(m: re.Match) -> list[tuple[int, int]]:
    """A candidate's span, and those of its long parts between signs."""
    parts = [(m.start() + p.start(), m.start() + p.end()) for p in PART.finditer(m[0])]
    return [m.span(), *(p for p in parts if p != m.span())]


def _accepted(tokens: list[str], fdr: float, reject: float) -> list[bool]:
    """Benjamini-Hochberg over the p-values under prose, less what isn't random enough."""
    tested = [randomness(t) for t in tokens]
    order = sorted(range(len(tokens)), key=lambda i: tested[i][0])
    last = max((k for k, i in enumerate(order, 1) if tested[i][0] <= fdr * k / len(tokens)), default=0)
    taken = set(order[:last])
    return [i in taken and tested[i][1] >= reject for i in range(len(tokens))]


def find_spans(text: str | None, fdr: float = 0.001, reject: float = 0.001) -> list[tuple[int, int, int]]:
    """(start, end, kind's place in KINDS) of every secret in a text, in order."""
    if not text:
        return []
    found = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)]
    tokens = list(CANDIDATE.finditer(text))
    # a run of hex digits is part of a run of key characters, so it is looked for there alone
    for m in tokens:
        if m.end() - m.start() >= 24:
            found += [(m.start() + h.start(), m.start() + h.end(), 2) for h in HEX.finditer(m[0])]
    taken = _merged(sorted(found))
    ends = [e for _, e in taken]
    free = []
    for m in tokens:
        k = bisect_right(ends, m.start())  # the first that ends behind this one's start
        if k == len(taken) or taken[k][0] >= m.end():
            free.append(m)
    if free:
        tried = [p for m in free for p in _parts(m)]
        last = 0
        for (start, end), good in zip(tried, _accepted([text[a:b] for a, b in tried], fdr, reject), strict=True):
            # a part of what is taken already is no span of its own
            if good and start >= last:
                found.append((start, end, 3))
                last = end
    return sorted(found, key=lambda s: (s[0], s[2]))


SPANS = "array<struct<kind:string,start:int,end:int>>"


def secret_spans(text: Column, fdr: float = 0.001) -> Column:
    """Array of (kind, start, end) of the secrets in a text column."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in batches:
            yield pd.Series(
                [[{"kind": KINDS[k], "start": s, "end": e} for s, e, k in find_spans(t, fdr)] for t in series],
                dtype=object,
            )

    return F.pandas_udf(run, SPANS)(text.cast("string"))


def _merged(spans) -> list[list[int]]:
    """Spans that overlap or touch, as one."""
    out: list[list[int]] = []
    for start, end, _ in spans:
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def redact_text(text: str | None, mark: str, fdr: float = 0.001) -> str | None:
    spans = _merged(find_spans(text, fdr))
    if not spans:
        return text
    ends = [0] + [e for _, e in spans]
    return "".join(text[a:b] + mark for a, (b, _) in zip(ends, spans)) + text[ends[-1] :]


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", fdr: float = 0.001) -> DataFrame:
    """The same rows with every secret in the text column replaced by `mark`."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in batches:
            yield pd.Series([redact_text(t, mark, fdr) for t in series], dtype=object)

    return docs.withColumn(text, F.pandas_udf(run, "string")(F.col(text).cast("string")))
