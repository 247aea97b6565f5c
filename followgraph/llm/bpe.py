"""Byte-pair encoding and decoding with forced-boundary splitting.

A vocabulary fixes which two neighbouring symbols can ever stand inside one token. Where two
neighbours of a word form a pair that occurs in no token, no merge can reach across, so the
word is cut there for certain; the pieces between such cuts are encoded each on its own and
the ids put one after another. Pieces repeat far more than words do, which is what makes
remembering their codes worthwhile; the memory has a fixed number of entries per task.

The tokenizer file (a `tokenizers` JSON: NFC, white space folding, lower case, a split
pattern, byte-level symbols, BPE with an end-of-word suffix, added special tokens that are
found in the raw text) is a parameter and is read on the driver; tasks get its vocabulary and
merges by broadcast, whose size is that of the file, whatever the corpus. Letters and numbers
are those of the `regex` module's Unicode tables; for code points assigned after Unicode 15.1
other libraries may have older or younger tables.

Defined results for odd input: a null text is encoded as the empty text (no ids, decoded to
the empty text); very long texts are encoded whole; repeated rows give repeated rows; an
empty table gives an empty table with the same columns. The columns `ids`, `n_tokens` and
`decoded` that `encode` and `decode` add replace input columns of the same names.
"""

from __future__ import annotations

import json
import sys
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Code points with the property White_Space, which is what the split pattern's \\s means.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Entries of each memory of an encoder, some hundred MB in all; they go with their task.
MEMORY = 1 << 19
#: Bytes of text whose ids and decoded texts are held at once.
PART = 2 << 20
_NEVER = 1 << 62


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


@dataclass(frozen=True)
class BpeModel:
    """A tokenizer file, taken apart."""

    vocab: dict[str, int]
    ranks: dict[tuple[str, str], int]
    suffix: str
    special: dict[str, int]
    pattern: str
    #: Neighbouring symbols that occur inside some token; all others are certain cuts.
    inner: frozenset[tuple[str, str]] = field(default_factory=frozenset)


def load_bpe(path: str) -> BpeModel:
    """Read a `tokenizers` JSON file of the kind described above (on the driver)."""
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    model, normalizer, pre = whole["model"], whole["normalizer"], whole["pre_tokenizer"]
    kinds = [x["type"] for x in normalizer["normalizers"]], [x["type"] for x in pre["pretokenizers"]]
    if model["type"] != "BPE" or kinds != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]):
        raise ValueError(f"{path}: not a lower-case word BPE file")
    merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
    inner = {
        pair for token in vocab for symbols in [_symbols(token, suffix)] for pair in zip(symbols, symbols[1:])
    }
    return BpeModel(
        vocab,
        {pair: rank for rank, pair in enumerate(merges)},
        suffix,
        {t["content"]: t["id"] for t in whole["added_tokens"]},
        pre["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", _SPACE),
        frozenset(inner),
    )


def _symbols(token: str, suffix: str) -> list[str]:
    """Single symbols of a token; the suffix belongs to the last one."""
    ends = bool(suffix) and token.endswith(suffix) and token != suffix
    symbols = list(token[: -len(suffix)] if ends else token)
    return [*symbols[:-1], symbols[-1] + suffix] if ends else symbols


class _Memory(dict):
    """Codes made so far; starts anew when it is full."""

    def __init__(self, make: Callable, most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.make(key)
        return value


class Encoder:
    """Encodes texts one at a time; remembers the codes of stretches, words and pieces."""

    def __init__(self, model: BpeModel, memory: int = MEMORY):
        self.model = model
        self.stretches, self.words, self.pieces = (_Memory(f, memory) for f in (self.stretch, self.word, self.merge))
        self.bytes = byte_symbols()
        self.find = regex.compile(model.pattern).findall
        self.special = regex.compile("(" + "|".join(map(regex.escape, model.special)) + ")") if model.special else None

    def split(self, symbols: list[str]) -> list[tuple[str, ...]]:
        """Pieces between certain cuts."""
        inner = self.model.inner
        cuts = [i for i, pair in enumerate(zip(symbols, symbols[1:]), 1) if pair not in inner]
        if not cuts:
            return [tuple(symbols)]
        return [tuple(symbols[i:j]) for i, j in zip([0, *cuts], [*cuts, len(symbols)])]

    def merge(self, piece: tuple[str, ...]) -> list[str]:
        """Tokens of a piece: the pair with the lowest rank is joined, the leftmost first."""
        parts, rank = list(piece), self.model.ranks.get
        ranks = [rank(pair, _NEVER) for pair in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == _NEVER:
                break
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((parts[i - 1], parts[i]), _NEVER)
            if i < len(ranks):
                ranks[i] = rank((parts[i], parts[i + 1]), _NEVER)
        return parts

    def word(self, text: str) -> tuple[bytes, str]:
        """Little-endian ids of a word, and its tokens each with a blank after it."""
        symbols = [self.bytes[b] for b in text.encode("utf-8")]
        symbols[-1] += self.model.suffix
        tokens = [token for piece in self.split(symbols) for token in self.pieces[piece]]
        ids = array("I", [self.model.vocab[t] for t in tokens])
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes(), "".join([t + " " for t in tokens])

    def stretch(self, text: str) -> tuple[bytes, str]:
        """The same of what stands between blanks: white space never joins anything, so each
        stretch is normalised and cut into words by itself."""
        coded = []
        for k, part in enumerate(self.special.split(text) if self.special else [text]):
            if k % 2:
                coded.append((self.model.special[part].to_bytes(4, "little"), part + " "))
            else:
                # a capital sigma is lowered by itself, not by its place in the word
                plain = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                coded += [self.words[w] for w in self.find(plain)]
        return b"".join([c[0] for c in coded]), "".join([c[1] for c in coded])

    def forget(self) -> None:
        """Empty the memories, so that a Python process that goes on to other tasks gives them back."""
        for memory in (self.stretches, self.words, self.pieces):
            memory.clear()

    def encode(self, text: str | None) -> tuple[bytes, str]:
        """Ids as little-endian unsigned 32-bit integers, and the decoded text."""
        if not text:
            return b"", ""
        coded = [self.stretches[s] for s in text.replace("\n", " ").split(" ")]
        return b"".join([c[0] for c in coded]), "".join([c[1] for c in coded])[:-1]


def _parts(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Stretches of rows with about `most` bytes of text each."""
    start = size = 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        size += n
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _all_of(coded: list[tuple[bytes, str]]) -> list[pa.Array]:
    """ids, n_tokens and decoded of coded texts."""
    sizes = np.array([len(ids) // 4 for ids, _ in coded], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    values = np.frombuffer(b"".join([ids for ids, _ in coded]), "<u4").astype(np.int32)
    return [pa.ListArray.from_arrays(offsets, values), pa.array(sizes), pa.array([shown for _, shown in coded], pa.string())]


def encode(
    docs: DataFrame,
    model: BpeModel,
    text: str = "text",
    finish: Callable[[bytes, str], tuple] | None = None,
    schema: str = "ids array<int>, n_tokens bigint, decoded string",
    memory: int = MEMORY,
) -> DataFrame:
    """All columns of `docs` but those named in `schema`, and those: token ids, their number and the
    text that the ids decode to. `finish` makes other columns of a text's little-endian ids and
    decoded text, where ids need not leave the task (digests). `memory` bounds the entries of each
    of the encoder's three memories; it trades Python memory for time and changes no result."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    new = T.StructType.fromDDL(schema)
    other = [c for c in docs.columns if c not in new.names]
    rows = docs.select(*other, F.col(text).cast("string").alias("__bpe_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shipped.value, memory)
        try:
            for batch in batches:
                for a, b in _parts(batch.column("__bpe_text"), PART):
                    part = batch.slice(a, b - a)
                    coded = [encoder.encode(t) for t in part.column("__bpe_text").to_pylist()]
                    made = [pa.array(c) for c in zip(*[finish(*c) for c in coded])] if finish else _all_of(coded)
                    yield pa.RecordBatch.from_arrays([part.column(c) for c in other] + made, [*other, *new.names])
        finally:
            encoder.forget()

    return rows.mapInArrow(run, T.StructType([f for f in rows.schema if f.name != "__bpe_text"] + new.fields))


def decode(coded: DataFrame, model: BpeModel, ids: str = "ids") -> DataFrame:
    """The column `decoded`: tokens of an id array, joined by blanks; unknown ids are skipped,
    a null array gives the empty text."""
    spark: SparkSession = coded.sparkSession
    shipped = spark.sparkContext.broadcast({i: t for t, i in {**model.vocab, **model.special}.items()})

    @F.pandas_udf("string")
    def text_of(series: pd.Series) -> pd.Series:
        names = shipped.value
        return series.map(lambda a: " ".join(names[i] for i in ([] if a is None else a) if i in names))

    return coded.withColumn("decoded", text_of(F.col(ids)))
