"""Phrase collocations by mergeable Misra-Gries summaries and an exact second count.

Texts (A-Z lower-cased) are split at `[.,;:!?` and line breaks `]` into pieces and these at
blanks and tabs into words; a phrase is up to LONGEST consecutive words of one piece, and
everything is per stratum (language).

1. Summaries: a task sums up the phrases of its texts, by a 64-bit hash of stratum and words,
   and cuts the sums by the first bits of the hash. All parts of one hash partition are merged
   by the Misra-Gries rule: with more counters than `capacity` the one after the last allowed
   is taken off all. The capacity is the partition's mass (its phrase occurrences) divided by
   the threshold, and one more, so less than the threshold is ever taken off, and every phrase
   that occurs so often survives. Masses come before the parts in the sorted rows, so a task
   knows the capacity before it merges and holds no more counters than that and one batch.
2. What survives is kept in a Bloom filter of 2**BITS bits, in blocks of 2**BLOCK picked by the
   first bits of the hash, so a hash partition writes its own stretch of it; its size does not
   grow with the data.
   Phrases of one and two words are summed up first; longer ones only where all their word
   pairs have survived, as a phrase is no more frequent than its parts.
3. The second pass counts the survivors exactly, by stratum and words, never by a hash: a
   collision only makes it count a phrase that then fails the threshold. Tasks add up what they
   count and send it packed, a row for each bucket of phrases.
4. Cuts, scores and the dropping of phrases inside longer ones are joins on that count; scores
   are exact quotients of decimals.

The parts are exchanged in levels of at most 2**FAN ranges, so rows grow in proportion to the
texts, and the number of hash partitions with their bytes.

Defined results for odd input: null and empty texts have no words; a null stratum is `und`;
repeated rows and ids count as often as they are there; ties are settled by the phrase's bytes;
an empty table gives an empty table; very long texts are taken whole. Only text and stratum are
read, so other columns and their names don't matter.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from followgraph.llm.common import chunks, stored

LONGEST = 5
LEAST = 100
MOST = 2000
#: Bits of the table of survivors, and of one of its blocks, as powers of two: 16 MB, whatever the
#: size of the corpus.
BITS = 27
BLOCK = 9
#: Bits by which one exchange tells hash partitions apart.
FAN = 8
CHUNK = 4 << 20
#: Counters, and phrases of the second pass, that a task holds before it hands them on.
HELD = 1 << 21
HELD_PHRASES = 1 << 18
#: Bytes of counters that one hash partition is meant to get.
PARTITION_BYTES = 16 << 20

_BREAK = b"\xff"
_PIECES = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", _BREAK * 10)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class _Numbers(dict):
    """Numbers of words in the order they are met; 0 is the end of a piece."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Words:
    """The words of some texts in one array, with their pieces and strata."""

    def __init__(self, texts, strata):
        numbers, parts, sizes = _Numbers({_BREAK: 0}), [], []
        for text in texts:
            data = text.encode("utf-8", "surrogatepass").lower() if text else b""
            words = data.translate(_PIECES).replace(_BREAK, b" \xff ").split()
            words.append(_BREAK)
            parts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
            sizes.append(len(words))
        self.names = list(numbers)
        self.strata, which = np.unique(np.array([str(s) for s in strata], object), return_inverse=True)
        ids = np.concatenate([np.empty(0, np.int32), *parts])
        real = ids > 0
        self.ids = ids[real]
        self.piece = np.cumsum(~real)[real]
        self.stratum = np.repeat(which.astype(np.int32), sizes)[real]
        hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, self.names), np.uint64, len(self.names))
        seeds = np.fromiter((xxhash.xxh3_64_intdigest(s.encode()) for s in self.strata), np.uint64, len(self.strata))
        self._words, self._seeds = hashed[self.ids], seeds

    def windows(self):
        """(n, whether n words from each place on are of one piece, their hash) for n = 1, 2, ..."""
        total = self._words.copy()
        for n in range(1, LONGEST + 1):
            size = len(self.ids) - n + 1
            if size <= 0:
                return
            if n > 1:
                total = total[:size] * _STEP + self._words[n - 1 :]
            whole = self.piece[:size] == self.piece[n - 1 :]
            yield n, whole, _scrambled(total + self._seeds[self.stratum[:size]] * np.uint64(2 * n + 1))


def summed(hashes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order, and the sum of their counts (1 each if there are none)."""
    if counts is None:
        hashes = np.sort(hashes)
    else:
        order = np.argsort(hashes, kind="stable")
        hashes, counts = hashes[order], counts[order]
    if not len(hashes):
        return hashes, np.empty(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    if counts is None:
        return hashes[starts], np.diff(np.append(starts, len(hashes)))
    return hashes[starts], np.add.reduceat(counts, starts)


def shrunk(hashes: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The Misra-Gries step: at most `capacity` counters are left, and how much was taken off each."""
    if len(counts) <= capacity:
        return hashes, counts, 0
    off = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
    left = counts > off
    return hashes[left], counts[left] - off, off


def _places(hashes: np.ndarray, bits: int):
    """The three bits of each hash in a table of 2**bits: all in one block."""
    block = (hashes >> np.uint64(64 - bits + BLOCK)) << np.uint64(BLOCK)
    for k in range(3):
        yield (block | ((hashes >> np.uint64(k * BLOCK)) & np.uint64((1 << BLOCK) - 1))).astype(np.int64)


def hits(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes have all their bits set in the table (a power of two of bits)."""
    found = np.ones(len(hashes), bool)
    for place in _places(hashes, (8 * len(table)).bit_length() - 1):
        found &= (table[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1
    return found


def _alive(words: Words, short: np.ndarray | None):
    """(n, places, hashes) of the windows to look at: all of one and two words, and longer ones
    if all their pairs are in the table `short`."""
    pairs, before = None, None
    for n, whole, hashes in words.windows():
        if n <= 2:
            if short is None:
                yield n, np.flatnonzero(whole), hashes[whole]
                if n == 2:
                    return
                continue
            good = np.flatnonzero(whole)
            good = good[hits(short, hashes[good])]
            if n == 2:
                pairs = np.zeros(len(whole), bool)
                pairs[good] = True
                before = pairs
            yield n, good, hashes[good]
        else:
            before = before[: len(whole)] & pairs[n - 2 :]
            good = np.flatnonzero(before)
            yield n, good, hashes[good]


def _parts(hashes: np.ndarray, counts: np.ndarray, done: int, bits: int) -> pd.DataFrame:
    """Two rows for each range of the hash's bits done .. bits: its mass, and its counters."""
    bounds = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)
    found, starts = np.unique(bounds, return_index=True)
    rows = []
    for bucket, lo, hi in zip(found, starts, np.append(starts[1:], len(hashes))):
        own = counts[lo:hi]
        once = own == 1
        rows.append((int(bucket), 0, int(own.sum()), None, None, None))
        rows.append((int(bucket), 1, 0, hashes[lo:hi][once].tobytes(), hashes[lo:hi][~once].tobytes(), own[~once].astype(np.int64).tobytes()))
    return pd.DataFrame(rows, columns=["bucket", "kind", "mass", "once", "more", "counts"])


_PART = "bucket long, kind int, mass long, once binary, more binary, counts binary"


def _unpacked(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    once = np.frombuffer(b"".join(frame["once"]), np.uint64)
    more = np.frombuffer(b"".join(frame["more"]), np.uint64)
    counts = np.frombuffer(b"".join(frame["counts"]), np.int64)
    return np.concatenate([once, more]), np.concatenate([np.ones(len(once), np.int64), counts])


def _summaries(rows: DataFrame, table, bits: int) -> DataFrame:
    """The counters of every task's texts, in ranges of the hash. Without a table they are of
    phrases of one and two words, with one of longer phrases."""

    def run(batches):
        short = None if table is None else np.frombuffer(table.value, np.uint8)
        held: list = []
        size = 0

        def handed():
            return _parts(*summed(np.concatenate([h for h, _ in held]), np.concatenate([c for _, c in held])), 0, bits)

        for part in chunks(batches, "text", CHUNK):
            words = Words(part["text"], part["stratum"])
            found = [h for n, _, h in _alive(words, short) if short is None or n > 2]
            held.append(summed(np.concatenate([np.empty(0, np.uint64), *found])))
            size += len(held[-1][0])
            if size >= HELD:
                yield handed()
                held, size = [], 0
        if size:
            yield handed()

    return rows.mapInPandas(run, _PART)


def _regrouped(parts: DataFrame, done: int, more: int, left: int) -> DataFrame:
    """Counters of ranges of `done` bits, merged in groups of parts and cut by `more` bits: a
    range that is still 2**left partitions wide is merged in as many groups."""
    group = F.pmod(F.xxhash64("once", "more"), F.lit(1 << left))
    rows = parts.where("kind = 1").withColumn("part", group)

    def run(key, frame):
        del key
        return _parts(*summed(*_unpacked(frame)), done, done + more)

    return rows.groupBy("bucket", "part").applyInPandas(run, _PART)


def survivors(parts: DataFrame, bits: int, least: int) -> bytes:
    """The table of what may occur `least` times: every hash partition merges its counters and
    writes its stretch of the table."""
    size_of_table = BITS
    each = 1 << (BITS - bits)

    def run(batches):
        bucket, mass, off, held, buffer, size = None, 0, 0, None, [], 0

        def merge():
            nonlocal off, held, buffer, size
            if buffer:
                h, c = summed(np.concatenate([x for x, _ in buffer]), np.concatenate([x for _, x in buffer]))
                h, c, took = shrunk(h, c, mass // least + 1)
                held, off, buffer, size = (h, c), off + took, [(h, c)], len(h)

        def finished():
            merge()
            table = np.zeros(each, np.uint8)
            if held is not None:
                kept = held[0][held[1] + off >= least]
                for place in _places(kept, size_of_table):
                    table[place - bucket * each] = 1
            return pd.DataFrame({"bucket": [bucket], "bits": [np.packbits(table).tobytes()]})

        for frame in batches:
            for (b, kind), part in frame.groupby(["bucket", "kind"], sort=True):
                if b != bucket:
                    if bucket is not None:
                        yield finished()
                    bucket, mass, off, held, buffer, size = int(b), 0, 0, None, [], 0
                if kind == 0:
                    mass += int(part["mass"].sum())
                    continue
                for at in range(len(part)):
                    buffer.append(_unpacked(part.iloc[at : at + 1]))
                    size += len(buffer[-1][0])
                    if size > 2 * (mass // least + 1) + HELD:
                        merge()
        if bucket is not None:
            yield finished()

    ordered = parts.repartition(1 << bits, "bucket").sortWithinPartitions("bucket", "kind")
    whole = np.zeros((1 << BITS) // 8, np.uint8)
    # stretches of a table of 2**BITS bits, whatever the size of the corpus
    for row in ordered.mapInPandas(run, "bucket long, bits binary").collect():
        stretch = np.frombuffer(row["bits"], np.uint8)
        whole[row["bucket"] * len(stretch) : (row["bucket"] + 1) * len(stretch)] = stretch
    return whole.tobytes()


def partition_bits(volume: int) -> int:
    """Bits of the hash that tell partitions apart, for so many bytes of counters."""
    return min(BITS - BLOCK, max(5, math.ceil(math.log2(max(1, volume / PARTITION_BYTES)))))


def _table(rows: DataFrame, earlier, volume: int, least: int) -> bytes:
    bits = partition_bits(volume)
    done = min(bits, FAN)
    parts = _summaries(rows, earlier, done)
    while done < bits:
        more = min(FAN, bits - done)
        parts = _regrouped(parts, done, more, bits - done)
        done += more
    return survivors(parts, bits, least)


def frequent_phrases(docs: DataFrame, text: str = "text", stratum: str = "lang", least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(stratum, words, phrase, f) of every phrase of 1 to LONGEST words that occurs `least` times
    or more in its stratum, and (stratum, n) with the number of words of every stratum."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(text).cast("string").alias("text"), F.coalesce(F.col(stratum).cast("string"), F.lit("und")).alias("stratum")
    )
    # a phrase of two words takes some six bytes of text and eight of counters
    volume = 2 * (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    short = spark.sparkContext.broadcast(_table(rows, None, volume, least))
    long_ = spark.sparkContext.broadcast(_table(rows, short, volume, least))

    buckets = 1 << partition_bits(volume)

    def count(batches):
        tables = [np.frombuffer(b.value, np.uint8) for b in (short, long_)]
        held: dict = {}

        def handed():
            frame = pd.DataFrame([(*key, f) for key, f in held.items()], columns=["stratum", "words", "phrase", "f"])
            hashed = [xxhash.xxh3_64_intdigest(p.encode("utf-8", "surrogatepass")) & (buckets - 1) for p in frame["phrase"]]
            return frame.groupby(np.array(hashed, np.int64)).agg(list).rename_axis("bucket").reset_index()

        for part in chunks(batches, "text", CHUNK):
            words = Words(part["text"], part["stratum"])
            for name, f in zip(words.strata, np.bincount(words.stratum, minlength=len(words.strata)).tolist()):
                held[name, 0, ""] = held.get((name, 0, ""), 0) + f
            for n, places, hashes in _alive(words, tables[0]):
                if n > 2:
                    good = hits(tables[1], hashes)
                    places, hashes = places[good], hashes[good]
                if len(places):
                    for name, phrase, f in _counted(words, n, places, hashes):
                        held[name, n, phrase] = held.get((name, n, phrase), 0) + f
            if len(held) >= HELD_PHRASES:
                yield handed()
                held.clear()
        if held:
            yield handed()

    # a row for each bucket that a task has phrases of, so no more rows than phrases
    packed = rows.mapInPandas(count, "bucket long, stratum array<string>, words array<int>, phrase array<string>, f array<long>")

    def add_up(batches):
        total: dict = {}
        for frame in batches:
            for lists in zip(frame["stratum"], frame["words"], frame["phrase"], frame["f"]):
                for *key, f in zip(*map(list, lists)):
                    total[tuple(key)] = total.get(tuple(key), 0) + f
        rest = [(*key, f) for key, f in total.items() if f >= least or not key[1]]
        yield pd.DataFrame(rest, columns=["stratum", "words", "phrase", "f"])

    total = packed.repartition(buckets, "bucket").mapInPandas(add_up, "stratum string, words int, phrase string, f long")
    kept = stored(total, "phrases")
    sums = stored(kept.where("words = 0 AND f > 0").select("stratum", F.col("f").alias("n")), "words")
    return kept.where("words > 0"), sums


def _counted(words: Words, n: int, places: np.ndarray, hashes: np.ndarray):
    """(stratum, phrase, how often it begins at one of the places); equal hashes are told apart by words."""
    order = np.argsort(hashes, kind="stable")
    places, hashes = places[order], hashes[order]
    new = np.concatenate([[True], hashes[1:] != hashes[:-1]])
    for column in [words.stratum[places], *(words.ids[places + k] for k in range(n))]:
        new[1:] |= column[1:] != column[:-1]
    starts = np.flatnonzero(new)
    first, names = places[starts], words.names
    own = np.stack([words.ids[first + k] for k in range(n)], axis=1).tolist()
    phrases = (b" ".join([names[i] for i in row]).decode("utf-8", "replace") for row in own)
    return zip(words.strata[words.stratum[first]].tolist(), phrases, np.diff(np.append(starts, len(places))).tolist())


def collocations(docs: DataFrame, text: str = "text", stratum: str = "lang", least: int = LEAST, most: int = MOST) -> DataFrame:
    """stratum, rank, phrase, a, l, r, n, score: the `most` best phrases of two words or more of
    every stratum.

    A phrase cut after its k-th word scores floor(1000 * a * n / (l * r)), where a, l and r are
    the counts of the phrase and of its two parts; the lowest cut counts. Phrases that lie in a
    longer one with the same count are dropped."""
    phrases, sums = frequent_phrases(docs, text, stratum, least)
    known = phrases.select("stratum", "phrase", "f")
    several = phrases.where("words > 1")
    cuts = several.select(
        "stratum", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    ).withColumn("left", F.expr("substring_index(phrase, ' ', k)"))
    cuts = cuts.withColumn("right", F.substring(F.col("phrase"), F.length("left") + 2, F.length("phrase")))
    scored = (
        cuts.join(known.toDF("stratum", "left", "l"), ["stratum", "left"])
        .join(known.toDF("stratum", "right", "r"), ["stratum", "right"])
        .join(sums, "stratum")
    )
    wide = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "l", "r", "n")}
    score = F.call_function("div", wide["a"] * wide["n"] * F.lit(1000).cast("decimal(4,0)"), wide["l"] * wide["r"])
    best = (
        scored.withColumn("score", score)
        .groupBy("stratum", "phrase")
        .agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("cut"))
        .select("stratum", "phrase", "cut.*")
    )
    # a phrase inside any longer one as frequent as itself is also inside one that is a word longer
    inner = (
        phrases.where("words > 2")
        .select(
            "stratum",
            F.expr("explode(array(substring_index(phrase, ' ', words - 1), substring_index(phrase, ' ', 1 - words)))").alias("phrase"),
            "f",
        )
        .groupBy("stratum", "phrase")
        .agg(F.max("f").alias("longer"))
    )
    left = best.join(inner, ["stratum", "phrase"], "left").where("longer IS NULL OR longer < a")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # first within shares of a stratum, so that no task orders all phrases of a large one
    share = F.pmod(F.xxhash64("phrase"), F.lit(64))
    near = left.withColumn("share", share).withColumn("rank", F.row_number().over(Window.partitionBy("stratum", "share").orderBy(*order)))
    ranked = near.where(F.col("rank") <= most).withColumn("rank", F.row_number().over(Window.partitionBy("stratum").orderBy(*order)))
    return ranked.where(F.col("rank") <= most).select("stratum", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
