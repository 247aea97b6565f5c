"""Near-duplicates by MinHash with sequential Bayesian verification.

1. A text's set: its distinct five-word shingles (64-bit hashes; A-Z lower-cased; a shorter
   text is one shingle). Texts with equal sets form a class and go on as one.
2. A class's signature of MINIMA minima is cut into bands; classes that agree on a band are
   candidates of each other. A pair at the threshold t shares no band with a chance of
   (1 - t**rows) ** bands; bands have as many rows as keep that at `miss` or below.
3. Verification compares signatures batch by batch. With m of n equal and a flat prior, the
   posterior chance of similarity t or more is P(Binomial(n + 1, t) <= m); a pair is dropped
   as soon as that is under `miss`. What survives is verified exactly on the full sets.
4. First every class of a bucket is held against one of them, the least id (`pivot`), which is linear. Links make
   components. That settles the pivot. Where the rest of a bucket still has classes of several
   components, those outside its largest one are held against all of the rest, in blocks of
   bounded size inside tasks: only links come out, never pairs. So no candidate pair between
   different components is left out, and no group of copies is paired up within itself. Of
   these classes signatures are compared first, and full sets are sent only of those that have
   a partner left.

Defined results for odd input: null and empty texts, and texts without words, have an empty
set (0 shingles) and no links; rows that share an id are one node: their sets' links are
united, and each row keeps its own number of shingles; a row with a null id has null for
component, takes part in no link and is kept; an empty table gives an empty table. Only id
and text are read. Very long texts are taken whole.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from followgraph.llm.common import WordHashes, chunks, coarse, discard, hashed_words, mixed, stored, window_hashes
from followgraph.llm.components import components

WIDTH = 5
MINIMA = 120
BATCH = 24
MISS = 1e-6
BLOCK = 512

_FACTORS = np.random.default_rng(20).integers(1, 2**63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(words: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Distinct shingle hashes, sorted."""
    if not len(words):
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(words, min(width, len(words))))


def signature(own: np.ndarray) -> np.ndarray:
    """Minima of MINIMA hash functions over a set, each cut to 32 bits."""
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(own), 2048):
        np.minimum(least, (own[at : at + 2048, None] * _FACTORS).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def band_rows(percent: int, miss: float = MISS) -> int:
    """Rows of a band: the most for which a pair at the threshold is missed with `miss` at most."""
    fit = [r for r in (6, 5, 4, 3, 2) if (1 - (percent / 100) ** r) ** (MINIMA // r) <= miss]
    return fit[0] if fit else 1


def band_hashes(signatures: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit value for each band of each signature (rows of a matrix)."""
    parts = signatures.reshape(len(signatures), MINIMA // rows, rows).astype(np.uint64)
    total = np.broadcast_to(np.arange(parts.shape[1], dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(rows):
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return total.view(np.int64)


@lru_cache
def least_matches(threshold: float, miss: float = MISS) -> tuple[tuple[int, int], ...]:
    """(n, least number of equal minima among the first n) that keep a pair alive."""
    table = []
    for n in range(BATCH, MINIMA + 1, BATCH):
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        table.append((n, m))
    return tuple(table)


def alive(a: np.ndarray, b: np.ndarray, threshold: float, miss: float = MISS) -> np.ndarray:
    """Which pairs (rows of two matrices of signatures) survive all batches; later batches are
    looked at for the survivors of the earlier ones only."""
    left, same, seen = np.arange(len(a)), np.zeros(len(a), np.int64), 0
    for n, least in least_matches(threshold, miss):
        same[left] += (a[left, seen:n] == b[left, seen:n]).sum(axis=1)
        left, seen = left[same[left] >= least], n
    return left


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 * |x & y| >= percent * |x | y|, in whole numbers."""
    if min(len(x), len(y)) * 100 < percent * max(len(x), len(y)):
        return False
    both = np.concatenate([x, y])
    both.sort()
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * common >= percent * (len(both) - common)


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """(id, class, shingles as bytes) of the given rows (id, text)."""

    def run(batches):
        hashes = WordHashes()
        for part in chunks(batches, "text", 4 << 20):
            words, at = hashed_words(part["text"], hashes, lower=True)
            own = [shingles(words[a:b], width).tobytes() for a, b in zip(at, at[1:])]
            yield pd.DataFrame({"id": part["id"], "class": [xxhash.xxh3_128_digest(x) for x in own], "own": own})

    return docs.mapInPandas(run, "id long, class binary, own binary")


def _signed(docs: DataFrame, width: int) -> DataFrame:
    """(id, n, class, signature) of every row (id, text)."""

    def run(batches):
        hashes = WordHashes()
        for part in chunks(batches, "text", 4 << 20):
            words, at = hashed_words(part["text"], hashes, lower=True)
            found = []
            for a, b in zip(at, at[1:]):
                own = shingles(words[a:b], width)
                digest = xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None
                found.append((len(own), digest, signature(own).tobytes() if len(own) else None))
            n, classes, signatures = zip(*found)
            yield pd.DataFrame({"id": part["id"].astype("Int64"), "n": n, "class": classes, "signature": signatures})

    return docs.mapInPandas(run, "id long, n long, class binary, signature binary")


def _bands(classes: DataFrame, rows: int) -> DataFrame:
    """(band, id, mark): a row for each band of each class."""

    def run(batches):
        for frame in batches:
            if len(frame):
                matrix = np.frombuffer(b"".join(frame["signature"]), np.uint32).reshape(len(frame), -1)
                ids, marks = (np.repeat(frame[c].to_numpy(np.int64), MINIMA // rows) for c in ("id", "mark"))
                yield pd.DataFrame({"band": band_hashes(matrix, rows).ravel(), "id": ids, "mark": marks})

    return classes.select("id", "mark", "signature").mapInPandas(run, "band long, id long, mark long")


def _near(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose id shares one of 2**18 slots with one of `ids`: a broadcast of bounded size
    that leaves out most other rows before a shuffle."""
    slots = ids.select(coarse(F.col("id")).alias("slot")).distinct()
    return rows.withColumn("slot", coarse(F.col("id"))).join(F.broadcast(slots), "slot", "left_semi").drop("slot")


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int, miss: float) -> DataFrame:
    """The pairs (a, b) that are links: signatures first, then full sets."""
    ends = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    signed = _near(classes.select("id", "signature"), ends)

    def look(batches):
        for frame in batches:
            if len(frame):
                a, b = (np.frombuffer(b"".join(frame[c]), np.uint32).reshape(len(frame), -1) for c in ("sa", "sb"))
                yield frame[["a", "b"]].iloc[alive(a, b, percent / 100, miss)]

    compared = pairs.join(signed.toDF("a", "sa"), "a").join(signed.toDF("b", "sb"), "b")
    survivors = stored(compared.mapInPandas(look, "a long, b long").distinct(), "survivors")
    ends = survivors.select(F.col("a").alias("id")).unionByName(survivors.select(F.col("b").alias("id")))
    own = _sets(_near(docs, ends), width).select("id", "own")

    def exact(batches):
        for frame in batches:
            good = [
                similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                for x, y in zip(frame["xa"], frame["xb"])
            ]
            yield frame.loc[good, ["a", "b"]]

    full = survivors.join(own.toDF("a", "xa"), "a").join(own.toDF("b", "xb"), "b")
    found = stored(full.mapInPandas(exact, "a long, b long").distinct(), "verified")
    discard(survivors)
    return found


def _open_members(members: DataFrame, known: DataFrame) -> DataFrame:
    """Members of buckets whose classes, but for the settled pivot, lie in several components:
    band, id, mark, component, the size n of that rest, and whether the class is outside the
    rest's largest component."""
    named = members.where("id <> pivot").join(known.withColumnRenamed("node", "id"), "id", "left").select(
        "band", "id", "mark", F.coalesce("component", "id").alias("component")
    )
    sizes = named.groupBy("band", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed_up = (
        sizes.groupBy("band")
        .agg(F.sum("n").alias("n"), F.max_by("component", "n").alias("main"), F.count(F.lit(1)).alias("parts"))
        .where("parts > 1")
    )
    return named.join(mixed_up, "band").withColumn("rest", F.col("component") != F.col("main"))


def _cells(open_: DataFrame, whole: DataFrame) -> DataFrame:
    """The members, with the columns of `whole`, in cells: one side is what is outside the bucket's
    largest component, the other all of the bucket. Rows of a cell follow each other in a
    partition, so that one Python call takes many small cells."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = open_.withColumn("block", F.pmod(F.xxhash64("id", "mark"), blocks).cast("int"))
    every = F.sequence(F.lit(0), blocks - 1)
    left = placed.where("rest").select("band", "id", "mark", "component", F.col("block").alias("row"), F.explode(every).alias("column"), F.lit(True).alias("left"))
    right = placed.select("band", "id", "mark", "component", F.explode(every).alias("row"), F.col("block").alias("column"), F.lit(False).alias("left"))
    cells = left.unionByName(right).join(whole, ["id", "mark"])
    return cells.repartition("band", "row", "column").sortWithinPartitions("band", "row", "column")


def _in_cells(cells: DataFrame, look, schema: str) -> DataFrame:
    """`look` over whole cells, as many at once as come in a batch."""

    def run(batches):
        carried = None
        for frame in batches:
            if carried is not None and len(carried):
                frame = pd.concat([carried, frame], ignore_index=True)
            if not len(frame):
                continue
            starts = _cell_starts(frame)
            carried = frame.iloc[starts[-1] :]
            yield look(frame.iloc[: starts[-1]])
        if carried is not None and len(carried):
            yield look(carried)

    return cells.mapInPandas(run, schema)


def _leftover(members: DataFrame, known: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int, miss: float):
    """Links between classes that share a bucket and are not yet in one component."""
    open_ = stored(_open_members(members, known), "open")
    rows = band_rows(percent, miss)
    signed = _near(classes.select("id", "mark", "signature"), open_)
    partners = _in_cells(
        _cells(open_, signed), lambda frame: _with_partner(frame, percent, miss, rows), "band long, id long, mark long"
    )
    found = stored(partners.distinct(), "partners")
    ids = found.select("id").distinct()
    # an id may stand for several classes: each has its own signature and set
    own = _sets(_near(docs, ids), width).select("id", F.xxhash64("class").alias("mark"), "own").dropDuplicates(["id", "mark"])
    whole = signed.join(own, ["id", "mark"])
    left = open_.join(found, ["band", "id", "mark"])
    links = _in_cells(_cells(left, whole), lambda frame: _links_in_cells(frame, percent, miss, rows), "a long, b long")
    result = stored(links.distinct(), "leftover")
    discard(open_, found)
    return result


def _cell_starts(frame: pd.DataFrame) -> np.ndarray:
    """Where a new cell begins among sorted rows."""
    key = frame[["band", "row", "column"]].to_numpy(np.int64)
    return np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)]))


def _pairs_in_cells(frame: pd.DataFrame, percent: int, miss: float, rows: int):
    """(first and second rows of the pairs whose signatures agree enough, the cell's rows on its
    left and on its right) for each cell of sorted rows, in stretches."""
    if not len(frame):
        return
    starts = _cell_starts(frame)
    signatures = np.frombuffer(b"".join(frame["signature"]), np.uint32).reshape(len(frame), -1)
    bands = band_hashes(signatures, rows)
    parts = frame["component"].to_numpy(np.int64)
    band, left = frame["band"].to_numpy(np.int64), frame["left"].to_numpy(bool)
    sizes = frame["own"].str.len().to_numpy() // 8 if "own" in frame else np.ones(len(frame), np.int64)
    for lo, hi in zip(starts, np.append(starts[1:], len(frame))):
        here = np.arange(lo, hi)
        x, y = here[left[lo:hi]], here[~left[lo:hi]]
        if not len(x) or not len(y):
            continue
        column = int(np.flatnonzero((bands[x[:1]] == band[lo]).any(axis=0))[0])
        for i, j in _candidates(x, y, parts, sizes, bands, column, percent):
            near = alive(signatures[i], signatures[j], percent / 100, miss)
            yield i[near], j[near], x, y


def _with_partner(frame: pd.DataFrame, percent: int, miss: float, rows: int) -> pd.DataFrame:
    """The members of which some pair is left, by signatures alone."""
    marked = np.zeros(len(frame), bool)
    for i, j, _, _ in _pairs_in_cells(frame, percent, miss, rows):
        marked[i] = marked[j] = True
    return frame.loc[marked, ["band", "id", "mark"]]


def _links_in_cells(frame: pd.DataFrame, percent: int, miss: float, rows: int) -> pd.DataFrame:
    """Links within each cell of sorted rows, between its left and its right side."""
    a, b, seen, common = [], [], None, None
    ids = frame["id"].to_numpy(np.int64)
    sets = [np.frombuffer(v, np.uint64) for v in frame["own"]]
    sizes = np.array([len(v) for v in sets])
    for i, j, x, y in _pairs_in_cells(frame, percent, miss, rows):
        if len(i) > len(x) + len(y):
            if seen is not x:
                seen, common = x, _in_common(x, y, sets)
            lo = min(x[0], y[0])
            most = np.minimum(common[i - lo], common[j - lo])
            possible = 100 * most >= percent * (sizes[i] + sizes[j] - most)
            i, j = i[possible], j[possible]
        good = [similar(sets[p], sets[q], percent) for p, q in zip(i, j)]
        a.append(ids[i][good])
        b.append(ids[j][good])
    none = np.empty(0, np.int64)
    return pd.DataFrame({"a": np.concatenate([none, *a]), "b": np.concatenate([none, *b])})


def _candidates(x, y, parts, sizes, bands, column: int, percent: int, step: int = 16384):
    """Pairs of rows to compare, in stretches: of different components and like sizes, each in the
    first band that it shares."""
    width = max(1, step // len(y))
    for at in range(0, len(x), width):
        i, j = (v.ravel() for v in np.meshgrid(x[at : at + width], y, indexing="ij"))
        low, high = np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j])
        todo = (parts[i] != parts[j]) & (100 * low >= percent * high)
        i, j = i[todo], j[todo]
        if column and len(i):
            first = ~(bands[i, :column] == bands[j, :column]).any(axis=1)
            i, j = i[first], j[first]
        if len(i):
            yield i, j


def _in_common(x, y, sets) -> np.ndarray:
    """How many of each set's elements the other side has at all: no pair shares more."""
    first = min(x[0], y[0])
    common = np.zeros(len(x) + len(y), np.int64)
    for own, other in ((x, y), (y, x)):
        there = np.unique(np.concatenate([sets[k] for k in other]))
        for k in own:
            common[k - first] = np.isin(sets[k], there, assume_unique=True).sum()
    return common


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", percent: int = 80, width: int = WIDTH, miss: float = MISS
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row: documents are linked if their sets
    agree in `percent` of a hundred or more."""
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    signed = stored(_signed(rows, width), "signatures")
    classed = signed.where(F.col("id").isNotNull() & F.col("class").isNotNull())
    classes = stored(
        classed.groupBy("class")
        .agg(F.min("id").alias("id"), F.any_value("signature").alias("signature"))
        .withColumn("mark", F.xxhash64("class")),
        "classes",
    )
    per_band = band_rows(percent, miss)
    buckets = _bands(classes, per_band).groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("pivot")).where("n > 1")
    members = stored(_bands(classes, per_band).join(buckets.select("band", "pivot"), "band"), "members")
    pairs = stored(members.where("id <> pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct(), "pairs")
    links = _verified(pairs, classes, rows, width, percent, miss)
    known = stored(components(links), "components")
    more = _leftover(members, known, classes, rows, width, percent, miss)
    discard(members, pairs)
    # rows of one id are one node: each class hangs together with every id that it has
    same = classed.join(classes.select("class", F.col("id").alias("rep")), "class").where("id <> rep").select(
        F.col("rep").alias("a"), F.col("id").alias("b")
    )
    last = components(links.unionByName(more).unionByName(same))
    return (
        signed.join(last.withColumnRenamed("node", "id"), "id", "left")
        .withColumn("component", F.coalesce("component", "id"))
        .select(
            F.col("id").alias("doc_id"),
            F.col("n").alias("n_shingles"),
            F.col("component").alias("component_id"),
            F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
        )
    )
