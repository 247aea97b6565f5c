"""Approximate nearest neighbours with randomly rotated one-bit codes.

1. `fit`: the dimension (the commonest length), the mean of all vectors, and a random rotation
   from a seed.
2. Every vector less the mean, scaled to length 1 and rotated, leaves one bit for each
   dimension (its signs, packed into 64-bit words) and two scalars: its length, and the inner
   product of its direction with its code.
3. `search`: queries are rotated too and held as a few bit planes, so that the inner product of
   a query with a code is a sum of popcounts. Divided by the code's correction scalar it is an
   unbiased estimate with a known error bound. In a block, the best by estimate are computed
   exactly; then every vector whose estimate plus bound reaches the k-th best so far is.
4. The k best of the blocks, with exact scores, are merged for each query.

Rows and queries meet block by block: `rows` vectors against `queries` queries, both of fixed
size, as array work in one task. Only the k best of a block leave it.

Defined results for odd input: null vectors, vectors of length zero, with null or non-finite
components or of another than the commonest length take no part (the longer length wins a
tie); null ids take no part; rows that repeat an id are candidates each; queries that are equal
in id and vector are searched once, others that share an id are ranked each on its own; equal scores rank by the smaller id; with fewer than k
candidates all are returned; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from followgraph.llm.common import stored

#: Standard errors that an estimate may be off before the true neighbour is overlooked.
ERROR_BOUND = 4.0
PLANES = 6
ROWS, QUERIES = 8192, 1024
#: What the order of additions can change in an inner product of unit vectors, and more.
_SLIP = 1e-9


@dataclass(frozen=True)
class RotatedCodes:
    """What is needed to make codes: dimension, mean, seed."""

    dimension: int
    mean: tuple[float, ...]
    seed: int = 7

    @property
    def width(self) -> int:
        return -(-self.dimension // 64) * 64

    @cached_property
    def rotation(self) -> np.ndarray:
        """A random orthogonal matrix; vectors are filled up with zeros to whole 64-bit words."""
        q, r = np.linalg.qr(np.random.default_rng(self.seed).standard_normal((self.width, self.width)))
        return (q * np.sign(np.diag(r)))[:, : self.dimension]

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes (words of 64 bits), lengths, and inner products of directions with codes."""
        centred = vectors - np.array(self.mean)
        length = np.linalg.norm(centred, axis=1)
        rotated = centred @ self.rotation.T / np.where(length > 0, length, 1)[:, None]
        bits = rotated > 0
        aligned = np.abs(rotated).sum(axis=1) / math.sqrt(self.width)
        codes = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
        return codes, length, np.where(length > 0, aligned, 1)


def valid_vectors(df: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(id, v: array of double) of the rows that can take part, whatever their length."""
    v = F.col(vector).cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    return df.select(F.col(id_column).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & good)


def fit(valid: DataFrame, seed: int = 7) -> RotatedCodes | None:
    """Dimension and mean over all rows; None if there is no row."""
    sizes = valid.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    if not sizes:
        return None
    n = sizes[0]["n"]

    def sums(batches):
        total, rows = np.zeros(n), 0
        for frame in batches:
            if len(frame):
                x = np.stack(frame["v"].to_numpy())
                total += x.sum(axis=0)
                rows += len(x)
        yield pd.DataFrame({"place": np.arange(n), "total": total, "rows": rows})

    parts = valid.where(F.size("v") == n).select("v").mapInPandas(sums, "place int, total double, rows long")
    means = parts.groupBy("place").agg((F.sum("total") / F.sum("rows")).alias("mean")).orderBy("place").collect()
    return RotatedCodes(n, tuple(r["mean"] for r in means), seed)


def _exact(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products in double precision, added up from the first component on."""
    total = np.zeros(len(vectors))
    for d in range(len(query)):
        total += query[d] * vectors[:, d]
    return total


def _planes(rotated: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Queries as bit planes of PLANES-bit whole numbers: planes, least value, step."""
    low = rotated.min(axis=1)
    step = np.maximum((rotated.max(axis=1) - low) / (2**PLANES - 1), 1e-300)
    whole = np.clip(np.rint((rotated - low[:, None]) / step[:, None]), 0, 2**PLANES - 1).astype(np.int64)
    planes = [
        np.packbits((whole >> b & 1).astype(bool), axis=1, bitorder="little").view(np.uint64) for b in range(PLANES)
    ]
    return np.stack(planes), low, step


def search_block(model: RotatedCodes, q_id, q, v_id, v, codes, length, aligned, k: int, bound: float):
    """The k nearest of a block for each query: arrays of query id, id, score."""
    width = model.width
    rotated = q @ model.rotation.T
    planes, low, step = _planes(rotated)
    words = [np.ascontiguousarray(w) for w in codes.T]
    ones = np.bitwise_count(codes).sum(axis=1).astype(np.float64)
    to_mean, whole, norm = q @ np.array(model.mean), rotated.sum(axis=1), np.linalg.norm(rotated, axis=1)
    factor = length / aligned / math.sqrt(width)
    spread = bound * length * np.sqrt(np.maximum(1 / aligned**2 - 1, 0) / max(width - 1, 1))
    rounding = factor * (width / 2)
    found = []
    for i in range(len(q)):
        counts = np.zeros(len(codes), np.int32)
        for b in range(PLANES):
            for w, word in enumerate(words):
                counts += np.bitwise_count(word & planes[b, i, w]) * np.int32(1 << b)
        # sum of the query's components under set bits, twice, less the sum of all
        estimate = to_mean[i] + factor * (2 * (low[i] * ones + step[i] * counts) - whole[i])
        other = v_id != q_id[i]
        estimate[~other] = -np.inf
        first = np.argpartition(-estimate, min(2 * k, len(estimate) - 1))[: 2 * k]
        first = first[other[first]]
        if not len(first):
            continue
        score = v[first] @ q[i]
        if len(first) > k:
            # what may still be among the k best, by the error bounds of estimate and of rounding
            floor = np.partition(score, len(score) - k)[len(score) - k]
            first = np.flatnonzero((estimate + norm[i] * spread + step[i] * rounding >= floor - _SLIP * norm[i]) & other)
            score = v[first] @ q[i]
            floor = np.partition(score, len(score) - k)[len(score) - k]
            first = first[score >= floor - _SLIP * norm[i] * length.max()]
        exact = _exact(q[i], v[first])
        best = np.lexsort((v_id[first], -exact))[:k]
        found.append((np.full(len(best), q_id[i]), v_id[first][best], exact[best], np.full(len(best), i)))
    return [np.concatenate(x) for x in zip(*found)] if found else None


def search(
    df: DataFrame,
    queries: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    k: int = 20,
    bound: float = ERROR_BOUND,
    model: RotatedCodes | None = None,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k vectors of `df` with the largest inner
    product for every row of `queries`, without the query's own id."""
    valid = valid_vectors(df, id_column, vector)
    model = model or fit(valid)
    if model is None:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    n = model.dimension
    index = stored(_encoded(valid.where(F.size("v") == n), model), "codes")
    asked = valid_vectors(queries, id_column, vector).where(F.size("v") == n).dropDuplicates(["id", "v"])
    packed = stored(_packed(asked), "queries")
    # each block of vectors has a slot, and each block of queries is sent to every slot
    slots = max(index.count(), 1)
    rows = index.withColumn("slot", F.pmod(F.xxhash64("block"), F.lit(slots)))
    sent = packed.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)).cast("array<long>")))
    pairs = rows.join(sent, "slot").drop("slot", "block")

    def run(batches):
        for frame in batches:
            best: list = []
            for row in frame.itertuples():
                v_id, v = np.frombuffer(row.ids, np.int64), np.frombuffer(row.vectors).reshape(-1, n)
                codes = np.frombuffer(row.codes, np.uint64).reshape(len(v_id), -1)
                length, aligned = np.frombuffer(row.scalars).reshape(2, -1)
                q_id, key = np.frombuffer(row.q_ids, np.int64), np.frombuffer(row.q_keys, np.int64)
                q = np.frombuffer(row.q).reshape(-1, n)
                got = search_block(model, q_id, q, v_id, v, codes, length, aligned, k, bound)
                if got:
                    best.append(pd.DataFrame({"query_id": got[0], "vec_id": got[1], "score": got[2], "q_key": key[got[3]]}))
            if best:
                merged = pd.concat(best).sort_values(["q_key", "score", "vec_id"], ascending=[True, False, True])
                yield merged.groupby("q_key", sort=False).head(k)

    near = pairs.mapInPandas(run, "query_id long, vec_id long, score double, q_key long")
    order = Window.partitionBy("q_key").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _encoded(vectors: DataFrame, model: RotatedCodes) -> DataFrame:
    """Blocks of at most ROWS vectors with their codes, each with a number of its own."""

    def run(batches):
        for frame in batches:
            for at in range(0, len(frame), ROWS):
                part = frame.iloc[at : at + ROWS]
                v = np.stack(part["v"].to_numpy())
                codes, length, aligned = model.encode(v)
                made = {
                    "ids": part["id"].to_numpy(np.int64),
                    "vectors": v,
                    "codes": codes,
                    "scalars": np.stack([length, aligned]),
                }
                yield pd.DataFrame({name: [x.tobytes()] for name, x in made.items()})

    blocks = vectors.mapInPandas(run, "ids binary, vectors binary, codes binary, scalars binary")
    return blocks.withColumn("block", F.monotonically_increasing_id())


def _packed(asked: DataFrame) -> DataFrame:
    """Blocks of at most QUERIES queries; `q_keys` tells queries of one id apart."""

    def run(batches):
        for frame in batches:
            for at in range(0, len(frame), QUERIES):
                part = frame.iloc[at : at + QUERIES]
                yield pd.DataFrame(
                    {
                        "q_ids": [part["id"].to_numpy(np.int64).tobytes()],
                        "q_keys": [part["key"].to_numpy(np.int64).tobytes()],
                        "q": [np.stack(part["v"].to_numpy()).tobytes()],
                    }
                )

    return asked.withColumn("key", F.xxhash64("id", "v")).mapInPandas(run, "q_ids binary, q_keys binary, q binary")
