"""Helpers that the operators of this subpackage share.

Words come in two kinds: `space_words` (anything between ASCII white space) works on bytes
inside Python tasks, `PLAIN_WORD` (ASCII letters, digits and everything beyond ASCII) is a
regular expression for SQL functions.
"""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Word characters: not ASCII, or an ASCII letter or digit. Both cases of A-Z belong to it.
PLAIN_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: About this many bytes of text are handled at once in a Python task.
CHUNK_BYTES = 16 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`. Where no such
    setting exists, the session's checkpoint folder is taken, and in local runs (tests) a new
    temporary folder becomes it. On a cluster there is no such folder to fall back to."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        context = spark.sparkContext
        if context.getCheckpointDir() is None:
            if not re.match(r"local(\[|$)", context.master):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="followgraph-"))
        found = context.getCheckpointDir()
    return found.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of `df`, written to the shared folder and read back: lineage ends here and
    a lost executor costs a re-read, not a re-run."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found.stored_at = path
    return found


def discard(*tables: DataFrame) -> None:
    """Deletes tables that `stored` has written, once nothing is left to be read from them."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Jobs run inside delete their shuffle files when they end, not when the driver's memory is
    next cleaned, and compress what they store by zstd."""
    settings = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}
    with _held(spark, settings):
        yield


@contextmanager
def small_batches(spark: SparkSession, size: int):
    """Where rows are large: jobs run inside hand about `size` bytes at once to a Python task, and
    store and read groups of rows of that size. Otherwise Spark takes 10,000 rows and Parquet a
    hundred before either looks at their size."""
    settings = {
        "spark.sql.execution.arrow.maxBytesPerBatch": str(size),
        "parquet.block.size": str(size),
        "parquet.block.size.row.check.min": "1",
        "parquet.page.size.row.check.min": "1",
    }
    with _held(spark, settings):
        yield


@contextmanager
def _held(spark: SparkSession, settings: dict[str, str]):
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is (SQL's lower() would change other letters)."""
    return F.translate(text, UPPER, LOWER)


def row_key(id_column: Column, text: Column) -> Column:
    """A key that tells rows apart that share an id; equal rows have equal keys."""
    return F.xxhash64(F.coalesce(id_column.cast("string"), F.lit("\x00null")), text)


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def fold(id_column: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; null ids fall in no fold (null)."""
    return F.crc32(id_column.cast("string").cast("binary")) % parts


def chunks(batches: Iterator[pd.DataFrame], text: str, most: int = CHUNK_BYTES):
    """The rows of a task in frames of about `most` bytes of text, in the order they come."""
    for frame in batches:
        if not len(frame):
            continue
        size = frame[text].str.len().fillna(0).to_numpy(np.int64)
        group = np.maximum.accumulate((np.cumsum(size) - size) // most)
        for _, part in frame.groupby(group, sort=True):
            yield part.reset_index(drop=True)
    give_back()


def give_back() -> None:
    """Returns freed memory to the system: idle Python processes otherwise keep the peak of the
    tasks they have run."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def then_gives_back(run):
    """A function of one or two frames for `applyInPandas`, after which freed memory returns to the
    system: of two tasks on an executor, the one that waits otherwise keeps its peak."""

    def one(group: pd.DataFrame) -> pd.DataFrame:
        try:
            return run(group)
        finally:
            give_back()

    def two(group: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
        try:
            return run(group, other)
        finally:
            give_back()

    return one if run.__code__.co_argcount == 1 else two


class WordHashes(dict):
    """64-bit hashes of words (bytes), kept for the words met so far."""

    LIMIT = 1 << 18

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def space_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space (exactly what bytes.split() cuts at), case unchanged."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def hashed_words(
    texts, hashes: WordHashes, lower: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in one array, and where each text starts in it
    (one entry more than there are texts)."""
    parts, starts = [], [0]
    for text in texts:
        data = text.encode("utf-8", "surrogatepass") if text else b""
        words = (data.lower() if lower else data).split()
        parts.append(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)))
        starts.append(starts[-1] + len(words))
    joined = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    return joined, np.array(starts, np.int64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of words[i : i + width] for each i where that lies inside the array."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = words[:n].copy()
    for k in range(1, width):
        total *= np.uint64(0x9E3779B97F4A7C15)
        total += words[k : n + k]
    return mixed(total)


def inside(starts: np.ndarray, width: int) -> np.ndarray:
    """Which windows over the joined texts lie within one text: a mask over positions."""
    n = max(int(starts[-1]) - width + 1, 0)
    ok = np.ones(n, bool)
    for end in starts[1:-1]:
        ok[max(end - width + 1, 0) : end] = False
    return ok


def coarse(key: Column, bits: int = 18) -> Column:
    """One of 2**bits slots; equal ids have one slot whatever their integer type."""
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(1 << bits))


def keep_matching(rows: DataFrame, keys: DataFrame, key: str, bits: int = 18) -> DataFrame:
    """The rows whose key is in `keys`. A broadcast of at most 2**bits slots, whatever the
    number of keys, drops most others before the rows are shuffled."""
    slots = keys.select(coarse(F.col(key), bits).alias("__slot")).distinct()
    near = rows.withColumn("__slot", coarse(F.col(key), bits)).join(
        F.broadcast(slots), "__slot", "left_semi"
    )
    return near.drop("__slot").join(keys.select(key).distinct(), key, "left_semi").select(*rows.columns)


def drop_matching(rows: DataFrame, keys: DataFrame, key: str, bits: int = 18) -> DataFrame:
    """The rows whose key is not in `keys` (null keys stay); only rows that share a slot with
    one of the keys are shuffled."""
    slots = keys.select(coarse(F.col(key), bits).alias("__slot")).distinct()
    slotted = rows.withColumn("__slot", coarse(F.col(key), bits))
    apart = slotted.join(F.broadcast(slots), "__slot", "left_anti").drop("__slot")
    near = slotted.join(F.broadcast(slots), "__slot", "left_semi").drop("__slot")
    left = near.join(keys.select(key).distinct(), key, "left_anti")
    return apart.select(*rows.columns).unionByName(left.select(*rows.columns))


def pandas_column(run, schema: str):
    """A pandas UDF of several columns that gives a struct."""

    def typed(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        return run(a, b)

    return F.pandas_udf(typed, schema)


def bucket_count(df: DataFrame, least: int = 32) -> int:
    """Buckets for an exchange between tasks: as many as the input has partitions."""
    return max(least, df.rdd.getNumPartitions())
