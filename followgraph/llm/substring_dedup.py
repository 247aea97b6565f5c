"""Substring dedup with fixed-block anchors.

A window is `window` consecutive words. Any window holds a whole block of window // 2 words
that starts at a multiple of the block's length in its document, so:

1. Index and probe: each document's non-overlapping blocks are the reference index, and every
   rolling window of a block's length probes it. A block that stands anywhere else, too, is an
   anchor, at all its places.
2. Extend: the full windows that hold an anchor are compared with each other, by hashes of
   their words. Neighbouring windows that repeat make up the maximal repeat. The place that
   comes first, by id and start, stays; words covered by any other place of it go.

Both steps meet by hash. Tasks work on chunks of texts: a chunk sends each distinct hash once,
packed, to the hash's bucket, and gets back which of its places matter; what repeats inside a
chunk is settled there. So a passage that stands in a third of all documents is one entry per
chunk, not one per document. A false match in step 1 only costs work; step 2 compares 64 bits
and the bucket.

Defined results for odd input: null and empty texts have no words; texts shorter than a
window lose nothing; a null id comes before all others; rows that are equal in id and text
stand at the same place, so neither removes the other's words; rows that share an id only are
compared by start (equal starts both stay). Very long texts are taken whole; an empty table
gives an empty table. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from followgraph.llm.common import (
    WordHashes,
    bucket_count,
    chunks,
    coarse,
    hashed_words,
    inside,
    mixed,
    pandas_column,
    row_key,
    space_words,
    stored,
    window_hashes,
)

WINDOW = 20
BUCKETS = 64
#: Bytes of text that a task hashes at once: a dozen arrays of eight bytes a word stand beside it.
CHUNK = 8 << 20
_LOW = np.uint64((1 << 40) - 1)
_MANY, _ALIGNED = 1, 2
#: What a row of an exchange holds: entries for a bucket, or news of a chunk about itself.
_ENTRIES, _PLACES, _KEYS = 0, 1, 2
_EXCHANGE = "bucket int, chunk long, what int, a binary, b binary, c binary, d binary"


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _runs(places: np.ndarray) -> np.ndarray:
    """Sorted places as rows (start, number)."""
    if not len(places):
        return np.empty((0, 2), np.int32)
    first = np.flatnonzero(np.diff(places, prepend=places[0] - 2) != 1)
    return np.stack([places[first], np.diff(first, append=len(places))], axis=1).astype(np.int32)


def _spread(runs: np.ndarray) -> np.ndarray:
    return np.concatenate([np.arange(s, s + n) for s, n in runs]) if len(runs) else np.empty(0, np.int64)


def _row(bucket: int, chunk: int, what: int, *parts: np.ndarray) -> dict:
    data = [p.tobytes() for p in parts] + [b""] * (4 - len(parts))
    return {"bucket": bucket, "chunk": chunk, "what": what} | dict(zip("abcd", data))


def _chunk_id(keys: np.ndarray) -> int:
    """The same for the same rows, whichever attempt of a task handles them."""
    part = mixed(keys.view(np.uint64) + np.arange(len(keys), dtype=np.uint64))
    return int(np.bitwise_xor.reduce(part).view(np.int64))


def _news(chunk: int, what: int, *parts: np.ndarray) -> dict:
    """A chunk's news to itself takes the same way as its entries, to a bucket below 0."""
    return _row(-1 - chunk % BUCKETS, chunk, what, *parts)


def _document_of(starts: np.ndarray, places: np.ndarray) -> np.ndarray:
    return np.searchsorted(starts, places, side="right") - 1


def _place_rows(chunk: int, starts: np.ndarray, places: np.ndarray) -> list[dict]:
    """Places (in the joined words) as news: document and runs of starts inside it."""
    if not len(places):
        return []
    runs = _runs(np.sort(places))
    document = _document_of(starts, runs[:, 0])
    table = np.stack([document, runs[:, 0] - starts[document], runs[:, 1]], axis=1).astype(np.int32)
    return [_news(chunk, _PLACES, table)]


def _probe(docs: DataFrame, block: int, buckets: int) -> DataFrame:
    """Step 1, map side: rolling windows of a block's length, one entry per distinct hash."""

    def run(batches):
        hashes = WordHashes()
        for part in chunks(batches, "text", CHUNK):
            words, starts = hashed_words(part["text"], hashes, lower=False)
            keys = part["key"].to_numpy(np.int64)
            chunk = _chunk_id(keys)
            rows = [_news(chunk, _KEYS, keys)]
            h = window_hashes(words, block)
            places = np.flatnonzero(inside(starts, block)) if len(h) else np.empty(0, np.int64)
            h = h[places]
            if len(h):
                document = _document_of(starts, places)
                code = (_bucket(h, buckets) << np.uint64(40)) | (h & _LOW)
                order = np.argsort(code, kind="stable")
                code = code[order]
                first = np.flatnonzero(np.diff(code, prepend=code[0] ^ np.uint64(1)) != 0)
                number = np.diff(first, append=len(code))
                aligned = ((places - starts[document]) % block == 0)[order]
                flags = np.where(number > 1, _MANY, 0) | np.where(np.logical_or.reduceat(aligned, first), _ALIGNED, 0)
                # several places here already: anchors at once, whatever other chunks have
                many = np.repeat(number > 1, number)
                rows += _place_rows(chunk, starts, places[order[many]])
                kept, owner = code[first], document[order[first]]
                edges = np.searchsorted(kept >> np.uint64(40), np.arange(buckets + 1))
                for b in range(buckets):
                    s = slice(edges[b], edges[b + 1])
                    if edges[b + 1] > edges[b]:
                        low = kept[s] & _LOW
                        rows.append(
                            _row(
                                b, chunk, _ENTRIES,
                                (low & np.uint64(0xFFFFFFFF)).astype(np.uint32), (low >> np.uint64(32)).astype(np.uint8),
                                flags[s].astype(np.uint8), owner[s].astype(np.uint16 if len(part) < 65536 else np.uint32),
                            )
                        )
            yield pd.DataFrame(rows)

    return docs.mapInPandas(run, _EXCHANGE)


def _anchors_in_bucket(group: pd.DataFrame) -> pd.DataFrame:
    """Step 1, reduce side: hashes of reference blocks that stand in several places."""
    if group["what"].iloc[0] != _ENTRIES:
        return group.drop(columns="bucket")
    low, flags, owner, source = [], [], [], []
    for i, row in enumerate(group.itertuples()):
        part = np.frombuffer(row.a, np.uint32)
        low.append(part.astype(np.uint64) | (np.frombuffer(row.b, np.uint8).astype(np.uint64) << np.uint64(32)))
        flags.append(np.frombuffer(row.c, np.uint8))
        owner.append(np.frombuffer(row.d, np.uint16 if len(row.d) == 2 * len(part) else np.uint32).astype(np.uint32))
        source.append(np.full(len(part), i, np.uint32))
    low, flags, owner, source = (np.concatenate(x) for x in (low, flags, owner, source))
    order = np.argsort(low, kind="stable")
    low, flags, owner, source = low[order], flags[order], owner[order], source[order]
    first = np.flatnonzero(np.diff(low, prepend=low[0] ^ np.uint64(1)) != 0)
    number = np.diff(first, append=len(low))
    several = (number > 1) | (np.bitwise_or.reduceat(flags, first) & _MANY > 0)
    anchor = several & (np.bitwise_or.reduceat(flags, first) & _ALIGNED > 0)
    # chunks with several places of it know already
    told = np.repeat(anchor, number) & (flags & _MANY == 0)
    code = (np.uint64(group["bucket"].iloc[0]) << np.uint64(40)) | low[told]
    owner, source = owner[told], source[told]
    by_source = np.argsort(source, kind="stable")
    edges = np.searchsorted(source[by_source], np.arange(len(group) + 1))
    rows = []
    for i, chunk in enumerate(group["chunk"]):
        at = by_source[edges[i] : edges[i + 1]]
        if len(at):
            rows.append(_row(0, chunk, _ENTRIES, owner[at], code[at]))
    columns = ["chunk", "what", "a", "b", "c", "d"]
    return pd.DataFrame(rows, columns=["bucket", *columns])[columns]


def _by_document(answers: DataFrame) -> DataFrame:
    """(key, codes, runs): what the buckets and a chunk's own news tell of each document."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        keys, codes, runs = np.empty(0, np.int64), {}, {}
        for row in group.itertuples():
            if row.what == _KEYS:
                keys = np.frombuffer(row.a, np.int64)
            elif row.what == _PLACES:
                table = np.frombuffer(row.a, np.int32).reshape(-1, 3)
                for d in np.unique(table[:, 0]):
                    runs.setdefault(int(d), []).append(table[table[:, 0] == d, 1:])
            else:
                owner, code = np.frombuffer(row.a, np.uint32), np.frombuffer(row.b, np.uint64)
                order = np.argsort(owner, kind="stable")
                found, at = np.unique(owner[order], return_index=True)
                for d, own in zip(found, np.split(code[order], at[1:])):
                    codes.setdefault(int(d), []).append(own)
        rows = [
            (
                keys[d],
                np.concatenate(codes.get(d, [np.empty(0, np.uint64)])).tobytes(),
                np.concatenate(runs.get(d, [np.empty((0, 2), np.int32)])).tobytes(),
            )
            for d in sorted(codes.keys() | runs.keys())
        ]
        return pd.DataFrame(rows, columns=["key", "codes", "runs"])

    found = answers.groupBy("chunk").applyInPandas(run, "key long, codes binary, runs binary")
    return stored(found.dropDuplicates(["key"]), "places")


def _extend(docs: DataFrame, window: int, block: int, buckets: int) -> DataFrame:
    """Step 2, map side: full windows that hold an anchor, one entry per distinct one."""

    def run(batches):
        hashes = WordHashes()
        for part in chunks(batches, "text", CHUNK):
            words, starts = hashed_words(part["text"], hashes, lower=False)
            keys = part["key"].to_numpy(np.int64)
            ids = part["order"].to_numpy(np.int64)
            chunk = _chunk_id(keys)
            rows = [_news(chunk, _KEYS, keys)]
            anchors = np.zeros(len(words) + 1, np.int32)
            short = window_hashes(words, block)
            for i, (code, runs) in enumerate(zip(part["codes"], part["runs"])):
                own = short[starts[i] : max(starts[i + 1] - block + 1, starts[i])]
                if len(code):
                    wanted = np.frombuffer(code, np.uint64)
                    mine = (_bucket(own, buckets) << np.uint64(40)) | (own & _LOW)
                    anchors[starts[i] + np.flatnonzero(np.isin(mine, wanted))] = 1
                for s, n in np.frombuffer(runs, np.int32).reshape(-1, 2):
                    anchors[starts[i] + s : starts[i] + s + n] = 1
            long = window_hashes(words, window)
            if len(long):
                seen = np.concatenate([[0], np.cumsum(anchors, dtype=np.int64)])
                reach = window - block
                holds = seen[reach + 1 : reach + 1 + len(long)] - seen[: len(long)] > 0
                places = np.flatnonzero(holds & inside(starts, window))
                long = long[places]
            if len(long):
                document = _document_of(starts, places)
                start = places - starts[document]
                bucket = _bucket(mixed(long + np.uint64(1)), buckets)
                order = np.lexsort((start, ids[document], long, bucket))
                code, document, start = long[order], document[order], start[order]
                new = np.diff(code, prepend=code[0] ^ np.uint64(1)) != 0
                first = np.flatnonzero(new)
                group = np.cumsum(new) - 1
                leader = first[group]
                later = (ids[document] != ids[document[leader]]) | (start != start[leader])
                rows += _place_rows(chunk, starts, places[order[later]])
                sent = np.flatnonzero(~later)
                edges = np.searchsorted(bucket[order][sent], np.arange(buckets + 1))
                for b in range(buckets):
                    at = sent[edges[b] : edges[b + 1]]
                    if len(at):
                        owners, local = np.unique(document[at], return_inverse=True)
                        head = np.stack([owners.astype(np.int64), ids[owners]])
                        rows.append(
                            _row(b, chunk, _ENTRIES, code[at], local.astype(np.uint32), start[at].astype(np.uint32), head)
                        )
            yield pd.DataFrame(rows)

    return docs.mapInPandas(run, _EXCHANGE)


def _later_in_bucket(group: pd.DataFrame) -> pd.DataFrame:
    """Step 2, reduce side: of equal windows, all but the first place."""
    if group["what"].iloc[0] != _ENTRIES:
        return group.drop(columns="bucket")
    code, owner, order_id, start, source = [], [], [], [], []
    for i, row in enumerate(group.itertuples()):
        owners, ids = np.frombuffer(row.d, np.int64).reshape(2, -1)
        local = np.frombuffer(row.b, np.uint32)
        code.append(np.frombuffer(row.a, np.uint64))
        owner.append(owners[local].astype(np.int32))
        order_id.append(ids[local])
        start.append(np.frombuffer(row.c, np.uint32).astype(np.int32))
        source.append(np.full(len(local), i, np.uint32))
    code, owner, order_id, start, source = (np.concatenate(x) for x in (code, owner, order_id, start, source))
    order = np.lexsort((start, order_id, code))
    code, owner, order_id, start, source = (x[order] for x in (code, owner, order_id, start, source))
    new = np.diff(code, prepend=code[0] ^ np.uint64(1)) != 0
    leader = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = (order_id != order_id[leader]) | (start != start[leader])
    owner, start, source = owner[later], start[later], source[later]
    order = np.lexsort((start, owner, source))
    owner, start, source = owner[order], start[order], source[order]
    edges = np.searchsorted(source, np.arange(len(group) + 1))
    rows = []
    for i, chunk in enumerate(group["chunk"]):
        d, s = owner[edges[i] : edges[i + 1]], start[edges[i] : edges[i + 1]]
        if len(d):
            first = np.flatnonzero((np.diff(s, prepend=s[0] - 2) != 1) | (np.diff(d, prepend=d[0]) != 0))
            table = np.stack([d[first], s[first], np.diff(first, append=len(s))], axis=1).astype(np.int32)
            rows.append(_row(0, chunk, _PLACES, table))
    columns = ["chunk", "what", "a", "b", "c", "d"]
    return pd.DataFrame(rows, columns=["bucket", *columns])[columns]


_ANSWER = "chunk long, what int, a binary, b binary, c binary, d binary"


def repeated_places(docs: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text: str = "text", buckets: int | None = None) -> DataFrame:
    """(key, runs): for each document with words to remove, runs (start, number) of the places
    where a window begins that also begins earlier; `key` is the row_key of the document."""
    block = max(window // 2, 1)
    buckets = buckets or bucket_count(docs, BUCKETS)
    rows = docs.select(
        row_key(F.col(id_column), F.col(text)).alias("key"),
        F.coalesce(F.col(id_column).cast("long"), F.lit(-(2**63))).alias("order"),
        F.col(text).cast("string").alias("text"),
    )
    asked = _probe(rows.select("key", "text"), block, buckets)
    anchors = _by_document(asked.groupBy("bucket").applyInPandas(_anchors_in_bucket, _ANSWER))
    slots = anchors.select(coarse(F.col("key")).alias("slot")).distinct()
    near = rows.withColumn("slot", coarse(F.col("key"))).join(F.broadcast(slots), "slot", "left_semi").drop("slot")
    held = near.join(anchors, "key")
    compared = _extend(held, window, block, buckets).groupBy("bucket").applyInPandas(_later_in_bucket, _ANSWER)
    return _by_document(compared).select("key", "runs")


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    id_column: str = "doc_id",
    text: str = "text",
    finish: Callable[[list[bytes], int], dict] | None = None,
    schema: str = "n_words long, n_removed long, kept string",
) -> DataFrame:
    """The id column and those of `schema` for every row. `finish` makes these of the words
    that stay and the number of words removed; by itself `kept` is the text that is left, its
    words joined by one blank."""
    runs = repeated_places(docs, window, id_column, text)
    rows = docs.select(F.col(id_column), F.col(text).cast("string").alias("__text"), row_key(F.col(id_column), F.col(text)).alias("key"))
    slots = runs.select(coarse(F.col("key")).alias("slot")).distinct()
    slotted = rows.withColumn("slot", coarse(F.col("key")))
    apart = slotted.join(F.broadcast(slots), "slot", "left_anti").select(id_column, "__text", F.lit(None).cast("binary").alias("runs"))
    near = slotted.join(F.broadcast(slots), "slot", "left_semi").join(runs, "key", "left").select(id_column, "__text", "runs")
    made = finish or (lambda kept, gone: {"n_words": len(kept) + gone, "n_removed": gone, "kept": b" ".join(kept).decode("utf-8", "surrogatepass")})
    new = [part.split()[0] for part in schema.split(", ")]

    def cut(texts: pd.Series, runs_of: pd.Series) -> pd.DataFrame:
        out = []
        for content, run in zip(texts, runs_of):
            words, gone = space_words(content), 0
            if run is not None and len(run):
                gone_at = np.zeros(len(words) + 1, np.int64)
                for s, n in np.frombuffer(run, np.int32).reshape(-1, 2):
                    gone_at[s] += 1
                    gone_at[min(s + n + window - 1, len(words))] -= 1
                hit = np.cumsum(gone_at[:-1]) > 0
                gone = int(hit.sum())
                words = [w for w, h in zip(words, hit) if not h]
            out.append(made(words, gone))
        return pd.DataFrame(out, columns=new)

    return apart.unionByName(near).select(id_column, pandas_column(cut, schema)("__text", "runs").alias("__made")).select(id_column, "__made.*")
