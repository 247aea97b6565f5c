"""Ranked lexical search: the best documents for every item of a query set, by a document FP-tree.

Terms are runs of ASCII letters and digits and of anything beyond ASCII, A-Z lower-cased. With N
documents that have a term, L terms in all of them, n in one and df documents that hold a term,
a term weighs w = floor(1000 * ln((2N + 2) / (2 df + 1))), a document has
m = 75 + (25 * n * N) div L, and its score for an item is the sum, over the item's terms with
repeats, of w * ((10**9 * tf) div (1000 * tf + 12 * m)). All but w is whole numbers.

1. Every text is cut down to the terms that occur in items: a vector of (term, tf), with its n,
   written to the shared folder. N, L and df are sums over all of them.
2. A task orders the terms of each vector by frequency (the most frequent first) and the vectors
   of some thousand documents by their terms: documents that begin alike are neighbours, and each
   common beginning is a path of a trie, its subtree a stretch of neighbours. Every node knows,
   of its subtree, the largest tf of each term and the least m.
3. An item's score of such a pair of maxima and minimum bounds the scores below, as a score grows
   with tf and falls with m. The search goes depth-first, best bound first, and leaves out
   subtrees whose bound is under the score of the last of the best so far. What is left are
   documents, whose bound is their score.
4. The best of all tasks are ranked, in two steps.

Items are taken in blocks of bounded size (BLOCK_TERMS), each of which is sent to all tasks; no
document is left out for any of them.

Defined results for odd input: null texts and texts without terms are found by nothing and are no
documents of N; items without terms find nothing; every row of the items is searched on its own,
also where ids or rows repeat; rows of documents that share an id are documents of their own;
null ids come last among equal scores; empty tables give an empty table. Only ids and texts are
read, so other columns and their names don't matter. Very long texts are taken whole.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from followgraph.llm.common import chunks, stored

MOST = 20
#: Terms of the items (repeats included) that one pass over the documents looks for.
BLOCK_TERMS = 1 << 19
#: Documents, and (document, term) pairs, that one tree holds at most.
TREE_DOCS = 1 << 15
TREE_TERMS = 1 << 20
#: Lengths of the common beginnings that are nodes, and the fewest documents of a node.
DEPTHS = (1, 2, 3, 4, 6, 8, 12, 16, 24)
LEAST_DOCS = 24
CHUNK = 8 << 20

_TERMS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text, in order."""
    return text.encode("utf-8", "surrogatepass").lower().translate(_TERMS).split() if text else []


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


@dataclass
class Vectors:
    """Restricted vectors of some documents: `starts` cuts `term` and `tf` into documents."""

    ids: np.ndarray
    m: np.ndarray
    starts: np.ndarray
    term: np.ndarray
    tf: np.ndarray


class Tree:
    """An FP-tree over vectors whose terms are numbered by falling frequency.

    Units are the documents, in the order of their terms, and then the nodes; each has a row of
    `keys` (unit * terms + term) with the tf, or the largest below it, and its (least) m."""

    def __init__(self, vectors: Vectors, terms: int, least_docs: int = LEAST_DOCS):
        count = len(vectors.ids)
        size = np.diff(vectors.starts)
        text = vectors.term.astype(">u4").tobytes()
        begin = (vectors.starts * 4).tolist()
        order = np.array(sorted(range(count), key=lambda d: text[begin[d] : begin[d + 1]]), np.int64)
        self.ids, self.m, self.terms = vectors.ids[order], vectors.m[order], terms
        size = size[order]
        starts = np.concatenate([[0], np.cumsum(size)])
        from_ = np.arange(starts[-1]) + np.repeat(vectors.starts[:-1][order] - starts[:-1], size)
        term, tf = vectors.term[from_].astype(np.int64), vectors.tf[from_]
        doc = np.repeat(np.arange(count), size)

        # how many terms each document has in common with the one before it, up to the deepest level
        deepest = DEPTHS[-1]
        place = np.arange(starts[-1]) - starts[:-1][doc]
        head = np.full((count, deepest), -1, np.int64)
        near = place < deepest
        head[doc[near], place[near]] = term[near]
        equal = (head[1:] == head[:-1]) & (head[1:] >= 0)
        common = np.concatenate([[0], np.cumprod(equal, axis=1).sum(axis=1)])

        keys, tfs, least, parents = [doc * terms + term], [tf], [self.m], []
        above = np.full(count, -1, np.int64)  # the deepest node of each document so far; -1 is the root
        reach = np.concatenate([[count], []]).astype(np.int64)  # documents below each node, root first
        number = count
        for depth in DEPTHS:
            group = np.cumsum(common < depth) - 1
            docs_of = np.bincount(group)
            first = np.flatnonzero(common < depth)
            # a node of its own if it is large enough, has the depth, and is less than the node above it
            over = above[first]
            whole = reach[np.where(over < 0, 0, over - count + 1)]
            keep = (docs_of >= least_docs) & (size[first] >= depth) & (docs_of < whole)
            if not keep.any():
                continue
            name = np.where(keep, number + np.cumsum(keep) - 1, -1)
            parents.append(over[keep])
            reach = np.concatenate([reach, docs_of[keep]])
            of_doc = name[group]
            inside = of_doc[doc] >= 0
            pair = of_doc[doc[inside]] * terms + term[inside]
            by = np.argsort(pair, kind="stable")
            pair, most = pair[by], tf[inside][by]
            new = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
            keys.append(pair[new])
            tfs.append(np.maximum.reduceat(most, new))
            low = np.minimum.reduceat(self.m, first)
            least.append(low[keep])
            above = np.where(of_doc >= 0, of_doc, above)
            number += int(keep.sum())
        self.docs = count
        self.keys, self.tf, self.least = np.concatenate(keys), np.concatenate(tfs), np.concatenate(least)
        parent = np.concatenate([above, *parents])
        by = np.argsort(parent, kind="stable")
        at = np.searchsorted(parent[by], np.concatenate([[-1], np.arange(count, number + 1)]))
        self._children, self._at = by, at

    def children(self, unit: int) -> np.ndarray:
        k = 0 if unit < 0 else unit - self.docs + 1
        return self._children[self._at[k] : self._at[k + 1]]

    def bounds(self, units: np.ndarray, wanted: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The scores that no document below the units passes; of documents, their scores."""
        key = units[:, None] * self.terms + wanted
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        tf = np.where(self.keys[at] == key, self.tf[at], 0)
        return ((10**9 * tf) // (1000 * tf + 12 * self.least[units][:, None]) * weights).sum(axis=1)


def _order(found):
    score, one = found
    return (-score, one is None, one if one is not None else 0)


def search_tree(tree: Tree, wanted: np.ndarray, weights: np.ndarray, best: list, most: int = MOST) -> tuple[list, int]:
    """`best` (score, id) with what the tree adds to it, and how many units were looked at."""
    stack, looked = [(0, -1)], 0
    last = best[-1][0] if len(best) >= most else 1
    while stack:
        bound, unit = stack.pop()
        if unit >= 0 and bound < last:
            continue
        units = tree.children(unit)
        score = tree.bounds(units, wanted, weights)
        looked += len(units)
        good = score >= last
        units, score = units[good], score[good]
        leaf = units < tree.docs
        if leaf.any():
            docs, own = units[leaf], score[leaf]
            if len(own) > most:  # of many, those that reach the last of the best among them
                reach = own >= np.partition(own, len(own) - most)[len(own) - most]
                docs, own = docs[reach], own[reach]
            best = sorted(best + list(zip(own.tolist(), tree.ids[docs])), key=_order)[:most]
            last = best[-1][0] if len(best) >= most else 1
        inner = np.flatnonzero(~leaf)
        for k in inner[np.argsort(score[inner], kind="stable")]:
            stack.append((int(score[k]), int(units[k])))
    return best, looked


@dataclass
class Block:
    """Some items: their ids, and for each the terms (as numbers) with how often it has them."""

    items: list
    terms: dict
    wanted: list


def _blocks(items: DataFrame, id_column: str, text: str):
    """The items in blocks that hold BLOCK_TERMS terms or a single item."""
    rows = items.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text")).where("text IS NOT NULL")
    block, size = Block([], {}, []), 0
    for row in rows.toLocalIterator(prefetchPartitions=False):
        own = Counter(terms(row["text"]))
        if not own:
            continue
        if block.items and size + len(own) > BLOCK_TERMS:
            yield block
            block, size = Block([], {}, []), 0
        numbers = [block.terms.setdefault(t, len(block.terms)) for t in own]
        block.items.append(row["id"])
        block.wanted.append((np.array(numbers, np.int64), np.array(list(own.values()), np.int64)))
        size += len(own)
    if block.items:
        yield block


def _vectors(docs: DataFrame, numbers: dict) -> DataFrame:
    """(id, n, term, tf) of every document with a term: its number of terms, and as packed arrays
    those that items have, by their number."""
    kind = dict(docs.dtypes)["id"]
    sent = docs.sparkSession.sparkContext.broadcast(numbers)

    def run(batches):
        look, size = sent.value.get, len(sent.value) + 1
        for part in chunks(batches, "text", CHUNK):
            found, lengths = [], []
            for text in part["text"]:
                own = terms(text)
                lengths.append(len(own))
                found.append(np.array([k for k in map(look, own) if k is not None], np.int64))
            doc = np.repeat(np.arange(len(found)), [len(f) for f in found])
            pair, tf = np.unique(doc * size + np.concatenate([np.empty(0, np.int64), *found]), return_counts=True)
            at = np.searchsorted(pair // size, np.arange(len(found) + 1))
            term, tf = (pair % size).astype(np.int32), tf.astype(np.int32)
            packed = pd.DataFrame(
                {
                    "id": part["id"],
                    "n": lengths,
                    "term": [term[a:b].tobytes() for a, b in zip(at, at[1:])],
                    "tf": [tf[a:b].tobytes() for a, b in zip(at, at[1:])],
                }
            )
            yield packed[packed["n"] > 0]

    return docs.mapInPandas(run, f"id {kind}, n long, term binary, tf binary")


def _document_counts(vectors: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each of the block's terms."""

    def run(batches):
        count = np.zeros(size, np.int64)
        for frame in batches:
            count += np.bincount(np.frombuffer(b"".join(frame["term"]), np.int32), minlength=size)
        held = np.flatnonzero(count)
        yield pd.DataFrame({"term": held, "df": count[held]})

    out = np.zeros(size, np.int64)
    # at most BLOCK_TERMS rows, or the terms of one item
    for row in vectors.select("term").mapInPandas(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[row["term"]] = row["df"]
    return out


def _trees(batches, rank: np.ndarray, documents: int, total: int, most_docs: int, most_terms: int, least_docs: int):
    """Trees over the documents of a task, a bounded number of documents and terms in each."""

    def tree(frames):
        frame = pd.concat(frames, ignore_index=True)
        size = np.array([len(t) // 4 for t in frame["term"]])
        term = rank[np.frombuffer(b"".join(frame["term"]), np.int32)]
        tf = np.frombuffer(b"".join(frame["tf"]), np.int32).astype(np.int64)
        doc = np.repeat(np.arange(len(frame)), size)
        by = np.lexsort([term, doc])
        n = frame["n"].to_numpy(np.int64)
        m = 75 + np.array([25 * int(k) * documents // total for k in n], np.int64)
        ids = np.empty(len(frame), object)
        ids[:] = [None if pd.isna(v) else v for v in frame["id"].tolist()]
        return Tree(Vectors(ids, m, np.concatenate([[0], np.cumsum(size)]), term[by], tf[by]), len(rank), least_docs)

    held, docs, amount = [], 0, 0
    for frame in batches:
        frame = frame[frame["term"].str.len() > 0]
        if not len(frame):
            continue
        # the batch in parts that fit into trees
        size = np.cumsum(frame["term"].str.len().to_numpy() // 4)
        part = np.maximum(size // most_terms, np.arange(len(frame)) // most_docs)
        for _, piece in frame.groupby(part, sort=True):
            own = int(piece["term"].str.len().sum()) // 4
            if held and (docs + len(piece) > most_docs or amount + own > most_terms):
                yield tree(held)
                held, docs, amount = [], 0, 0
            held.append(piece)
            docs, amount = docs + len(piece), amount + own
    if held:
        yield tree(held)


def _search_block(docs: DataFrame, block: Block, most: int) -> DataFrame:
    """(item, id, score): the best of every task for every item of the block, by its place in it."""
    vectors = stored(_vectors(docs, block.terms), "vectors")
    documents, total = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = _document_counts(vectors, len(block.terms))
    by = np.argsort(-df, kind="stable")
    rank = np.empty(len(df), np.int64)
    rank[by] = np.arange(len(df))
    weights = np.array([weight(documents, int(d)) if d else 0 for d in df], np.int64)
    wanted = []
    for numbers, times in block.wanted:
        use = (df[numbers] > 0) & (weights[numbers] > 0)
        wanted.append((rank[numbers[use]], (weights[numbers] * times)[use]))
    sent = docs.sparkSession.sparkContext.broadcast((rank, wanted))
    kind = dict(docs.dtypes)["id"]

    def run(batches):
        rank, wanted = sent.value
        best: list = [[] for _ in wanted]
        for tree in _trees(batches, rank, documents, total, TREE_DOCS, TREE_TERMS, LEAST_DOCS):
            for k, (ranks, weighed) in enumerate(wanted):
                if len(ranks):
                    best[k] = search_tree(tree, ranks, weighed, best[k], most)[0]
        rows = [(k, one, score) for k, found in enumerate(best) for score, one in found]
        frame = pd.DataFrame(rows, columns=["item", "id", "score"])
        if kind in ("bigint", "int", "smallint", "tinyint"):
            frame["id"] = frame["id"].astype("Int64")
        yield frame

    return vectors.mapInPandas(run, f"item long, id {kind}, score long")


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    item_column: str = "item_id",
    text: str = "text",
    most: int = MOST,
) -> DataFrame:
    """item_id, rank, doc_id, score: every item's `most` best documents with a score above 0, equal
    scores by ascending id."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text"))
    kind = dict(items.select(item_column).dtypes)[item_column]
    found = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id {dict(rows.dtypes)['id']}, score long")
    order = [F.desc("score"), F.asc_nulls_last("id")]
    for block in _blocks(items, item_column, text):
        near = stored(_search_block(rows, block, most), "found")
        share = near.withColumn("share", F.pmod(F.xxhash64("score", F.col("id").cast("string")), F.lit(32)))
        near = share.withColumn("rank", F.row_number().over(Window.partitionBy("item", "share").orderBy(*order))).where(F.col("rank") <= most)
        last = near.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= most)
        # BLOCK_TERMS rows at most
        names = spark.createDataFrame(list(enumerate(block.items)), f"item long, item_id {kind}")
        found = found.unionByName(
            last.join(names, "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score")
        )
    return found
