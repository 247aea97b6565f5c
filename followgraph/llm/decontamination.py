"""Benchmark decontamination: documents against the word windows of benchmark items.

Items are cut into windows of `width` consecutive words (a shorter item is one window). The
windows are the broadcast hash set: they are keyed by their anchor, the first of their longest
words, so that a document's words are looked up one by one, and where a word is an anchor the
whole window around it is compared. Everything is SQL functions in one stage after the scan,
and no row of a document moves unless it is hit.

The broadcast has a stated bound: windows are put into blocks of at most `most` (by hash), and
the documents are scanned once for each block. For the usual benchmarks that is one block.

Defined results for odd input: null and empty texts have no words and are never hit; items
without words have no window; a null item id takes part in hits but is not listed among the
items; several rows of one item count as one item; rows that are equal in id and text get
equal results each; without documents or items nothing is hit. Only id and text columns are
read; helper columns carry names starting with "__".
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from followgraph.llm.common import PLAIN_WORD, row_key
from followgraph.llm.native_words import count_words, plain_words

WIDTH = 10
#: Windows in one broadcast: some hundred bytes each.
MOST = 200_000


def windows(items: DataFrame, width: int = WIDTH, id_column: str = "item_id", text: str = "text") -> DataFrame:
    """One row for each distinct window of an item: its words, anchor and the anchor's place."""
    words = items.select(F.col(id_column).alias("item"), plain_words(F.col(text)).alias("words")).where(
        F.size("words") > 0
    )
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - width + 1, F.lit(1)))
    cut = words.select("item", "words", F.explode(starts).alias("at")).select(
        "item", F.slice("words", F.col("at"), F.lit(width)).alias("window")
    )
    longest = F.array_max(F.transform("window", lambda w: F.length(w)))
    offset = F.array_position(F.transform("window", lambda w: F.length(w)), longest)
    return cut.distinct().select(
        "item", "window", (offset - 1).cast("int").alias("offset"), F.element_at("window", offset.cast("int")).alias("anchor")
    )


def hits(
    docs: DataFrame,
    items: DataFrame,
    width: int = WIDTH,
    id_column: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    most: int = MOST,
) -> DataFrame:
    """Rows (key, start, length, item): where a window of an item stands in a document; words
    count from 0, `key` is the row_key of the document."""
    found = windows(items, width, item_id, item_text)
    blocks = -(-found.count() // most) or 1
    words = docs.select(
        row_key(F.col(id_column), F.col(text)).alias("key"), plain_words(F.col(text)).alias("words")
    ).where(F.size("words") > 0)
    placed = words.select("key", "words", F.posexplode("words").alias("at", "word"))

    def one(block: int) -> DataFrame:
        part = found.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == block) if blocks > 1 else found
        start = F.col("at") - F.col("offset")
        whole = (start >= 0) & (F.slice("words", F.greatest(start, F.lit(0)) + 1, F.size("window")) == F.col("window"))
        return (
            placed.join(F.broadcast(part), F.col("word") == F.col("anchor"))
            .where(whole)
            .select("key", start.alias("start"), F.size("window").alias("length"), "item")
        )

    return reduce(DataFrame.unionByName, [one(b) for b in range(blocks)])


def hit_words(spans: Column) -> Column:
    """Distinct word places that spans (array of start and length) cover."""
    return F.array_distinct(
        F.flatten(F.transform(spans, lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1)))
    )


def leaks(docs: DataFrame, items: DataFrame, width: int = WIDTH, id_column: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """A row for each hit document text: key, spans, items (ids as text, sorted)."""
    return (
        hits(docs, items, width, id_column, text, **names)
        .groupBy("key")
        .agg(
            F.collect_set(F.struct("start", "length")).alias("spans"),
            F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("items"),
        )
    )


def report(docs: DataFrame, items: DataFrame, width: int = WIDTH, id_column: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """id, n_words, hit (word places), items, contaminated of every document."""
    found = leaks(docs, items, width, id_column, text, **names)
    every = docs.select(
        F.col(id_column), row_key(F.col(id_column), F.col(text)).alias("key"), count_words(F.col(text)).alias("n_words")
    )
    none = F.array().cast("array<string>")
    return every.join(found, "key", "left").select(
        id_column,
        "n_words",
        F.coalesce(F.array_sort(hit_words(F.col("spans"))), F.array().cast("array<int>")).alias("hit"),
        F.coalesce("items", none).alias("items"),
        F.col("spans").isNotNull().alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame, items: DataFrame, width: int = WIDTH, remove: str = "documents", id_column: str = "doc_id", text: str = "text", **names
) -> DataFrame:
    """The documents with their columns; `remove` says what goes: "documents" or "spans" (the
    hit words; what stands between words stays)."""
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove: {remove}")
    found = leaks(docs, items, width, id_column, text, **names).withColumnRenamed("key", "__key")
    keyed = docs.withColumn("__key", row_key(F.col(id_column), F.col(text)))
    slots = found.select(_slot(F.col("__key")).alias("__slot")).distinct()
    slotted = keyed.withColumn("__slot", _slot(F.col("__key")))
    # at most 2**18 slots are broadcast; what shares no slot with a hit stays where it is
    apart = slotted.join(F.broadcast(slots), "__slot", "left_anti")
    near = slotted.join(F.broadcast(slots), "__slot", "left_semi")
    if remove == "documents":
        left = near.join(found.select("__key"), "__key", "left_anti")
        return apart.select(*docs.columns).unionByName(left.select(*docs.columns))
    words = F.regexp_extract_all(F.col(text), F.lit(PLAIN_WORD), 0)
    gaps = F.split(F.col(text), PLAIN_WORD)
    gone = hit_words(F.col("spans"))
    kept = F.array_join(
        F.transform(
            F.arrays_zip(gaps.alias("gap"), words.alias("word")),
            lambda x, i: F.concat(
                x["gap"], F.when(F.array_contains(F.col("__gone"), i), F.lit("")).otherwise(F.coalesce(x["word"], F.lit("")))
            ),
        ),
        "",
    )
    cut = near.join(found, "__key", "left").withColumn("__gone", gone)
    cut = cut.withColumn(text, F.when(F.col("__gone").isNull(), F.col(text)).otherwise(kept))
    return apart.select(*docs.columns).unionByName(cut.select(*docs.columns))


def _slot(key: Column) -> Column:
    return F.pmod(key, F.lit(1 << 18))
