"""The corpus pipeline: stages over `documents`, each on what the stage before it has kept.

Stage functions take (spark, docs, sf_dir) and return a DataFrame; `run` writes what each one
returns as Parquet in the shared folder and reads it again for the next. All but the last
return the columns of `documents`.

Defined results for odd input: a null or empty text is scored by the classifier like any other,
has no shingles, words or secrets, and its ids are empty; a row with a null id is no copy of
anything and stays; rows with one id are one node of the near-duplicate stage, which goes or
stays as a whole, and of equal ones among them one stays; an empty table passes through empty;
columns beyond those of `documents` are carried to the last stage, which
returns doc_id, ids, n_tokens and decoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from followgraph.llm import bpe, decontamination, minhash_dedup, quality, secret_scan
from followgraph.llm.common import discard, drop_matching, keep_matching, stored
from followgraph.llm.queries import table, tokenizer_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the quality classifier scores below its threshold.

    The model is fitted on this stage's documents and their rows in `labels`, less those
    that are held out. Texts are measured twice, for the model and for their scores: kept between,
    the documents would lie beside their own copy until the last stage has ended."""
    known = stored(quality.document_statistics(docs), "statistics")
    model = quality.fit_quality(known, table(spark, sf_dir, "labels"), calibrate=True)
    discard(known)
    return docs.where(quality.score_column(model, F.col("text")) >= quality.THRESHOLD)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity of 0.8 or more) the
    document with the least id stays; of equal rows (id and text), one."""
    found = minhash_dedup.near_duplicates(docs, percent=80)
    gone = found.where(~F.col("kept")).select("doc_id").distinct()
    left = drop_matching(docs, gone, "doc_id")
    # rows that share an id are few: only they are shuffled, to keep one of each
    shared = found.groupBy("doc_id").count().where("count > 1 AND doc_id IS NOT NULL").select("doc_id")
    once = drop_matching(left, shared, "doc_id")
    return once.unionByName(keep_matching(left, shared, "doc_id").dropDuplicates(["doc_id", "text"]))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold ten consecutive words of a benchmark item."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in texts by a mark; no document goes. n_chars follows the text."""
    clean = secret_scan.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and decoded text of what is left.

    The stages before have filled the executors' heaps, so the encoder's memories are small here."""
    model = bpe.load_bpe(tokenizer_path())
    return bpe.encode(docs.select("doc_id", "text"), model, memory=1 << 16).drop("text")


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("secrets", mask_secrets),
    ("tokens", tokens),
]

#: SQL expresses neither the classifier nor the tokens; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
