"""One query for each operator, over whole tables, and the SQL of those that SQL can express.

A query takes the rows of its operator and derives the columns it reports from them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from followgraph.llm import (
    bpe,
    collocations,
    decontamination,
    html_extract,
    license_scan,
    minhash_dedup,
    pitman_yor,
    quality,
    quality_rules,
    ranked_search,
    secret_scan,
    substring_dedup,
    vectors,
)
from followgraph.llm.common import fold, sha256_hex, stored

TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _digests(ids: bytes, shown: str) -> tuple[int, str, str]:
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(shown.encode("utf-8")).hexdigest()


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    coded = bpe.encode(docs, bpe.load_bpe(tokenizer_path()), finish=_digests, schema=schema)
    return coded.drop("text")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return vectors.search(rows, rows.where(F.col("vec_id") % 20 == 0))


OP3_SQL = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e) AS score
    FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("hit").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        sha256_hex(F.array_join("items", ",")).alias("items_sha256"),
        (F.size("hit") > 0).alias("contaminated"),
    )


OP4_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS k, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, w[i : i + least(len(w), 10) - 1] AS win
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
n AS (SELECT DISTINCT len(win) AS m FROM g),
h AS (SELECT x.k, x.i, x.m, g.item_id FROM (SELECT k, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, n WHERE len(w) >= m) x
    JOIN g ON g.win = x.w[x.i : x.i + x.m - 1]),
c AS (SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(i, i + m)) AS p FROM h) GROUP BY k),
t AS (SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS item FROM h WHERE item_id IS NOT NULL) GROUP BY k)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
    sha256(coalesce(t.items, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON d.k = c.k LEFT JOIN t ON d.k = t.k
"""


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    known = stored(quality.document_statistics(docs), "statistics")
    model = quality.fit_quality(known, table(spark, sf_dir, "labels"), calibrate=True)
    return quality.score_quality(known, model).select(
        F.col("id").alias("doc_id"), (fold(F.col("id"), 4) == 2).alias("held_out"), "score", "predicted"
    )


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = docs.select("doc_id", secret_scan.secret_spans(F.col("text")).alias("found"))

    def of(kind: str):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    base = F.filter("found", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id",
        of("assign"),
        of("access"),
        of("hex"),
        sha256_hex(joined(base)).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract(pages).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents")).withColumn(
        "detections", F.coalesce("detections", F.array())
    )
    base = F.filter("detections", lambda d: d["base"])

    def labels(of):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda d: d["label"]))), ",")

    first = F.transform(base, lambda d: d["first"].cast("long"))
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(first).alias("first_word"),
        F.array_max(first).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("detections")).alias("labels"),
        F.coalesce(F.array_max(F.transform("detections", lambda d: d["confidence"])), F.lit(0.0)).alias("score"),
    )


def _kept_digest(kept: list[bytes], gone: int) -> dict:
    return {
        "n_words": len(kept) + gone,
        "n_removed": gone,
        "kept_sha256": hashlib.sha256(b" ".join(kept)).hexdigest(),
    }


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(
        table(spark, sf_dir, "documents"), finish=_kept_digest, schema="n_words long, n_removed long, kept_sha256 string"
    )


OP9_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT k, doc_id, i, array_to_string(w[i : i + 19], ' ') AS g
    FROM (SELECT k, doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
f AS (SELECT g, min({'d': doc_id, 'i': i}) AS first FROM x GROUP BY g HAVING count(*) > 1),
c AS (SELECT DISTINCT k, unnest(range(i, i + 20)) AS p FROM x JOIN f ON x.g = f.g WHERE {'d': x.doc_id, 'i': x.i} > f.first),
r AS (SELECT k, list(p) AS gone FROM c GROUP BY k),
o AS (SELECT d.doc_id, len(d.w) AS n, list_filter(range(1, len(d.w) + 1), lambda p: NOT list_contains(coalesce(r.gone, []), p)) AS left_places, d.w
    FROM d LEFT JOIN r ON d.k = r.k)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(n - len(left_places) AS BIGINT) AS n_removed,
    sha256(array_to_string(list_transform(left_places, lambda p: w[p]), ' ')) AS kept_sha256 FROM o
"""


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = pitman_yor.train(pitman_yor.learned_from(docs))
    return pitman_yor.score(docs, model).select(
        "doc_id",
        (fold(F.col("doc_id"), 7) == 2).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = stored(quality_rules.rule_statistics(table(spark, sf_dir, "documents")), "rules")
    rules = quality_rules.fit_rules(counts, table(spark, sf_dir, "labels"))
    return quality_rules.apply_rules(counts, rules).select(
        F.col("id").alias("doc_id"), *quality_rules.COUNTS, "base_failed", "kept", F.array_join("broken", ",").alias("broken")
    )


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH x AS (SELECT doc_id, row_number() OVER () AS k, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
d AS (SELECT k, doc_id, w, CAST(len(w) AS BIGINT) AS n FROM x WHERE len(w) > 0),
s AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS total FROM d),
b AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
i AS (SELECT q, item_id, t, CAST(count(*) AS BIGINT) AS times FROM (SELECT q, item_id, unnest(w) AS t FROM b) GROUP BY ALL),
f AS (SELECT k, t, CAST(count(*) AS BIGINT) AS tf FROM (SELECT k, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM i) GROUP BY ALL),
g AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM f, s GROUP BY t, docs),
r AS (SELECT i.q, i.item_id, d.doc_id, CAST(sum(i.times * g.weight * ((1000000000 * f.tf)
    // (1000 * f.tf + 12 * (75 + (25 * d.n * s.docs) // s.total)))) AS BIGINT) AS score
    FROM i JOIN f ON i.t = f.t JOIN g ON g.t = f.t JOIN d ON d.k = f.k, s GROUP BY i.q, i.item_id, d.k, d.doc_id),
o AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o WHERE rank <= 20
"""


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents")).withColumnRenamed("stratum", "lang")


OP13_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i : i + m - 1], ' '))) AS phrase
    FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS m) WHERE len(w) >= m),
f AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
h AS (SELECT * FROM f WHERE f >= 100),
c AS (SELECT lang, m, phrase, f AS a, k, array_to_string(string_split(phrase, ' ')[1 : k], ' ') AS part1,
    array_to_string(string_split(phrase, ' ')[k + 1 :], ' ') AS part2 FROM h, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE k < m),
s AS (SELECT c.lang, c.m, c.phrase, c.a, c.k, x.f AS l, y.f AS r, n.n,
    CAST(1000 * CAST(c.a AS HUGEINT) * n.n // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
    FROM c JOIN h x ON x.lang = c.lang AND x.phrase = c.part1 JOIN h y ON y.lang = c.lang AND y.phrase = c.part2 JOIN n ON n.lang = c.lang),
t AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM s),
u AS (SELECT * FROM t WHERE place = 1 AND NOT EXISTS (SELECT 1 FROM h z WHERE z.lang = t.lang AND z.m > t.m AND z.f >= t.a
    AND contains(' ' || z.phrase || ' ', ' ' || t.phrase || ' '))),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM u)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, score FROM o WHERE rank <= 2000
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_near_duplicates": op1,
        "op2_bpe_tokens": op2,
        "op3_neighbours": op3,
        "op4_decontamination": op4,
        "op5_quality": op5,
        "op6_secrets": op6,
        "op7_main_text": op7,
        "op8_licenses": op8,
        "op9_repeats": op9,
        "op10_language_model": op10,
        "op11_quality_rules": op11,
        "op12_ranked_search": op12,
        "op13_collocations": op13,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_neighbours": OP3_SQL,
        "op4_decontamination": OP4_SQL,
        "op9_repeats": OP9_SQL,
        "op12_ranked_search": OP12_SQL,
        "op13_collocations": OP13_SQL,
    }
