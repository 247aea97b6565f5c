"""Queries over the supplied tables and the SQL each one is checked against.

Edge relations, always over the whole table:

LP  lineitem  l_partkey  -> l_suppkey   (repeated edges and self-loops)
PL  lineitem  l_suppkey  -> l_partkey
OC  orders    o_orderkey -> o_custkey
CO  orders    o_custkey  -> o_orderkey
OP  lineitem  l_orderkey -> l_partkey
SO  lineitem  l_suppkey  -> l_orderkey
SN  supplier  s_suppkey  -> s_nationkey

The id cut-offs (MAX_ID, LOW_MAX_ID) and the divisor (MODULUS) are parameters of the operators
themselves; every cut-off or divided query has a counterpart over all ids.

Queries ending in `_split` run the code for large graphs: their Limits are so low that joins
shuffle and keys are split on any of the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import followgraph as fg
from followgraph.functions import pair_text, walk_text

try:  # the training-data operators and their pipeline may be left out of a checkout
    import corpus_pipeline
    from followgraph.llm import queries as llm
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "followgraph.llm"):
        raise  # they are there, but something that they need isn't
    llm = corpus_pipeline = None

MAX_ID = 10_000
LOW_MAX_ID = 60
SPLIT = fg.Limits(
    broadcast_rows=0, rows=200, max_share=1_000, wedge_rows=5, path_rows=10, task_paths=50_000, copies=2, repeats=2, list_size=50
)
INDEX_SPLIT = fg.Limits(broadcast_rows=0, rows=200, max_share=1_000, list_size=10, task_paths=100)
MAX_IDS = [100, 1_000, 10_000]
MODULUS = 100

SMOKE_DIR = "/root/testdata/sf0.001"

RELATIONS = {
    "LP": ("lineitem", "l_partkey", "l_suppkey"),
    "PL": ("lineitem", "l_suppkey", "l_partkey"),
    "OC": ("orders", "o_orderkey", "o_custkey"),
    "CO": ("orders", "o_custkey", "o_orderkey"),
    "OP": ("lineitem", "l_orderkey", "l_partkey"),
    "SO": ("lineitem", "l_suppkey", "l_orderkey"),
    "SN": ("supplier", "s_suppkey", "s_nationkey"),
}


def edges(spark: SparkSession, sf_dir: str, relation: str) -> DataFrame:
    table, follower, followee = RELATIONS[relation]
    return fg.from_table(spark.read.parquet(f"{sf_dir}/{table}.parquet"), follower, followee)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: triangles of the part-supplier graph."""
    return fg.triangle_count(edges(spark, SMOKE_DIR, "LP"))


def _priced_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part-supplier edges that weigh their price in cents."""
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_partkey").alias("follower"),
        F.col("l_suppkey").alias("followee"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
    )


def _adjacency(e: DataFrame, **how) -> DataFrame:
    """Adjacency lists taken apart again, so that list order does not enter the check."""
    return (
        fg.adjacency(e, **how)
        .select("follower", F.inline("followees"))
        .groupBy("follower")
        .agg(
            F.sum("multiplicity").alias("n_followees"),
            F.min("followee").alias("first_followee"),
            F.max("followee").alias("last_followee"),
            F.sum(F.col("followee") * F.col("multiplicity")).alias("followee_checksum"),
        )
    )


def _path_profile(e: DataFrame, **how) -> DataFrame:
    """2-paths by start node; the strategies must agree on it."""
    return (
        fg.two_paths(e, **how)
        .groupBy("start_node")
        .agg(
            F.count(F.lit(1)).alias("n_paths"),
            F.sum("mid_node").alias("mid_checksum"),
            F.sum("end_node").alias("end_checksum"),
        )
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines of the part-supplier edges: some broken by rule, some with blanks or more fields."""
    table = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    number = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    follower, followee = F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")
    return table.select(
        F.when(number % 11 == 0, F.concat(F.lit("x"), follower, F.lit(","), followee))
        .when(number % 11 == 1, F.concat(follower, F.lit(".0,"), followee))
        .when(number % 11 == 2, F.concat(follower, F.lit(",")))
        .when(number % 11 == 3, F.concat(F.lit(" "), follower, F.lit(" , "), followee))
        .when(number % 11 == 4, F.concat(follower, F.lit(","), followee, F.lit(",more")))
        .when(number % 11 == 5, F.lit("  "))
        .otherwise(F.concat(follower, F.lit(","), followee))
        .alias("value")
    )


def _profile(paths: DataFrame) -> DataFrame:
    """2-paths by start node, so that results of millions of rows are compared by sums."""
    return paths.groupBy("start_node").agg(
        F.count(F.lit(1)).alias("n_paths"), F.sum("mid_node").alias("mid_checksum"), F.sum("end_node").alias("end_checksum")
    )


def _saved_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of `_lines`, written as text into nested folders and read back from there."""
    path = fg.scratch_path(spark, "lines")
    lines = _lines(spark, sf_dir).withColumn("folder", F.pmod(F.xxhash64("value"), F.lit(3)))
    lines.write.partitionBy("folder").text(path)
    return spark.read.option("recursiveFileLookup", "true").text(path)


def _nested_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges from nested text files, by the reader that drops what is no edge."""
    path = fg.scratch_path(spark, "edges")
    lines = _lines(spark, sf_dir).withColumn("folder", F.pmod(F.xxhash64("value"), F.lit(3)))
    lines.write.partitionBy("folder").text(path)
    return fg.read_edges(spark, path, recursive=True)


def _closed_saved_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triangles in two programs: 2-paths are saved as text (packed: they are many times the edges),
    read again and closed."""
    e = edges(spark, sf_dir, "LP")
    path = fg.scratch_path(spark, "paths")
    fg.write_tsv(fg.two_paths(e, loops=False), path, compression="gzip")
    return fg.close_paths(fg.read_walks(spark, path, ["start_node", "mid_node", "end_node"]), e)


def _saved_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Follower counts as `(key,value)` lines, over an earlier result, with the counters of the
    writing job beside what is read back."""
    counts = fg.follower_count(edges(spark, sf_dir, "PL"), None)
    path = fg.scratch_path(spark, "pairs")
    fg.save_counted(spark.sql("SELECT 'earlier' AS value"), path)
    lines = counts.select(pair_text("followee", "follower_count").alias("value"), "follower_count")
    seen = fg.save_counted(lines.select("value"), path, overwrite=True, longest=F.max(F.length("value")))
    return spark.read.text(path).select(
        F.col("value").alias("line"), F.lit(seen["rows"]).cast("bigint").alias("rows_written"), F.lit(seen["longest"]).cast("bigint").alias("longest_line")
    )


def _counted_walks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed walks saved with their copies, and one row with the counters of that job."""
    walks = fg.closed_walks(edges(spark, sf_dir, "LP"))
    path = fg.scratch_path(spark, "walks")
    loops = F.count_if((F.col("n1") == F.col("n2")) | (F.col("n2") == F.col("n3")))
    seen = fg.save_counted(walks, path, form="parquet", walks=F.sum("walks"), over_loops=loops)
    back = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows_read"))
    return back.select("rows_read", *[F.lit(seen[c]).cast("bigint").alias(c) for c in ("rows", "walks", "over_loops")])


def _in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every edge with its position in the order of followees."""
    path = fg.scratch_path(spark, "ordered")
    return fg.save_in_order(edges(spark, sf_dir, "LP"), path, "followee", "follower")


def _indexed_paths(spark: SparkSession, sf_dir: str, asking: str, indexed: str, **how) -> DataFrame:
    """2-paths from one relation into the stored lists of another, opened anew."""
    path = fg.scratch_path(spark, "index")
    fg.save_adjacency(edges(spark, sf_dir, indexed), path, **how)
    return fg.paths_by_index(edges(spark, sf_dir, asking), fg.open_adjacency(spark, path), **how)


def _looked_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that each supplier has delivered, and how often, from an index of suppliers."""
    index = fg.save_adjacency(edges(spark, sf_dir, "PL"), fg.scratch_path(spark, "index"))
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    return fg.followees_of(suppliers.select(F.col("s_suppkey").cast("bigint").alias("node")), index)


def _walk_profile(e: DataFrame) -> DataFrame:
    """Closed walks by start node, summed over weighted walks."""
    return (
        fg.closed_walks(e)
        .groupBy(F.col("n1").alias("node"))
        .agg(F.sum("walks").alias("closing_walks"))
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def on(relation: str, build: Callable[[DataFrame], DataFrame]):
        return lambda spark, sf_dir: build(edges(spark, sf_dir, relation))

    def capped(build: Callable[[DataFrame], DataFrame]):
        return lambda e: build(fg.under_max(e, MAX_ID))

    found = {
        "edges_valid": on("LP", fg.valid),
        "edges_under_max": on("LP", capped(fg.valid)),
        "edges_reversed": on("LP", fg.reverse),
        "edges_core": on("LP", fg.core),
        "edge_multiplicity": on("LP", fg.multiplicity),
        "adjacency": on("LP", _adjacency),
        "follower_count_mod100": on("PL", lambda e: fg.follower_count(e, MODULUS)),
        "follower_count_orders": on("OC", lambda e: fg.follower_count(e, MODULUS)),
        "follower_count_all": on("PL", lambda e: fg.follower_count(e, None)),
        "follower_group_size": on("PL", lambda e: fg.follower_group_size(e, MODULUS)),
        "follower_group_size_all": on("PL", lambda e: fg.follower_group_size(e, None)),
        "degrees": on("LP", fg.degrees),
        "degree_product": on("LP", fg.degree_product),
        "two_path_count_exact": on("LP", fg.two_path_count),
        "two_path_count_sampled": on("LP", lambda e: fg.two_path_count(e, MAX_ID)),
        "two_path_count_no_loop": on("LP", lambda e: fg.two_path_count(e, loops=False)),
        "two_path_cardinality_vs_max": on("LP", lambda e: fg.two_path_count_by_max(e, MAX_IDS)),
        "two_paths": on("LP", fg.two_paths),
        "two_paths_no_loop": on("LP", lambda e: fg.two_paths(e, loops=False)),
        "two_paths_orders": on("OC", fg.two_paths),
        "triangles_closed_walks": on("LP", lambda e: fg.triangles(e, "closed")),
        "triangles_no_loop": on("LP", fg.triangles),
        "triangles_strict": on("LP", lambda e: fg.triangles(e, "strict")),
        "triangle_count_closed_walks": on("LP", lambda e: fg.triangle_count(e, "closed")),
        "triangle_count_no_loop": on("LP", fg.triangle_count),
        "triangle_count_strict": on("LP", lambda e: fg.triangle_count(e, "strict")),
        "triangle_count_no_loop_max": on("LP", capped(fg.triangle_count)),
        "triangle_count_closed_walks_max": on(
            "LP", capped(lambda e: fg.triangle_count(e, "closed"))
        ),
        "triangle_walk_metrics": on("LP", fg.walk_counts),
        "triangles_per_node": on("LP", _walk_profile),
    }
    how = {"strategy": "shuffle"}
    found |= {
        "two_paths_shuffle": on("LP", lambda e: _path_profile(e, **how)),
        "two_paths_no_loop_shuffle": on("LP", lambda e: _path_profile(e, loops=False, **how)),
        "triangles_no_loop_shuffle": on("LP", lambda e: fg.triangles(e, **how)),
        "triangle_count_no_loop_shuffle": on("LP", lambda e: fg.triangle_count(e, **how)),
        "triangle_count_closed_walks_shuffle": on("LP", lambda e: fg.triangle_count(e, "closed", **how)),
        "triangle_count_no_loop_broadcast": on("LP", lambda e: fg.triangle_count(e, strategy="broadcast")),
        "triangle_count_by_lists": on("LP", lambda e: fg.triangle_count(e, method="lists", **how)),
        "walk_counts_by_lists": on("LP", lambda e: fg.walk_counts(e, method="lists")),
    }
    split = {"limits": SPLIT}
    found |= {
        "two_paths_split": on("LP", lambda e: _path_profile(e, **split)),
        "two_paths_no_loop_split": on("LP", lambda e: _path_profile(e, loops=False, **split)),
        "triangles_closed_walks_split": on("LP", lambda e: fg.triangles(e, "closed", **split)),
        "triangles_no_loop_split": on("LP", lambda e: fg.triangles(e, **split)),
        "triangles_strict_split": on("LP", lambda e: fg.triangles(e, "strict", **split)),
        "triangle_count_no_loop_split": on("LP", lambda e: fg.triangle_count(e, **split)),
        "triangle_count_by_lists_split": on("LP", lambda e: fg.triangle_count(e, "closed", method="lists", **split)),
        "edges_core_split": on("LP", lambda e: fg.core(e, **split)),
        "adjacency_split": on("LP", lambda e: _adjacency(e, **split)),
        "edges_under_low_max": on("LP", lambda e: fg.under_max(e, LOW_MAX_ID)),
        "two_path_count_low_max": on("LP", lambda e: fg.two_path_count(e, LOW_MAX_ID)),
        "triangle_count_low_max": on("LP", lambda e: fg.triangle_count(fg.under_max(e, LOW_MAX_ID))),
        "edges_under_max_orders": on("OC", capped(fg.valid)),
        "two_path_count_sampled_orders": on("OC", lambda e: fg.two_path_count(e, MAX_ID)),
        "degrees_reversed": on("LP", lambda e: fg.degrees(fg.reverse(e))),
        "follower_group_size_plain": on("PL", lambda e: fg.follower_group_size(e, None, distinct=False)),
        "lines_parsed": lambda spark, sf_dir: fg.valid(fg.parse_lines(_lines(spark, sf_dir))),
        "lines_parsed_as_text": lambda spark, sf_dir: fg.valid(fg.parse_lines(_lines(spark, sf_dir), id_type="string")),
        "lines_dropped": lambda spark, sf_dir: fg.dropped_lines(fg.parse_lines(_lines(spark, sf_dir))),
        "pair_lines": on("PL", lambda e: fg.follower_count(e, None).select(pair_text("followee", "follower_count").alias("line"))),
        "walk_lines": on(
            "LP", lambda e: fg.triangles(e).select(F.concat_ws("\t", "n3", walk_text("n1", "n2", "n3", "n1")).alias("line"))
        ),
    }

    def between(build: Callable[..., DataFrame], *relations: str, **given):
        return lambda spark, sf_dir: build(*[edges(spark, sf_dir, r) for r in relations], **given)

    found |= {
        "two_paths_between": between(fg.two_paths_between, "CO", "OP"),
        "two_paths_between_side": between(fg.two_paths_between, "LP", "SN"),
        "two_paths_between_hubs": between(lambda *r, **how: _profile(fg.two_paths_between(*r, **how)), "SO", "OP"),
        "two_paths_between_split": between(lambda *r, **how: _profile(fg.two_paths_between(*r, **how)), "CO", "OP", **split),
        "two_path_count_between": between(fg.two_path_count_between, "LP", "SO"),
        "two_path_count_between_no_loop": between(fg.two_path_count_between, "LP", "PL", loops=False),
        "closed_walks_between": between(fg.closed_walks_between, "LP", "SO", "OP"),
        "closed_walks_between_strict": between(fg.closed_walks_between, "SO", "OP", "LP", walks="strict"),
        "closed_walks_between_shuffle": between(fg.closed_walks_between, "LP", "SO", "OP", strategy="shuffle"),
        "close_saved_paths": _closed_saved_paths,
        "two_path_weight": lambda spark, sf_dir: fg.two_path_weight(_priced_edges(spark, sf_dir), "cents"),
        "two_path_weights": lambda spark, sf_dir: fg.two_path_weights(_priced_edges(spark, sf_dir), "cents"),
        "lines_explained": lambda spark, sf_dir: fg.explain_lines(_saved_lines(spark, sf_dir)),
        "edges_from_nested_files": _nested_edges,
        "pairs_saved": _saved_pairs,
        "walks_saved_with_counters": _counted_walks,
        "edges_in_order": _in_order,
        "paths_by_index": lambda spark, sf_dir: _indexed_paths(spark, sf_dir, "CO", "OP"),
        "paths_by_index_split": lambda spark, sf_dir: _indexed_paths(spark, sf_dir, "LP", "LP", limits=INDEX_SPLIT),
        "followees_looked_up": _looked_up,
    }
    if llm:
        found |= llm.queries() | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    def source(relation: str) -> str:
        table, follower, followee = RELATIONS[relation]
        return f"SELECT {follower} AS follower, {followee} AS followee FROM {table}"

    lp, pl, oc = source("LP"), source("PL"), source("OC")
    all_lp = f"WITH e AS ({lp})"
    max_lp = f"WITH e AS (SELECT follower, followee FROM ({lp}) WHERE follower < {MAX_ID} AND followee < {MAX_ID})"
    ends = (
        f"WITH d AS (SELECT follower AS node, 1 AS o, 0 AS i FROM ({lp})"
        f" UNION ALL SELECT followee, 0, 1 FROM ({lp}))"
    )
    path = "e a JOIN e b ON a.followee = b.follower"
    walk = f"{path} JOIN e c ON b.followee = c.follower AND c.followee = a.follower"
    nodes3 = "a.follower AS n1, a.followee AS n2, b.followee AS n3"
    no_loop = "a.follower <> b.followee"
    strict = f"{no_loop} AND a.follower <> a.followee AND b.follower <> b.followee"
    path_columns = "a.follower AS start_node, a.followee AS mid_node, b.followee AS end_node"
    thirds = "CAST(count(*) // 3 AS BIGINT) AS triangle_count"

    def follower_count(src: str, where: str) -> str:
        return f"SELECT followee, count(*) AS follower_count FROM ({src}) {where} GROUP BY followee"

    def group_size(src: str, where: str) -> str:
        return (
            "SELECT followee, count(follower) AS n_followers,"
            f" count(DISTINCT follower) AS n_distinct_followers FROM ({src}) {where} GROUP BY followee"
        )

    def path_profile(where: str) -> str:
        return (
            f"{all_lp} SELECT a.follower AS start_node, count(*) AS n_paths,"
            " CAST(sum(a.followee) AS BIGINT) AS mid_checksum,"
            f" CAST(sum(b.followee) AS BIGINT) AS end_checksum FROM {path} {where} GROUP BY a.follower"
        )

    divided = f"WHERE followee % {MODULUS} = 0"
    sql = {
        "edges_valid": f"SELECT follower, followee FROM ({lp}) WHERE follower IS NOT NULL AND followee IS NOT NULL",
        "edges_under_max": f"{max_lp} SELECT follower, followee FROM e",
        "edges_reversed": f"SELECT followee AS follower, follower AS followee FROM ({lp})",
        "edges_core": (
            f"{all_lp} SELECT follower, followee FROM e"
            " WHERE follower IN (SELECT followee FROM e) AND followee IN (SELECT follower FROM e)"
        ),
        "edge_multiplicity": f"SELECT follower, followee, count(*) AS multiplicity FROM ({lp}) GROUP BY follower, followee",
        "adjacency": (
            "SELECT follower, count(*) AS n_followees, min(followee) AS first_followee,"
            " max(followee) AS last_followee, CAST(sum(followee) AS BIGINT) AS followee_checksum"
            f" FROM ({lp}) GROUP BY follower"
        ),
        "follower_count_mod100": follower_count(pl, divided),
        "follower_count_orders": follower_count(oc, divided),
        "follower_count_all": follower_count(pl, ""),
        "follower_group_size": group_size(pl, divided),
        "follower_group_size_all": group_size(pl, ""),
        "degrees": (
            f"{ends} SELECT node, CAST(sum(i) AS BIGINT) AS in_degree,"
            " CAST(sum(o) AS BIGINT) AS out_degree FROM d GROUP BY node"
        ),
        "degree_product": f"{ends} SELECT node, CAST(sum(i) * sum(o) AS BIGINT) AS degree_product FROM d GROUP BY node",
        "two_path_count_exact": (
            f"{ends} SELECT CAST(sum(p) AS BIGINT) AS two_path_count"
            " FROM (SELECT sum(i) * sum(o) AS p FROM d GROUP BY node)"
        ),
        "two_path_count_sampled": f"{max_lp} SELECT count(*) AS two_path_count FROM {path}",
        "two_path_count_no_loop": f"{all_lp} SELECT count(*) AS two_path_count FROM {path} WHERE {no_loop}",
        "two_path_cardinality_vs_max": (
            f"WITH m AS (SELECT CAST(unnest({MAX_IDS}) AS BIGINT) AS max_id), e AS ({lp}),"
            " n AS (SELECT m.max_id, count(*) AS two_path_count FROM m, e a JOIN e b"
            " ON a.followee = b.follower WHERE a.follower < m.max_id AND a.followee < m.max_id"
            " AND b.followee < m.max_id GROUP BY m.max_id)"
            " SELECT m.max_id, coalesce(n.two_path_count, 0) AS two_path_count"
            " FROM m LEFT JOIN n ON m.max_id = n.max_id"
        ),
        "two_paths": f"{all_lp} SELECT {path_columns} FROM {path}",
        "two_paths_no_loop": f"{all_lp} SELECT {path_columns} FROM {path} WHERE {no_loop}",
        "two_paths_orders": f"WITH e AS ({oc}) SELECT {path_columns} FROM {path}",
        "triangles_closed_walks": f"{all_lp} SELECT {nodes3} FROM {walk}",
        "triangles_no_loop": f"{all_lp} SELECT {nodes3} FROM {walk} WHERE {no_loop}",
        "triangles_strict": f"{all_lp} SELECT {nodes3} FROM {walk} WHERE {strict}",
        "triangle_count_closed_walks": f"{all_lp} SELECT {thirds} FROM {walk}",
        "triangle_count_no_loop": f"{all_lp} SELECT {thirds} FROM {walk} WHERE {no_loop}",
        "triangle_count_strict": f"{all_lp} SELECT {thirds} FROM {walk} WHERE {strict}",
        "triangle_count_no_loop_max": f"{max_lp} SELECT {thirds} FROM {walk} WHERE {no_loop}",
        "triangle_count_closed_walks_max": f"{max_lp} SELECT {thirds} FROM {walk}",
        "triangle_walk_metrics": (
            f"{all_lp} SELECT count(*) AS closed_walks,"
            f" count(*) FILTER (WHERE {no_loop}) AS no_loop_walks,"
            f" count(*) FILTER (WHERE {strict}) AS strict_walks FROM {walk}"
        ),
        "triangles_per_node": (
            f"{all_lp} SELECT a.follower AS node, count(*) AS closing_walks"
            f" FROM {walk} WHERE {no_loop} GROUP BY a.follower"
        ),
    }
    low_lp = f"WITH e AS (SELECT follower, followee FROM ({lp}) WHERE follower < {LOW_MAX_ID} AND followee < {LOW_MAX_ID})"
    max_oc = f"WITH e AS (SELECT follower, followee FROM ({oc}) WHERE follower < {MAX_ID} AND followee < {MAX_ID})"
    kind = "(l_orderkey * 7 + l_linenumber) % 11"
    good = f"SELECT l_partkey AS follower, l_suppkey AS followee FROM lineitem WHERE {kind} NOT IN (0, 1, 2, 5)"
    text = f"""SELECT CASE {kind} WHEN 0 THEN 'x' ELSE '' END || l_partkey || CASE {kind} WHEN 1 THEN '.0' ELSE '' END AS follower,
        CAST(l_suppkey AS VARCHAR) AS followee FROM lineitem WHERE {kind} NOT IN (2, 5)"""
    for strategy in ("shuffle", "split"):
        sql |= {
            f"two_paths_{strategy}": path_profile(""),
            f"two_paths_no_loop_{strategy}": path_profile(f"WHERE {no_loop}"),
            f"triangles_no_loop_{strategy}": sql["triangles_no_loop"],
            f"triangle_count_no_loop_{strategy}": sql["triangle_count_no_loop"],
        }
    sql |= {
        "triangle_count_closed_walks_shuffle": sql["triangle_count_closed_walks"],
        "triangle_count_no_loop_broadcast": sql["triangle_count_no_loop"],
        "triangle_count_by_lists": sql["triangle_count_no_loop"],
        "triangle_count_by_lists_split": sql["triangle_count_closed_walks"],
        "walk_counts_by_lists": sql["triangle_walk_metrics"],
        "triangles_closed_walks_split": sql["triangles_closed_walks"],
        "triangles_strict_split": sql["triangles_strict"],
        "edges_core_split": sql["edges_core"],
        "adjacency_split": sql["adjacency"],
        "edges_under_low_max": f"{low_lp} SELECT follower, followee FROM e",
        "two_path_count_low_max": f"{low_lp} SELECT count(*) AS two_path_count FROM {path}",
        "triangle_count_low_max": f"{low_lp} SELECT {thirds} FROM {walk} WHERE {no_loop}",
        "edges_under_max_orders": f"{max_oc} SELECT follower, followee FROM e",
        "two_path_count_sampled_orders": f"{max_oc} SELECT count(*) AS two_path_count FROM {path}",
        "degrees_reversed": (
            f"{ends} SELECT node, CAST(sum(o) AS BIGINT) AS in_degree,"
            " CAST(sum(i) AS BIGINT) AS out_degree FROM d GROUP BY node"
        ),
        "follower_group_size_plain": f"SELECT followee, count(*) AS n_followers FROM ({pl}) GROUP BY followee",
        "lines_parsed": good,
        "lines_parsed_as_text": text,
        "lines_dropped": (
            f"SELECT count(*) FILTER (WHERE {kind} <> 5) AS n_lines,"
            f" count(*) FILTER (WHERE {kind} IN (0, 1, 2)) AS n_dropped FROM lineitem"
        ),
        "pair_lines": f"SELECT '(' || followee || ',' || count(*) || ')' AS line FROM ({pl}) GROUP BY followee",
        "walk_lines": (
            f"{all_lp} SELECT b.followee || chr(9) || a.follower || ' ' || a.followee || ' ' || b.followee || ' ' || a.follower AS line"
            f" FROM {walk} WHERE {no_loop}"
        ),
    }

    def paths_of(first: str, second: str, columns: str = "a.follower AS start_node, a.followee AS mid_node, b.followee AS end_node"):
        return f"SELECT {columns} FROM ({source(first)}) a JOIN ({source(second)}) b ON a.followee = b.follower"

    priced = (
        "WITH e AS (SELECT l_partkey AS a, l_suppkey AS b, CAST(coalesce(round(l_extendedprice * 100), 0) AS HUGEINT) AS w"
        " FROM lineitem WHERE l_partkey IS NOT NULL AND l_suppkey IS NOT NULL),"
        " d AS (SELECT a AS node, 0::HUGEINT AS i, w AS o FROM e UNION ALL SELECT b, w, 0 FROM e),"
        " p AS (SELECT node, sum(i) * sum(o) AS t FROM d GROUP BY node)"
    )
    limbs = "CAST({0} // 1000000000000000000 AS BIGINT) AS weight_high, CAST({0} % 1000000000000000000 AS BIGINT) AS weight_low"

    def profile_of(first: str, second: str) -> str:
        return (
            "SELECT start_node, count(*) AS n_paths, CAST(sum(mid_node) AS BIGINT) AS mid_checksum,"
            f" CAST(sum(end_node) AS BIGINT) AS end_checksum FROM ({paths_of(first, second)}) GROUP BY start_node"
        )

    def walks_of(first: str, second: str, third: str, where: str = "") -> str:
        # copies are merged first: the same counts, by shorter joins
        merged = {n: f"SELECT follower, followee, count(*) AS m FROM ({source(r)}) GROUP BY ALL" for n, r in zip("abc", (first, second, third))}
        return (
            "SELECT a.follower AS n1, a.followee AS n2, b.followee AS n3, CAST(sum(a.m * b.m * c.m) AS BIGINT) AS walks"
            f" FROM ({merged['a']}) a JOIN ({merged['b']}) b ON a.followee = b.follower"
            f" JOIN ({merged['c']}) c ON b.followee = c.follower AND c.followee = a.follower {where} GROUP BY ALL"
        )

    lines = f"""SELECT CASE {kind} WHEN 0 THEN 'x' || l_partkey || ',' || l_suppkey WHEN 1 THEN l_partkey || '.0,' || l_suppkey
        WHEN 2 THEN l_partkey || ',' WHEN 3 THEN ' ' || l_partkey || ' , ' || l_suppkey WHEN 4 THEN l_partkey || ',' || l_suppkey || ',more'
        WHEN 5 THEN '  ' ELSE l_partkey || ',' || l_suppkey END AS line, {kind} AS kind, l_partkey, l_suppkey FROM lineitem"""
    sql |= {
        "two_paths_between": paths_of("CO", "OP"),
        "two_paths_between_side": paths_of(
            "LP", "SN", "a.follower AS start_node, a.followee AS mid_node, CAST(b.followee AS BIGINT) AS end_node"
        ),
        "two_paths_between_hubs": profile_of("SO", "OP"),
        "two_paths_between_split": profile_of("CO", "OP"),
        "two_path_weight": f"{priced} SELECT {limbs.format('coalesce(sum(t), 0)')} FROM p",
        "two_path_weights": f"{priced} SELECT node, {limbs.format('t')} FROM p",
        "two_path_count_between": paths_of("LP", "SO", "count(*) AS two_path_count"),
        "two_path_count_between_no_loop": paths_of("LP", "PL", "count(*) AS two_path_count") + " WHERE a.follower <> b.followee",
        "closed_walks_between": walks_of("LP", "SO", "OP"),
        "closed_walks_between_strict": walks_of(
            "SO", "OP", "LP", "WHERE a.follower <> a.followee AND a.followee <> b.followee AND a.follower <> b.followee"
        ),
        "closed_walks_between_shuffle": walks_of("LP", "SO", "OP"),
        "close_saved_paths": sql["triangles_no_loop"],
        "lines_explained": (
            "SELECT CASE WHEN kind NOT IN (0, 1, 2, 5) THEN l_partkey END AS follower, CASE WHEN kind NOT IN (0, 1, 2, 5) THEN l_suppkey END AS followee,"
            " CASE kind WHEN 0 THEN 'follower' WHEN 1 THEN 'follower' WHEN 2 THEN 'followee' WHEN 5 THEN 'blank' END AS reason, line"
            f" FROM ({lines})"
        ),
        "edges_from_nested_files": good,
        "paths_by_index": f"SELECT *, count(*) AS copies FROM ({paths_of('CO', 'OP')}) GROUP BY ALL",
        "paths_by_index_split": f"SELECT *, count(*) AS copies FROM ({paths_of('LP', 'LP')}) GROUP BY ALL",
        "followees_looked_up": (
            f"SELECT follower AS node, followee, count(*) AS copies FROM ({pl})"
            " WHERE follower IN (SELECT s_suppkey FROM supplier) GROUP BY ALL"
        ),
        "pairs_saved": (
            "SELECT line, count(*) OVER () AS rows_written, max(length(line)) OVER () AS longest_line"
            f" FROM ({sql['pair_lines']})"
        ),
        "walks_saved_with_counters": (
            "SELECT count(*) AS rows_read, count(*) AS rows, CAST(sum(w) AS BIGINT) AS walks, count(*) FILTER (WHERE n1 = n2 OR n2 = n3) AS over_loops"
            f" FROM (SELECT n1, n2, n3, count(*) AS w FROM ({sql['triangles_no_loop']}) GROUP BY ALL)"
        ),
        "edges_in_order": f"SELECT follower, followee, row_number() OVER (ORDER BY followee, follower) AS position FROM ({lp})",
    }
    if llm:
        sql |= llm.oracle_sql()
    return sql
