"""The analytics as batch programs: read edge files, write result files.

    spark-submit --py-files followgraph.zip followgraph/jobs.py JOB INPUT OUTPUT [options]
    python -m followgraph.jobs JOB INPUT OUTPUT [options]

Jobs

follower-count    followees divisible by --modulus with their number of followers
two-path-exact    every node with its in-degree times out-degree; prints the sum
two-path-list     every 2-path under --max; prints how many
two-path-count    how many 2-paths there are under --max, without listing one
triangle-list     every closed walk under --max; prints a third of their number
triangle-count    a third of the closed walks under --max

--walks says which walks count: closed (default for two-path-list), no_loop (default for the
triangle jobs) or strict. For 2-paths there are closed and no_loop, which leaves out those that
go back to where they started.

Lines that are no edge are dropped and their number is printed to standard error;
--strict-input makes them an error.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import followgraph as fg
from followgraph.functions import both_ends


def _follower_count(edges: DataFrame, args) -> None:
    counts = fg.follower_count(edges, args.modulus or None)
    write = fg.write_pairs if args.format == "pairs" else fg.write_csv
    write(counts, args.output, mode=args.mode)


def _two_path_exact(edges: DataFrame, args) -> int:
    total = F.coalesce(F.sum("degree_product"), F.lit(0))
    products, seen = fg.with_metrics(
        fg.degree_product(edges, wide=args.wide), "two_path_exact", total=total
    )
    fg.write_tsv(products, args.output, mode=args.mode)
    return seen.get["total"]


def _two_path_list(edges: DataFrame, args) -> int:
    paths = fg.two_paths(
        edges,
        loops=args.walks in (None, "closed"),
        strategy=args.strategy,
    )
    paths, seen = fg.with_metrics(paths, "two_path_list")
    fg.write_tsv(paths, args.output, mode=args.mode)
    return seen.get["rows"]


def _two_path_count(edges: DataFrame, args) -> int:
    count = fg.two_path_count(edges, loops=args.walks in (None, "closed"), wide=args.wide)
    count, seen = fg.with_metrics(count, "two_path_count", count=F.max("two_path_count"))
    fg.write_scalar(count, args.output, mode=args.mode)
    return int(seen.get["count"])


def _triangle_list(edges: DataFrame, args) -> int:
    walks = fg.triangles(
        edges, args.walks or "no_loop", strategy=args.strategy, edge_rows=args.edges
    )
    walks, seen = fg.with_metrics(walks, "triangle_list")
    fg.write_tsv(walks, args.output, key="n1", values=["n1", "n2", "n3", "n1"], mode=args.mode)
    return seen.get["rows"] // 3


def _triangle_count(edges: DataFrame, args) -> int:
    count = fg.triangle_count(
        edges,
        args.walks or "no_loop",
        strategy=args.strategy,
        edge_rows=args.edges,
        wide=args.wide,
    )
    count, seen = fg.with_metrics(count, "triangle_count", count=F.max("triangle_count"))
    fg.write_scalar(count, args.output, mode=args.mode)
    return int(seen.get["count"])


JOBS = {
    "follower-count": _follower_count,
    "two-path-exact": _two_path_exact,
    "two-path-list": _two_path_list,
    "two-path-count": _two_path_count,
    "triangle-list": _triangle_list,
    "triangle-count": _triangle_count,
}
WITH_MAX = {"two-path-list", "two-path-count", "triangle-list", "triangle-count"}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(
        prog="followgraph", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter
    )
    p.add_argument("job", choices=sorted(JOBS))
    p.add_argument("input", help="file or directory of follower,followee lines")
    p.add_argument("output", help="directory to write")
    p.add_argument("--max", type=int, default=None, help="keep edges with both ids below this")
    p.add_argument("--edges", type=int, help="number of edges, if known; saves the triangle jobs counting them")
    p.add_argument("--modulus", type=int, default=100, help="0 keeps all followees")
    p.add_argument("--walks", choices=fg.WALKS)
    p.add_argument("--strategy", choices=fg.STRATEGIES, default="auto")
    p.add_argument("--format", choices=("csv", "pairs"), default="csv", help="of follower-count")
    p.add_argument("--overwrite", dest="mode", action="store_const", const="overwrite", default="errorifexists")
    p.add_argument("--recursive", action="store_true", help="read nested input directories")
    p.add_argument("--strict-input", action="store_true", help="fail on lines that are no edge")
    p.add_argument("--wide", action="store_true", help="counts as decimal(38,0)")
    p.add_argument("--explain", action="store_true", help="print the plan of the input")
    return p


def run(spark: SparkSession, arguments: list[str]) -> int | None:
    """Run one job; the number it reports, if any."""
    args = parser().parse_args(arguments)
    if args.job.startswith("two-path") and args.walks == "strict":
        raise ValueError("2-paths are closed or no_loop")
    lines = fg.read_lines(spark, args.input, recursive=args.recursive, strict=args.strict_input)
    lines, seen = fg.with_metrics(lines, "lines", dropped=F.count_if(~both_ends()))
    edges = fg.valid(lines)
    if args.job in WITH_MAX:
        edges = fg.under_max(edges, args.max)
    if args.explain:
        print(fg.plan_text(edges))
    result = JOBS[args.job](edges, args)
    if seen.get["dropped"]:
        print(f"{seen.get['dropped']} lines are no edge", file=sys.stderr)
    return result


def main(arguments: list[str] | None = None) -> None:
    spark = SparkSession.builder.appName("followgraph").getOrCreate()
    result = run(spark, arguments)
    if result is not None:
        print(result)


if __name__ == "__main__":
    main()
