"""Edge tables from files and from any DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from followgraph.functions import both_ends, line_ids

EDGE_SCHEMA = "follower bigint, followee bigint"


def parse_lines(
    lines: DataFrame, line: str = "value", *, sep: str = ",", id_type: str = "bigint", strict: bool = False
) -> DataFrame:
    """``follower, followee`` of every line of text that isn't blank; a field that is no id is
    null. ``strict`` raises on such lines, and on lines with more than two fields."""
    follower, followee = line_ids(line, sep, id_type)
    filled = lines.filter(F.trim(F.col(line)) != "")
    both = F.struct(follower.alias("follower"), followee.alias("followee"))
    # as a row of its own, so that what tests the ids does not parse them once more
    if not strict:
        return filled.select(F.inline(F.array(both)))
    edges = filled.select(F.col(line).alias("__line"), F.inline(F.array(both)))
    good = both_ends() & (F.size(F.split("__line", "\\Q" + sep + "\\E")) <= 2)
    fail = F.raise_error(F.concat(F.lit("MALFORMED line: "), F.col("__line"))).cast(id_type)
    return edges.select(F.when(good, F.col("follower")).otherwise(fail).alias("follower"), "followee")


def explain_lines(lines: DataFrame, line: str = "value", *, sep: str = ",", id_type: str = "bigint") -> DataFrame:
    """``follower, followee, reason, line`` of every line: ``reason`` is null for an edge, or else
    ``blank`` (or null), ``fields`` (fewer than two), ``follower``, ``followee`` or ``both`` (no ids). Lines that
    are no edge are kept, with null ids, instead of being dropped."""
    follower, followee = line_ids(line, sep, id_type)
    read = lines.select(
        F.inline(
            F.array(
                F.struct(
                    follower.alias("follower"),
                    followee.alias("followee"),
                    F.col(line).alias("line"),
                    F.contains(F.col(line), F.lit(sep)).alias("several"),
                )
            )
        )
    )
    no_one, no_other = F.col("follower").isNull(), F.col("followee").isNull()
    reason = (
        F.when(F.coalesce(F.trim("line"), F.lit("")) == "", "blank")
        .when(~F.col("several"), "fields")
        .when(no_one & no_other, "both")
        .when(no_one, "follower")
        .when(no_other, "followee")
    )
    good = reason.isNull()
    return read.select(
        F.when(good, F.col("follower")).alias("follower"), F.when(good, F.col("followee")).alias("followee"), reason.alias("reason"), "line"
    )


def read_lines(
    spark: SparkSession,
    path: str | list[str],
    *,
    recursive: bool = False,
    id_type: str = "bigint",
    sep: str = ",",
    strict: bool = False,
) -> DataFrame:
    """Headerless ``follower,followee`` text files or directories, one row per line that isn't
    blank, with nulls where a field is no id; ``valid`` drops these rows."""
    reader = spark.read.option("recursiveFileLookup", "true") if recursive else spark.read
    return parse_lines(reader.text(path), sep=sep, id_type=id_type, strict=strict)


def read_edges(
    spark: SparkSession,
    path: str | list[str],
    *,
    mode: str = "PERMISSIVE",
    recursive: bool = False,
    id_type: str = "bigint",
    sep: str = ",",
) -> DataFrame:
    """Headerless ``follower,followee`` text files or directories.

    By default (and with ``mode="DROPMALFORMED"``) a line with a field that is no id is dropped,
    and further fields are ignored; ``mode="FAILFAST"`` raises on both. ``id_type="string"``
    keeps ids as text. ``dropped_lines`` tells how many lines have gone.
    """
    strict = mode.upper() == "FAILFAST"
    return read_lines(spark, path, recursive=recursive, id_type=id_type, sep=sep, strict=strict).filter(both_ends())


def dropped_lines(lines: DataFrame) -> DataFrame:
    """One row, ``n_lines, n_dropped``: lines that aren't blank, and those that are no edge."""
    return lines.agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if(~both_ends()).alias("n_dropped")
    )


def from_table(df: DataFrame, follower: str, followee: str, *, id_type: str = "bigint") -> DataFrame:
    """Two columns of any DataFrame as edges; rows without both ids are dropped.

    A column of fractions is refused: casting would make one id of several."""

    def ids(name: str):
        column, kind = F.col(name), df.schema[name].dataType
        if isinstance(kind, T.FractionalType) and not (isinstance(kind, T.DecimalType) and kind.scale == 0):
            raise ValueError(f"{name}: ids can't be of type {kind.simpleString()}")
        return column.try_cast(id_type) if isinstance(kind, T.StringType) else column.cast(id_type)

    edges = df.select(ids(follower).alias("follower"), ids(followee).alias("followee"))
    return edges.filter(both_ends())


def read_walks(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Saved paths or triangles: ids separated by tabs or blanks, one walk per line."""
    ids = F.struct(F.split("value", "[\t ]").alias("ids"))
    walk = F.struct(*[F.col("ids")[i].cast("bigint").alias(c) for i, c in enumerate(columns)])
    # each as a row of its own, so that a line is split once for all ids, and what tests the ids does
    # not parse them once more
    return spark.read.text(path).select(F.inline(F.array(ids))).select(F.inline(F.array(walk)))
