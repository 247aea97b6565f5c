"""Slots for hot join keys.

A join on a node id sends every row of that node to one task. A node that holds a third of
all edges would stop the job, so the two sides of such a join also meet on a *slot*: rows of
one side pick one slot from a hash of their own values, rows of the other side appear once in
every slot. Each pair of matching rows still meets exactly once, and because the slot is a
hash, a task that is run again after a lost executor puts its rows where they were before.

The slot counts of the hot keys are broadcast. ``Route.hot_limit`` bounds their number by
``Limits.max_share``, which does not grow with the data. All other keys have one slot.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def long(value: int) -> Column:
    """A BIGINT literal, whatever its size."""
    return F.lit(value).cast("bigint")


def slots_for(size: str, limit: int) -> Column:
    """Slots of a key with ``size`` rows: one unless it is hot."""
    return F.greatest(long(1), F.call_function("div", F.col(size) + (limit - 1), F.lit(limit)))


def hot_keys(sizes: DataFrame, key: str, columns: list[str], limit: int) -> DataFrame:
    """``hot_key`` and, for each size column ``c``, its slots ``c_slots``; hot keys only."""
    hot = reduce(or_, [F.col(c) > limit for c in columns])
    return sizes.filter(hot).select(
        F.col(key).alias("hot_key"), *[slots_for(c, limit).alias(f"{c}_slots") for c in columns]
    )


def with_slots(df: DataFrame, key: str, hot: DataFrame, bounded: bool = True) -> DataFrame:
    """Add the slot counts of ``key``; keys that are not hot get 1.

    ``bounded`` says that the number of hot keys is known to be small; where it rests on an
    unchecked number of edges, the planner chooses the join by what it finds."""
    counts = [c for c in hot.columns if c != "hot_key"]
    return df.join(F.broadcast(hot) if bounded else hot, F.col(key) == F.col("hot_key"), "left").select(
        *df.columns, *[F.coalesce(F.col(c), long(1)).alias(c) for c in counts]
    )


def pick_slot(slots: Column, *by: str) -> Column:
    """The one slot of this row, from a hash of ``by``."""
    return F.pmod(F.xxhash64(*by), slots)


def all_slots(slots: Column) -> Column:
    """One row for every slot."""
    return F.explode(F.sequence(long(0), slots - 1))


def in_blocks(df: DataFrame, last: Column, name: str = "block") -> DataFrame:
    """Each row once for every number from 0 to ``last``, in the column ``name``. Numbers are written out digit by
    digit in base 2^16, so no array has more than 65,536 elements however large ``last`` is."""
    base = long(1 << 16)
    columns = df.columns
    df = df.select(*columns, last.alias("__last"), long(0).alias(name))
    for power in (2, 1, 0):
        unit = long((1 << 16) ** power)
        # how many units are left from this block's start to the end
        left = F.call_function("div", F.col("__last") - F.col(name), unit)
        digits = F.sequence(long(0), F.least(base - 1, left)) if power < 2 else F.sequence(long(0), left)
        df = df.select(*columns, "__last", name, F.explode(digits).alias("__digit")).select(
            *columns, "__last", (F.col(name) + F.col("__digit") * unit).alias(name)
        )
    return df.drop("__last")


def repeat_rows(df: DataFrame, times: str, columns: list[str], most: int) -> DataFrame:
    """Each row ``times`` times over.

    Rows with many repeats are first cut into blocks of ``most`` and the blocks spread over
    tasks, so one heavy row is not written out by a single task. All rows take part in that one
    shuffle: leaving the light ones out means a second run of what made the rows, which was
    measured to take longer.
    """
    size = long(most)
    last = F.call_function("div", F.col(times) - 1, size)
    blocks = in_blocks(df.select(*columns, times), last).repartition(*columns, "block")
    rest = F.least(size, F.col(times) - F.col("block") * size)
    return blocks.select(*columns, F.explode(F.sequence(long(1), rest)).alias("repeat")).select(*columns)
