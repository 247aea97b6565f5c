"""Small column expressions; everything here is a built-in JVM expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDE = "decimal(38,0)"


def divisible_by(column: str, modulus: int) -> Column:
    """True for multiples of ``modulus``, zero and negative ones included."""
    return F.col(column) % F.lit(modulus) == 0


def both_ends() -> Column:
    """True for edges that have both ends.

    Written as two IS NOT NULL tests, which reach the scan. Joins imply the same tests, and where
    they are there already, the inputs of several joins stay alike and share one shuffle.
    """
    return F.col("follower").isNotNull() & F.col("followee").isNotNull()


def below(max_id: int) -> Column:
    """True for edges whose ends are both strictly below ``max_id``."""
    return (F.col("follower") < max_id) & (F.col("followee") < max_id)


def whole_thirds(count: Column, wide: bool = False) -> Column:
    """A third of ``count`` in whole numbers; plain ``/`` would keep the fraction."""
    if wide:  # ``div`` always answers BIGINT
        return ((count - count % 3) / 3).cast(WIDE)
    return F.call_function("div", count, F.lit(3))


def pair_text(key: str, value: str) -> Column:
    """``(key,value)``."""
    return F.concat(F.lit("("), F.col(key), F.lit(","), F.col(value), F.lit(")"))


def walk_text(*nodes: str) -> Column:
    """Node ids separated by single blanks."""
    return F.concat_ws(" ", *[F.col(n).cast("string") for n in nodes])


def line_ids(line: str, sep: str, id_type: str) -> tuple[Column, Column]:
    """The first two fields of a line as ids, null where a field is none. White space around an
    id is no part of it; fields beyond the second are ignored."""
    fields = F.split(F.col(line), F.lit("\\Q" + sep + "\\E"), F.lit(3))

    def field(place: int) -> Column:
        text = F.nullif(F.btrim(F.get(fields, F.lit(place)), F.lit(" \t\r")), F.lit(""))
        return text if id_type == "string" else text.try_cast(id_type)

    return field(0), field(1)
