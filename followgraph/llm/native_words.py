"""Plain words (ASCII letters and digits, and all beyond ASCII) with SQL functions alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from followgraph.llm.common import PLAIN_WORD, lower_ascii

_SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lowered(text: Column) -> Column:
    """A-Z in lower case. Texts of ASCII alone take the faster lower()."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(lower_ascii(text))


def plain_words(text: Column) -> Column:
    """The words of a text in lower case, in order; none for a null text."""
    return F.array_remove(F.split(lowered(text), _SEPARATOR), "")


def word_line(text: Column) -> Column:
    """The words in lower case with one blank before, between and after them."""
    return F.regexp_replace(F.concat(F.lit(" "), lowered(text), F.lit(" ")), _SEPARATOR, " ")


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(PLAIN_WORD)), F.lit(0)).cast("long")
