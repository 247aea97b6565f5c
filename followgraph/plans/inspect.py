"""Looking at a plan, and counting rows while they are written."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode=mode)
    return out.getvalue()


def with_metrics(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """``df`` and an observation filled by the first action on it, writes included.

    Without ``metrics`` it counts ``rows``.
    """
    observation = Observation(name)
    columns = metrics or {"rows": F.count(F.lit(1))}
    return df.observe(observation, *[c.alias(n) for n, c in columns.items()]), observation
