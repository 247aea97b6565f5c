"""Follower-graph analytics on Spark DataFrames.

An edge table has two columns, ``follower`` and ``followee``. Every operator takes one and
gives a DataFrame back. Operators that join count the edges first, unless told how many there
are; nothing else runs until the caller asks for the result.
"""

from followgraph.operators import *  # noqa: F401,F403
from followgraph.operators import __all__ as _operators
from followgraph.plans import STRATEGIES, Limits, plan_text, with_metrics
from followgraph.sources import *  # noqa: F401,F403
from followgraph.sources import __all__ as _sources

__all__ = [*_operators, *_sources, "STRATEGIES", "Limits", "plan_text", "with_metrics"]
