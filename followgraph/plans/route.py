"""How the joins of an operator are carried out, decided from the number of edges."""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STRATEGIES = ("auto", "shuffle", "broadcast")


@dataclass(frozen=True)
class Limits:
    """Sizes at which plans change.

    ``broadcast_rows``  most edges whose relations may be broadcast (tens of MB of id pairs)
    ``rows``            a key with at most this many rows is never split
    ``max_share``       a key is split only if it holds more than 1/max_share of all edge ends
    ``wedge_rows``      neighbours of one middle node for each group of the wedge join
    ``path_rows``       edges into, and out of, a middle node for each cell of the 2-path join
    ``task_paths``      2-paths that one task of a listing is to make
    ``tasks``           most tasks of a listing
    ``copies``          most identical edges that one row of a join stands for
    ``repeats``         most identical result rows written out by one row
    ``list_size``       expected neighbours in one adjacency row
    """

    broadcast_rows: int = 1_000_000
    rows: int = 1_000_000
    max_share: int = 1_000_000
    wedge_rows: int = 10_000
    path_rows: int = 100
    task_paths: int = 200_000
    tasks: int = 50_000
    copies: int = 1_000
    repeats: int = 1_000_000
    list_size: int = 100_000


@dataclass(frozen=True)
class Route:
    """The choice for one operator call."""

    broadcast: bool
    hint: str | None
    edge_rows: int
    limits: Limits
    counted: bool = True

    @property
    def split(self) -> bool:
        """Whether any key can be hot: only if rows are sent by key, and there are enough."""
        return not self.broadcast and self.edge_rows > self.limits.rows

    @property
    def hot_limit(self) -> int:
        """Rows above which a key is split. Edges have two ends, so at most ``max_share`` keys
        can pass it, however many edges there are."""
        return max(self.limits.rows, 2 * self.edge_rows // self.limits.max_share + 1)

    @property
    def wedge_groups(self) -> int:
        """Groups of a node's neighbours at most. With m edges, no node has more than sqrt(2m)
        neighbours ranked above it, and only these are put into groups."""
        return max(1, -(-(math.isqrt(2 * self.edge_rows) + 1) // self.limits.wedge_rows))

    def mark(self, df: DataFrame) -> DataFrame:
        """Mark the right side of a join."""
        if self.broadcast:
            return F.broadcast(df)
        return df.hint(self.hint) if self.hint else df


def route(
    edges: DataFrame, strategy: str, limits: Limits, edge_rows: int | None = None, counted: int | None = None
) -> Route:
    """Choose a route.

    The edges are counted (a scan, no shuffle) unless the caller knows an upper bound and says
    so in ``edge_rows``. Such a number never leads to a broadcast by itself: where it would, the
    scan goes on until there are more edges than may be broadcast. Up to
    ``limits.broadcast_rows`` edges, ``auto`` and ``broadcast`` send whole relations to every
    task; none of these has more rows than there are edges or edge ends. Beyond that both turn
    to joins that shuffle and spill, and ``broadcast`` warns of it. ``counted`` is for an
    operator that has counted the edges itself. ``shuffle`` always does, and
    asks for sort-merge joins; ``auto`` leaves their kind to the planner.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, not {strategy!r}")
    if counted is not None:
        n = counted
    elif edge_rows is None:
        n = edges.count()
    elif edge_rows > limits.broadcast_rows:
        n = edge_rows
    else:
        n = max(edge_rows, edges.limit(limits.broadcast_rows + 1).count())
    if strategy == "broadcast" and n > limits.broadcast_rows:
        warnings.warn(f"{n} edges are too many to broadcast (Limits.broadcast_rows); joins will shuffle", stacklevel=3)
    return Route(
        broadcast=strategy != "shuffle" and n <= limits.broadcast_rows,
        hint=None if strategy == "auto" else "merge",
        edge_rows=n,
        limits=limits,
        counted=edge_rows is None or counted is not None,
    )
