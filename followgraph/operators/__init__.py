"""DataFrame in, DataFrame out."""

from followgraph.operators.degrees import (
    degree_product,
    degrees,
    follower_count,
    follower_group_size,
    two_path_count,
    two_path_count_by_max,
    two_path_weight,
    two_path_weights,
)
from followgraph.operators.edges import adjacency, core, multiplicity, reverse, under_max, valid
from followgraph.operators.paths import two_path_count_between, two_paths, two_paths_between
from followgraph.operators.closing import close_paths, closed_walks_between
from followgraph.operators.index import AdjacencyIndex, followees_of, open_adjacency, paths_by_index, save_adjacency
from followgraph.operators.cycles import (
    WALKS,
    closed_walks,
    triangle_count,
    triangles,
    walk_counts,
)

__all__ = [
    "WALKS",
    "AdjacencyIndex",
    "adjacency",
    "close_paths",
    "closed_walks",
    "closed_walks_between",
    "core",
    "degree_product",
    "degrees",
    "followees_of",
    "follower_count",
    "follower_group_size",
    "multiplicity",
    "open_adjacency",
    "paths_by_index",
    "reverse",
    "save_adjacency",
    "triangle_count",
    "triangles",
    "two_path_count",
    "two_path_count_between",
    "two_path_count_by_max",
    "two_path_weight",
    "two_path_weights",
    "two_paths",
    "two_paths_between",
    "under_max",
    "valid",
    "walk_counts",
]
