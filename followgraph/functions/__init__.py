"""Column expressions shared by the operators and the sinks."""

from followgraph.functions.columns import (
    below,
    both_ends,
    divisible_by,
    line_ids,
    pair_text,
    whole_thirds,
    walk_text,
)
from followgraph.functions.limbs import high_low, product_limbs, sum_limbs

__all__ = [
    "below",
    "both_ends",
    "divisible_by",
    "high_low",
    "line_ids",
    "pair_text",
    "product_limbs",
    "sum_limbs",
    "walk_text",
    "whole_thirds",
]
