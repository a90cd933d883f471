"""Relational building blocks: bounded lookups, arg-max, ordered top-k."""

from hackney.operators.argmax import arg_max, arg_max_packed, first_packed, ordered_first
from hackney.operators.filters import nonzero_coordinates
from hackney.operators.lookup import count_per, lookup_join, sum_again, unique_side
from hackney.operators.topk import sort_small, sort_total, top_k

__all__ = [
    "arg_max", "arg_max_packed", "first_packed", "ordered_first", "nonzero_coordinates", "count_per",
    "lookup_join", "sum_again", "unique_side", "sort_small", "sort_total", "top_k",
]
