from .joins import equi_join
from .project import (
    cast_columns,
    prefix_clashes,
    prefixed,
    select_shared,
    shared_columns,
    suffix_to_prefix,
)
from .rows import draw_without_replacement, first_rows, number_rows

__all__ = [
    "cast_columns",
    "draw_without_replacement",
    "equi_join",
    "first_rows",
    "number_rows",
    "prefix_clashes",
    "prefixed",
    "select_shared",
    "shared_columns",
    "suffix_to_prefix",
]
