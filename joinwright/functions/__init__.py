from .columns import col
from .draws import array_of, hash32, hash63, literal, permuted, stream, stride
from .patterns import drawn_string, pattern_regex, unique_room, unique_string

__all__ = [
    "array_of",
    "col",
    "drawn_string",
    "hash32",
    "hash63",
    "literal",
    "pattern_regex",
    "permuted",
    "stream",
    "stride",
    "unique_room",
    "unique_string",
]
