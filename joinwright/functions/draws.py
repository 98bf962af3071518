"""Repeatable draws as SQL expressions.

Every value is a pure function of a seed, a column and a row index, so a table
comes out the same on any number of partitions, after a retry, and on a second
read, without shuffling or keeping anything.

The functions take and give SQL text for ``selectExpr``; an index is a bigint.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
from collections.abc import Iterable
from typing import Any

# A prime below 2^32, and multipliers that keep every product within a bigint.
PRIME = 4294967291
LOW = 668265263
HIGH = 374761393
MIX = 73244475
MASK32 = 0xFFFFFFFF
# Ranges above WIDE are permuted in BLOCKS blocks.
WIDE = 1 << 32
BLOCKS = 1 << 20


def literal(value: Any) -> str:
    """A Python value as a SQL literal."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, int):
        return str(value) if value >= 0 else f"({value})"
    if isinstance(value, float):
        return f"({value!r}D)"
    if isinstance(value, dt.date):
        return f"DATE'{value.isoformat()}'"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def array_of(values: Iterable[Any]) -> str:
    return "array(" + ", ".join(literal(v) for v in values) + ")"


def stream(seed: int, *names: object) -> int:
    """32-bit number of the draws of one column under one seed."""
    text = ":".join([str(seed), *map(str, names)])
    return int.from_bytes(hashlib.md5(text.encode()).digest()[:4], "big")


def hash32(index: str, stream_no: int) -> str:
    """Number in ``0 .. 2^32 - 1`` that looks random but depends on index and stream only.

    One multiplication modulo a prime, one shift-and-multiply, one shift: plain
    integer arithmetic, which stays within generated code.
    """
    low = f"(({index}) ^ {stream_no}) % {PRIME} * {LOW}"
    high = f"shiftright({index}, 32) * {HIGH}"
    x = f"(({low} + {high}) % {PRIME})"
    x = f"((({x} ^ shiftright({x}, 16)) * {MIX}) & {MASK32})"
    return f"({x} ^ shiftright({x}, 15))"


def hash63(index: str, stream_no: int) -> str:
    """Like :func:`hash32` with 63 bits."""
    first = hash32(index, stream_no)
    second = hash32(index, stream_no ^ MASK32)
    return f"(shiftright({first}, 1) * {1 << 32} + {second})"


def stride(size: int) -> int:
    """Multiplier without a common divisor with ``size``, near the golden section of it.

    It is kept so low that ``stride * size`` fits a bigint.
    """
    step = max(min(size, (1 << 62) // size) * 618 // 1000, 1)
    while math.gcd(step, size) != 1:
        step -= 1
    return step


def permuted(slot: str, size: int, stream_no: int) -> str:
    """One-to-one map of ``0 .. size - 1`` onto itself: unique values without a shuffle.

    One stride can cross a range whose square fits a bigint.  A wider range is
    divided into blocks: slots go round the blocks, and step within each from a
    start of its own.
    """
    if size <= WIDE:
        return f"((({slot}) * {stride(size)} + {stream_no}) % {size})"
    length = size // BLOCKS
    block = f"(({slot}) % {BLOCKS})"
    start = f"shiftright({hash63(block, stream_no)}, 2)"
    place = f"(({slot}) div {BLOCKS} * {stride(length)} + {start}) % {length}"
    spread = f"{permuted(block, BLOCKS, stream_no)} * {length} + {place}"
    return f"(CASE WHEN ({slot}) < {BLOCKS * length} THEN {spread} ELSE ({slot}) END)"
