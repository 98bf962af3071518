"""Which values each generated row gets in a column that several tables share.

All values a chain's tables may use in one column form a pool.  Every pool is cut
into cells: stretches of values that the same tables may use.  Rows that have to
match get the same slots of a cell, all other rows get slots of their own, so the
number of matches between two tables is exact.  This is bookkeeping over table
sizes and bounds on the driver; it does not grow with the number of rows.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..functions.draws import array_of, literal, permuted
from ..functions.patterns import Spelling, unique_room, unique_string
from ..sources.scratch import cut
from ..spec import Column, SpecError

# Points a range of doubles is divided into at most.
GRID = 1 << 31
EPOCH = dt.date(1970, 1, 1)


# Longer value lists are joined as a table of (place, value), not written into the plan; a row
# gets the same value either way.
INLINE = 1000


@dataclass(frozen=True)
class Listed:
    """A value of a long list by its place, which is SQL over the row number."""

    place: str
    values: tuple[Any, ...]
    dtype: T.DataType

    def table(self, spark) -> DataFrame:
        """``place, value`` of the list, written once."""
        schema = T.StructType(
            [T.StructField("place", T.LongType()), T.StructField("value", self.dtype)]
        )
        return cut(spark.createDataFrame(list(enumerate(self.values)), schema))


# What gives a column over the row number: SQL, or more than that.
Expression = str | Spelling | Listed


@dataclass(frozen=True)
class Member:
    """A table in a pool: its column, its size, and its rows that copy the table before.

    Row ``i < copied`` has the value of row ``i`` of the pool's first table.
    """

    table: str
    column: Column
    size: int
    copied: int = 0


@dataclass
class Cell:
    """Values that exactly the tables in ``members`` may use."""

    members: frozenset[int]
    room: int
    lo: Any = None
    hi: Any = None
    values: tuple[Any, ...] | None = None
    used: int = 0

    @property
    def free(self) -> int:
        return self.room - self.used

    def value(self, slot: str, dtype: T.DataType, stream_no: int) -> str:
        """The slot's value as SQL; no two slots of a pool have the same."""
        place = permuted(slot, self.room, stream_no)
        if self.values is not None:
            return f"element_at({array_of(self.values)}, CAST({place} + 1 AS INT))"
        lo = literal(self.lo)
        if isinstance(dtype, T.DoubleType):
            width = literal(float(self.hi) - float(self.lo))
            return f"({literal(float(self.lo))} + {width} * (({place} + 0.5D) / {self.room}D))"
        if isinstance(dtype, T.DateType):
            return f"date_from_unix_date(CAST({place} + {lo} AS INT))"
        return f"CAST({place} + {lo} AS {dtype.simpleString()})"


@dataclass(frozen=True)
class Piece:
    """Rows ``start .. stop - 1`` of a table get the slots of a cell from ``slot`` on."""

    start: int
    stop: int
    cell: Cell
    slot: int


@dataclass
class Pool:
    """A column of one or more tables, and the value of each of their rows."""

    members: list[Member]
    stream_no: int
    pieces: list[list[Piece]] = field(default_factory=list)

    def allot(self) -> Pool:
        """Give every row its slot; raises :class:`SpecError` if there are too few."""
        cells = _cells(self.members)
        stretches = self._stretches()
        needs = [(frozenset(sharing), stop - start) for start, stop, sharing in stretches]
        self.pieces = [[] for _ in self.members]
        for (start, _, sharing), parts in zip(stretches, self._shares(cells, needs)):
            for cell, slot, count in parts:
                for m in sharing:
                    self.pieces[m].append(Piece(start, start + count, cell, slot))
                start += count
        self.pieces = [_merged(p) for p in self.pieces]
        return self

    def _shares(self, cells: list[Cell], needs: list[Need]) -> list[list[Share]]:
        in_a_row = all(c.lo is not None and c.values is None for c in cells)
        whole = not isinstance(self.members[0].column.dtype, T.DoubleType)
        given, missing = (_sweep if in_a_row and whole else _least_shared)(cells, needs)
        for (sharing, _), count in zip(needs, missing):
            if count:
                raise SpecError(
                    f"{self._label(sharing)}: {count} more values are needed than there are"
                )
        return given

    def _label(self, sharing: frozenset[int]) -> str:
        return " and ".join(
            f"{self.members[m].table}.{self.members[m].column.name}" for m in sorted(sharing)
        )

    def _stretches(self) -> list[tuple[int, int, list[int]]]:
        """Row ranges, and the tables whose rows in it have the same value.

        Copied counts do not rise along the chain, so the rows all tables share
        come first, then those that all but the last share, and so on.
        """
        out = []
        start = 0
        for m in range(len(self.members) - 1, 0, -1):
            stop = self.members[m].copied
            if stop > start:
                out.append((start, stop, list(range(m + 1))))
                start = stop
        for m, member in enumerate(self.members):
            first = start if m == 0 else member.copied
            if member.size > first:
                out.append((first, member.size, [m]))
        return out

    def column(self, member: int, index: str) -> Expression:
        """The column of one table as SQL over its row index."""
        column = self.members[member].column
        pieces = self.pieces[member]
        if len(pieces) == 1 and len(pieces[0].cell.values or ()) > INLINE:
            piece, cell = pieces[0], pieces[0].cell
            slot = f"{index} + {literal(piece.slot - piece.start)}"
            return Listed(permuted(slot, cell.room, self.stream_no), cell.values, column.dtype)
        if not pieces:
            return f"CAST(NULL AS {column.dtype.simpleString()})"
        slots = [f"{index} + {literal(p.slot - p.start)}" for p in pieces]
        stops = [p.stop for p in pieces]
        if column.pattern is not None:
            slot, used = by_row(index, stops, slots), pieces[0].cell.used
            return unique_string(
                column.name, slot, used, column.pattern, column.letters, self.stream_no
            )
        values = [
            p.cell.value(slot, column.dtype, self.stream_no) for p, slot in zip(pieces, slots)
        ]
        return by_row(index, stops, values)


def by_row(index: str, stops: Sequence[int], values: Sequence[str]) -> str:
    """The value for the stretch of rows that the index lies in."""
    if len(values) == 1:
        return values[0]
    cases = [f"WHEN {index} < {stop} THEN {v}" for stop, v in zip(stops, values[:-1])]
    return f"(CASE {' '.join(cases)} ELSE {values[-1]} END)"


def _merged(pieces: list[Piece]) -> list[Piece]:
    """Join neighbours that continue in the same cell."""
    out: list[Piece] = []
    for p in sorted(pieces, key=lambda p: p.start):
        last = out[-1] if out else None
        if last and last.cell is p.cell and last.stop == p.start and (
            last.slot - last.start == p.slot - p.start
        ):
            out[-1] = Piece(last.start, p.stop, p.cell, last.slot)
        else:
            out.append(p)
    return out


# Tables that share a stretch of rows, and how many values these need.
Need = tuple[frozenset[int], int]
# Cell, first slot and number of slots.
Share = tuple[Cell, int, int]


def _take(cell: Cell, count: int, to: list[Share]) -> int:
    """Hand out up to so many slots of a cell; returns how many are still missing."""
    part = min(cell.free, count)
    if part:
        to.append((cell, cell.used, part))
        cell.used += part
    return count - part


def _sweep(cells: list[Cell], needs: list[Need]) -> tuple[list[list[Share]], list[int]]:
    """Division of whole-number ranges: from the lowest cell up, each goes to those
    whose range ends first.  It meets every set of needs that can be met."""
    given: list[list[Share]] = [[] for _ in needs]
    missing = [count for _, count in needs]
    ends = [
        max((c.hi for c in cells if sharing <= c.members), default=0) for sharing, _ in needs
    ]
    for cell in sorted(cells, key=lambda c: c.lo):
        may = [n for n, (sharing, _) in enumerate(needs) if sharing <= cell.members]
        for n in sorted(may, key=ends.__getitem__):
            missing[n] = _take(cell, missing[n], given[n])
    return given, missing


def _least_shared(cells: list[Cell], needs: list[Need]) -> tuple[list[list[Share]], list[int]]:
    """Division of any values: those that few tables may use are given out first."""
    given: list[list[Share]] = [[] for _ in needs]
    missing = [count for _, count in needs]
    for n, (sharing, _) in enumerate(needs):
        usable = [c for c in cells if sharing <= c.members]
        for cell in sorted(usable, key=lambda c: (len(c.members), -c.free)):
            missing[n] = _take(cell, missing[n], given[n])
    return given, missing


def _number(value: Any) -> Any:
    return (value - EPOCH).days if isinstance(value, dt.date) else value


def _cells(members: Sequence[Member]) -> list[Cell]:
    columns = [m.column for m in members]
    dtype = columns[0].dtype
    everyone = frozenset(range(len(columns)))
    if all(c.pattern is not None for c in columns):
        if len({(c.pattern, c.letters) for c in columns}) > 1:
            raise SpecError(f"{columns[0].name}: tables that share it need one pattern")
        return [Cell(everyone, unique_room(columns[0].pattern, columns[0].letters))]
    if any(c.pattern is not None for c in columns):
        raise SpecError(f"{columns[0].name}: a pattern and a value list have nothing in common")
    lists = [tuple(dict.fromkeys(c.values)) if c.values is not None else None for c in columns]
    cells = _list_cells(columns, lists)
    if any(c.bounds is not None for c in columns):
        cells += _range_cells(columns, lists, dtype)
    return cells


def _list_cells(columns, lists) -> list[Cell]:
    """Listed values, grouped by the tables that may use them."""
    groups: dict[frozenset[int], list[Any]] = {}
    listed = [set(values) if values is not None else None for values in lists]
    for value in dict.fromkeys(v for values in lists if values for v in values):
        may = frozenset(
            m
            for m, c in enumerate(columns)
            if (value in listed[m] if listed[m] is not None else c.bounds[0] <= value <= c.bounds[1])
        )
        groups.setdefault(may, []).append(value)
    return [Cell(may, len(values), values=tuple(values)) for may, values in groups.items()]


def total_room(column: Column) -> int:
    """Number of values that a column's rows may have without repeating one."""
    return sum(c.room for c in _cells([Member("", column, 0)]))


def double_room(lo: float, hi: float) -> int:
    """Different doubles that a stretch gives: no two places of its grid round to one."""
    finest = 2 * math.ulp(max(abs(float(lo)), abs(float(hi))))
    return min(GRID, int((float(hi) - float(lo)) / finest))


def _range_cells(columns, lists, dtype: T.DataType) -> list[Cell]:
    """What the ranges leave between their ends and the listed values."""
    whole = not isinstance(dtype, T.DoubleType)
    ranges = {
        m: tuple(_number(b) for b in c.bounds)
        for m, c in enumerate(columns)
        if c.bounds is not None
    }
    points = {_number(v) for values in lists if values for v in values}
    # Whole numbers: half-open stretches.  Doubles: stretches without their ends.
    cuts = sorted(
        {lo for lo, _ in ranges.values()}
        | {hi + whole for _, hi in ranges.values()}
        | points
        | ({p + 1 for p in points} if whole else set())
    )
    cells = []
    for lo, hi in zip(cuts, cuts[1:]):
        if whole and lo in points:
            continue
        may = frozenset(m for m, (a, b) in ranges.items() if a <= lo and hi <= b + whole)
        if may:
            room = hi - lo if whole else double_room(lo, hi)
            if room:
                cells.append(Cell(may, room, lo, hi))
    if not whole:
        # The ends themselves; two ranges may have nothing else in common.
        for end in sorted({end for bounds in ranges.values() for end in bounds} - points):
            may = frozenset(m for m, (a, b) in ranges.items() if a <= end <= b)
            cells.append(Cell(may, 1, values=(float(end),)))
    return cells
