"""What a chain of generated tables joins to, in closed form.

Generated tables match by row number: row ``i`` of a table goes with row ``i`` of the table
its key comes from, for as many rows as there are matches, and with no other.  So the joined
table is known without joining: it is a few stretches of row numbers, in each of which
some of the tables have their row and the others are null.  A filter may leave any of
these rows; the next table then copies the first that are left, and the joined rows are
these, the other ones that are left, and the table's other rows.

Nothing here uses the joins of this library, so an error in them shows as a difference
between a job's result and this one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col
from ..spec import Join

ORDER = "_order"


@dataclass(frozen=True)
class Field:
    """A column of the joined table: its name, the table it first came from, and whose
    columns (table number, column) fill it; of these the first that is there."""

    name: str
    owner: str
    sources: tuple[tuple[int, str], ...]


def first_fields(name: str, columns: Sequence[str]) -> list[Field]:
    return [Field(c, name, ((0, c),)) for c in columns]


def joined_fields(
    fields: Sequence[Field], t: int, name: str, columns: Sequence[str], keys: tuple[str, str]
) -> list[Field]:
    """Columns after the join with table ``t``.

    A key of one name is one column.  Any other name both sides have becomes
    ``<table>.<column>`` on either.
    """
    key = keys[0] if keys[0] == keys[1] else None
    clashes = {f.name for f in fields} & set(columns) - {key}
    out = []
    for f in fields:
        if f.name == key:
            f = replace(f, sources=(*f.sources, (t, f.name)))
        elif f.name in clashes:
            f = replace(f, name=f"{f.owner}.{f.name}")
        out.append(f)
    for c in columns:
        if c != key:
            out.append(Field(f"{name}.{c}" if c in clashes else c, name, ((t, c),)))
    return out


@dataclass(frozen=True)
class Stretch:
    """Joined rows of the row numbers ``start .. stop - 1``.

    The tables in ``there`` have the row of that number; ``order`` is SQL over it.
    """

    start: int
    stop: int
    there: frozenset[int]
    order: str

    def part(self, start: int, stop: int, **changes) -> list[Stretch]:
        start, stop = max(start, self.start), min(stop, self.stop)
        return [replace(self, start=start, stop=stop, **changes)] if start < stop else []


def joined_stretches(
    stretches: Sequence[Stretch],
    sources: frozenset[int],
    t: int,
    size: int,
    matches: int,
    how: str,
    row: str,
) -> list[Stretch]:
    """Join with table ``t``, whose first ``matches`` rows go with those of the same number
    of the tables that have its key.  ``row`` is SQL for the row number.
    """
    orders = {"inner": "{0}", "left": "{0}", "right": row, "full": "({0} * 2)"}
    out, covered = [], []
    for s in stretches:
        order = orders[how].format(s.order)
        matched = s.part(0, matches, there=s.there | {t}, order=order) if sources & s.there else []
        out += matched
        covered += [(m.start, m.stop) for m in matched]
        if how in ("left", "full"):
            out += s.part(matched[0].stop if matched else s.start, s.stop, order=order)
    if how in ("right", "full"):
        alone = row if how == "right" else f"({row} * 2 + 1)"
        at = 0
        for start, stop in [*sorted(covered), (size, size)]:
            if at < start:
                out.append(Stretch(at, start, frozenset({t}), alone))
            at = max(at, stop)
    return out


def outer_union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def padded(rows: DataFrame, like: DataFrame, names: Sequence[str]) -> DataFrame:
    """The rows with nulls, of the types of ``like``, for the names that they lack."""
    types = {f.name: f.dataType for f in like.schema}
    return rows.select(
        *[col(c) if c in rows.columns else F.lit(None).cast(types[c]).alias(c) for c in names]
    )


def joined_rows(
    matched: DataFrame, left: DataFrame, right: DataFrame, how: str, names: Sequence[str]
) -> DataFrame:
    """Result of a join from its parts: the matched rows, and those of either side alone.

    All have the order column; its values are those of the side that is kept whole.
    """
    frames = [matched]
    if how in ("left", "full"):
        frames.append(padded(left, matched, names))
    if how in ("right", "full"):
        frames.append(padded(right, matched, names))
    return outer_union([f.select(*[col(c) for c in names]) for f in frames])


def plain_join(left: DataFrame, right: DataFrame, join: Join, fields: Sequence[Field], t: int) -> DataFrame:
    """Spark's own join of the rows so far with a table, where one of them is given.

    ``left`` has the columns of the fields before, ``right`` those of table ``t``.
    """
    mine = {c: f"right {c}" for c in right.columns}
    joined = left.join(
        right.withColumnsRenamed(mine), col(join.left_key) == col(mine[join.right_key]), join.how
    )
    out = []
    for f, before in zip(fields, [*left.columns, *[None] * len(fields)]):
        own = [mine[c] for n, c in f.sources if n == t]
        if before is not None:
            own = [before, *own]
        out.append(F.coalesce(*[col(c) for c in own]).alias(f.name))
    return joined.select(out)
