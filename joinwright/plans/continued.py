"""Tables that go with existing ones, whose values are found in the data.

The existing rows are read once, and reduced to their keys: how many rows have each, and
what the first of them holds.  All that follows reads this table of keys.

* A new row copies a key and matches as many rows as have it, so keys are chosen whose
  numbers of rows add up to the matches asked for.
* Every other row needs a key that no existing row has.  Values are drawn without
  repeating, as for any generated table, and those that exist are left out by an anti
  join; so this works for every type that has an equality.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col
from ..functions.draws import hash63, stream
from ..functions.patterns import Spelling, pattern_regex, unique_room
from ..operators.rows import counted_rows, number_rows
from ..sources.scratch import cut
from ..spec import INTEGRAL, Column, SpecError, Table
from .layout import ROW, Layout, index_rows, select_columns
from .pools import Member, Pool, total_room

#: Most bits of the search for numbers of keys that add up.
SEARCH_BITS = 1 << 28


# ----------------------------------------------------------- which keys to copy


def adds_up(keys: Mapping[int, int], rows: int, most: int) -> dict[int, int] | None:
    """How many keys of each multiplicity to take so that they have ``rows`` rows in all.

    ``keys`` has the number of keys for each number of rows; at most ``most`` keys are
    taken.  Keys of few rows are preferred, and if these are too many, keys of many rows.
    None if there is no such choice.
    """
    multiplicities = sorted(m for m in keys if keys[m] > 0)
    bounds = sorted({1 << n for n in range(max(multiplicities, default=1).bit_length() + 1)})
    for bound in bounds:
        usable = [m for m in multiplicities if m <= bound]
        if sum(m * keys[m] for m in usable) >= rows:
            found = _filled(usable, keys, rows)
            if found is not None and sum(found.values()) <= most:
                return found
    found = _filled(multiplicities[::-1], keys, rows)
    return found if found is not None and sum(found.values()) <= most else None


def _filled(order: Sequence[int], keys: Mapping[int, int], rows: int) -> dict[int, int] | None:
    """Take keys in this order of their multiplicities; then exchange some of them.

    Any choice that adds up can be had from the filling by exchanging no more keys than
    twice the largest multiplicity, and one; the search tries few exchanges first.
    """
    taken, left = {}, rows
    for m in order:
        taken[m] = min(keys[m], left // m)
        left -= m * taken[m]
    if not left:
        return {m: n for m, n in taken.items() if n}
    for exchanged in (2, 16, 128, 2 * max(order, default=0) + 1):
        fixed = {m: max(0, taken[m] - exchanged) for m in order}
        spare = {m: min(keys[m], taken[m] + exchanged) - fixed[m] for m in order}
        target = rows - sum(m * n for m, n in fixed.items())
        if target * max(1, len(order)) > SEARCH_BITS:
            break
        added = _subset(spare, target)
        if added is not None:
            return {m: fixed[m] + added[m] for m in order if fixed[m] + added[m]}
    return None


def _subset(spare: Mapping[int, int], target: int) -> dict[int, int] | None:
    """Numbers of each multiplicity, no more than are spare, that add up to ``target``.

    Bit ``s`` of a number says whether ``s`` rows can be reached.
    """
    mask, reached, trail = (1 << target + 1) - 1, 1, []
    for m, n in spare.items():
        size = 1
        while n:
            size = min(size, n)
            trail.append((m, size, reached))
            reached |= reached << m * size & mask
            n, size = n - size, size * 2
    if not reached >> target & 1:
        return None
    out = dict.fromkeys(spare, 0)
    for m, size, before in reversed(trail):
        if not before >> target & 1:
            out[m] += size
            target -= m * size
    return out


@dataclass(frozen=True)
class Keys:
    """The keys of existing rows: ``key``, ``n`` rows, and ``first``, what is copied from
    the first row that fits (null if none does).  Kept in the shared folder.

    ``fitting`` has the number of keys that fit for each number of rows, ``known`` is the number
    of all keys but null, ``tops`` the largest values of some columns.
    """

    frame: DataFrame
    fitting: dict[int, int]
    known: int
    tops: dict[str, Any]

    @classmethod
    def of(
        cls,
        base: DataFrame,
        key: str,
        order: Sequence[str],
        copies: Sequence[tuple[str, Column]],
        tops: Mapping[str, str],
    ) -> Keys:
        """``copies`` pairs a column of the base with the new table's column that copies it;
        ``tops`` names the base's column for each column whose largest value is asked for."""
        fits = reduce(and_, [_fits(c, col(name)) for name, c in copies])
        row = F.struct(
            *[col(c).alias(f"o{i}") for i, c in enumerate(order)],
            *[col(name).alias(f"c{i}") for i, (name, _) in enumerate(copies)],
        )
        # A null is a group too, for the largest values of its rows; it matches nothing.
        keyed = cut(
            base.groupBy(col(key).alias("key")).agg(
                F.count("*").alias("n"),
                F.min(F.when(fits, row)).alias("first"),
                *[F.max(col(c)).alias(f"top{i}") for i, c in enumerate(tops.values())],
            )
        )
        # One row for each number of rows a key has: no more than the root of twice the rows.
        facts = keyed.groupBy("n").agg(
            F.count_if(F.col("key").isNotNull() & F.col("first").isNotNull()).alias("fitting"),
            F.count("key").alias("known"),
            *[F.max(f"top{i}").alias(f"top{i}") for i in range(len(tops))],
        ).collect()
        largest = {
            c: max((f[f"top{i}"] for f in facts if f[f"top{i}"] is not None), default=None)
            for i, c in enumerate(tops)
        }
        return cls(
            keyed.filter("key IS NOT NULL"),
            {f["n"]: f["fitting"] for f in facts if f["fitting"]},
            sum(f["known"] for f in facts),
            largest,
        )

    def chosen(self, rows: int, most: int, order: int) -> tuple[DataFrame, int]:
        """Keys that have so many rows in all, numbered from 0, and how many they are.

        Of the keys of one multiplicity the first are taken in the order of their first rows.
        """
        fitting = self.frame.filter("first IS NOT NULL")
        taken = adds_up(self.fitting, rows, most)
        if taken is None:
            raise SpecError(f"{rows} rows are needed, and no choice of keys that fit has as many")
        if not taken:
            return fitting.limit(0).withColumn(ROW, F.lit(0).cast("bigint")), 0
        places, start, row = [], 0, 0
        for m in sorted(taken):
            places.append((m, start, taken[m], row))
            start, row = start + self.fitting[m], row + taken[m]
        spark = self.frame.sparkSession
        places = spark.createDataFrame(places, "n bigint, start bigint, taken bigint, row bigint")
        by = [F.col(f"first.o{i}").alias(f"by{i}") for i in range(order)]
        used = fitting.join(places, "n", "left_semi").select("n", "first", *by, "key")
        ordered = ["n", *[f"by{i}" for i in range(order)], "key"]
        numbered = number_rows(used, ordered, "place").join(places, "n")
        inside = numbered.filter(F.col("place") - F.col("start") < F.col("taken"))
        number = F.col("row") + F.col("place") - F.col("start")
        return inside.select("first", number.alias(ROW)), row


def _fits(column: Column, value: SparkColumn) -> SparkColumn:
    """Whether a value may be copied into the column."""
    fits = value.isNotNull()
    if column.bounds is not None:
        fits = fits & value.between(*[F.lit(b) for b in column.bounds])
    if column.values is not None:
        fits = fits & value.isin(list(column.values))
    if column.pattern is not None and column.letters is not None:
        fits = fits & value.rlike(pattern_regex(column.pattern, column.letters))
    return fits


# ------------------------------------------------------------ values nothing has


def free_slots(
    spark,
    column: Column,
    taken: DataFrame,
    known: int,
    rows: int,
    stream_no: int,
    partitions: int | None,
    label: str,
) -> tuple[DataFrame, Pool, int]:
    """``slot`` and its number ``i``, of as many values as there are rows, none of which is taken.

    ``taken`` has one column of ``known`` values.  The pool gives the value of a slot.  A column
    that may repeat is content with fewer values, as long as there is one.
    """
    drawn = replace(column, name="value", unique=True, repeatable=False, nullable=False)
    if isinstance(column.dtype, T.BooleanType):
        drawn = replace(drawn, values=column.values or (False, True))
    if drawn.values is not None:
        drawn = replace(drawn, values=tuple(dict.fromkeys(drawn.values)))
    if drawn.pattern is None:
        room = total_room(drawn)
    else:
        room = unique_room(drawn.pattern, drawn.letters)
    wanted = min(rows, room) if column.repeats else rows
    used = taken.select(col(taken.columns[0]).try_cast(column.dtype).alias("value"))
    tries = min(room, wanted + min(known, wanted) + 64)
    while True:
        pool = Pool([Member(label, drawn, tries)], stream_no).allot()
        values = select_columns(
            index_rows(spark, 0, tries, partitions), {"value": pool.column(0, ROW)}
        )
        free = values.join(used, "value", "left_anti").select(F.col(ROW).alias("slot"))
        free, found = counted_rows(free, "slot", "i")
        if found >= wanted or tries == room:
            break
        tries = min(room, 2 * tries)
    if found < wanted and not (column.repeats and found):
        raise SpecError(
            f"{label}.{column.name}: {rows} values are needed that match nothing, there are {found}"
        )
    return free.filter(F.col("i") < wanted), pool, min(found, wanted)


def filler_rows(
    spark,
    table: Table,
    taken: Mapping[str, tuple[DataFrame, int]],
    start: int,
    columns: Mapping[str, str | Spelling],
    seed: int,
    partitions: int | None,
) -> DataFrame:
    """Rows ``start .. size - 1`` whose values of some columns are none of those taken.

    ``columns`` has the expressions of the other columns over the row number.  With the taken
    values goes how many they are.
    """
    rows = table.size - start
    frame, made = None, dict(columns)
    for n, (name, (values, known)) in enumerate(taken.items()):
        column = table.column(name)
        number = stream(seed, f"{table.name}.{name}")
        free, pool, found = free_slots(
            spark, column, values, known, rows, number, partitions, table.name
        )
        free = free.toDF(f"slot {n}", f"i {n}")
        made[name] = pool.column(0, f"`slot {n}`")
        if frame is None and found == rows:
            frame = free.withColumn(ROW, F.col(f"i {n}") + start)
            continue
        if frame is None:
            frame = index_rows(spark, start, table.size, partitions)
        place = f"({ROW} - {start})"
        if found < rows:
            place = f"{hash63(place, number)} % {max(found, 1)}"
        place = F.expr(place).alias(f"at {n}")
        frame = frame.select("*", place).join(free, F.col(f"at {n}") == F.col(f"i {n}"))
    if frame is None:
        frame = index_rows(spark, start, table.size, partitions)
    return select_columns(frame, {c: made[c] for c in table.names})


# ------------------------------------------------------------------- the table


def continued(
    base: DataFrame,
    table: Table,
    matches: int,
    key: tuple[str, str],
    shared: Mapping[str, str],
    order: Sequence[str],
    seed: int,
    partitions: int | None = None,
    only_above: bool = False,
) -> DataFrame:
    """A table whose join with ``base`` on ``key`` (column of the base, of the table) has
    ``matches`` rows.

    ``shared`` names the base's column that each shared column copies.  In the other rows, shared
    whole numbers and dates lie above the base's largest; where there are too few of these,
    they are values that the base does not have, or :class:`SpecError` is raised with
    ``only_above``.  A key of another type has values that no base row has.  A key of a type with
    few values, or one that may repeat, may be the same in several of the other rows.
    """
    spark = base.sparkSession
    copies = [(source, table.column(c)) for c, source in shared.items()]
    counted = (*INTEGRAL, T.DateType)
    countable = {
        c: source
        for c, source in shared.items()
        if isinstance(table.column(c).dtype, counted) and table.column(c).bounds is not None
    }
    keys = Keys.of(base, key[0], order, copies, countable)
    head, copied = keys.chosen(matches, table.size, len(order))

    def expressions(columns: Sequence[Column], size: int, index: str) -> dict[str, str | Spelling]:
        return Layout([Table(table.name, size, tuple(columns))], [], seed).columns(0, index)

    own = [c for c in table.columns if c.name not in shared]
    alike = {
        c: f"CAST(first.c{i} AS {table.column(c).dtype.simpleString()})" for i, c in enumerate(shared)
    }
    head = select_columns(head, {**expressions(own, table.size, ROW), **alike})

    size, index = table.size - copied, f"({ROW} - {copied})"
    taken, drawn = {}, []
    for c in (table.column(c) for c in shared):
        above = above_top(c, keys.tops[c.name]) if c.name in countable else None
        if above is not None and (c.repeats or _room(above) >= size):
            drawn.append(above)
        elif c.name in countable and only_above:
            values = _room(above) if above is not None else 0
            raise SpecError(f"{c.name}: {values} values above {keys.tops[c.name]} for {size} rows")
        elif c.name == key[1]:
            taken[c.name] = keys.frame.select("key"), keys.known
        elif c.repeats or c.pattern is not None:
            drawn.append(c)
        else:
            taken[c.name] = head.select(col(c.name)), copied
    rest = expressions(own, table.size, ROW) | expressions(drawn, size, index)
    tail = filler_rows(spark, table, taken, copied, rest, seed, partitions)
    names = [col(c) for c in table.names]
    return head.select(names).unionByName(tail.select(names))


def _room(column: Column) -> int:
    lo, hi = column.bounds
    return ((hi - lo).days if isinstance(hi, dt.date) else hi - lo) + 1


def above_top(column: Column, top: Any) -> Column | None:
    """The column with bounds above a value, None if there is no such value."""
    lo, hi = column.bounds
    if top is not None:
        top = top.date() if isinstance(top, dt.datetime) else top
        lo = max(lo, top + (dt.timedelta(days=1) if isinstance(top, dt.date) else 1))
    return replace(column, bounds=(lo, hi)) if lo <= hi else None
