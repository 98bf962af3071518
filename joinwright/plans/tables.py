"""Typed tables of any size with an exact number of matches between neighbours.

A table is ``spark.range`` with one native expression per column.  Nothing is
shuffled or stored to make it, and no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col
from ..functions.draws import hash32, hash63, permuted, stream
from ..functions.patterns import Spelling
from ..operators.rows import counted_rows, first_rows, number_rows
from ..sources.files import save_tables
from ..sources.scratch import cut
from ..spec import INTEGRAL, Column, Join, Spec, SpecError, Table, given_table
from .closed import (
    ORDER,
    Field,
    Stretch,
    first_fields,
    joined_fields,
    joined_rows,
    joined_stretches,
    outer_union,
    plain_join,
)
from .continued import continued
from .layout import ROW, Layout, index_rows, select_columns


@dataclass(frozen=True)
class Generated:
    """Generated tables, the joined table after each step, and the expected result."""

    spec: Spec
    tables: dict[str, DataFrame]
    steps: list[DataFrame] = field(default_factory=list)

    @property
    def expected(self) -> DataFrame:
        return self.steps[-1] if self.steps else next(iter(self.tables.values()))

    @property
    def format(self) -> str:
        return "csv" if self.spec.defaults.save_to_csv else "parquet"

    def save(self, folder: str) -> dict[str, str]:
        """Write the tables and the expected result in the format of the spec."""
        return save_tables(self.tables, folder, self.format, self.expected)


def generate_table(
    spark: SparkSession,
    table: Table,
    seed: int = 0,
    partitions: int | None = None,
    start: int = 0,
) -> DataFrame:
    """One table on its own: rows ``start .. size - 1``."""
    table = Spec((table,)).checked().tables[0]
    layout = Layout([table], [], seed)
    rows = index_rows(spark, start, table.size, partitions)
    return select_columns(rows, layout.columns(0, ROW)).drop(ROW)


# ------------------------------------------------------------------ chain


def generate(
    spark: SparkSession,
    spec: Spec | Mapping[str, Any],
    seed: int = 0,
    partitions: int | None = None,
    given: Mapping[str, DataFrame] | None = None,
) -> Generated:
    """Generate the tables of a spec and the result its joins are expected to give.

    Everything is lazy while no join has a filter.  After a filter the next table
    copies rows that survived it; which ones these are is found by reading the rows that
    are left, and they are kept in the shared folder.  A spec that cannot be
    met raises :class:`SpecError` before any job, but for a filter that leaves
    too few rows, which raises when it has run.

    ``given`` has the rows of tables that exist already: the first ones of the chain, of
    which the spec needs to name no size and no columns.  The next table's join has its matches
    with the rows that the given tables join to, see :mod:`joinwright.plans.continued`.

    The expected result is not had from the joins of this library: it is known in closed
    form (:mod:`joinwright.plans.closed`), or, beside given tables, by Spark's join.
    """
    given = dict(given or {})
    if isinstance(spec, Mapping):
        spec = Spec.from_dict(spec, given)
    else:
        spec = spec.with_given(given).checked()
    if given:
        return _generate_after(spark, spec, given, seed, partitions)
    layout = Layout(spec.tables, spec.joins, seed)
    chain = _Closed(spark, spec, layout, partitions)
    tables = {spec.tables[0].name: chain.table(0)}
    steps: list[DataFrame] = []
    for t, join in enumerate(spec.joins, start=1):
        tables[spec.tables[t].name] = chain.join(t, join)
        steps.append(chain.frame().drop(ORDER))
    return Generated(spec, tables, steps)


class _Closed:
    """The joined table so far, without a join; see :mod:`joinwright.plans.closed`."""

    def __init__(self, spark, spec: Spec, layout: Layout, partitions: int | None):
        self.spark, self.tables, self.layout, self.partitions = spark, spec.tables, layout, partitions
        first = self.tables[0]
        self.fields = first_fields(first.name, first.names)
        self.stretches = [Stretch(0, first.size, frozenset({0}), ROW)]
        self.rows: DataFrame | None = None  # what a filter has left, from then on

    def _index(self, start: int, stop: int) -> DataFrame:
        return index_rows(self.spark, start, stop, self.partitions)

    def table(self, t: int) -> DataFrame:
        rows = self._index(0, self.tables[t].size)
        return select_columns(rows, self.layout.columns(t, ROW)).drop(ROW)

    def frame(self) -> DataFrame:
        if self.rows is not None:
            return self.rows
        nothing = Stretch(0, 0, frozenset(range(len(self.tables))), ROW)
        return outer_union([self._rows_of(s) for s in self.stretches or [nothing]])

    def _rows_of(self, s: Stretch) -> DataFrame:
        columns: dict[str, str | Spelling] = {}
        for f in self.fields:
            there = [(t, c) for t, c in f.sources if t in s.there]
            t, c = (there or f.sources)[0]
            column = self.tables[t].column(c)
            if there:
                made = self.layout.columns(t, ROW)[c]
                columns[f.name] = made.renamed(f"{t} ") if isinstance(made, Spelling) else made
            else:
                columns[f.name] = f"CAST(NULL AS {column.dtype.simpleString()})"
        columns[ORDER] = s.order
        return select_columns(self._index(s.start, s.stop), columns).drop(ROW)

    def join(self, t: int, join: Join) -> DataFrame:
        """Join the next table; returns the table."""
        table, keys = self.tables[t], (join.left_key, join.right_key)
        source = next(f for f in self.fields if f.name == join.left_key)
        before = self.fields
        self.fields = joined_fields(before, t, table.name, table.names, keys)
        if self.rows is None:
            made = self.table(t)
            self.stretches = joined_stretches(
                self.stretches, frozenset(n for n, _ in source.sources), t, table.size,
                join.matches, join.how, ROW,
            )
        else:
            made = self._join_rows(t, join, before)
        if join.where is not None:
            self.rows = self.frame().filter(F.expr(join.where))
        return made

    def _join_rows(self, t: int, join: Join, before: Sequence[Field]) -> DataFrame:
        """A table whose first rows copy the first rows that are left of the chain."""
        table, columns = self.tables[t], self.layout.columns(t, ROW)
        copied = self._first_left(t, join.matches)
        matched = number_rows(self.rows.filter(copied), ORDER, ROW)
        shared = self.layout.shared[t]
        copies = {n: _copy(table.column(n), source) for n, source in shared.items()}
        head = {**columns, **(copies if join.matches else {})}
        tail = self._index(join.matches, table.size)
        made = select_columns(matched, head).unionByName(select_columns(tail, columns))

        old = {f.name: b.name for f, b in zip(self.fields, before)}
        own = {f.name: c for f in self.fields for n, c in f.sources if n == t}
        both = {f.name: f"`{old[f.name]}`" if f.name in old else head[own[f.name]] for f in self.fields}
        orders = {"inner": ORDER, "left": ORDER, "right": ROW, "full": f"({ORDER} * 2)"}
        order = orders[join.how]
        alone = {n: f"`{b}`" for n, b in old.items()} | {ORDER: order.replace(ROW, "0L")}
        place = f"({ROW} * 2 + 1)" if join.how == "full" else ROW
        self.rows = joined_rows(
            select_columns(matched, {**both, ORDER: order}),
            self.rows.filter(~copied).selectExpr(*[f"{e} AS `{n}`" for n, e in alone.items()]),
            select_columns(tail, {**{n: columns[c] for n, c in own.items()}, ORDER: place}),
            join.how,
            [*[f.name for f in self.fields], ORDER],
        )
        return made.drop(ROW)

    def _first_left(self, t: int, matches: int) -> SparkColumn:
        """Whether a row that is left is one of the first that fit table ``t``."""
        if not matches:
            return F.lit(False)
        fits = F.lit(True)
        for source, allowed in self.layout.allowed(t).items():
            fits = fits & allowed & col(source).isNotNull()
        fits = F.coalesce(fits, F.lit(False))
        try:
            first = first_rows(cut(self.rows.filter(fits).select(ORDER)), ORDER, matches)
        except ValueError as e:
            name = self.tables[t].name
            raise SpecError(f"{name}: the filter leaves too few rows: {e}") from None
        return fits & (F.col(ORDER) <= first.agg(F.max(ORDER)).first()[0])


def _copy(column: Column, source: str) -> str:
    return f"CAST(`{source}` AS {column.dtype.simpleString()})"


def _generate_after(
    spark, spec: Spec, given: Mapping[str, DataFrame], seed: int, partitions: int | None
) -> Generated:
    """Tables that go with given ones: each with what the tables before it join to."""
    tables: dict[str, DataFrame] = {}
    steps: list[DataFrame] = []
    rows, fields, first_key = None, [], None
    for t, table in enumerate(spec.tables):
        join = spec.joins[t - 1] if t else None
        if table.given:
            frame = given[table.name]
        else:
            if join.left_key not in rows.columns:
                raise SpecError(f"{join.left_key!r} is not one column of the joined table")
            first_key = first_key or join.left_key
            shared = {c: c for c in table.names if c in rows.columns} | {join.right_key: join.left_key}
            order = first_key if first_key in rows.columns else join.left_key
            keys = (join.left_key, join.right_key)
            frame = continued(rows, table, join.matches, keys, shared, [order], seed, partitions)
        tables[table.name] = frame
        if rows is None:
            rows, fields = frame, first_fields(table.name, frame.columns)
            continue
        fields = joined_fields(fields, t, table.name, frame.columns, (join.left_key, join.right_key))
        rows = plain_join(rows, frame, join, fields, t)
        rows = rows if join.where is None else rows.filter(F.expr(join.where))
        steps.append(rows)
    return Generated(spec, tables, steps)


def correlated_pair(
    spark: SparkSession,
    left: Table | DataFrame,
    right: Table,
    matches: int,
    key: str,
    seed: int = 0,
    partitions: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Two tables whose join on the key has ``matches`` rows, which agree on all columns both have.

    The left table may be given; the rows it matches are then the first in the order of the key.
    """
    given = {}
    if isinstance(left, DataFrame):
        given = {"left": left}
        left = given_table("left", left.schema)
    spec = Spec((left, right), (Join(key, key, "inner", matches),))
    tables = generate(spark, spec, seed, partitions, given).tables
    return tables[left.name], tables[right.name]


def add_columns(
    df: DataFrame,
    order: str | Sequence[str],
    columns: Sequence[Column],
    seed: int = 0,
    lists: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """The rows of a table with drawn columns added.

    The rows are numbered in the order of some of their columns, and a row's values
    depend on its number, the column and the seed.  Columns that may not repeat
    differ on all rows.

    ``lists`` gives the value list of a column as a frame of one column, of any length: its
    different values but null are numbered in their order, and joined on the drawn place.  Too few
    values for a column that may not repeat raise :class:`SpecError`, and so does an empty list.
    """
    lists = lists or {}
    numbered, rows = counted_rows(df, order, ROW)
    clash = {c.name for c in columns} & set(df.columns)
    if clash:
        raise SpecError(f"the table has the columns {sorted(clash)} already")
    inline = tuple(c for c in columns if c.name not in lists)
    table = Spec((Table("made", rows, inline),)).checked().tables[0]
    made = {c: f"`{c}`" for c in df.columns}
    for n, c in enumerate(c for c in columns if c.name in lists):
        values = lists[c.name].toDF("value").filter("value IS NOT NULL").distinct()
        listed, found = counted_rows(values, "value", "place")
        if not found or not c.repeatable and found < rows:
            raise SpecError(f"made.{c.name}: {rows} rows need more than the {found} listed values")
        number = stream(seed, f"made.{c.name}")
        draw = hash32(ROW, number) if found <= 1 << 20 else hash63(ROW, number)
        place = f"{draw} % {found}" if c.repeatable else permuted(ROW, found, number)
        listed = listed.toDF(f"__value_of_{n}", f"__place_of_{n}")
        numbered = numbered.withColumn(f"__at_of_{n}", F.expr(place)).join(
            listed, F.col(f"__at_of_{n}") == F.col(f"__place_of_{n}")
        )
        made[c.name] = f"CAST(`__value_of_{n}` AS {c.dtype.simpleString()})"
    made |= Layout([table], [], seed).columns(0, ROW)
    order_of = [*df.columns, *[c.name for c in columns]]
    return select_columns(numbered, {c: made[c] for c in order_of}).drop(ROW)


def next_table(
    base: DataFrame,
    order: str,
    table: Table,
    matches: int,
    seed: int = 0,
    partitions: int | None = None,
    key: str | None = None,
) -> DataFrame:
    """A table that goes with an existing one: its join on ``key`` has ``matches`` rows.

    ``key`` is a column both have, of any type, by default the first whole number or date, else
    the first.  Rows of the new table copy every column both have from the rows of ``base`` whose
    shared values are not null and within the bounds and lists of the new table's columns.  A key
    that several rows have is copied once and matches all of them: keys of few rows come
    first, and of these the first in the order of a column; if no choice of keys
    has exactly as many rows, ``SpecError`` is raised.

    In the other rows whole numbers and dates that both have lie above the largest in
    ``base``; a key of another type has values that ``base`` does not.  They match nothing, and
    the rest is drawn.  ``base`` is read once.
    """
    shared = [c for c in table.names if c in base.columns]
    if not shared:
        raise SpecError(f"{table.name!r} has no column in common with the other table")
    if not 0 <= matches:
        raise SpecError(f"{matches} matches do not fit {table.name!r}")
    table = Spec((table,)).checked().tables[0]
    countable = [c for c in shared if isinstance(table.column(c).dtype, (*INTEGRAL, T.DateType))]
    key = key or (countable or shared)[0]
    if key not in shared:
        raise SpecError(f"{key!r} is not a column of both tables")
    try:
        return continued(
            base, table, matches, (key, key), {c: c for c in shared}, [order], seed, partitions,
            only_above=True,
        )
    except SpecError as e:
        raise SpecError(f"{table.name}: {e}") from None
