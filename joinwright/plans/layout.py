"""Which expression gives each column of generated tables over the row number."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col
from ..functions.draws import array_of, hash32, hash63, literal, stream
from ..functions.patterns import Spelling, drawn_string
from ..spec import Column, Join, SpecError, Table
from .pools import INLINE, Expression, Listed, Member, Pool, by_row

ROW = "_rid"
# Rows one task makes, where the number of partitions is not given.
ROWS_PER_TASK = 4_000_000


# ---------------------------------------------------------------- columns


def drawn_column(
    column: Column, index: str, stream_no: int, inline: bool = False
) -> Expression:
    """Values that may repeat: drawn for each index from bounds, a pattern or a list.

    With ``inline`` a list of any length is written out.
    """
    dtype = column.dtype
    draw = hash32(index, stream_no)
    if column.values is not None:
        if len(column.values) > INLINE and not inline:
            return Listed(f"{draw} % {len(column.values)}", column.values, dtype)
        place = f"CAST({draw} % {len(column.values)} + 1 AS INT)"
        return f"CAST(element_at({array_of(column.values)}, {place}) AS {dtype.simpleString()})"
    if isinstance(dtype, T.BooleanType):
        return f"({draw} % 2 = 1)"
    if column.pattern is not None:
        return drawn_string(column.name, index, column.pattern, column.letters, stream_no)
    lo, hi = column.bounds
    if isinstance(dtype, T.DoubleType):
        width = literal(float(hi) - float(lo))
        return f"({literal(float(lo))} + {width} * ({draw} / {float(1 << 32)}D))"
    if isinstance(dtype, T.DateType):
        return f"date_add({literal(lo)}, CAST({draw} % {(hi - lo).days + 1} AS INT))"
    room = hi - lo + 1
    if room > 1 << 20:  # else the remainder of a short draw would favour some values
        draw = hash63(index, stream_no)
    return f"CAST({draw} % {room} + {literal(lo)} AS {dtype.simpleString()})"


def select_columns(rows: DataFrame, columns: Mapping[str, Expression]) -> DataFrame:
    """Two projections: the numbers strings are spelled from, then the columns.

    Values of long lists are joined as a table, on their places.
    """
    numbers: dict[str, str] = {}
    values = []
    for n, (name, column) in enumerate(columns.items()):
        if isinstance(column, Listed):
            at, place, value = f"__at_{n}", f"__place_{n}", f"__value_{n}"
            listed = column.table(rows.sparkSession).toDF(place, value)
            rows = rows.withColumn(at, F.expr(column.place))
            rows = rows.join(listed, F.col(at) == F.col(place))
            column = f"`{value}`"
        elif isinstance(column, Spelling):
            numbers.update(column.numbers)
            # Never null, and said so: else a join on it would spell it once more to filter.
            column = f"coalesce({column.text}, '')"
        values.append(f"{column} AS `{name}`")
    if numbers:
        rows = rows.selectExpr("*", *[f"{n} AS {c}" for c, n in numbers.items()])
    return rows.selectExpr(ROW, *values)


def index_rows(spark: SparkSession, start: int, stop: int, partitions: int | None) -> DataFrame:
    rows = max(stop - start, 0)
    if partitions is None:
        partitions = max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK))
    return spark.range(start, start + rows, 1, partitions).withColumnRenamed("id", ROW)


# ----------------------------------------------------------------- layout


class Layout:
    """The columns of a chain's tables as expressions of their row index.

    Two neighbours agree, in their first rows, on every column name both have;
    a name that clashed in an earlier join no longer names one column, and is
    not shared with later tables.
    """

    def __init__(self, tables: Sequence[Table], joins: Sequence[Join], seed: int):
        self.tables = list(tables)
        self.joins = list(joins)
        self.seed = seed
        self.pools: list[list[Member]] = []
        # (table, column) -> (pool, place in the pool)
        self.places: dict[tuple[int, str], tuple[int, int]] = {}
        self.shared: list[dict[str, str]] = []
        self._connect()
        self.allotted = {
            p: Pool(members, self._pool_stream(members)).allot()
            for p, members in enumerate(self.pools)
            if not any(m.column.repeats for m in members) and not self._only_drawn(members)
        }

    def _pool_stream(self, members: list[Member]) -> int:
        return stream(self.seed, f"{members[0].table}.{members[0].column.name}")

    @staticmethod
    def _only_drawn(members: list[Member]) -> bool:
        """A string of one table need not be unique, it is drawn."""
        return len(members) == 1 and members[0].column.pattern is not None

    def _connect(self) -> None:
        live: dict[str, tuple[int, str]] = {}
        for t, table in enumerate(self.tables):
            join = self.joins[t - 1] if t else None
            shared: dict[str, str] = {}
            if join is not None:
                shared = {c: c for c in table.names if c in live}
                if join.left_key not in live:
                    raise SpecError(f"{join.left_key!r} is not one column of the joined table")
                shared[join.right_key] = join.left_key
            self.shared.append(shared)
            for c in table.columns:
                source = live.get(shared[c.name]) if c.name in shared else None
                if source is None:
                    self.pools.append([])
                    pool = len(self.pools) - 1
                else:
                    pool = self.places[source][0]
                copied = join.matches if source is not None else 0
                self.pools[pool].append(Member(table.name, c, table.size, copied))
                self.places[t, c.name] = (pool, len(self.pools[pool]) - 1)
            for c in table.names:
                if c in live and not (join and join.left_key == join.right_key == c):
                    del live[c]
                elif c not in live:
                    live[c] = (t, c)

    def columns(self, t: int, index: str) -> dict[str, Expression]:
        return {c.name: self._column(t, c, index) for c in self.tables[t].columns}

    def _column(self, t: int, column: Column, index: str) -> Expression:
        pool, place = self.places[t, column.name]
        if pool in self.allotted:
            return self.allotted[pool].column(place, index)
        own = stream(self.seed, f"{self.tables[t].name}.{column.name}")
        members = self.pools[pool]
        if len(members) == 1:
            return drawn_column(column, index, own)
        return self._drawn_shared(members, place, index, own)

    def _drawn_shared(self, members, place, index, own) -> str:
        """Draws that may repeat: matched rows draw alike, from what all may use."""
        first = self._pool_stream(members)
        stops, values = [], []
        for last in range(len(members) - 1, max(place, 1) - 1, -1):
            common = _common([m.column for m in members[: last + 1]])
            values.append(drawn_column(common, index, first, inline=True))
            stops.append(members[last].copied)
        values.append(drawn_column(members[place].column, index, own, inline=True))
        return by_row(index, stops, values)

    def allowed(self, t: int) -> dict:
        """For each shared column of table ``t``: whether a joined row's value fits it."""
        out = {}
        for name, source in self.shared[t].items():
            c = self.tables[t].column(name)
            if c.values is not None:
                out[source] = col(source).isin(*c.values)
            elif c.bounds is not None:
                out[source] = col(source).between(*c.bounds)
            else:
                out[source] = F.lit(True)
        return out


def _common(columns: Sequence[Column]) -> Column:
    """A column whose values all the given columns may have."""
    first = columns[0]
    lists = [c.values for c in columns if c.values is not None]
    bounds = [c.bounds for c in columns if c.bounds is not None]
    if len({(c.pattern, c.letters) for c in columns}) > 1:
        raise SpecError(f"{first.name}: tables that share it need one pattern")
    if lists:
        values = tuple(
            v
            for v in lists[0]
            if all(v in other for other in lists) and all(lo <= v <= hi for lo, hi in bounds)
        )
        if not values:
            raise SpecError(f"{first.name}: the value lists have nothing in common")
        return replace(first, values=values, bounds=None, repeatable=True)
    if bounds:
        lo, hi = max(b[0] for b in bounds), min(b[1] for b in bounds)
        if lo > hi:
            raise SpecError(f"{first.name}: the ranges have nothing in common")
        return replace(first, bounds=(lo, hi), unique=False)
    return first
