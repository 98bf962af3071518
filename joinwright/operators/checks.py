"""Checks of table contents, each giving one small row of counts.

A result row says what was looked at, how many were ``expected``, how many there
actually were, and the number of ``violations``; a check holds if that is 0.

Checks that look at one row at a time are aggregates.  :func:`report` gathers
those of a table into one ``agg``, so that any number of them takes one scan of
just the columns they name.  Checks over groups pre-aggregate before they
shuffle, so a value with a large share of the rows weighs no more than another.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, fresh
from ..functions.patterns import pattern_regex
from ..spec import type_of

SCHEMA = T.StructType(
    [
        T.StructField("check", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("expected", T.LongType()),
        T.StructField("actual", T.LongType()),
        T.StructField("violations", T.LongType()),
    ]
)
# Longer lists of allowed values are joined as a table, not written into the plan;
# the result is the same.
SHORT_LIST = 200

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Check:
    """Name and subject of a check."""

    check: str
    table: str
    column: str

    def row(self, expected: Column, actual: Column, violations: Column) -> Column:
        values = [F.lit(self.check), F.lit(self.table), F.lit(self.column)]
        values += [c.cast("bigint") for c in (expected, actual, violations)]
        return F.struct(*[v.alias(f.name) for v, f in zip(values, SCHEMA)])


@dataclass(frozen=True)
class RowCheck(Check):
    """Counts over single rows: ``measure(df)`` gives (expected, actual, violations)."""

    measure: Callable[[DataFrame], tuple[Column, Column, Column]]


@dataclass(frozen=True)
class GroupCheck(Check):
    """Counts over groups or two tables: ``measure(tables)`` gives a one-row frame
    with the columns expected, actual and violations."""

    measure: Callable[[Tables], DataFrame]


@dataclass(frozen=True)
class EndsCheck(Check):
    """A check that takes the smallest and largest value of some columns:
    ``measure(tables, ends)`` finds them in ``ends`` by (table, column), typed."""

    wanted: tuple[tuple[str, str], ...]
    measure: Callable[[Tables, Mapping[tuple[str, str], tuple[Column, Column]]], DataFrame]


# ------------------------------------------------------- checks of single rows


def _passing(check: str, table: str, column: str, passes: Callable[[Column], Column]) -> RowCheck:
    """Rows that pass; a null passes, since only a null check is about nulls."""

    def measure(df: DataFrame):
        fails = ~passes(col(column))
        bad = F.count_if(fails)
        return F.count("*"), F.count("*") - bad, bad

    return RowCheck(check, table, column, measure)


def row_count(table: str, size: int) -> RowCheck:
    """The table has exactly ``size`` rows."""

    def measure(df: DataFrame):
        return F.lit(size), F.count("*"), F.abs(F.count("*") - F.lit(size))

    return RowCheck("row count", table, "*", measure)


def in_range(table: str, column: str, lo: Any, hi: Any) -> RowCheck:
    """Integers, doubles or dates lie in ``lo .. hi``, ends included."""
    return _passing("range", table, column, lambda c: c.between(F.lit(lo), F.lit(hi)))


def matches_pattern(table: str, column: str, pattern: str, letters: str) -> RowCheck:
    """Strings follow a pattern of letters, digits and fixed characters."""
    regex = pattern_regex(pattern, letters)
    return _passing("pattern", table, column, lambda c: c.rlike(regex))


def converts(table: str, column: str, to: str | T.DataType, source: str = "") -> RowCheck:
    """Values convert to a type, such as that of another table's column of this name."""
    dtype = type_of(to) if isinstance(to, str) else to
    name = f"type {source}".strip()
    return _passing(name, table, column, lambda c: c.isNull() | c.try_cast(dtype).isNotNull())


def same_type(tables: Tables, left: str, right: str) -> list[RowCheck]:
    """Columns of the same name in two tables can be compared: the values of the
    first convert to the type of the second."""
    types = {f.name: f.dataType for f in tables[right].schema}
    return [
        converts(left, f.name, types[f.name], f"of {right}")
        for f in tables[left].schema
        if f.name in types
    ]


def not_null(table: str, column: str) -> RowCheck:
    """No nulls in a column."""

    def measure(df: DataFrame):
        bad = F.count_if(col(column).isNull())
        return F.count("*"), F.count("*") - bad, bad

    return RowCheck("not null", table, column, measure)


def declared_not_null(table: str, schema: T.StructType) -> list[RowCheck]:
    """No nulls in the columns a schema declares as not nullable."""
    return [not_null(table, f.name) for f in schema if not f.nullable]


def capacity(table: str, column: str, bounds: tuple[Any, Any] | None = None) -> RowCheck:
    """A range holds enough values for all rows to differ.

    The range is ``bounds``, or from the smallest to the largest value found.  Whole
    numbers and decimals of any size, and days, are counted; any number of doubles
    fit into a range of two different ends.  Other types raise ``ValueError``.
    """

    def measure(df: DataFrame):
        lo, hi = _ends(df, column, bounds)
        rows = F.count("*")
        room = _room(df.schema[column].dataType, lo, hi, rows)
        return rows, room, F.greatest(rows - room, F.lit(0))

    return RowCheck("capacity", table, column, measure)


def _ends(df: DataFrame, column: str, bounds: tuple[Any, Any] | None) -> tuple[Column, Column]:
    if bounds is not None:
        return F.lit(bounds[0]), F.lit(bounds[1])
    return F.min(col(column)), F.max(col(column))


def _at_most_long(n: Column) -> Column:
    longest = F.lit((1 << 63) - 1)
    return F.when(n > longest, longest).otherwise(n.cast("bigint"))


def _room(dtype: T.DataType, lo: Column, hi: Column, many: Column) -> Column:
    """Number of values in ``lo .. hi``; of doubles as many as wanted."""
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        room = F.datediff(hi, lo) + 1
    elif isinstance(dtype, T.IntegralType):
        wide = T.DecimalType(20, 0)
        room = _at_most_long(hi.cast(wide) - lo.cast(wide) + 1)
    elif isinstance(dtype, T.DecimalType):
        room = _at_most_long((hi - lo) * F.lit(10**dtype.scale).cast("decimal(38,0)") + 1)
    elif not isinstance(dtype, (T.FloatType, T.DoubleType)):
        raise ValueError(f"values of {dtype.simpleString()} are not counted")
    else:
        room = F.when(hi > lo, many).otherwise((hi == lo).cast("bigint"))
    return F.greatest(F.coalesce(room.cast("bigint"), F.lit(0)), F.lit(0))


# ------------------------------------------------- checks of groups and of pairs


def _one_row(df: DataFrame, expected, actual, violations) -> DataFrame:
    return df.agg(
        expected.cast("bigint").alias("expected"),
        actual.cast("bigint").alias("actual"),
        violations.cast("bigint").alias("violations"),
    )


def typed(values: Iterable[Any], dtype: T.DataType) -> list[Any]:
    """Different values of a list as Python values of a column's type.

    Days and times may be given as ISO text.  Null is left out, and so is what no value of the
    column can equal: another type, a number out of range or with more digits, a text that is no day.
    """
    made = (_as_type(v, dtype) for v in values)
    return list(dict.fromkeys(v for v in made if v is not None))


def _as_type(value: Any, dtype: T.DataType) -> Any:
    if isinstance(dtype, T.BooleanType):
        return value if isinstance(value, bool) else None
    if isinstance(dtype, T.StringType):
        return value if isinstance(value, str) else None
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return _as_time(value, dt.date if isinstance(dtype, T.DateType) else dt.datetime)
    if not isinstance(dtype, T.NumericType):
        return value
    if not isinstance(value, (int, float, Decimal)):
        return None
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return float(value)
    exact = Decimal(value) if not isinstance(value, float) or math.isfinite(value) else None
    if exact is None or not exact.is_finite():
        return None
    if isinstance(dtype, T.DecimalType):
        whole = exact.scaleb(dtype.scale)
        fits = whole == whole.to_integral_value() and abs(whole) < 10**dtype.precision
        return exact if fits else None
    whole = int(exact)
    return whole if whole == exact and -WIDEST[type(dtype)] <= whole < WIDEST[type(dtype)] else None


#: What a whole number of a type is below.
WIDEST = {T.ByteType: 1 << 7, T.ShortType: 1 << 15, T.IntegerType: 1 << 31, T.LongType: 1 << 63}


def _as_time(value: Any, kind: type) -> Any:
    try:
        found = dt.datetime.fromisoformat(value) if isinstance(value, str) else value
    except ValueError:
        return None
    if kind is dt.date and isinstance(found, dt.datetime):
        return found.date() if found.time() == dt.time() else None
    if kind is dt.datetime and type(found) is dt.date:
        return dt.datetime(found.year, found.month, found.day)
    return found if isinstance(found, kind) else None


def in_domain(table: str, column: str, values: Sequence[Any] | DataFrame) -> Check:
    """Values are in a list, given as Python values or as a one-column frame.

    A null value passes, and a null in the list allows nothing.  Listed values are
    converted to the type of the column.
    """
    if not isinstance(values, DataFrame) and len(values) <= SHORT_LIST:

        def in_list(df: DataFrame):
            listed = typed(values, df.schema[column].dataType)
            found = col(column)
            dtype = df.schema[column].dataType
            values_ = [F.lit(v).cast(dtype) for v in listed]
            bad = F.count_if(found.isNotNull() & ~found.isin(values_) if listed else found.isNotNull())
            return F.count("*"), F.count("*") - bad, bad

        return RowCheck("domain", table, column, in_list)

    def measure(tables: Tables) -> DataFrame:
        df = tables[table]
        dtype = df.schema[column].dataType
        if isinstance(values, DataFrame):
            listed = values.toDF("value").select(F.col("value").try_cast(dtype)).toDF("value").distinct()
        else:
            listed = df.sparkSession.createDataFrame(
                [(v,) for v in typed(values, dtype)],
                T.StructType([T.StructField("value", dtype)]),
            )
        # One row per value, so that no value is hot in the join.
        counted = df.groupBy(col(column).alias("found")).agg(F.count("*").alias("rows"))
        judged = counted.join(
            listed.withColumn("listed", F.lit(True)), F.col("found") == F.col("value"), "left"
        )
        bad = F.col("found").isNotNull() & F.col("listed").isNull()
        fails = F.coalesce(F.sum(F.when(bad, F.col("rows"))), F.lit(0))
        total = F.coalesce(F.sum("rows"), F.lit(0))
        return _one_row(judged, total, total - fails, fails)

    return GroupCheck("domain", table, column, measure)


def unique(table: str, *columns: str, null_keys: bool = True) -> GroupCheck:
    """No two rows have the same key; the violations are the rows too many.

    Nulls count as equal; without ``null_keys``, rows with a null in the key are left out.
    """

    def measure(tables: Tables) -> DataFrame:
        df = tables[table]
        if not null_keys:
            df = df.dropna(subset=["`" + c.replace("`", "``") + "`" for c in columns])
        keys = repeated_keys(df, columns, keep_all=True)
        rows = F.coalesce(F.sum(col(keys.columns[-1])), F.lit(0))
        return _one_row(keys, rows, F.count("*"), rows - F.count("*"))

    return GroupCheck("unique", table, ", ".join(columns), measure)


def repeated_keys(
    df: DataFrame, columns: Sequence[str], keep_all: bool = False
) -> DataFrame:
    """Keys that occur more than once, and last their number of ``rows``.

    If a key column has this name already, underscores are added to the number's.
    """
    rows = fresh("rows", *columns)
    counted = df.groupBy(*[col(c) for c in columns]).agg(F.count("*").alias(rows))
    return counted if keep_all else counted.filter(col(rows) > 1)


def list_long_enough(table: str, column: str) -> GroupCheck:
    """Each value is used once: there are as many different values as rows.

    Nulls are rows without a value.
    """

    def measure(tables: Tables) -> DataFrame:
        values = tables[table].groupBy(col(column).alias("value")).agg(F.count("*").alias("rows"))
        rows = F.coalesce(F.sum("rows"), F.lit(0))
        return _one_row(values, rows, F.count("value"), rows - F.count("value"))

    return GroupCheck("list length", table, column, measure)


def shared_values(left: DataFrame, right: DataFrame, on: str | tuple[str, str]) -> DataFrame:
    """Distinct values, nulls left out, that a column has in both tables.

    Both sides are grouped together: an ``intersect`` would shuffle every row of
    one side, this shuffles distinct values only.
    """
    left_key, right_key = (on, on) if isinstance(on, str) else on
    sides = left.select(col(left_key).alias("value"), F.lit(1).alias("side")).union(
        right.select(col(right_key), F.lit(2))
    )
    return (
        sides.filter("value is not null")
        .groupBy("value")
        .agg(F.bit_or("side").alias("sides"))
        .filter("sides = 3")
        .select(F.col("value").alias(left_key))
    )


def key_overlap(left: str, right: str, on: str | tuple[str, str], size: int) -> GroupCheck:
    """Two tables share exactly ``size`` key values."""

    def measure(tables: Tables) -> DataFrame:
        both = shared_values(tables[left], tables[right], on)
        return _one_row(both, F.lit(size), F.count("*"), F.abs(F.count("*") - F.lit(size)))

    return GroupCheck("key overlap", f"{left}, {right}", _names(on), measure)


def value_overlap(left: str, right: str, on: str | tuple[str, str], size: int) -> GroupCheck:
    """Two tables share at least ``size`` values of a column."""

    def measure(tables: Tables) -> DataFrame:
        both = shared_values(tables[left], tables[right], on)
        return _one_row(
            both, F.lit(size), F.count("*"), F.greatest(F.lit(size) - F.count("*"), F.lit(0))
        )

    return GroupCheck("value overlap", f"{left}, {right}", _names(on), measure)


def range_overlap(
    left: str, right: str, on: str | tuple[str, str], size: int,
    left_bounds: tuple[Any, Any] | None = None, right_bounds: tuple[Any, Any] | None = None,
) -> GroupCheck:
    """The ranges of a column in two tables have at least ``size`` values in common.

    A side's range is its bounds, or else from its smallest to its largest value.
    """
    left_key, right_key = (on, on) if isinstance(on, str) else on
    given = [((left, left_key), left_bounds), ((right, right_key), right_bounds)]

    def measure(tables: Tables, ends) -> DataFrame:
        dtype = tables[left].schema[left_key].dataType
        los, his = zip(
            *(
                [e.cast(dtype) for e in (map(F.lit, b) if b is not None else ends[of])]
                for of, b in given
            )
        )
        lo = F.when(los[0].isNotNull() & los[1].isNotNull(), F.greatest(*los))
        room = _room(dtype, lo, F.least(*his), F.lit(size))
        return tables[left].sparkSession.range(1).select(
            F.lit(size).cast("bigint").alias("expected"),
            room.alias("actual"),
            F.greatest(F.lit(size) - room, F.lit(0)).cast("bigint").alias("violations"),
        )

    wanted = tuple(of for of, b in given if b is None)
    return EndsCheck("range overlap", f"{left}, {right}", _names(on), wanted, measure)


def values_in_range(
    left: str, right: str, on: str | tuple[str, str], size: int,
    bounds: tuple[Any, Any] | None = None,
) -> GroupCheck:
    """At least ``size`` different values of the first table lie in the range of the second.

    The range is ``bounds``, or else from the smallest to the largest value of the
    second table.
    """
    left_key, right_key = (on, on) if isinstance(on, str) else on

    def measure(tables: Tables, ends) -> DataFrame:
        lo, hi = map(F.lit, bounds) if bounds is not None else ends[right, right_key]
        values = tables[left].select(col(left_key)).distinct().filter(col(left_key).between(lo, hi))
        n = F.count("*")
        return _one_row(values, F.lit(size), n, F.greatest(F.lit(size) - n, F.lit(0)))

    wanted = () if bounds is not None else ((right, right_key),)
    return EndsCheck("values in range", f"{left}, {right}", _names(on), wanted, measure)


def join_cardinality(steps: Sequence[Any], sizes: Sequence[int]) -> list[GroupCheck]:
    """The joins of a chain give so many rows; see :func:`joinwright.plans.chain.chain_counts`.

    The tables are joined in the order in which :func:`report` is given them.
    """
    from ..plans.chain import chain_counts

    last: list[Any] = [None, None]  # tables that were counted, and their counts

    def counted(i: int):
        def measure(tables: Tables) -> DataFrame:
            if last[0] is not tables:
                names = list(tables)[: len(steps) + 1]
                last[:] = tables, chain_counts({n: tables[n] for n in names}, steps)
            counts = last[1][i]
            size, rows = F.lit(sizes[i]), F.max("rows")
            return _one_row(counts, size, rows, F.abs(rows - size))

        return measure

    return [
        GroupCheck("join cardinality", f"join {i + 1}", _names(step.on), counted(i))
        for i, step in enumerate(steps)
    ]


def _names(on: str | tuple[str, str]) -> str:
    return on if isinstance(on, str) else ", ".join(on)


# --------------------------------------------------------------------- report


def report(tables: Tables, checks: Iterable[Check]) -> DataFrame:
    """All checks as one frame, one row each.

    The checks of single rows of a table, and the ends of its columns that other
    checks ask for, are one ``agg``.  A table whose ends are asked for is aggregated
    at once, to one row that the driver gets; all else is lazy.
    """
    checks = list(checks)
    if not checks:
        raise ValueError("no checks given")
    rows: dict[str, list[Column]] = {}
    wanted: dict[str, dict[str, None]] = {}
    for check in checks:
        if isinstance(check, RowCheck):
            rows.setdefault(check.table, []).append(check.row(*check.measure(tables[check.table])))
        elif isinstance(check, EndsCheck):
            for table, column in check.wanted:
                wanted.setdefault(table, {})[column] = None
    frames: list[DataFrame] = []
    ends: dict[tuple[str, str], tuple[Column, Column]] = {}
    for name in dict.fromkeys([*rows, *wanted]):
        df, columns = tables[name], list(wanted.get(name, ()))
        found = [F.array(*rows[name]).alias("rows")] if name in rows else []
        for i, c in enumerate(columns):
            found += [F.min(col(c)).alias(f"low {i}"), F.max(col(c)).alias(f"high {i}")]
        if not columns:
            frames.append(df.agg(*found).select(F.inline("rows")))
            continue
        row = df.agg(*found).first()
        for i, c in enumerate(columns):
            dtype = df.schema[c].dataType
            ends[name, c] = tuple(F.lit(row[f"{end} {i}"]).cast(dtype) for end in ("low", "high"))
        if name in rows:
            frames.append(df.sparkSession.createDataFrame(row["rows"], SCHEMA))
    for check in checks:
        if isinstance(check, (GroupCheck, EndsCheck)):
            one = check.measure(tables, ends) if isinstance(check, EndsCheck) else check.measure(tables)
            row = check.row(F.col("expected"), F.col("actual"), F.col("violations"))
            frames.append(one.select(F.inline(F.array(row))))
    return reduce(DataFrame.unionByName, frames)


def check_spec_bounds(spec: Any) -> list[Check]:
    """The checks that a spec's sizes, bounds, lists, patterns and null flags stand for."""
    checks: list[Check] = []
    for table in spec.tables:
        checks.append(row_count(table.name, table.size))
        checks += declared_not_null(table.name, table.schema)
        for c in table.columns:
            if c.values is not None:
                checks.append(in_domain(table.name, c.name, c.values))
                if not c.repeatable:
                    checks.append(list_long_enough(table.name, c.name))
            elif c.pattern is not None:
                checks.append(matches_pattern(table.name, c.name, c.pattern, c.letters))
            elif c.bounds is not None:
                checks.append(in_range(table.name, c.name, *c.bounds))
                if not c.repeats:
                    checks.append(unique(table.name, c.name))
    for i, join in enumerate(spec.joins):
        owner = [t.name for t in spec.tables[: i + 1] if join.left_key in t.names]
        if owner and not any(j.where for j in spec.joins[:i]):
            on = (join.left_key, join.right_key)
            on = on[0] if on[0] == on[1] else on
            checks.append(key_overlap(owner[-1], spec.tables[i + 1].name, on, join.matches))
    return checks
