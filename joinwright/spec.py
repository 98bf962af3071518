"""What to generate and join: tables, columns, joins and default bounds.

A specification is a small driver-side description.  It can be written with the
dataclasses below or as a plain ``dict`` (see :meth:`Spec.from_dict`).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Type names a specification may use, and the bounds that hold
# where it states none.
TYPE_NAMES = {
    "IntegerType": T.IntegerType(),
    "LongType": T.LongType(),
    "DoubleType": T.DoubleType(),
    "DateType": T.DateType(),
    "BooleanType": T.BooleanType(),
    "StringType": T.StringType(),
}
JOIN_TYPES = {
    "inner": "inner",
    "left": "left",
    "right": "right",
    "outer": "full",
    "full": "full",
}
DEFAULT_PATTERN = "?###???#?#?"
DEFAULT_LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"

INTEGRAL = (T.IntegerType, T.LongType)


class SpecError(ValueError):
    """The specification is malformed or cannot be met."""


def type_of(name: str) -> T.DataType:
    """Spark type of a type name; an unknown name is an error."""
    try:
        return TYPE_NAMES[name]
    except KeyError:
        known = ", ".join(TYPE_NAMES)
        raise SpecError(f"unknown type {name!r}; known types are {known}") from None


def join_type_of(name: str) -> str:
    try:
        return JOIN_TYPES[name]
    except KeyError:
        raise SpecError(f"unknown join type {name!r}") from None


def schema_of(columns: Mapping[str, str]) -> T.StructType:
    """``StructType`` of a ``{column: type name}`` mapping."""
    return T.StructType([T.StructField(c, type_of(t)) for c, t in columns.items()])


def typed_value(value: Any, dtype: T.DataType) -> Any:
    """A bound or list value as the Python value of a column type."""
    if isinstance(dtype, T.DateType) and isinstance(value, str):
        return dt.date.fromisoformat(value)
    if isinstance(dtype, INTEGRAL):
        return int(value)
    if isinstance(dtype, T.DoubleType):
        return float(value)
    if isinstance(dtype, T.BooleanType) and isinstance(value, str):
        return {"true": True, "false": False}[value.strip().lower()]
    return value


@dataclass(frozen=True)
class Defaults:
    """Bounds of columns that state none of their own."""

    min_int: int = 0
    max_int: int = 1
    min_double: float = 0.0
    max_double: float = 1.0
    min_date: dt.date = dt.date(1979, 1, 1)
    max_date: dt.date = dt.date(2047, 12, 2)
    string_format: str = DEFAULT_PATTERN
    letters: str = DEFAULT_LETTERS
    save_to_csv: bool = True

    def bounds(self, dtype: T.DataType) -> tuple[Any, Any] | None:
        if isinstance(dtype, INTEGRAL):
            return self.min_int, self.max_int
        if isinstance(dtype, T.DoubleType):
            return self.min_double, self.max_double
        if isinstance(dtype, T.DateType):
            return self.min_date, self.max_date
        return None


@dataclass(frozen=True)
class Column:
    """One column: a type and at most one of bounds, pattern and value list.

    ``unique=False`` lets values of an integer, double or date column repeat;
    otherwise they are all different.  Values of a list are drawn with
    replacement unless ``repeatable`` is false.
    """

    name: str
    dtype: T.DataType
    nullable: bool = False
    bounds: tuple[Any, Any] | None = None
    pattern: str | None = None
    letters: str | None = None
    values: tuple[Any, ...] | None = None
    repeatable: bool = True
    unique: bool = True

    @property
    def repeats(self) -> bool:
        """Whether a value may occur in more than one row."""
        if isinstance(self.dtype, T.BooleanType):
            return True
        if self.values is not None:
            return self.repeatable
        return not self.unique

    def resolved(self, defaults: Defaults) -> Column:
        """The column with defaults filled in and its own values typed."""
        if self.values is not None:
            values = tuple(typed_value(v, self.dtype) for v in self.values)
            return replace(self, values=values, bounds=None, pattern=None)
        if isinstance(self.dtype, T.StringType):
            return replace(
                self,
                pattern=self.pattern or defaults.string_format,
                letters=self.letters or defaults.letters,
            )
        bounds = self.bounds or defaults.bounds(self.dtype)
        if bounds is None:
            return self
        lo, hi = (typed_value(v, self.dtype) for v in bounds)
        return replace(self, bounds=(lo, hi))


@dataclass(frozen=True)
class Table:
    """A table; of one that is ``given``, whose rows exist already, the size is not looked at."""

    name: str
    size: int
    columns: tuple[Column, ...]
    given: bool = False

    def column(self, name: str) -> Column:
        for c in self.columns:
            if c.name == name:
                return c
        raise SpecError(f"table {self.name!r} has no column {name!r}")

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c.name, c.dtype, c.nullable) for c in self.columns]
        )


def given_table(name: str, schema: T.StructType) -> Table:
    """Table of rows that exist already; their columns may have any type."""
    return Table(name, 0, tuple(Column(f.name, f.dataType, f.nullable) for f in schema), given=True)


@dataclass(frozen=True)
class Join:
    """Join of the chain so far with the next table, with ``matches`` matches."""

    left_key: str
    right_key: str
    how: str
    matches: int
    where: str | None = None


@dataclass(frozen=True)
class Spec:
    tables: tuple[Table, ...]
    joins: tuple[Join, ...] = ()
    defaults: Defaults = Defaults()

    @classmethod
    def from_dict(cls, spec: Mapping[str, Any], given: Mapping[str, DataFrame] | None = None) -> Spec:
        """Read the dict form: ``datasets``, ``restrictions``, ``join_conditions``.

        Bounds are pairs (``"restriction": (0, 100)``), value lists are lists and
        a join condition is a pair ``(left column, right column)``.  Datasets of ``given``
        tables need no size and no schema, and a join of two of them no number of matches.
        """
        given = given or {}
        stated = dict(spec.get("restrictions", {}))
        for key in ("min_date", "max_date"):
            if key in stated:
                stated[key] = typed_value(stated[key], T.DateType())
        defaults = Defaults(**stated)
        tables = tuple(
            given_table(name, given[name].schema)
            if name in given
            else Table(name, int(d["size"]), tuple(_column(c, f) for c, f in d["schema"].items()))
            for name, d in spec["datasets"].items()
        )
        joins = tuple(
            Join(
                left_key=j["condition"][0],
                right_key=j["condition"][1],
                how=join_type_of(j["type"]),
                matches=int(j["intersecting_records"] if t >= len(given) else j.get("intersecting_records", 0)),
                where=j.get("where"),
            )
            for t, j in enumerate(spec.get("join_conditions", {}).values(), start=1)
        )
        return cls(tables, joins, defaults).with_given(given).checked()

    @classmethod
    def from_schemas(
        cls,
        schemas: Mapping[str, T.StructType],
        sizes: Sequence[int],
        keys: Sequence[str | tuple[str, str]],
        types: Sequence[str],
        matches: Sequence[int],
        defaults: Defaults = Defaults(),
    ) -> Spec:
        """A spec of tables given as ``StructType``, all under the default bounds.

        ``keys``, ``types`` and ``matches`` describe the joins in order.
        """
        if len(sizes) != len(schemas) or not len(keys) == len(types) == len(matches):
            raise SpecError("each table needs a size, each join a key, a type and its matches")
        unknown = {
            f.dataType.simpleString()
            for schema in schemas.values()
            for f in schema
            if f.dataType not in TYPE_NAMES.values()
        }
        if unknown:
            raise SpecError(f"unknown type {', '.join(sorted(unknown))}")
        tables = tuple(
            Table(name, size, tuple(Column(f.name, f.dataType, f.nullable) for f in schema))
            for (name, schema), size in zip(schemas.items(), sizes)
        )
        joins = tuple(
            Join(*((key, key) if isinstance(key, str) else key), join_type_of(how), k)
            for key, how, k in zip(keys, types, matches)
        )
        return cls(tables, joins, defaults).checked()

    def with_given(self, given: Mapping[str, DataFrame]) -> Spec:
        """The spec with the columns of given tables, which have to be the first of the chain."""
        names = [t.name for t in self.tables]
        if set(names[: len(given)]) != set(given):
            raise SpecError(f"given tables {sorted(given)} are not the first of {names}")
        return replace(
            self,
            tables=tuple(
                given_table(t.name, given[t.name].schema) if t.name in given else t for t in self.tables
            ),
        )

    def checked(self) -> Spec:
        """The spec with all defaults filled in; raises if it cannot be met."""
        tables = tuple(
            t if t.given else replace(t, columns=tuple(c.resolved(self.defaults) for c in t.columns))
            for t in self.tables
        )
        spec = replace(self, tables=tables)
        if len({t.name for t in tables}) != len(tables):
            raise SpecError("table names must differ")
        for table in tables:
            if len(set(table.names)) != len(table.names):
                raise SpecError(f"column names of {table.name!r} must differ")
            for column in table.columns:
                if not table.given:
                    _check_column(table, column)
        _check_shared_types(tables)
        _check_joins(spec)
        return spec


def _column(name: str, field: Mapping[str, Any]) -> Column:
    bounds = field.get("restriction")
    if bounds is not None and (isinstance(bounds, str) or len(bounds) != 2):
        raise SpecError(f"restriction of {name!r} must be a pair (low, high)")
    values = field.get("values")
    if isinstance(values, str):
        raise SpecError(f"values of {name!r} must be a list")
    if bounds is not None and field["type"] in ("StringType", "BooleanType"):
        raise SpecError(f"{name!r}: a {field['type']} column takes no restriction")
    if field.get("string_format") is not None and field.get("letters") is None:
        raise SpecError(f"string_format of {name!r} needs letters")
    return Column(
        name=name,
        dtype=type_of(field["type"]),
        nullable=bool(field["nullable"]),
        bounds=tuple(bounds) if bounds is not None else None,
        pattern=field.get("string_format"),
        letters=field.get("letters"),
        values=tuple(values) if values is not None else None,
        repeatable=bool(field.get("repeatable", True)),
        unique=bool(field.get("unique", True)),
    )


def _check_column(table: Table, column: Column) -> None:
    where = f"{table.name}.{column.name}"
    if column.values is not None:
        if not column.values:
            raise SpecError(f"{where}: empty value list")
        if not column.repeatable and len(set(column.values)) < table.size:
            raise SpecError(f"{where}: fewer listed values than rows")
    elif column.bounds is not None:
        lo, hi = column.bounds
        if lo > hi:
            raise SpecError(f"{where}: empty range {lo}..{hi}")
        if column.repeats:
            return
        if isinstance(column.dtype, T.DoubleType):
            if lo == hi and table.size > 1:
                raise SpecError(f"{where}: one value for {table.size} rows")
            return
        room = (hi - lo).days if isinstance(column.dtype, T.DateType) else hi - lo
        if room + 1 < table.size:
            raise SpecError(f"{where}: {room + 1} values for {table.size} rows")


def _check_shared_types(tables: tuple[Table, ...]) -> None:
    seen: dict[str, Column] = {}
    for table in tables:
        for column in table.columns:
            other = seen.setdefault(column.name, column)
            if other.dtype != column.dtype:
                raise SpecError(f"column {column.name!r} has two types")


def _check_joins(spec: Spec) -> None:
    if len(spec.joins) != max(len(spec.tables) - 1, 0):
        raise SpecError("a chain of N tables needs N - 1 joins")
    after_given = any(t.given for t in spec.tables)
    for i, join in enumerate(spec.joins):
        if not after_given:
            if i and join.matches > spec.joins[i - 1].matches:
                raise SpecError("the number of matches must not rise along the chain")
            for table in spec.tables[i : i + 2]:
                if not 0 <= join.matches <= table.size:
                    raise SpecError(f"{join.matches} matches do not fit {table.name!r}")
        right = spec.tables[i + 1].column(join.right_key)
        earlier = [t for t in spec.tables[: i + 1] if join.left_key.split(".")[-1] in t.names]
        if not earlier:
            raise SpecError(f"no table before {spec.tables[i + 1].name!r} has {join.left_key!r}")
        left = earlier[-1].column(join.left_key.split(".")[-1])
        if left.dtype != right.dtype:
            raise SpecError(f"keys {join.left_key!r} and {join.right_key!r} differ in type")
        for key in (left, right):
            if key.repeats and not after_given:
                raise SpecError(f"key {key.name!r} may repeat, so matches cannot be exact")
