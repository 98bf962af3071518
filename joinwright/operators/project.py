"""Column names and types around a join."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from ..functions.columns import col
from ..spec import schema_of


def shared_columns(left: Iterable[str], right: Iterable[str]) -> list[str]:
    """Names both have, in the order of the first."""
    others = set(right)
    return [c for c in left if c in others]


def select_shared(df: DataFrame, other: DataFrame) -> DataFrame:
    """The columns of ``df`` that ``other`` has too."""
    return df.select([col(c) for c in shared_columns(df.columns, other.columns)])


def prefixed(df: DataFrame, table: str, names: Iterable[str]) -> DataFrame:
    """Rename the given columns to ``<table>.<column>``."""
    return df.withColumnsRenamed({c: f"{table}.{c}" for c in names})


def prefix_clashes(
    left: DataFrame, left_name: str, right: DataFrame, right_name: str, keep: Iterable[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Give every name both sides have its table as prefix, but for ``keep``."""
    kept = set(keep)
    clashes = [c for c in shared_columns(left.columns, right.columns) if c not in kept]
    return prefixed(left, left_name, clashes), prefixed(right, right_name, clashes)


def suffix_to_prefix(df: DataFrame, tables: Iterable[str]) -> DataFrame:
    """Rename every ``<column>.<table>`` to ``<table>.<column>``.

    A name that already starts with a table is left alone, so a second call
    changes nothing.
    """
    names = set(tables)
    renamed = {}
    for c in df.columns:
        head, dot, tail = c.rpartition(".")
        if dot and tail in names and head.split(".")[0] not in names:
            renamed[c] = f"{tail}.{head}"
    return df.withColumnsRenamed(renamed)


def cast_columns(
    df: DataFrame, types: T.StructType | Mapping[str, str], strict: bool = True
) -> DataFrame:
    """Cast the described columns to their types and keep the others.

    ``strict`` raises at run time on a value that does not convert; otherwise
    the value becomes null.
    """
    schema = types if isinstance(types, T.StructType) else schema_of(types)
    wanted = {f.name: f.dataType for f in schema}
    unknown = [c for c in wanted if c not in df.columns]
    if unknown:
        raise ValueError(f"no such column: {', '.join(unknown)}")

    def convert(name: str) -> Column:
        if name not in wanted:
            return col(name)
        column = col(name)
        cast = column.cast(wanted[name]) if strict else column.try_cast(wanted[name])
        return cast.alias(name)

    return df.select([convert(c) for c in df.columns])
