"""Comparison of two tables: as multisets of rows, and cell by cell."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, fresh
from ..sources.scratch import cut
from .rows import number_rows

LEFT, RIGHT = "left", "right"
FRACTIONS = (T.FloatType, T.DoubleType, T.DecimalType)


class SchemaMismatch(AssertionError):
    """Two tables do not have the same columns and types."""


def check_schemas(left: DataFrame, right: DataFrame, ignore_column_order: bool = True) -> None:
    """Raise :class:`SchemaMismatch` unless names and types agree."""
    a = [(f.name, f.dataType.simpleString()) for f in left.schema]
    b = [(f.name, f.dataType.simpleString()) for f in right.schema]
    if ignore_column_order:
        a, b = sorted(a), sorted(b)
    if a != b:
        only_left = [f"{n} {t}" for n, t in a if (n, t) not in b]
        only_right = [f"{n} {t}" for n, t in b if (n, t) not in a]
        raise SchemaMismatch(f"columns differ: left {only_left}, right {only_right}")


def _aligned(df: DataFrame, names: Sequence[str], digits: int | None) -> DataFrame:
    def value(name: str) -> Column:
        if digits is not None and isinstance(df.schema[name].dataType, FRACTIONS):
            return F.round(col(name), digits).alias(name)
        return col(name)

    return df.select([value(n) for n in names])


def row_difference(
    left: DataFrame,
    right: DataFrame,
    ignore_column_order: bool = True,
    digits: int | None = None,
    by: str | Sequence[str] = (),
) -> DataFrame:
    """Rows one table has more often than the other.

    Columns of the tables, plus ``side`` (which table has more) and ``copies``
    (how many more), with underscores added to a name that a column of the tables has
    already; they are the last two.  The tables are equal, whatever their row order, if there
    are no such rows.  Null equals null.  ``digits`` rounds fractions first.

    Rows are counted, +1 on the left and -1 on the right, in one aggregation over
    both tables; copies are added up before they are shuffled.

    ``by`` names columns to deal the rows of both tables by, instead of by all: a table that a
    join has left dealt by them is not shuffled again.  It changes the plan only; rows that are
    alike in these columns, or null there, meet in one task.
    """
    check_schemas(left, right, ignore_column_order)
    names = left.columns
    weight, balance = fresh("weight", *names), fresh("balance", *names)
    keys = [col(k) for k in ([by] if isinstance(by, str) else by)]

    def weighed(df: DataFrame, number: int) -> DataFrame:
        rows = _aligned(df, names, digits)
        return (rows.repartition(*keys) if keys else rows).withColumn(weight, F.lit(number))

    both = weighed(left, 1).unionByName(weighed(right, -1))
    return (
        both.groupBy(*[col(n) for n in names])
        .agg(F.sum(weight).alias(balance))
        .filter(col(balance) != 0)
        .select(
            *[col(n) for n in names],
            F.when(col(balance) > 0, LEFT).otherwise(RIGHT).alias(fresh("side", *names)),
            F.abs(col(balance)).alias(fresh("copies", *names)),
        )
    )


def equal(
    left: DataFrame,
    right: DataFrame,
    ignore_column_order: bool = True,
    digits: int | None = None,
) -> bool:
    """Whether two tables have the same columns and the same rows in any order."""
    try:
        difference = row_difference(left, right, ignore_column_order, digits)
    except SchemaMismatch:
        return False
    return difference.isEmpty()


def assert_equal(
    left: DataFrame,
    right: DataFrame,
    ignore_column_order: bool = True,
    digits: int | None = None,
    sample: int = 10,
) -> None:
    """Raise ``AssertionError``, with some of the rows that differ, unless equal."""
    difference = row_difference(left, right, ignore_column_order, digits)
    rows = difference.limit(sample).collect()
    if rows:
        shown = "\n".join(str(r.asDict()) for r in rows)
        raise AssertionError(f"the tables differ, for instance in\n{shown}")


def cell_difference(
    left: DataFrame,
    right: DataFrame,
    key: str | Sequence[str],
    digits: int | None = None,
    repeated: str = "count",
) -> DataFrame:
    """Cells that differ between the rows of the same key.

    One row per cell: the key, ``column``, and both values as text.  A row only
    one table has gives one row with ``column`` null and its presence as the
    value.  A key that repeats among the rows that differ names no one row; it
    gives the number of these rows on either side under the column ``*``.

    With ``repeated="pair"`` the rows of such a key are paired: first those that differ in one
    cell only, whichever it is, then the others in the order of their cells.  Each row is in
    one pair at most, and a row without a partner counts as one that only its table has.

    Equal rows cancel out first, so only rows that differ are paired.  A key column
    of a name used here keeps it; underscores are added to the other.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cells = [c for c in left.columns if c not in keys]
    difference = row_difference(left, right, digits=digits)
    side, copies = difference.columns[-2:]
    number = {s: fresh(s, *keys) for s in (LEFT, RIGHT)}
    row = {s: fresh(f"{s}_row", *keys) for s in (LEFT, RIGHT)}
    of = []
    if repeated == "pair":
        of = [fresh("pair", *left.columns, side, copies)]
        difference = _paired(difference, keys, cells, side, copies, of[0])
    elif repeated != "count":
        raise ValueError(f"repeated keys are counted or paired, not {repeated!r}")
    sides = difference.groupBy(*[col(k) for k in [*keys, *of]]).agg(
        *[
            F.coalesce(F.sum(F.when(col(side) == s, col(copies))), F.lit(0)).alias(number[s])
            for s in (LEFT, RIGHT)
        ],
        *[
            F.any_value(F.when(col(side) == s, F.struct(F.lit(0), *[col(c) for c in cells])), True)
            .alias(row[s])
            for s in (LEFT, RIGHT)
        ],
    )
    one = col(number[LEFT]) + col(number[RIGHT]) == 1
    pair = (col(number[LEFT]) == 1) & (col(number[RIGHT]) == 1)
    there = [F.when(col(number[s]) > 0, "present") for s in (LEFT, RIGHT)]
    counts = [col(number[s]).cast("string") for s in (LEFT, RIGHT)]
    cell, changed = _cells(keys, cells, col(row[LEFT]), col(row[RIGHT]))
    found = (
        F.when(pair, changed)
        .when(one, F.array(cell(F.lit(None).cast("string"), *there)))
        .otherwise(F.array(cell(F.lit("*"), *counts)))
    )
    return sides.select(*[col(k) for k in keys], F.inline(found))


def _cells(keys: Sequence[str], cells: Sequence[str], left: Column, right: Column):
    """What makes a cell of the output, and the cells that differ between two rows."""
    out = [fresh(n, *keys) for n in ("column", "left_value", "right_value")]

    def cell(*values: Column) -> Column:
        return F.struct(*[v.alias(n) for v, n in zip(values, out)])

    changed = [
        F.when(
            ~left.getField(c).eqNullSafe(right.getField(c)),
            cell(F.lit(c), left.getField(c).cast("string"), right.getField(c).cast("string")),
        )
        for c in cells
    ]
    return cell, F.array_compact(F.array(*changed))


def _paired(
    difference: DataFrame, keys: Sequence[str], cells: Sequence[str], side: str, copies: str, of: str
) -> DataFrame:
    """The rows one by one, with the number of their pair among those of their key.

    Rows that differ in one cell are alike without it, so they meet in a group of the cells
    that are left; nothing is compared with all rows of its key.
    """
    by = [col(k).alias(f"key {i}") for i, k in enumerate(keys)]
    names = [f"key {i}" for i in range(len(keys))]
    row = F.struct(*[col(c).alias(f"cell {i}") for i, c in enumerate(cells)])
    single = difference.select(
        *by, col(side).alias("side"), row.alias("row"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), col(copies))).alias("copy"),
    )
    place = Window.partitionBy(*[col(n) for n in names], "side").orderBy("row", "copy")
    single = cut(single.withColumn("n", F.row_number().over(place)).drop("copy"))
    # The rows without one cell each, numbered among those that are alike then.
    without = [
        F.struct(F.lit(i).alias("cell"), F.struct(*[F.col(f"row.cell {j}") for j in range(len(cells)) if j != i]).alias("rest"))
        if len(cells) > 1
        else F.struct(F.lit(i).alias("cell"), F.struct(F.lit(0)).alias("rest"))
        for i in range(len(cells))
    ]
    reduced = [
        single.select(*[col(n) for n in names], "side", "n", w.getField("cell").alias("cell"), F.to_json(w.getField("rest"), {"ignoreNullFields": "false"}).alias("rest"))
        for w in without
    ]
    reduced = reduce(DataFrame.union, reduced)
    alike = Window.partitionBy(*[col(n) for n in names], "cell", "rest", "side").orderBy("n")
    reduced = reduced.withColumn("m", F.row_number().over(alike))
    sides = {
        s: reduced.filter(F.col("side") == s).withColumnRenamed("n", f"{s} n").drop("side")
        for s in (LEFT, RIGHT)
    }
    # A row that could go with several takes the first cell's, if that one takes it as well.
    met = _null_safe_join(sides[LEFT], sides[RIGHT], [*names, "cell", "rest", "m"], "inner")
    for s in (LEFT, RIGHT):
        other = RIGHT if s == LEFT else LEFT
        first = Window.partitionBy(*[col(n) for n in names], f"{s} n").orderBy("cell", f"{other} n")
        met = met.withColumn(f"{s} first", F.row_number().over(first) == 1)
    pairs = cut(met.filter(f"`{LEFT} first` AND `{RIGHT} first`").select(*[col(n) for n in names], f"{LEFT} n", f"{RIGHT} n"))
    out = []
    for s in (LEFT, RIGHT):
        # A pair is called by its left row.
        own = pairs.select(*[col(n) for n in names], F.col(f"{s} n").alias("n"), F.col(f"{LEFT} n").alias("pair"))
        rows = _null_safe_join(single.filter(F.col("side") == s), own, [*names, "n"], "left")
        rest = Window.partitionBy(*[col(n) for n in names], F.col("pair").isNull()).orderBy("n")
        number = F.when(F.col("pair").isNull(), -F.row_number().over(rest)).otherwise(F.col("pair"))
        out.append(rows.withColumn("pair", number))
    rows = out[0].unionByName(out[1])
    return rows.select(
        *[col(n).alias(k) for n, k in zip(names, keys)],
        *[F.col(f"row.cell {i}").alias(c) for i, c in enumerate(cells)],
        F.col("side").alias(side),
        F.lit(1).cast("bigint").alias(copies),
        F.col("pair").alias(of),
    )


def _null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    other = right.withColumnsRenamed({c: f"other {c}" for c in on})
    same = reduce(and_, [col(c).eqNullSafe(col(f"other {c}")) for c in on])
    return left.join(other, same, how).drop(*[f"other {c}" for c in on])


def cells_by_place(
    left: DataFrame, right: DataFrame, order: str | Sequence[str], place: str = "place"
) -> DataFrame:
    """Cells that differ between rows of the same place, counted from 0 in an order.

    Rows are placed by the order columns and then by all others, so equal tables have equal
    places.  The output is as that of :func:`cell_difference`, with the place for a key; where one
    table has more rows, its last ones give a row each with ``column`` null.
    """
    if sorted(left.columns) != sorted(right.columns):
        raise SchemaMismatch(f"columns differ: {left.columns} and {right.columns}")
    first = [order] if isinstance(order, str) else list(order)
    by = [*first, *[c for c in left.columns if c not in first]]
    sides = []
    for s, df in ((LEFT, left), (RIGHT, right)):
        row = F.struct(*[col(c) for c in left.columns]).alias(s)
        sides.append(number_rows(df.select(left.columns), by, "_place").select("_place", row))
    both = sides[0].join(sides[1], "_place", "full")
    cell, changed = _cells([place], left.columns, F.col(LEFT), F.col(RIGHT))
    alone = F.col(LEFT).isNull() | F.col(RIGHT).isNull()
    there = [F.when(F.col(s).isNotNull(), "present") for s in (LEFT, RIGHT)]
    found = F.when(alone, F.array(cell(F.lit(None).cast("string"), *there))).otherwise(changed)
    return both.select(F.col("_place").alias(place), F.inline(found))


def same_cells(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> bool:
    """Whether no cell differs between rows of the same key."""
    return cell_difference(left, right, key).isEmpty()


def difference_counts(difference: DataFrame) -> DataFrame:
    """One row: rows missing on the right, and rows the right has too many."""

    names = difference.columns[-2:]

    def copies(side: str) -> Column:
        return F.coalesce(F.sum(F.when(col(names[0]) == side, col(names[1]))), F.lit(0))

    return difference.agg(copies(LEFT).alias("missing"), copies(RIGHT).alias("unexpected"))
