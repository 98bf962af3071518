"""Rows picked by their order, without sorting a table in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import col
from ..functions.draws import permuted
from ..sources.scratch import cut


def first_rows(df: DataFrame, order: str | Sequence[str], k: int) -> DataFrame:
    """The first ``k`` rows in the order of columns of any type that can be sorted.

    Rows with a null among these have no place in the order and are left out.
    Together the columns must tell the rows at the cut apart, else there is no such
    set of rows, and ``ValueError`` is raised, as it is for fewer than ``k`` rows.

    Only the order columns are shuffled: equal values are counted per task first,
    and the different ones are range-partitioned and kept in the shared folder.  The sizes of the
    partitions tell where the cut lies, and what is not beyond it is an ordinary filter.
    """
    columns = [order] if isinstance(order, str) else list(order)
    if k <= 0:
        return df.limit(0)
    for c in columns:
        df = df.filter(col(c).isNotNull())
    names = [f"c{i}" for i in range(len(columns))]
    counted = df.groupBy(*[col(c).alias(n) for c, n in zip(columns, names)]).agg(
        F.count("*").alias("n")
    )
    placed = cut(counted.repartitionByRange(*names)).withColumn("part", F.spark_partition_id())
    sizes = dict(placed.groupBy("part").agg(F.sum("n")).collect())  # one row per partition
    rows = sum(sizes.values())
    if rows < k:
        raise ValueError(f"{k} rows are needed, there are {rows}")
    before = 0
    for part in sorted(sizes):
        if before + sizes[part] >= k:
            break
        before += sizes[part]
    running = Window.orderBy(*names).rowsBetween(Window.unboundedPreceding, 0)
    last = (
        placed.filter(F.col("part") == part)
        .withColumn("upto", F.sum("n").over(running) + before)
        .filter(F.col("upto") >= k)
        .orderBy("upto")
        .first()
    )
    if last["upto"] != k:
        raise ValueError(f"rows with equal {', '.join(columns)} have no order")
    inside: Column = F.lit(True)
    for c, n in reversed(list(zip(columns, names))):
        inside = (col(c) < F.lit(last[n])) | ((col(c) == F.lit(last[n])) & inside)
    return df.filter(inside)


def number_rows(df: DataFrame, order: str | Sequence[str], name: str = "_rid") -> DataFrame:
    """Add 0, 1, 2, ... in the order of the given columns.

    The columns should tell rows apart, as equal ones end up in one task.  The rows are range-partitioned and sorted, and kept in the shared folder so
    that their places are fixed; a row's number is its place in its partition
    plus the sizes of the partitions before.  Only these sizes reach the driver.
    """
    return counted_rows(df, order, name)[0]


def counted_rows(
    df: DataFrame, order: str | Sequence[str], name: str = "_rid"
) -> tuple[DataFrame, int]:
    """:func:`number_rows`, and how many rows there are."""
    columns = [col(c) for c in ([order] if isinstance(order, str) else order)]
    placed = cut(df.repartitionByRange(*columns).sortWithinPartitions(*columns))
    sizes = dict(
        placed.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*")).collect()
    )
    starts, total = [], 0
    for part in range(max(sizes, default=-1) + 1):
        starts.append(total)
        total += sizes.get(part, 0)
    if not starts:
        return placed.withColumn(name, F.lit(0).cast("bigint")), 0
    start = F.element_at(F.lit(starts).cast("array<bigint>"), F.spark_partition_id() + 1)
    place = F.monotonically_increasing_id() % F.lit(1 << 33)
    return placed.withColumn(name, start + place), total


def draw_without_replacement(
    rows: DataFrame, index: str, values: DataFrame, value: str, stream_no: int
) -> DataFrame:
    """Give every row a value of a table, and no value twice.

    ``index`` numbers the rows from 0.  The different values are numbered in their
    order and matched with the rows through a one-to-one shuffle of these numbers.
    A null is not drawn.  Too few values raise ``ValueError``, and so does an index that is
    null, negative or repeated.
    """
    different = values.select(col(value)).filter(col(value).isNotNull()).distinct()
    listed, size = counted_rows(different, value, "__place")
    i = col(index)
    seen, least, top, different, numbered = rows.agg(
        F.count("*"), F.min(i), F.max(i), F.count_distinct(i), F.count(i)
    ).first()
    if numbered < seen or (seen and (least < 0 or different < seen)):
        raise ValueError(f"{index!r} does not number the rows: null, negative or repeated values")
    if top is not None and top >= size:
        raise ValueError(f"{top + 1} rows need as many values, there are {size}")
    placed = rows.withColumn("__place", F.expr(permuted(f"`{index}`", max(size, 1), stream_no)))
    return placed.join(listed, "__place").drop("__place")
