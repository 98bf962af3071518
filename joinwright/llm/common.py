"""What several operators share: written tables, rows as bytes, groups in sorted order."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from functools import partial
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from joinwright.functions.columns import col
from joinwright.sources import new_folder

#: The most bytes of the batches in which rows go to Python workers and back. An executor holds
#: several for each task, by default of 10,000 rows or 64 MB, and its workers stay from stage to stage.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def in_small_batches(spark: SparkSession) -> None:
    """Bound batches by BATCH_BYTES, unless the session has a bound of its own."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)


def importable(spark: SparkSession) -> None:
    """Let Python workers look for the package where the driver found it.

    This serves local mode, whatever the working folder. On a cluster the package is
    installed, or shipped with ``--py-files``, as usual.
    """
    if not spark.sparkContext.master.startswith("local"):
        return
    environment = spark.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def staged(df: DataFrame) -> DataFrame:
    """The frame, written as Parquet to the shared folder and read again.

    It cuts the lineage: what reads it neither computes the frame anew nor sees
    other values after an executor is lost.
    """
    spark, folder = df.sparkSession, new_folder(df.sparkSession)
    importable(spark)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def id_and_text(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """The two columns as ``doc_id`` and ``text``; a null text is empty."""
    importable(docs.sparkSession)
    return docs.select(
        col(id_column).alias("doc_id"), F.coalesce(col(text_column), F.lit("")).alias("text")
    )


def unused(df: DataFrame, name: str) -> str:
    """A name that no column of the frame has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken or f"{name}_fp".lower() in taken:
        name += "_"
    return name


def id_type(df: DataFrame, name: str = "doc_id") -> str:
    return df.schema[name].dataType.simpleString()


def spread(spark, rows: int, per_task: int) -> int:
    """Number of partitions for so many rows; all cores get some."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // per_task))


def flat(array: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Values of a column without nulls."""
    return array.to_numpy(zero_copy_only=False)


def batch_by_batch(
    function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]],
    batches: Iterator[pa.RecordBatch],
) -> Iterator[pa.RecordBatch]:
    """What ``function`` makes of each batch; the memory that Arrow keeps of it is given back.

    A worker serves task after task of all stages, and would hold the most that any of them took.
    """
    give_back = pa.default_memory_pool().release_unused
    for batch in batches:
        yield from function(batch)
        del batch
        give_back()
    give_back()


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups, from a partition that is sorted by the keys.

    A table holds the groups that end in a batch; the last, which may go on, is
    carried over.
    """
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table]).combine_chunks()
        last = np.ones(table.num_rows, dtype=bool)
        for key in keys:
            values = flat(table[key])
            last &= values == values[-1]
        start = table.num_rows - int(last.sum())
        rest = table.slice(start)
        if start:
            yield table.slice(0, start)
    if rest is not None and rest.num_rows:
        yield rest


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Row numbers where a group begins, and the number of rows."""
    changed = np.zeros(table.num_rows, dtype=bool)
    changed[:1] = True
    for key in keys:
        values = flat(table[key])
        changed[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(changed), table.num_rows)


def chunk_pairs(df: DataFrame, chunks: Column, own: Column) -> DataFrame:
    """Rows dealt to pairs of chunks, so that no group of a key is unbounded.

    ``chunks`` is the number of chunks of the row's key and ``own`` the chunk of
    the row. Any two rows of a key meet in the group (key, ``chunk_low``,
    ``chunk_high``) of their chunks. A key with one chunk has one group.
    """
    others = F.sequence(F.lit(0), chunks - 1)
    return (
        df.withColumn("own_chunk", own.cast("int"))
        .withColumn("other_chunk", F.explode(others))
        .withColumn("chunk_low", F.least("own_chunk", "other_chunk"))
        .withColumn("chunk_high", F.greatest("own_chunk", "other_chunk"))
        .drop("other_chunk")
    )


def with_struct(
    docs: DataFrame, text_column: str, name: str, kind: T.StructType, function: Callable
) -> DataFrame:
    """The rows with a struct column ``name`` that ``function`` makes of their texts.

    ``function`` takes a list of texts, null ones empty, and returns one tuple for each.
    """
    importable(docs.sparkSession)
    at = docs.columns.index(text_column)

    def added(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_type(kind)
        for start, stop in text_runs(batch.column(at)):
            part = batch.slice(start, stop - start)
            texts = [t or "" for t in part.column(at).to_pylist()]
            rows = [dict(zip(kind.names, r, strict=True)) for r in function(texts)]
            made = pa.array(rows, arrow)
            yield pa.RecordBatch.from_arrays([*part.columns, made], [*part.schema.names, name])

    schema = T.StructType([*docs.schema.fields, T.StructField(name, kind)])
    return docs.mapInArrow(partial(batch_by_batch, added), schema)


def text_runs(texts: pa.StringArray, most: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Stretches of about ``most`` bytes of text; a longer text is one of its own."""
    ends = np.cumsum(flat(pc.fill_null(pc.binary_length(texts), 0)), dtype=np.int64)
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield start, stop
        start = stop


def bounded_sample(df: DataFrame, key: str, bound: int) -> DataFrame:
    """About ``bound`` rows, chosen by a hash of the key, or all if there are fewer."""
    importable(df.sparkSession)
    n = df.count()
    if n <= bound:
        return df
    return df.filter(F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 40)) < int(bound / n * (1 << 40)))
