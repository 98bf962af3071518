"""CSV and Parquet tables: scans and sinks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col
from ..spec import schema_of

FORMATS = ("csv", "parquet")
# Names of saved tables that have none of their own.
UNNAMED = "Dataset№{}"
RESULT = "Result"
# A quote within a quoted value is doubled, as in most CSV files, and blanks at
# the ends of a value belong to it.
CSV = {
    "header": True,
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
# Stands for a quoted empty value while a file is read; no text may be just this.
EMPTY = "\0"


def _format(fmt: str) -> str:
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; known formats are {', '.join(FORMATS)}")
    return fmt


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: T.StructType | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Scan one table.

    A CSV file has a header and commas.  Without a schema its types are
    inferred, which reads the file once more, and an empty value is null.  With
    one it is read once, a quoted empty value is an empty string, and a row that
    does not fit the schema raises.
    ``multiline`` allows line breaks within quoted values; such a file cannot be
    split among tasks, so it should be written as many files.
    """
    if _format(fmt) == "parquet":
        df = spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path)
        return df
    reader = spark.read.options(**CSV, multiLine=multiline)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    df = reader.options(enforceSchema=False, emptyValue=EMPTY, mode="FAILFAST").schema(schema).csv(path)
    return df.select(
        [
            F.when(col(f.name) == EMPTY, "").otherwise(col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else col(f.name)
            for f in schema
        ]
    )


def read_tables(
    spark: SparkSession,
    paths: Mapping[str, str] | str | Iterable[str],
    fmt: str = "csv",
    schemas: Mapping[str, T.StructType] | None = None,
    multiline: bool = False,
) -> dict[str, DataFrame]:
    """Scan several tables, keeping their order; see :func:`read_table`.

    ``paths`` maps names to paths, or lists paths (also as one string with
    commas) whose last part, without its ending, is the name.
    """
    if isinstance(paths, str):
        paths = [p.strip() for p in paths.split(",")]
    if not isinstance(paths, Mapping):
        paths = {_base_name(p): p for p in paths}
    schemas = schemas or {}
    return {
        name: read_table(spark, path, fmt, schemas.get(name), multiline)
        for name, path in paths.items()
    }


def _base_name(path: str) -> str:
    last = path.rstrip("/").rsplit("/", 1)[-1]
    for ending in FORMATS:
        last = last.removesuffix("." + ending)
    return last


def write_table(df: DataFrame, path: str, fmt: str = "csv") -> str:
    """Write one table from all executors; returns its path.

    CSV has no way to write a text that is just the character NUL; it raises.
    """
    if _format(fmt) == "csv":
        refused = F.raise_error(F.lit("CSV cannot hold a text that is just NUL"))
        checked = [
            F.when(col(f.name) == EMPTY, refused).otherwise(col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else col(f.name)
            for f in df.schema
        ]
        # An empty string is written as "", a null as nothing.
        df.select(checked).write.mode("overwrite").options(**CSV).csv(path)
    else:
        df.write.mode("overwrite").parquet(path)
    return path


def save_tables(
    tables: Mapping[str, DataFrame] | Iterable[DataFrame],
    folder: str,
    fmt: str = "csv",
    result: DataFrame | None = None,
) -> dict[str, str]:
    """Write tables under their names, and the joined result as ``Result``.

    Returns ``{name: path}`` for :func:`read_tables`.
    """
    if not isinstance(tables, Mapping):
        tables = {UNNAMED.format(i): df for i, df in enumerate(tables, start=1)}
    named = dict(tables)
    if result is not None:
        if RESULT in named:
            raise ValueError(f"a table may not be called {RESULT!r}")
        named[RESULT] = result
    return {
        name: write_table(df, f"{folder.rstrip('/')}/{name}.{fmt}", fmt)
        for name, df in named.items()
    }


def _as_text(
    spark: SparkSession, path: str, columns: Mapping[str, str], fmt: str, multiline: bool
) -> DataFrame:
    """The columns as they are stored: of a CSV file as text."""
    if _format(fmt) != "csv":
        return read_table(spark, path, fmt).select(*[col(c) for c in columns])
    text = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return read_table(spark, path, fmt, text, multiline)


def read_typed(
    spark: SparkSession,
    path: str,
    columns: Mapping[str, str],
    fmt: str = "csv",
    multiline: bool = False,
) -> DataFrame:
    """Scan a table into the types its description names; unknown names raise.

    A value that does not convert reads as null; :func:`unconverted` counts them.
    """
    schema = schema_of(columns)
    df = _as_text(spark, path, columns, fmt, multiline)
    return df.select([col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def unconverted(
    spark: SparkSession,
    path: str,
    columns: Mapping[str, str],
    fmt: str = "csv",
    multiline: bool = False,
) -> DataFrame:
    """One row with the number of values per column that :func:`read_typed` turns into nulls."""
    schema = schema_of(columns)
    df = _as_text(spark, path, columns, fmt, multiline)
    return df.agg(
        *[
            F.count_if(col(f.name).isNotNull() & col(f.name).try_cast(f.dataType).isNull()).alias(
                f.name
            )
            for f in schema
        ]
    )
