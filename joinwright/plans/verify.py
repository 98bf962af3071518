"""Verification of a job: run it on tables and compare with the expected result."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.compare import SchemaMismatch, difference_counts, row_difference
from ..sources.files import RESULT, read_tables
from ..spec import Spec
from .tables import generate

Job = Callable[[Mapping[str, DataFrame]], DataFrame]

SUMMARY = "job string, passed boolean, missing bigint, unexpected bigint, reason string"


@dataclass(frozen=True)
class Verification:
    """Outcome of a job.

    ``summary`` has one row: whether it passed, and how many rows it lacks or has
    too many.  ``differences`` has these rows, or is None where the columns
    differ already.  Both are lazy; neither collects a table.  A job whose rows
    raise an error has not passed; ``reason`` says why, reading ``summary`` itself raises.
    """

    summary: DataFrame
    differences: DataFrame | None

    @property
    def passed(self) -> bool:
        return self._outcome[0]

    @property
    def reason(self) -> str | None:
        """Why the job has not passed; None if it has."""
        return self._outcome[1]

    @cached_property
    def _outcome(self) -> tuple[bool, str | None]:
        try:
            row = self.summary.first()
        except Exception as e:  # whatever the rows of a job under test may raise
            return False, f"{type(e).__name__}: {e}"
        return row["passed"], row["reason"]

    def sample(self, rows: int = 20) -> DataFrame | None:
        """Some of the rows that differ, for a person to look at."""
        return None if self.differences is None else self.differences.limit(rows)


def verify(
    job: Job,
    tables: Mapping[str, DataFrame],
    expected: DataFrame,
    name: str = "job",
    digits: int | None = None,
    by: str | Sequence[str] = (),
) -> Verification:
    """Run a job and compare its output with the expected table.

    Row and column order do not matter.  An error that the job raises while it
    builds its result, or while it runs, counts as failure.  ``by`` is that of
    :func:`joinwright.operators.compare.row_difference`.
    """
    try:
        difference = row_difference(expected, job(tables), digits=digits, by=by)
    except SchemaMismatch as e:
        return _failed(expected, name, str(e))
    except Exception as e:  # whatever a job under test may raise
        return _failed(expected, name, f"{type(e).__name__}: {e}")
    counts = difference_counts(difference)
    clean = (F.col("missing") == 0) & (F.col("unexpected") == 0)
    summary = counts.select(
        F.lit(name).alias("job"),
        clean.alias("passed"),
        "missing",
        "unexpected",
        F.when(~clean, "rows differ").alias("reason"),
    )
    return Verification(summary, difference)


def _failed(expected: DataFrame, name: str, reason: str) -> Verification:
    schema = T.StructType.fromDDL(SUMMARY)
    row = [(name, False, None, None, reason)]
    return Verification(expected.sparkSession.createDataFrame(row, schema), None)


def check_job(
    spark: SparkSession,
    job: Job,
    spec: Spec | Mapping[str, Any],
    seed: int = 0,
    folder: str | None = None,
    name: str = "job",
    multiline: bool = False,
) -> Verification:
    """Generate the tables of a spec, run a job on them and verify its result.

    With a folder, tables and expected result are written there in the format of
    the spec, and read back with their declared types for the job and for the
    comparison; ``multiline`` allows line breaks in their texts.  Without one
    everything is a single plan.
    """
    made = generate(spark, spec, seed)
    tables, expected = made.tables, made.expected
    if folder is not None:
        paths = made.save(folder)
        schemas = {n: df.schema for n, df in {**tables, RESULT: expected}.items()}
        tables = read_tables(spark, paths, made.format, schemas, multiline)
        expected = tables.pop(RESULT)
    return verify(job, tables, expected, name)
