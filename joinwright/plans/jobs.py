"""The example job: tables joined along a chain, and the result written out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..sources.files import read_tables, write_table
from .chain import Step, join_chain

# Keys and join types of the example.
EXAMPLE_STEPS = (Step("user_id", "left"), Step("product_id", "right"))


def chain_job(steps: Sequence[Step] = EXAMPLE_STEPS):
    """A job that joins its tables in order, for :func:`joinwright.plans.verify.verify`."""

    def job(tables: Mapping[str, DataFrame]) -> DataFrame:
        return join_chain(tables, steps)

    return job


def run_chain_job(
    spark: SparkSession,
    paths,
    output: str,
    steps: Sequence[Step] = EXAMPLE_STEPS,
    fmt: str = "csv",
    schemas=None,
    multiline: bool = False,
) -> str:
    """Read the tables, join them, and write the result from all executors."""
    tables = read_tables(spark, paths, fmt, schemas, multiline)
    return write_table(join_chain(tables, steps), output, fmt)
