"""Build and check table pipelines on Spark: generate, join, check, compare."""

from . import functions, operators, plans, sources
from .operators.checks import report
from .operators.compare import assert_equal, cell_difference, equal, row_difference
from .operators.joins import equi_join
from .plans import (
    Generated,
    Step,
    Verification,
    check_job,
    generate,
    generate_table,
    join_chain,
    verify,
)
from .spec import Column, Defaults, Join, Spec, SpecError, Table

__all__ = [
    "Column",
    "Defaults",
    "Generated",
    "Join",
    "Spec",
    "SpecError",
    "Step",
    "Table",
    "Verification",
    "assert_equal",
    "cell_difference",
    "check_job",
    "equal",
    "equi_join",
    "functions",
    "generate",
    "generate_table",
    "join_chain",
    "operators",
    "plans",
    "report",
    "row_difference",
    "sources",
    "verify",
]
