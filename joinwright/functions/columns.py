"""Columns by name."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """Column of exactly this name, also when the name has a dot in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(name: str, *taken: str) -> str:
    """This name, or the first like it that none of the others has."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name += "_"
    return name
