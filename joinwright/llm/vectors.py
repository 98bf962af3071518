"""Vectors with an id: which of them count, and shards of bounded size."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import flat


def finite(vector: str) -> Column:
    """True if the vector is not null and all its components are finite numbers."""
    ok = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return F.coalesce(F.col(vector).isNotNull() & ok, F.lit(False))


def matrix(lists: pa.ListArray, dtype=np.float64) -> np.ndarray:
    """Rows of a list column; shorter ones end in zeros."""
    sizes = np.diff(flat(lists.offsets))
    values = flat(lists.flatten())
    width = int(sizes.max(initial=0))
    if len(sizes) and (sizes == width).all():
        return values.reshape(len(sizes), width).astype(dtype)
    out = np.zeros((len(sizes), width), dtype)
    for row, part in zip(out, np.split(values, np.cumsum(sizes)[:-1]), strict=True):
        row[: len(part)] = part
    return out


def packed(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """One row per key with a list ``rows`` of its rows, in order of the first column."""
    return df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("rows"))
