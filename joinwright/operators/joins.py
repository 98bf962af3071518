"""Equi-joins, and their form for keys that have a large share of the rows.

Adaptive execution splits a hot key of an inner join on both sides, and of an
outer join on the side that is kept whole.  It cannot split the other side of an
outer join, nor either side of a full join.  A side that is known, or measured by
:func:`hot_sides`, to have a hot key there makes the join one of joins that can be
split::

    left  = inner  +  left anti
    right = inner  +  right anti
    full  = inner  +  left anti  +  right anti

The anti joins look at the distinct keys of the other side, which are
pre-aggregated before they are shuffled.  If the hot keys themselves are known, only their rows
are joined so, and all others in the plain way.  Any other join is the plain one, which
reads either side once.

Hot keys are found by a summary of bounded size that every task makes of its rows, so
nothing but summaries is shuffled to find them.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable, Iterable, Mapping, Sequence
from copy import copy
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col
from ..sources.scratch import cut
from ..spec import join_type_of
from .project import shared_columns

# Sides with hot keys, or the hot keys of a side.
Hot = Iterable[str] | Mapping[str, Sequence[Any]]
# Counters of a task's summary of keys.
TRACKED = 10_000

# Rows with a null key match nothing, so they may go to any of so many places.
NULL_SPREAD = 4096


def equi_join(
    left: DataFrame,
    right: DataFrame,
    on: str | tuple[str, str],
    how: str = "inner",
    null_safe: bool = False,
    hot: Hot = (),
) -> DataFrame:
    """Join on one key.

    ``on`` is a name both sides have, giving one key column filled from either
    side, or a pair ``(left name, right name)``, keeping both.  All other names
    must differ.  ``how`` is inner, left, right or full (also called outer).
    ``null_safe`` lets a null key match a null key.  ``hot`` names the sides
    ("left", "right") on which a key has a large share of the rows, or gives the keys that have
    for each such side: it changes the plan only, the result is the same without it.
    """
    how = join_type_of(how)
    left_key, right_key = (on, on) if isinstance(on, str) else on
    using = left_key == right_key
    clashes = shared_columns(left.columns, right.columns)
    if clashes != ([left_key] if using else []):
        raise ValueError(f"both sides have the columns {clashes}; rename them first")
    return _EquiJoin(left, right, left_key, right_key, null_safe).run(how, hot)


# Sides of an outer join on which adaptive execution cannot split a hot key.
UNSPLIT = {"left": ("right",), "right": ("left",), "full": ("left", "right")}


def splits(how: str, hot: Hot) -> bool:
    """Whether a join is to be put together from others for these hot sides."""
    sides = {s for s in hot if hot[s]} if isinstance(hot, Mapping) else set(hot)
    return bool(set(UNSPLIT.get(join_type_of(how), ())) & sides)


def hot_sides(
    left: DataFrame, right: DataFrame, on: str | tuple[str, str], share: float = 0.05
) -> tuple[str, ...]:
    """Sides on which one key, null aside, has more than this share of the rows.

    It reads the key column of either side once; rows are counted per task and key
    before they are shuffled.
    """
    keys = (on, on) if isinstance(on, str) else on
    found = []
    for side, df, key in zip(("left", "right"), (left, right), keys):
        if has_hot_key(df, key, share):
            found.append(side)
    return tuple(found)


def has_hot_key(df: DataFrame, key: str, share: float) -> bool:
    return bool(heavy_keys(df, key, share))


def heavy_keys(
    df: DataFrame, key: str, share: float = 0.05, weight: str | None = None
) -> list[Any]:
    """Keys, null aside, that have more than this share of the rows, and more than one.

    Every task summarises its rows in TRACKED counters and the summaries are merged; no key
    is shuffled.  With more different keys than counters the numbers may be a little too high,
    so a key somewhat below the share may be among them, but none above it is missing.
    With ``weight``, a row counts as often as the column says; these rows are summed by key.
    """
    found = df.filter(col(key).isNotNull())
    if weight is not None:
        sums = found.groupBy(col(key).alias("item")).agg(F.sum(col(weight)).alias("count"))
        sums = cut(sums)
        rows = sums.agg(F.sum("count")).first()[0] or 0
        return [r["item"] for r in sums.filter(F.col("count") > max(1, share * rows)).collect()]
    most = min(TRACKED, math.ceil(1 / share) + 1)
    value = col(key)
    if isinstance(df.schema[key].dataType, T.TimestampNTZType):
        value = value.cast("string")  # a type that has no summary
    summary = found.select(value.alias("item")).agg(
        F.expr(f"approx_top_k(item, {most}, {TRACKED})").alias("top"), F.count("*").alias("rows")
    )
    row = summary.first()
    heavy = [t["item"] for t in row["top"] or [] if t["count"] > max(1, share * row["rows"])]
    if isinstance(df.schema[key].dataType, T.TimestampNTZType):
        heavy = [dt.datetime.fromisoformat(h) for h in heavy]
    return heavy


class _EquiJoin:
    """The two sides with their keys, and the pieces a join is made of."""

    def __init__(self, left, right, left_key, right_key, null_safe):
        self.using = left_key == right_key
        self.left = left
        self.left_key = left_key
        # A key of the same name gets a name of its own until the output.
        self.right_key = f"{right_key} (right)" if self.using else right_key
        self.right = right.withColumnRenamed(right_key, self.right_key)
        self.null_safe = null_safe

    def run(self, how: str, hot: Hot) -> DataFrame:
        if not splits(how, hot):
            return self._plain_full() if how == "full" else self._plain(how)
        if not isinstance(hot, Mapping):
            return self._split(how)
        keys = list(dict.fromkeys(k for side in UNSPLIT[how] for k in hot.get(side, ())))
        light = self._where(lambda key: ~_among(key, keys)).run(how, ())
        return light.unionByName(self._where(lambda key: _among(key, keys))._split(how, few=True))

    def _where(self, condition: Callable[[Column], Column]) -> _EquiJoin:
        """The join of those rows of either side whose keys fulfil a condition."""
        part = copy(self)
        part.left = self.left.filter(condition(col(self.left_key)))
        part.right = self.right.filter(condition(col(self.right_key)))
        return part

    def _same(self, left_key: Column, right_key: Column) -> Column:
        return left_key.eqNullSafe(right_key) if self.null_safe else left_key == right_key

    def _output(self, joined: DataFrame, key: Column) -> DataFrame:
        """Columns of the result, with ``key`` as the only key column of a USING join."""
        if not self.using:
            return joined.select(
                [col(c) for c in self.left.columns] + [col(c) for c in self.right.columns]
            )
        return joined.select(
            [key.alias(c) if c == self.left_key else col(c) for c in self.left.columns]
            + [col(c) for c in self.right.columns if c != self.right_key]
        )

    def _plain(self, how: str, left=None, right=None, *extra: Column) -> DataFrame:
        left, right = left or self.left, right or self.right
        condition = self._same(col(self.left_key), col(self.right_key))
        for e in extra:
            condition = condition & e
        keys = {
            "inner": col(self.left_key),
            "left": col(self.left_key),
            "right": col(self.right_key),
            "full": F.coalesce(col(self.left_key), col(self.right_key)),
        }
        return self._output(left.join(right, condition, how), keys[how])

    def _plain_full(self) -> DataFrame:
        """Full join; the rows with a null key are spread out."""
        if self.null_safe:
            return self._plain("full")
        left = self.left.withColumn("__lsalt", _null_salt(self.left, self.left_key))
        right = self.right.withColumn("__rsalt", _null_salt(self.right, self.right_key))
        return self._plain("full", left, right, F.col("__lsalt") == F.col("__rsalt"))

    def _matched(self) -> DataFrame:
        return self._plain("inner", self._keyed(self.left, self.left_key),
                           self._keyed(self.right, self.right_key))

    def _split(self, how: str, few: bool = False) -> DataFrame:
        """``few``: there are no more different keys than hot ones, so they may be broadcast."""
        result = self._matched()
        if how in ("left", "full"):
            rows = self._unmatched(self.left, self.left_key, self.right, self.right_key, few)
            result = result.unionByName(self._padded(rows, self.right, self.left_key))
        if how in ("right", "full"):
            rows = self._unmatched(self.right, self.right_key, self.left, self.left_key, few)
            result = result.unionByName(self._padded(rows, self.left, self.right_key))
        return result

    def _keyed(self, df: DataFrame, key: str) -> DataFrame:
        return df if self.null_safe else df.filter(col(key).isNotNull())

    def _unmatched(self, kept, kept_key, other, other_key, few: bool) -> DataFrame:
        """Rows without a partner; a row with a null key stays, as it finds none."""
        keys = self._keyed(other, other_key).select(col(other_key)).distinct()
        keys = F.broadcast(keys) if few else keys
        return kept.join(keys, self._same(col(kept_key), col(other_key)), "left_anti")

    def _padded(self, rows: DataFrame, missing: DataFrame, key: str) -> DataFrame:
        nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in missing.schema]
        return self._output(rows.select("*", *nulls), col(key))


def _among(key: Column, keys: Sequence[Any]) -> Column:
    """Whether a key is one of these; false for null."""
    return F.coalesce(key.isin(list(keys)), F.lit(False))


def _null_salt(df: DataFrame, key: str) -> Column:
    """0 for a row with a key; for one without, a number that depends on its values."""
    spread = F.pmod(F.xxhash64(*[col(c) for c in df.columns]), F.lit(NULL_SPREAD))
    return F.when(col(key).isNull(), spread).otherwise(F.lit(0).cast("bigint"))
