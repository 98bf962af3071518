"""N tables joined one after the other, with an optional filter after each join."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col
from ..operators.joins import UNSPLIT, Hot, equi_join, heavy_keys, splits
from ..operators.project import shared_columns
from ..sources.scratch import cut
from ..spec import join_type_of


@dataclass(frozen=True)
class Step:
    """One join of the chain; see :func:`joinwright.operators.joins.equi_join`.

    ``where`` is SQL text over the joined columns, or several that must all hold.  It is
    applied after this join and before the next; a row for which it is null is dropped.
    """

    on: str | tuple[str, str]
    how: str = "inner"
    where: str | tuple[str, ...] | None = None
    null_safe: bool = False
    hot: Hot = ()

    @property
    def keys(self) -> tuple[str, str]:
        return (self.on, self.on) if isinstance(self.on, str) else tuple(self.on)

    @property
    def conditions(self) -> tuple[str, ...]:
        if self.where is None:
            return ()
        return (self.where,) if isinstance(self.where, str) else tuple(self.where)


@dataclass(frozen=True)
class Joined:
    """Tables joined so far, and the table each column first came from."""

    frame: DataFrame
    owners: Mapping[str, str] = field(default_factory=dict)
    derived: bool = False

    @classmethod
    def start(cls, name: str, frame: DataFrame) -> Joined:
        return cls(frame, {c: name for c in frame.columns})

    def then(self, name: str, right: DataFrame, step: Step) -> Joined:
        """Join the next table.

        A name both sides have, other than that of the one key column, becomes
        ``<table>.<column>`` on either side.
        """
        if self.derived and splits(step.how, step.hot):
            return replace(self, frame=cut(self.frame), derived=False).then(name, right, step)
        left_key, right_key = step.keys
        kept = {left_key} if left_key == right_key else set()
        clashes = [c for c in shared_columns(self.frame.columns, right.columns) if c not in kept]
        on_left = {c: f"{self.owners[c]}.{c}" for c in clashes}
        on_right = {c: f"{name}.{c}" for c in clashes}
        keys = on_left.get(left_key, left_key), on_right.get(right_key, right_key)
        frame = equi_join(
            self.frame.withColumnsRenamed(on_left),
            right.withColumnsRenamed(on_right),
            keys[0] if keys[0] == keys[1] else keys,
            step.how,
            step.null_safe,
            step.hot,
        )
        owners = {on_left.get(c, c): t for c, t in self.owners.items()}
        for c in right.columns:
            owners.setdefault(on_right.get(c, c), name)
        return Joined(frame, owners, True).where(*step.conditions)

    def where(self, *conditions: str) -> Joined:
        frame = self.frame
        for condition in conditions:
            frame = frame.filter(F.expr(condition))
        return replace(self, frame=frame)


def chain_results(
    tables: Mapping[str, DataFrame], steps: Sequence[Step], checkpoint: bool = False
) -> list[DataFrame]:
    """The joined table after each step, in the order of ``tables``.

    The whole chain is one plan that reads every table once.  Before a step whose
    hot keys have to be split, which reads its sides twice or more, the result so far is
    computed once and kept in the shared folder.  With ``checkpoint`` so is every
    result but the last.
    """
    return [j.frame for j in _chain(tables, steps, checkpoint)]


def _chain(
    tables: Mapping[str, DataFrame], steps: Sequence[Step], checkpoint: bool = False
) -> list[Joined]:
    names = list(tables)
    if len(steps) != len(names) - 1:
        raise ValueError("a chain of N tables needs N - 1 steps")
    joined = Joined.start(names[0], tables[names[0]])
    results = []
    for i, (name, step) in enumerate(zip(names[1:], steps), start=1):
        joined = joined.then(name, tables[name], step)
        if checkpoint and i < len(steps):
            joined = Joined(cut(joined.frame), joined.owners)
        results.append(joined)
    return results


def measured(
    tables: Mapping[str, DataFrame], steps: Sequence[Step], share: float = 0.05
) -> list[Step]:
    """The steps with the keys in ``hot`` that have more than this share of a side's rows.

    Only sides on which a hot key would not be split anyway are measured.  A table's key
    column is summarised in one pass.  How often a key occurs in what is joined so far is
    carried along the chain: tables are reduced to keys and numbers of rows, and joining
    multiplies these, so no rows are paired to find out.
    """
    names, out = list(tables), []
    counted: list[Joined] | None = None
    for i, step in enumerate(steps, start=1):
        left_key, right_key = step.keys
        hot = {}
        for side in UNSPLIT.get(join_type_of(step.how), ()):
            if side == "right":
                hot[side] = heavy_keys(tables[names[i]], right_key, share)
            elif i == 1:
                hot[side] = heavy_keys(tables[names[0]], left_key, share)
            else:
                counted = counted or [j for j, _ in _counted(tables, steps)]
                frame = counted[i - 2].frame
                if left_key in frame.columns:
                    hot[side] = heavy_keys(frame, left_key, share, f"rows {i - 1}")
        out.append(replace(step, hot={s: tuple(k) for s, k in hot.items() if k}))
    return out


def join_chain(
    tables: Mapping[str, DataFrame], steps: Sequence[Step], checkpoint: bool = False
) -> DataFrame:
    """The last table of :func:`chain_results`."""
    return chain_results(tables, steps, checkpoint)[-1]


def chain_counts(tables: Mapping[str, DataFrame], steps: Sequence[Step]) -> list[DataFrame]:
    """Number of rows after each step, one frame with a column ``rows`` each.

    Nothing is paired to be counted: every table is reduced to its keys and the
    number of rows with them, and joining multiplies these numbers.  So a key
    with many rows on both sides costs no more than any other.  Every table is read
    once, as each step's numbers are kept in the shared folder for the next.

    A condition on one table's columns is judged before that table is reduced, and only whether
    it holds is kept; for other conditions their columns are kept as if they were keys, up
    to the step that has them.  Conditions are told apart as a step gives them, so
    ``where=("a > 1", "b < 2")`` is kept smaller than ``where="a > 1 AND b < 2"``.
    """
    return [rows for _, rows in _counted(tables, steps)]


def _counted(
    tables: Mapping[str, DataFrame], steps: Sequence[Step]
) -> list[tuple[Joined, DataFrame]]:
    """After each step the keys with their numbers of rows, ``rows 1`` and so on, and the sum."""
    names = list(tables)
    if len(steps) != len(names) - 1:
        raise ValueError("a chain of N tables needs N - 1 steps")
    weighed = [_Weighed(n, tables[n], steps) for n in names]
    judged = _judged(tables, steps, dict(zip(names, weighed)))
    joined = Joined.start(names[0], weighed[0].frame("rows 0"))
    counts = []
    for i, (name, step) in enumerate(zip(names[1:], steps), start=1):
        right = weighed[i].frame(f"rows {i}")
        joined = joined.then(name, right, replace(step, where=None, hot=()))
        before, here = col(f"rows {i - 1}"), col(f"rows {i}")
        weight = F.coalesce(before, F.lit(1)) * F.coalesce(here, F.lit(1))
        frame = joined.frame.withColumn("__weight", weight).drop(f"rows {i - 1}", f"rows {i}")
        for condition in judged[i - 1]:
            frame = condition.applied(frame)
        later = _later_keys(frame.columns, steps[i:])
        later += [c for c in frame.columns if any(x.needs(c) for own in judged[i:] for x in own)]
        total = f"rows {i}"
        frame = frame.groupBy(*[col(c) for c in dict.fromkeys(later)]).agg(
            F.sum("__weight").alias(total)
        )
        if i < len(steps):
            frame = cut(frame)  # what counts this step and is joined in the next
        joined = Joined(frame, {**joined.owners, total: name})
        counts.append((joined, frame.agg(F.coalesce(F.sum(col(total)), F.lit(0)).alias("rows"))))
    return counts


class _Weighed:
    """A table that is to be reduced to its keys, what conditions need, and numbers of rows."""

    def __init__(self, name: str, df: DataFrame, steps: Sequence[Step]):
        keys = {k for s in steps for k in s.keys}
        keys |= {k.rsplit(".", 1)[-1] for k in keys}
        self.name, self.df = name, df
        self.columns = {c: col(c) for c in df.columns if c in keys}

    def frame(self, weight: str) -> DataFrame:
        grouped = self.df.groupBy(*[c.alias(n) for n, c in self.columns.items()])
        return grouped.agg(F.count("*").alias(weight))


@dataclass(frozen=True)
class _Judged:
    """A condition as the reduced tables can tell it.

    ``columns`` are those that hold it, kept for nothing else.  With ``absent``, the one column
    says whether it holds (1 or 0), and ``absent`` whether it does where the table has no row;
    otherwise ``names`` gives the joined columns' names, over which it is SQL, beside ``keys``.
    """

    condition: str
    columns: tuple[str, ...]
    absent: bool | None = None
    names: Mapping[str, str] = field(default_factory=dict)
    keys: frozenset[str] = frozenset()

    def needs(self, column: str) -> bool:
        return column in self.columns or column.rsplit(".", 1)[-1] in self.keys

    def applied(self, frame: DataFrame) -> DataFrame:
        if self.absent is not None:
            held = F.coalesce(col(self.columns[0]), F.lit(int(self.absent)))
            return frame.filter(held == 1)
        named = frame.withColumns({n: col(c) for n, c in self.names.items()})
        return named.filter(F.expr(self.condition)).select([col(c) for c in frame.columns])


def _judged(
    tables: Mapping[str, DataFrame], steps: Sequence[Step], weighed: Mapping[str, _Weighed]
) -> list[list[_Judged]]:
    """For each step its conditions; their columns are added to the tables to be reduced."""
    if not any(s.conditions for s in steps):
        return [[] for _ in steps]
    # Only the names are looked at; nothing runs.
    chain = _chain(tables, [replace(s, hot=(), where=None) for s in steps])
    out: list[list[_Judged]] = []
    merged: set[str] = set()  # keys of one name, filled from either side
    for i, (step, joined) in enumerate(zip(steps, chain)):
        merged |= {step.keys[0]} if step.keys[0] == step.keys[1] else set()
        own: list[_Judged] = []
        for n, condition in enumerate(step.conditions):
            used = [c for c in joined.frame.columns if _named(c, condition)]
            owners = {joined.owners[c] for c in used}
            if len(owners) == 1 and not merged & set(used):
                own.append(_of_one_table(weighed[owners.pop()], condition, used, f"held {i} {n}"))
                continue
            names = {}
            for c in used:
                table = weighed[joined.owners[c]]
                source = _own_name(c, table)
                if c not in merged and source not in table.columns:
                    kept = f"{table.name}: {source}"
                    table.columns[kept] = col(source)
                    names[c] = kept
                elif f"{table.name}: {source}" in table.columns:
                    names[c] = f"{table.name}: {source}"
            keys = frozenset(c.rsplit(".", 1)[-1] for c in used if c not in names)
            own.append(_Judged(condition, tuple(names.values()), names=names, keys=keys))
        out.append(own)
    return out


def _own_name(column: str, table: _Weighed) -> str:
    return column if column in table.df.columns else column.removeprefix(f"{table.name}.")


def _named(column: str, condition: str) -> bool:
    """Whether the name occurs in a condition; to keep a column too many does no harm."""
    name = re.escape(column.replace("`", "``"))
    return re.search(rf"(?<!\w){name}(?!\w)", condition, re.IGNORECASE) is not None


def _of_one_table(table: _Weighed, condition: str, used: Sequence[str], name: str) -> _Judged:
    own = {c: _own_name(c, table) for c in used}
    holds = F.coalesce(F.expr(condition), F.lit(False)).cast("int")
    nulls = [F.lit(None).cast(table.df.schema[s].dataType).alias(c) for c, s in own.items()]
    absent = table.df.sparkSession.range(1).select(nulls or [F.lit(0)]).select(holds).first()[0]
    table.df = table.df.withColumns({c: col(s) for c, s in own.items() if s != c})
    table.columns[name] = holds
    return _Judged(condition, (name,), absent=bool(absent))


def _later_keys(columns: Sequence[str], steps: Sequence[Step]) -> list[str]:
    """Columns of the joined table that a later step may join on or clash with."""
    wanted = {k for s in steps for k in s.keys} | {
        k.rsplit(".", 1)[-1] for s in steps for k in s.keys
    }
    return [c for c in columns if c in wanted]
