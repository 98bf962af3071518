"""Division of values among tables, checked row by row without Spark."""

import itertools

import pytest
from hypothesis import assume, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from joinwright.functions import stride
from joinwright.plans.pools import Member, Pool
from joinwright.spec import Column, SpecError


def value(piece, row):
    """What the piece's expression gives for a row."""
    cell = piece.cell
    place = ((piece.slot + row - piece.start) * stride(cell.room)) % cell.room
    return cell.values[place] if cell.values is not None else cell.lo + place


def rows_of(pool, member):
    out = []
    for piece in pool.pieces[member]:
        assert piece.start == len(out)
        out += [value(piece, r) for r in range(piece.start, piece.stop)]
    return out


def member(name, column, size, copied):
    return Member(name, column, size, copied)


def check(members):
    pool = Pool(members, 0).allot()
    columns = [rows_of(pool, m) for m in range(len(members))]
    for m, (found, given_) in enumerate(zip(columns, members)):
        assert len(found) == given_.size == len(set(found))
        column = given_.column
        if column.values is not None:
            assert set(found) <= set(column.values)
        else:
            assert all(column.bounds[0] <= v <= column.bounds[1] for v in found)
        if m:
            assert found[: given_.copied] == columns[0][: given_.copied]
    for (a, found), (b, other) in itertools.combinations(enumerate(columns), 2):
        # a table shares with an earlier one just the rows that both copy
        both = members[b].copied if a == 0 else min(members[a].copied, members[b].copied)
        assert len(set(found) & set(other)) == both


def ranges(tables):
    return st.lists(
        st.tuples(st.integers(0, 60), st.integers(0, 60), st.integers(1, 25)),
        min_size=tables, max_size=tables,
    )


def possible(members):
    """Whether the needs can be met, by Hall's condition over all stretches of values."""
    pool = Pool(members, 0)
    needs = []
    for start, stop, sharing in pool._stretches():
        lo = max(members[m].column.bounds[0] for m in sharing)
        hi = min(members[m].column.bounds[1] for m in sharing)
        needs.append((lo, hi, stop - start))
    if any(lo > hi for lo, hi, _ in needs):
        return False
    return all(
        sum(n for lo, hi, n in needs if a <= lo and hi <= b) <= b - a + 1
        for a in {lo for lo, _, _ in needs}
        for b in {hi for _, hi, _ in needs}
        if a <= b
    )


@settings(max_examples=300, deadline=None)
@given(ranges(3), st.integers(0, 20), st.integers(0, 20))
def test_ranges_are_divided_whenever_they_can_be(bounds, k1, k2):
    k1, k2 = max(k1, k2), min(k1, k2)
    sizes = [n for _, _, n in bounds]
    assume(k1 <= min(sizes[:2]) and k2 <= sizes[2])
    members = []
    for i, (a, b, n) in enumerate(bounds):
        column = Column("k", T.IntegerType(), bounds=(min(a, b), max(a, b)))
        members.append(member(f"t{i}", column, n, (0, k1, k2)[i]))
    if possible(members):
        check(members)
    else:
        with pytest.raises(SpecError):
            check(members)


@settings(max_examples=200, deadline=None)
@given(
    st.sets(st.integers(0, 40), min_size=5),
    st.sets(st.integers(0, 40), min_size=5),
    st.tuples(st.integers(0, 40), st.integers(0, 40)),
    st.integers(0, 5),
)
def test_lists_and_ranges(first, second, bounds, k):
    lists = [tuple(sorted(s)) for s in (first, second)]
    columns = [
        Column("k", T.IntegerType(), values=lists[0], repeatable=False),
        Column("k", T.IntegerType(), values=lists[1], repeatable=False),
        Column("k", T.IntegerType(), bounds=(min(bounds), max(bounds))),
    ]
    for one, other in itertools.permutations(columns, 2):
        members = [member("a", one, 5, 0), member("b", other, 5, k)]
        try:
            check(members)
        except SpecError:
            pass


def test_doubles_with_one_value_in_common():
    columns = [Column("k", T.DoubleType(), bounds=b) for b in ((0.0, 1.0), (1.0, 2.0))]
    pool = Pool([member("a", columns[0], 9, 0), member("b", columns[1], 9, 1)], 0).allot()
    assert pool.pieces[0][0].cell.values == (1.0,) == pool.pieces[1][0].cell.values
    with pytest.raises(SpecError):
        Pool([member("a", columns[0], 9, 0), member("b", columns[1], 9, 2)], 0).allot()
