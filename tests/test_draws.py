"""Draws: one-to-one, repeatable, spread out, and as patterns say."""

import collections
import datetime as dt
import math
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from joinwright.functions import (
    drawn_string,
    hash32,
    hash63,
    literal,
    pattern_regex,
    permuted,
    stream,
    stride,
    unique_room,
    unique_string,
)
from joinwright.functions import draws
from joinwright.functions.draws import HIGH, LOW, MASK32, MIX, PRIME


def values(spark, n, sql, start=0):
    return [r.v for r in spark.range(start, start + n).selectExpr(f"{sql} AS v").collect()]


def spelled(spark, n, spelling):
    rows = spark.range(n).selectExpr("*", *[f"{v} AS {k}" for k, v in spelling.numbers.items()])
    return [r.v for r in rows.selectExpr(f"{spelling.text} AS v").collect()]


@given(st.integers(1, 1 << 62))
def test_stride_has_no_common_divisor(size):
    step = stride(size)
    assert math.gcd(step, size) == 1
    assert 1 <= step and step * (size - 1) + MASK32 < 1 << 63


@pytest.mark.parametrize("size", [1, 2, 7, 1000, 1001, 4096])
def test_permutation_uses_every_value_once(spark, size):
    assert sorted(values(spark, size, permuted("id", size, 123456789))) == list(range(size))


@pytest.mark.parametrize("size", [9, 10, 11, 16, 50, 63, 64, 65, 200])
def test_permutation_in_blocks_uses_every_value_once(spark, size, monkeypatch):
    monkeypatch.setattr(draws, "WIDE", 8)
    monkeypatch.setattr(draws, "BLOCKS", 8)
    assert sorted(values(spark, size, permuted("id", size, 123456789))) == list(range(size))


@pytest.mark.parametrize("size", [1000, 1 << 31, 1 << 33, 1 << 45, 1 << 62])
def test_few_slots_are_spread_over_the_whole_range(spark, size):
    found = sorted(values(spark, 500, permuted("id", size, 99)))
    tenths = [v * 10 // size for v in found]
    assert all(20 < tenths.count(t) < 90 for t in range(10))


@pytest.mark.parametrize("size", [1 << 32, 52**6 * 10**5, 1 << 62])
def test_permutation_of_a_large_range_does_not_overflow(spark, size):
    found = values(spark, 1000, permuted("id", size, MASK32), start=size - 1000)
    assert len(set(found)) == 1000
    assert all(0 <= v < size for v in found)


def by_hand(i, s):
    x = ((i ^ s) % PRIME * LOW + (i >> 32) * HIGH) % PRIME
    x = ((x ^ (x >> 16)) * MIX) & MASK32
    return x ^ (x >> 15)


@pytest.mark.parametrize("start", [0, (1 << 32) - 50, 10**12])
def test_hash_is_the_formula(spark, start):
    s = stream(1, "t.c")
    assert values(spark, 100, hash32("id", s), start) == [by_hand(start + i, s) for i in range(100)]
    wide = [(by_hand(i, s) >> 1 << 32) + by_hand(i, s ^ MASK32) for i in range(start, start + 100)]
    assert values(spark, 100, hash63("id", s), start) == wide


@pytest.mark.parametrize("sides", [2, 10, 52])
def test_hash_is_even(spark, sides):
    n = 50_000
    rows = spark.range(n).selectExpr(f"{hash32('id', stream(5, 'x'))} % {sides} AS v")
    counts = [r["count"] for r in rows.groupBy("v").count().collect()]
    mean = n / sides
    assert len(counts) == sides
    assert sum((c - mean) ** 2 / mean for c in counts) < 2.5 * sides


def test_streams_differ():
    assert len({stream(s, f"t.c{c}") for s in range(20) for c in range(20)}) == 400


@pytest.mark.parametrize(
    "value",
    [0, -5, 1 << 40, 1.5, -2e-7, True, None, dt.date(1200, 1, 1), "it's", 'a\\b"c\n', "№ é"],
)
def test_literals_are_read_back(spark, value):
    assert spark.range(1).selectExpr(f"{literal(value)} AS v").first().v == value


@pytest.mark.parametrize("pattern", ["?###???#?#?", "AB-#?", "a.b#", "#", "x", "?" * 30])
def test_drawn_strings_fit_the_pattern(spark, pattern):
    letters = "abcXYZ.-]"
    found = spelled(spark, 300, drawn_string("c", "id", pattern, letters, 77))
    assert all(re.fullmatch(pattern_regex(pattern, letters), v) for v in found)
    room = unique_room(pattern, letters)
    assert len(set(found)) > (0.6 * 300 if room > 2000 else 0)


def test_optional_digits(spark):
    regex = pattern_regex("a!%@", "x")
    found = spelled(spark, 2000, drawn_string("c", "id", "a!%@", "x", 3))
    assert all(re.fullmatch(regex, v) for v in found)
    assert collections.Counter(len(v) for v in found).keys() == {2, 3, 4}
    with pytest.raises(ValueError, match="optional"):
        unique_string("c", "id", 5, "a!", "x", 3)


@pytest.mark.parametrize("pattern,letters", [("?##", "ab"), ("#-??", "aabc"), ("?##?", "ab")])
def test_unique_strings_use_the_whole_room(spark, pattern, letters):
    room = unique_room(pattern, letters)
    found = spelled(spark, room, unique_string("c", "id", room, pattern, letters, 9))
    assert len(set(found)) == room
    assert all(re.fullmatch(pattern_regex(pattern, letters), v) for v in found)
    with pytest.raises(ValueError, match="needed"):
        unique_string("c", "id", room + 1, pattern, letters, 9)


@settings(max_examples=50)
@given(st.text(alphabet="?#ab.*[]\\^-", max_size=8), st.text(alphabet="x.]^-\\", min_size=1))
def test_pattern_regex_is_well_formed(pattern, letters):
    regex = re.compile(pattern_regex(pattern, letters))
    example = pattern.replace("?", letters[0]).replace("#", "0")
    assert regex.fullmatch(example)
    assert not regex.fullmatch(example + "!")
