"""Comparison finds planted differences and nothing else."""

import datetime as dt

import pytest

from joinwright.operators.compare import (
    SchemaMismatch,
    assert_equal,
    cell_difference,
    cells_by_place,
    check_schemas,
    difference_counts,
    equal,
    row_difference,
    same_cells,
)

ROWS = [
    (1, "a", 1.5, dt.date(2020, 1, 1), True),
    (2, "b", 2.5, None, False),
    (3, None, float("nan"), dt.date(2020, 1, 3), None),
    (3, None, float("nan"), dt.date(2020, 1, 3), None),
    (4, "d", 0.0, dt.date(2020, 1, 4), True),
]
SCHEMA = "k int, s string, x double, d date, f boolean"


def made(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_equal_in_any_row_and_column_order(spark):
    a = made(spark, ROWS)
    b = made(spark, ROWS[::-1]).select("f", "x", "k", "d", "s")
    assert equal(a, b)
    assert not equal(a, b, ignore_column_order=False)
    assert difference_counts(row_difference(a, b)).first() == (0, 0)


@pytest.mark.parametrize(
    "rows,missing,unexpected",
    [
        (ROWS[1:], 1, 0),
        (ROWS + [ROWS[0]], 0, 1),
        (ROWS[:3] + ROWS[4:], 1, 0),
        (ROWS + [ROWS[2]] * 5, 0, 5),
        ([(1, "A", *ROWS[0][2:])] + ROWS[1:], 1, 1),
        ([], 5, 0),
    ],
)
def test_planted_differences(spark, rows, missing, unexpected):
    a, b = made(spark, ROWS), made(spark, rows)
    assert not equal(a, b)
    assert difference_counts(row_difference(a, b)).first() == (missing, unexpected)


def test_differences_show_rows_and_copies(spark):
    a, b = made(spark, ROWS), made(spark, ROWS[:2] + [ROWS[4]] * 4)
    found = {(r.k, r.side, r.copies) for r in row_difference(a, b).collect()}
    assert found == {(3, "left", 2), (4, "right", 3)}


def test_schemas_come_first(spark):
    a = made(spark, ROWS)
    for b in (
        a.drop("f"),
        a.withColumnRenamed("f", "g"),
        a.withColumn("k", a.k.cast("bigint")),
        a.withColumn("extra", a.k),
    ):
        assert not equal(a, b)
        with pytest.raises(SchemaMismatch):
            row_difference(a, b)
    with pytest.raises(SchemaMismatch, match="k int"):
        check_schemas(a, a.drop("k"))


def test_rounding(spark):
    a = spark.createDataFrame([(1, 0.1 + 0.2)], "k int, x double")
    b = spark.createDataFrame([(1, 0.3)], "k int, x double")
    assert not equal(a, b)
    assert equal(a, b, digits=9)
    assert same_cells(a, b, "k") is False


def test_cells(spark):
    schema = "k int, s string, x double"
    a = spark.createDataFrame([(1, "a", 1.0), (2, None, 2.0), (3, "c", 3.0), (4, "d", 4.0)], schema)
    b = spark.createDataFrame([(1, "a", 1.5), (2, "z", None), (3, "c", 3.0), (5, "e", 5.0)], schema)
    found = {(r.k, r.column, r.left_value, r.right_value) for r in cell_difference(a, b, "k").collect()}
    assert found == {
        (1, "x", "1.0", "1.5"),
        (2, "s", None, "z"),
        (2, "x", "2.0", None),
        (4, None, "present", None),
        (5, None, None, "present"),
    }
    assert not same_cells(a, b, "k")
    assert same_cells(a, a.select("x", "s", "k"), "k")


def test_repeated_key_is_reported_once(spark):
    a = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, s string")
    b = spark.createDataFrame([(1, "x"), (1, "y"), (1, "b"), (2, "c")], "k int, s string")
    found = [tuple(r) for r in cell_difference(a, b, "k").collect()]
    assert found == [(1, "*", "1", "2")]


def test_cells_by_two_keys_and_dotted_names(spark):
    a = spark.createDataFrame([(1, 1, "a")], "k int, j int, `t.s` string")
    b = spark.createDataFrame([(1, 1, "b")], "k int, j int, `t.s` string")
    assert [tuple(r) for r in cell_difference(a, b, ["k", "j"]).collect()] == [
        (1, 1, "t.s", "a", "b")
    ]


def test_assert_equal_shows_rows(spark):
    a = made(spark, ROWS)
    assert_equal(a, made(spark, ROWS[::-1]))
    with pytest.raises(AssertionError, match="'k': 3.*'side': 'left', 'copies': 2"):
        assert_equal(a, made(spark, ROWS[:2] + ROWS[4:]))
    with pytest.raises(AssertionError, match="columns differ"):
        assert_equal(a, a.drop("k"))


def test_columns_called_as_the_results_own(spark):
    names = "side int, copies int, left int, right int, left_row int, column int, weight int"
    a = spark.createDataFrame([(1,) * 7, (2,) * 7, (2,) * 7], names)
    b = spark.createDataFrame([(1,) * 7, (2,) * 7, (3, 1, 3, 3, 3, 3, 3)], names)
    found = row_difference(a, b)
    assert found.columns[-2:] == ["side_", "copies_"]
    assert sorted((r.side, r.side_, r.copies_) for r in found.collect()) == [(2, "left", 1), (3, "right", 1)]
    assert tuple(difference_counts(found).first()) == (1, 1)
    assert not equal(a, b) and equal(a, a)
    b = spark.createDataFrame([(1,) * 7, (2, 9, 2, 2, 2, 2, 2), (2,) * 7], names)
    for key in ("left", "column", "left_row"):
        a_, b_ = (df.filter("copies <> 2 OR side = 1").union(df.filter("copies = 2").limit(0)) for df in (a, b))
        cells = cell_difference(a_, b_, key)
        assert cells.columns[0] == key and len(set(cells.columns)) == 4
        cells.collect()


# -------------------------------------------------- repeated keys, and by place


def repeated_rows(spark):
    left = [(1, "a", 1, 1.0), (1, "a", 2, 1.0), (1, "b", 3, None), (1, "b", 3, None), (2, "x", 1, 0.5), (3, "y", 1, 1.5), (None, "n", 1, 1.0), (None, "n", 2, 1.0)]
    right = [(1, "a", 1, 9.0), (1, "c", 2, 1.0), (1, "b", 3, None), (1, "b", 4, None), (3, "y", 1, 1.5), (3, "z", 1, 1.5), (None, "n", 1, 1.0), (None, "m", 5, 7.0)]
    schema = "k int, s string, n int, x double"
    return spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)


def test_rows_of_a_repeated_key_are_paired(spark):
    left, right = repeated_rows(spark)
    found = {tuple(r) for r in cell_difference(left, right, "k", repeated="pair").collect()}
    assert found == {
        (1, "x", "1.0", "9.0"), (1, "s", "a", "c"), (1, "n", "3", "4"),  # one cell each
        (2, None, "present", None), (3, None, None, "present"),
        (None, "s", "n", "m"), (None, "n", "2", "5"), (None, "x", "1.0", "7.0"),  # what is left over
    }
    assert cell_difference(left, left, "k", repeated="pair").collect() == []
    with pytest.raises(ValueError, match="counted or paired"):
        cell_difference(left, right, "k", repeated="first")


def test_pairs_of_a_hot_key_are_one_to_one(spark):
    """Every row of one key, with one cell of each changed and some rows lacking."""
    left = spark.range(300).selectExpr("1 AS k", "id AS a", "id * 2 AS b", "CAST(id % 3 AS STRING) AS c")
    changed = left.selectExpr("k", "IF(a % 2 = 0, -a - 1, a) AS a", "IF(a % 2 = 1, -b, b) AS b", "c").filter("abs(b) < 580")
    found = cell_difference(left, changed, "k", repeated="pair").collect()
    want = {(1, "a", str(i), str(-i - 1)) for i in range(0, 290, 2)} | {(1, "b", str(2 * i), str(-2 * i)) for i in range(1, 290, 2)}
    assert {tuple(r) for r in found if r["column"]} == want
    assert [tuple(r) for r in found if not r["column"]] == [(1, None, "present", None)] * 10


def test_rows_without_a_key_are_compared_by_place(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (3, "z")], "n int, place string")
    right = spark.createDataFrame([(2, "q"), (1, "b"), (1, "a")], "n int, place string")
    found = cells_by_place(left, right, "n", place="at").collect()
    assert {tuple(r) for r in found} == {(2, "place", None, "q"), (3, None, "present", None)}
    assert cells_by_place(left, left.repartition(3), "n", place="at").collect() == []
    assert cells_by_place(left.limit(0), left.limit(0), "n").collect() == []
    with pytest.raises(SchemaMismatch):
        cells_by_place(left, right.drop("place"), "n")
