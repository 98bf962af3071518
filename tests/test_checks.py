"""Each check passes on clean data and finds a planted fault."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from joinwright.operators import checks as C
from joinwright.operators.checks import shared_values


@pytest.fixture(scope="module")
def tables(spark):
    a = [(i, float(i), dt.date(2020, 1, 1) + dt.timedelta(i), f"A{i % 10}", str(i)) for i in range(20)]
    b = [(i + 15, "x") for i in range(10)]
    return {
        "a": spark.createDataFrame(a, "id int, x double, d date, code string, n string"),
        "b": spark.createDataFrame(b, "id int, n string"),
        "hot": spark.range(300).selectExpr("CASE WHEN id % 3 = 0 THEN NULL ELSE id % 7 END AS v"),
        "empty": spark.createDataFrame([], "id int, d date, x double"),
    }


def outcome(tables, check):
    rows = C.report(tables, check if isinstance(check, list) else [check]).collect()
    return [(r.expected, r.actual, r.violations) for r in rows]


def one(tables, check):
    (row,) = outcome(tables, check)
    return row


def test_row_count(tables):
    assert one(tables, C.row_count("a", 20)) == (20, 20, 0)
    assert one(tables, C.row_count("a", 23)) == (23, 20, 3)
    assert one(tables, C.row_count("empty", 0)) == (0, 0, 0)


def test_range(tables):
    assert one(tables, C.in_range("a", "id", 0, 19))[2] == 0
    assert one(tables, C.in_range("a", "id", 1, 17)) == (20, 17, 3)
    assert one(tables, C.in_range("a", "x", 0.5, 18.5)) == (20, 18, 2)
    assert one(tables, C.in_range("a", "d", dt.date(2020, 1, 1), dt.date(2020, 1, 10)))[2] == 10
    assert one(tables, C.in_range("hot", "v", 0, 6))[2] == 0


def test_domain_short_long_and_table(spark, tables):
    codes = [f"A{i}" for i in range(10)]
    assert one(tables, C.in_domain("a", "code", codes))[2] == 0
    assert one(tables, C.in_domain("a", "code", codes[:9])) == (20, 18, 2)
    long = codes[:9] + [f"Z{i}" for i in range(C.SHORT_LIST)]
    assert isinstance(C.in_domain("a", "code", long), C.GroupCheck)
    assert one(tables, C.in_domain("a", "code", long)) == (20, 18, 2)
    listed = spark.createDataFrame([(c,) for c in codes[:9] * 2], "c string")
    assert one(tables, C.in_domain("a", "code", listed)) == (20, 18, 2)
    zeros = sum(1 for i in range(300) if i % 3 and i % 7 == 0)
    found = one(tables, C.in_domain("hot", "v", spark.range(1, 7).toDF("v")))
    assert found == (300, 300 - zeros, zeros)


def test_unique(tables):
    assert one(tables, C.unique("a", "id")) == (20, 20, 0)
    assert one(tables, C.unique("a", "code")) == (20, 10, 10)
    assert one(tables, C.unique("a", "code", "id"))[2] == 0
    assert one(tables, C.unique("empty", "id")) == (0, 0, 0)


def test_repeated_keys(tables):
    found = {r.code: r.rows for r in C.repeated_keys(tables["a"], ["code"]).collect()}
    assert found == {f"A{i}": 2 for i in range(10)}


def test_pattern(tables):
    assert one(tables, C.matches_pattern("a", "code", "?#", "A"))[2] == 0
    assert one(tables, C.matches_pattern("a", "code", "?#", "B"))[2] == 20
    assert one(tables, C.matches_pattern("a", "n", "#", "B"))[2] == 10


def test_list_length(tables):
    assert one(tables, C.list_long_enough("a", "n"))[2] == 0
    assert one(tables, C.list_long_enough("a", "code")) == (20, 10, 10)


def test_types(tables):
    assert one(tables, C.converts("a", "n", "IntegerType"))[2] == 0
    assert one(tables, C.converts("a", "code", "IntegerType"))[2] == 20
    ways = C.report(tables, C.same_type(tables, "b", "a")).collect()
    assert {(r.column, r.violations) for r in ways} == {("id", 0), ("n", 0)}
    renamed = {**tables, "c": tables["b"].selectExpr("n AS id")}
    assert one(renamed, C.same_type(renamed, "c", "a")) == (10, 0, 10)


def test_nulls(tables):
    assert one(tables, C.not_null("a", "id"))[2] == 0
    assert one(tables, C.not_null("hot", "v")) == (300, 200, 100)
    declared = T.StructType(
        [T.StructField("v", T.LongType(), False), T.StructField("w", T.LongType(), True)]
    )
    assert one(tables, C.declared_not_null("hot", declared))[2] == 100


def test_capacity_counts_both_ends(tables):
    assert one(tables, C.capacity("a", "id")) == (20, 20, 0)
    assert one(tables, C.capacity("a", "id", (0, 19)))[2] == 0
    assert one(tables, C.capacity("a", "id", (0, 18))) == (20, 19, 1)
    assert one(tables, C.capacity("a", "d")) == (20, 20, 0)
    assert one(tables, C.capacity("a", "d", (dt.date(2020, 1, 1), dt.date(2020, 1, 5)))) == (20, 5, 15)
    assert one(tables, C.capacity("a", "x"))[2] == 0
    assert one(tables, C.capacity("a", "x", (1.0, 1.0))) == (20, 1, 19)
    assert one(tables, C.capacity("empty", "id")) == (0, 0, 0)


def test_key_and_value_overlap(tables):
    assert one(tables, C.key_overlap("a", "b", "id", 5)) == (5, 5, 0)
    assert one(tables, C.key_overlap("a", "b", "id", 4)) == (4, 5, 1)
    assert one(tables, C.value_overlap("a", "b", "id", 4)) == (4, 5, 0)
    assert one(tables, C.value_overlap("a", "b", "id", 9)) == (9, 5, 4)
    assert sorted(r.id for r in shared_values(tables["a"], tables["b"], "id").collect()) == [
        15, 16, 17, 18, 19
    ]
    assert one(tables, C.key_overlap("hot", "a", ("v", "id"), 7)) == (7, 7, 0)


def test_range_overlap(tables):
    assert one(tables, C.range_overlap("a", "b", "id", 5)) == (5, 5, 0)
    assert one(tables, C.range_overlap("b", "a", "id", 6)) == (6, 5, 1)
    assert one(tables, C.range_overlap("a", "b", "id", 3, right_bounds=(100, 200))) == (3, 0, 3)
    assert one(tables, C.range_overlap("a", "b", "id", 3, left_bounds=(0, 16))) == (3, 2, 1)
    days = (dt.date(2020, 1, 15), dt.date(2020, 3, 1))
    assert one(tables, C.range_overlap("a", "a", "d", 6, right_bounds=days)) == (6, 6, 0)
    assert one(tables, C.range_overlap("a", "a", "x", 6, right_bounds=(3.0, 4.0))) == (6, 6, 0)
    assert one(tables, C.range_overlap("a", "a", "x", 6, right_bounds=(19.0, 40.0))) == (6, 1, 5)
    assert one(tables, C.range_overlap("a", "a", "x", 6, right_bounds=(20.0, 40.0))) == (6, 0, 6)


def test_values_in_range(tables):
    assert one(tables, C.values_in_range("a", "b", "id", 5)) == (5, 5, 0)
    assert one(tables, C.values_in_range("b", "a", "id", 6)) == (6, 5, 1)
    assert one(tables, C.values_in_range("a", "b", "id", 3, bounds=(0, 1))) == (3, 2, 1)
    assert one(tables, C.values_in_range("hot", "a", ("v", "id"), 7)) == (7, 7, 0)


def test_report_scans_a_table_once_for_all_row_checks(tables):
    checks = [C.row_count("a", 20), C.in_range("a", "id", 0, 9), C.not_null("a", "n"),
              C.capacity("a", "x"), C.matches_pattern("a", "code", "?#", "A")]
    report = C.report(tables, checks)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
    assert [r.check for r in report.collect()] == [
        "row count", "range", "not null", "capacity", "pattern"
    ]
    with pytest.raises(ValueError, match="no checks"):
        C.report(tables, [])


def test_null_in_a_list_allows_nothing_whatever_its_length(spark):
    df = spark.createDataFrame([("a",), ("b",), ("zzz",), (None,)], "v string")
    numbers = spark.range(300).selectExpr("CAST(id AS DOUBLE) AS v")
    for extra in (0, 300):
        listed = ["a", "b", None, *(f"x{i}" for i in range(extra))]
        assert one({"t": df}, C.in_domain("t", "v", listed)) == (4, 3, 1)
        assert one({"t": df}, C.in_domain("t", "v", listed[:2] + listed[3:])) == (4, 3, 1)
    assert one({"t": df}, C.in_domain("t", "v", [None])) == (4, 1, 3)
    for n in (200, 201):
        assert one({"t": numbers}, C.in_domain("t", "v", list(range(n)))) == (300, n, 300 - n)
        assert one({"t": numbers}, C.in_domain("t", "v", [*range(n - 1), "x"])) == (300, n - 1, 301 - n)


def test_line_break_after_a_pattern(spark):
    df = spark.createDataFrame([("A1",), ("A1\n",), ("\nA1",), ("A1\r",), ("A1\nA1",)], "v string")
    assert one({"t": df}, C.matches_pattern("t", "v", "?#", "A"))[2] == 4


def test_capacity_of_small_and_decimal_types(spark):
    df = spark.createDataFrame([(1 + i % 2,) for i in range(10)], "v int")
    for kind in ("tinyint", "smallint", "int", "bigint", "decimal(5,0)"):
        assert one({"t": df.selectExpr(f"CAST(v AS {kind}) AS v")}, C.capacity("t", "v")) == (10, 2, 8)
    assert one({"t": df.selectExpr("CAST(v AS DECIMAL(5,1)) AS v")}, C.capacity("t", "v"))[1] == 11
    ends = spark.createDataFrame([(-(1 << 63),), ((1 << 63) - 1,)], "v bigint")
    assert one({"t": ends}, C.capacity("t", "v"))[2] == 0
    with pytest.raises(ValueError, match="not counted"):
        one({"t": df.selectExpr("CAST(v AS STRING) AS v")}, C.capacity("t", "v"))


def test_columns_called_as_the_checks_own(spark):
    df = spark.createDataFrame([(1, 1, 1), (1, 2, 1), (None, 3, 2)], "rows int, side int, value int")
    tables = {"t": df, "u": df}
    assert one(tables, C.unique("t", "rows")) == (3, 2, 1)
    assert one(tables, C.unique("t", "rows", null_keys=False)) == (2, 1, 1)
    assert one(tables, C.list_long_enough("t", "rows")) == (3, 1, 2)
    for name, n in (("rows", 1), ("side", 3), ("value", 2)):
        assert one(tables, C.key_overlap("t", "u", name, n))[1:] == (n, 0)
    assert C.repeated_keys(df, ["rows"]).columns == ["rows", "rows_"]


@pytest.mark.parametrize("n", [3, 200, 201, 400])
def test_lists_of_any_length_mean_the_same(spark, n):
    """Days as text, numbers out of range and values of other types, in short and long lists."""
    df = spark.sql(
        "SELECT CAST(id AS TINYINT) AS t, CAST(id AS INT) AS i, date_add(DATE'2020-01-01', id) AS d,"
        " CAST(id AS DECIMAL(5, 2)) AS m, timestampadd(DAY, id, TIMESTAMP_NTZ'2020-01-01 00:00:00') AS z FROM VALUES (1), (2), (NULL) AS v(id)"
    )
    more = [1000 + i for i in range(n)]
    for column, listed in [
        ("t", [1, 300, "2", -129, 1.5]), ("i", [1, 1 << 40, "2", 2.5]), ("d", ["2020-01-02", "no day", 7]),
        ("d", [dt.date(2020, 1, 2), dt.datetime(2020, 1, 3, 5)]), ("m", [Decimal("1.00"), Decimal("2.001"), 10**9]),
        ("z", ["2020-01-02", "2020-01-03 01:00:00"]),
    ]:
        row = C.report({"t": df}, [C.in_domain("t", column, [*listed, *more])]).first()
        assert (row.expected, row.actual, row.violations) == (3, 2, 1), (column, n)
