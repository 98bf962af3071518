"""Queries on tables that grow otherwise than the given ones."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from joinwright.operators.compare import row_difference
from joinwright.sources import save_tables
from workload import queries
from workload.queries import d4_verify_jobs, g4_dates


def saved(spark, folder, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("suppliers", [2, 5])
def test_more_suppliers_than_days_of_orders(spark, tmp_path, suppliers):
    days = [(dt.datetime(2000, 2, 28),), (dt.datetime(2000, 3, 1),), (None,)]
    folder = saved(
        spark,
        tmp_path,
        orders=(days, "o_orderdate timestamp"),
        supplier=([(i, f"s{i}") for i in range(suppliers)], "s_suppkey long, s_name string"),
    )
    rows = g4_dates(spark, folder).collect()
    assert sorted(map(tuple, rows)) == [(i, f"s{i}", True, 1) for i in range(suppliers)]


@pytest.fixture
def shuffled_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_joined_rows_are_not_dealt_by_all_columns_again(spark, tmp_path, shuffled_joins):
    folder = saved(
        spark,
        tmp_path,
        customer=([(1, "a"), (2, "b"), (None, "c")], "c_custkey long, c_name string"),
        orders=([(7, 1), (7, 1), (8, 1), (9, None)], "o_orderkey long, o_custkey long"),
        lineitem=([(7, 1), (7, 1), (5, 1), (None, 2)], "l_orderkey long, l_linenumber int"),
    )
    outcome = d4_verify_jobs(spark, folder)
    # Two line items have no order, an order and two customers have no line item.
    assert sorted(map(tuple, outcome.collect())) == [
        ("right", True, 0, 0, None),
        ("wrong", False, 2, 3, "rows differ"),
    ]
    assert "hashpartitioning(c_custkey" in plan_of(outcome)
    assert not [p for p in plan_of(outcome).split("hashpartitioning(")[1:] if p.split(")")[0].count(",") > 1]


@pytest.mark.parametrize("by", ["k", ["k", "x"], "x", []])
def test_difference_by_columns_is_that_by_all(spark, by):
    schema = "k long, x double, t string"
    left = [(1, 0.0, "a"), (1, -0.0, "a"), (1, 1.0, "b"), (None, None, None), (None, None, None), (2, float("nan"), "c")]
    right = [(1, 0.0, "a"), (1, 1.0, "d"), (None, None, None), (None, 1.0, None), (2, float("nan"), "c")]
    frames = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    found = row_difference(*frames, by=by).select("k", F.col("x").cast("string"), "t", "side", "copies")
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(
        map(
            str,
            [
                (1, "0.0", "a", "left", 1), (1, "1.0", "b", "left", 1), (None, None, None, "left", 1),
                (1, "1.0", "d", "right", 1), (None, "1.0", None, "right", 1),
            ],
        )
    )


def test_formats_of_a_result_are_written_from_one_join(spark, tmp_path, monkeypatch):
    folder = saved(
        spark,
        tmp_path,
        orders=([(7, "a"), (7, None), (8, "")], "o_orderkey long, o_text string"),
        lineitem=([(7, 1), (8, None), (None, 2)], "l_orderkey long, l_linenumber int"),
    )
    plans = []

    def recorded(tables, path, fmt, result):
        plans.append(plan_of(result))
        return save_tables(tables, path, fmt, result=result)

    monkeypatch.setattr(queries, "save_tables", recorded)
    rows = queries.s5_result_sink(spark, folder).collect()
    assert ["Join" in p for p in plans].count(True) == 1 and len(plans) == 2
    joined = [(7, "a", 7, 1), (7, None, 7, 1), (8, "", 8, None)]
    want = [(*row, fmt) for row in joined for fmt in ("csv", "parquet")]
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))
