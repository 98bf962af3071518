"""A job is judged by its output."""

import pytest
from specs import CLASH, FOUR, SHOP, changed

from joinwright import Step, check_job, generate, verify
from joinwright.plans.jobs import EXAMPLE_STEPS, chain_job, run_chain_job
from joinwright.sources import read_table


def shop_job(tables):
    """Written the way a user would, without this library."""
    users, buys, products = tables.values()
    return users.join(buys, "user_id", "left").join(products, "product_id", "right")


@pytest.mark.parametrize("job", [shop_job, chain_job()])
@pytest.mark.parametrize("fmt", [None, "csv", "parquet"])
def test_right_job(spark, tmp_path, job, fmt):
    spec = changed(SHOP, restrictions__save_to_csv=fmt == "csv")
    folder = None if fmt is None else str(tmp_path)
    outcome = check_job(spark, job, spec, seed=3, folder=folder)
    assert outcome.passed
    assert outcome.summary.first().asDict() == {
        "job": "job", "passed": True, "missing": 0, "unexpected": 0, "reason": None
    }
    assert outcome.differences.count() == 0


def test_names_that_clash_through_csv(spark, tmp_path):
    steps = [Step("user_id"), Step("date")]
    assert check_job(spark, chain_job(steps), CLASH, folder=str(tmp_path)).passed


def test_four_tables_in_one_plan(spark):
    steps = [Step("user_id", "left"), Step("date", "right"), Step("item", "inner")]
    assert check_job(spark, chain_job(steps), FOUR).passed


@pytest.mark.parametrize(
    "job,missing,unexpected",
    [
        (lambda t: shop_job(t).filter("price < 50"), True, False),
        (lambda t: shop_job(t).union(shop_job(t)), False, True),
        (lambda t: shop_job(t).selectExpr("* EXCEPT (price)", "price + 1 AS price"), True, True),
        (lambda t: t["user_info"].join(t["user_buy"], "user_id").join(t["product"], "product_id", "full"), False, False),
    ],
)
def test_job_with_wrong_rows(spark, job, missing, unexpected):
    made = generate(spark, SHOP, 3)
    outcome = verify(job, made.tables, made.expected)
    row = outcome.summary.first()
    assert row.passed == (not missing and not unexpected)
    assert (row.missing > 0, row.unexpected > 0) == (missing, unexpected)
    assert (row.reason is None) == row.passed
    assert outcome.sample(3).count() == min(3, row.missing + row.unexpected)


@pytest.mark.parametrize(
    "job,reason",
    [
        (lambda t: shop_job(t).drop("price"), "columns differ"),
        (lambda t: shop_job(t).selectExpr("*", "1 AS one"), "columns differ"),
        (lambda t: t["nowhere"], "KeyError"),
        (lambda t: t["product"].select("nothing"), "AnalysisException"),
    ],
)
def test_job_that_fails_early(spark, job, reason):
    made = generate(spark, SHOP, 3)
    outcome = verify(job, made.tables, made.expected, "bad")
    row = outcome.summary.first()
    assert (row.job, row.passed) == ("bad", False)
    assert reason in row.reason
    assert outcome.differences is None and outcome.sample() is None


def test_example_job_from_saved_tables(spark, tmp_path):
    made = generate(spark, SHOP, 1)
    paths = made.save(str(tmp_path))
    assert list(paths) == ["user_info", "user_buy", "product", "Result"]
    listed = ",".join(p for n, p in paths.items() if n != "Result")
    schemas = {n: df.schema for n, df in made.tables.items()}
    output = run_chain_job(spark, listed, f"{tmp_path}/SparkResult", EXAMPLE_STEPS, schemas=schemas)
    actual = read_table(spark, output, "csv", chain_job()(made.tables).schema)
    assert verify(lambda t: actual, made.tables, made.expected).passed


def test_a_job_that_fails_while_it_runs_has_not_passed(spark):
    tables = {"t": spark.createDataFrame([("1",), ("x",)], "v string")}
    expected = spark.createDataFrame([(1,), (2,)], "v int")
    outcome = verify(lambda t: t["t"].selectExpr("CAST(v AS INT) AS v"), tables, expected)
    assert not outcome.passed and "CAST_INVALID_INPUT" in outcome.reason
    right = verify(lambda t: expected, tables, expected)
    assert right.passed and right.reason is None
