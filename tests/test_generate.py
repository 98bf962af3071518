"""Generated tables: sizes, exact matches, constraints, repeatability, refusals."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from specs import CLASH, FOUR, INT, MAILS, REAL, SHOP, STR, changed, field, joins_of, table_of

from joinwright import Column, Defaults, Spec, SpecError, Table, generate, generate_table, report
from joinwright.operators.checks import check_spec_bounds, shared_values
from joinwright.operators.compare import equal
from joinwright.plans import layout, pools
from joinwright.plans.tables import add_columns, correlated_pair, next_table


def rows_out(how, n1, n2, k):
    return {"inner": k, "left": n1, "right": n2, "outer": n1 + n2 - k}[how]


def broken(made):
    """Checks of the spec that the tables do not pass."""
    rows = report(made.tables, check_spec_bounds(made.spec)).filter("violations > 0")
    return [tuple(r) for r in rows.collect()]


@pytest.mark.parametrize("seed", [0, 1])
def test_four_tables(spark, seed):
    made = generate(spark, FOUR, seed)
    assert list(made.tables) == ["df1", "df2", "df3", "df4"]
    assert [t.count() for t in made.tables.values()] == [1000] * 4
    assert [s.count() for s in made.steps] == [1000, 1000, 10]
    for table in made.spec.tables:
        frame = made.tables[table.name]
        assert [(f.name, f.dataType) for f in frame.schema] == [
            (f.name, f.dataType) for f in table.schema
        ]
    assert broken(made) == []


@pytest.mark.parametrize("how", ["inner", "left", "right", "outer"])
def test_rows_of_a_join_of_unique_keys(spark, how):
    for seed, k in [(1, 0), (2, 7), (3, 20)]:
        spec = joins_of(SHOP, ("inner", how), (20, k))
        made = generate(spark, spec, seed)
        assert made.steps[0].count() == 20
        assert made.steps[1].count() == rows_out(how, 20, 20, k)
        spec = joins_of(SHOP, (how, "inner"), (k, 0))
        assert generate(spark, spec, seed).steps[0].count() == rows_out(how, 40, 20, k)


def test_tables_given_as_schemas(spark):
    whole = Spec.from_dict(FOUR)
    schemas = {t.name: t.schema for t in whole.tables}
    spec = Spec.from_schemas(
        schemas, [1000] * 4, ["user_id", ("date", "date"), "item"], ["left", "right", "inner"],
        [20, 20, 10], Defaults(max_int=5000, max_double=100.0),
    )
    assert spec == whole
    with pytest.raises(SpecError, match="each table"):
        Spec.from_schemas(schemas, [1000] * 3, ["user_id"] * 3, ["left"] * 3, [1] * 3)
    odd = {"t": T.StructType([T.StructField("x", T.BinaryType())])}
    with pytest.raises(SpecError, match="unknown type binary"):
        Spec.from_schemas(odd, [1], [], [], [])


def test_shop(spark):
    made = generate(spark, SHOP, 5)
    assert [s.count() for s in made.steps] == [40, 20]
    assert broken(made) == []
    users = made.tables["user_info"].collect()
    assert {u.email for u in users} <= set(MAILS)
    assert all(re.fullmatch(r"[a-zA-Z]\d{3}[a-zA-Z]{3}\d[a-zA-Z]\d[a-zA-Z]", u.user_name) for u in users)
    assert {u.premium for u in users} == {True, False}


def test_clashing_names_and_columns_that_are_no_key(spark):
    made = generate(spark, CLASH, 1)
    assert [s.count() for s in made.steps] == [15, 10]
    assert made.expected.columns == [
        "data1.user_id", "user_name", "email", "data1.smth", "float", "date", "data2.smth",
        "has_work", "data3.user_id", "purchase",
    ]
    # all columns two neighbours share agree in the rows that match
    same = "`data1.smth` = `data2.smth` AND `data1.user_id` = `data3.user_id`"
    assert made.expected.filter(same).count() == 10
    one, two, three = made.tables.values()
    assert shared_values(one, two, "smth").count() == 15
    assert shared_values(one, three, "user_id").count() == 10


def test_same_seed_same_tables_on_any_partitions(spark):
    one, many = generate(spark, FOUR, 3, partitions=1), generate(spark, FOUR, 3, partitions=8)
    other = generate(spark, FOUR, 4)
    for name in one.tables:
        assert equal(one.tables[name], many.tables[name])
        assert not equal(one.tables[name], other.tables[name])
    assert equal(one.expected, many.expected)


# ---------------------------------------------------------- bounds that differ


def pair(left, right, k, n1=30, n2=25):
    return {
        "datasets": {
            "a": {"size": n1, "schema": {"k": left, "v": STR}},
            "b": {"size": n2, "schema": {"k": right, "w": STR}},
        },
        "restrictions": {"min_int": 0, "max_int": 1000, "min_double": 0.0, "max_double": 1.0},
        "join_conditions": {
            "j": {"condition": ("k", "k"), "type": "full", "intersecting_records": k}
        },
    }


PAIRS = {
    "ints that overlap": (field("Integer", restriction=(0, 40)), field("Integer", restriction=(20, 60)), 10),
    "one int range in the other": (field("Integer", restriction=(10, 44)), field("Integer", restriction=(0, 99)), 25),
    "ints with little to spare": (field("Integer", restriction=(0, 29)), field("Integer", restriction=(20, 44)), 10),
    "own int range and the default": (field("Integer", restriction=(990, 1990)), INT, 11),
    "dates": (field("Date", restriction=("2020-01-01", "2020-02-10")), field("Date", restriction=("2020-02-01", "2020-03-31")), 8),
    "doubles": (field("Double", restriction=(0.0, 10.0)), field("Double", restriction=(9.0, 20.0)), 12),
    "own doubles and the default": (field("Double", restriction=(-1.0, 0.5)), REAL, 12),
    "lists without replacement": (field("Integer", values=list(range(35)), repeatable=False), field("Integer", values=list(range(20, 50)), repeatable=False), 9),
    "list and range": (field("Integer", values=list(range(0, 90, 3)), repeatable=False), field("Integer", restriction=(30, 70)), 10),
    "text lists": (field("String", values=[f"s{i}" for i in range(40)], repeatable=False), field("String", values=[f"s{i}" for i in range(20, 60)], repeatable=False), 20),
    "text patterns": (field("String", string_format="?#", letters="abcdef"), field("String", string_format="?#", letters="abcdef"), 4),
}


@pytest.mark.parametrize("name", PAIRS)
def test_exact_matches_with_bounds_that_differ(spark, name):
    left, right, k = PAIRS[name]
    made = generate(spark, pair(left, right, k), 2)
    assert made.expected.count() == 30 + 25 - k
    assert shared_values(made.tables["a"], made.tables["b"], "k").count() == k
    assert made.tables["a"].select("k").distinct().count() == 30
    assert broken(made) == []


INFEASIBLE = {
    "too few common values": (field("Integer", restriction=(0, 40)), field("Integer", restriction=(35, 60)), 7),
    "disjoint ranges": (field("Integer", restriction=(0, 40)), field("Integer", restriction=(50, 90)), 1),
    "disjoint dates": (field("Date", restriction=("2020-01-01", "2020-03-01")), field("Date", restriction=("2021-01-01", "2021-03-01")), 1),
    "disjoint doubles": (field("Double", restriction=(0.0, 1.0)), field("Double", restriction=(2.0, 3.0)), 1),
    "disjoint lists": (field("Integer", values=list(range(30)), repeatable=False), field("Integer", values=list(range(30, 60)), repeatable=False), 1),
    "list outside the range": (field("Integer", values=list(range(2000, 2030)), repeatable=False), INT, 1),
    "range too small": (field("Integer", restriction=(0, 28)), INT, 1),
    "list too short": (field("Integer", values=list(range(29)), repeatable=False), INT, 1),
    "not enough room for both": (field("Integer", restriction=(0, 30)), field("Integer", restriction=(0, 30)), 5),
    "patterns that differ": (field("String", string_format="?#", letters="abcdef"), STR, 1),
    "boolean key": (field("Boolean"), field("Boolean"), 1),
    "key drawn with replacement": (field("Integer", values=list(range(99))), INT, 1),
    "more matches than rows": (INT, INT, 26),
    "types that differ": (INT, REAL, 1),
    "empty range": (field("Integer", restriction=(5, 0)), INT, 1),
}


@pytest.mark.parametrize("name", INFEASIBLE)
def test_what_cannot_be_met_is_refused_before_any_job(spark, name):
    left, right, k = INFEASIBLE[name]
    with pytest.raises(SpecError):
        generate(spark, pair(left, right, k), 2)


def test_capacity_counts_both_ends(spark):
    spec = pair(field("Integer", restriction=(0, 29)), field("Integer", restriction=(25, 49)), 5)
    made = generate(spark, spec, 1)
    assert sorted(r.k for r in made.tables["a"].collect()) == list(range(30))
    assert sorted(r.k for r in made.tables["b"].collect()) == list(range(25, 50))


def test_three_tables_share_a_column_with_bounds_of_their_own(spark):
    spec = table_of(CLASH, "data1", user_id=field("Integer", restriction=(0, 60)))
    spec = table_of(spec, "data2", user_id=field("Integer", restriction=(30, 90)))
    spec = table_of(spec, "data3", user_id=field("Integer", restriction=(40, 120)))
    made = generate(spark, spec, 6)
    assert [s.count() for s in made.steps] == [15, 10]
    one, two, three = made.tables.values()
    assert shared_values(one, two, "user_id").count() == 15
    assert shared_values(one, three, "user_id").count() == 10
    assert shared_values(two, three, "user_id").count() == 10
    assert broken(made) == []


def test_keys_of_two_names(spark):
    spec = pair(INT, INT, 9)
    spec["datasets"]["b"]["schema"] = {"j": INT, "w": STR}
    spec["join_conditions"]["j"]["condition"] = ("k", "j")
    made = generate(spark, spec, 1)
    assert made.expected.columns == ["k", "v", "j", "w"]
    assert made.expected.count() == 46
    assert made.expected.filter("k = j").count() == 9


# --------------------------------------------------------------------- filters


@pytest.mark.parametrize("types", [("inner", "left"), ("left", "right"), ("right", "full"), ("full", "inner")])
def test_filter_between_joins(spark, types):
    spec = joins_of(SHOP, types, (20, 5), where=("premium OR user_id > 90", None))
    spec["datasets"]["user_info"]["schema"]["user_id"] = INT
    made = generate(spark, spec, 11)
    first, second = made.steps
    unfiltered = generate(spark, joins_of(spec, where=None), 11)
    assert first.filter("NOT (premium OR user_id > 90)").count() == 0
    assert 5 <= first.count() < rows_out({"full": "outer"}.get(types[0], types[0]), 40, 20, 20)
    how = {"full": "outer"}.get(types[1], types[1])
    assert second.count() == rows_out(how, first.count(), 20, 5)
    assert [t.count() for t in made.tables.values()] == [40, 20, 20]
    assert shared_values(made.tables["user_buy"], made.tables["product"], "product_id").count() == 5
    assert equal(made.tables["user_buy"], unfiltered.tables["user_buy"])
    assert broken(made) == []


def test_first_surviving_rows_are_copied_in_order(spark):
    spec = joins_of(SHOP, ("inner", "inner"), (20, 6), where=("premium", None))
    made = generate(spark, spec, 4)
    users = made.tables["user_info"].collect()  # in row order
    bought = {r.user_id: r.product_id for r in made.tables["user_buy"].collect()}
    survivors = [bought[u.user_id] for u in users if u.premium and u.user_id in bought]
    products = [r.product_id for r in made.tables["product"].collect()]
    assert sorted(products[:6]) == sorted(survivors[:6])


def test_filter_that_leaves_too_few_rows(spark):
    with pytest.raises(SpecError, match="too few rows"):
        generate(spark, joins_of(SHOP, where=("user_id < 0", None)), 1)


def test_filter_after_the_last_join(spark):
    spec = joins_of(CLASH, where=(None, "has_work AND `data1.user_id` > 0"))
    made = generate(spark, spec, 1)
    assert 0 < made.expected.count() < 10
    assert made.expected.filter("NOT has_work").count() == 0


def test_filters_go_by_step_not_by_condition(spark):
    spec = {
        "datasets": {n: {"size": 30, "schema": {"k": INT, f"f{n}": field("Boolean")}} for n in "abc"},
        "restrictions": {"min_int": 0, "max_int": 1000},
        "join_conditions": {
            "j1": {"condition": ("k", "k"), "type": "inner", "intersecting_records": 20},
            "j2": {"condition": ("k", "k"), "type": "inner", "intersecting_records": 5, "where": "fc"},
        },
    }
    made = generate(spark, spec, 2)
    assert made.steps[0].count() == 20
    assert made.expected.count() == made.expected.filter("fc").count() <= 5


def test_large_chain_with_filter_keeps_the_count(spark):
    spec = joins_of(FOUR, ("inner", "left", "full"), (900, 400, 150), where=("user_id > 100", None, None))
    made = generate(spark, spec, 9)
    assert [t.count() for t in made.tables.values()] == [1000] * 4
    first, second, third = (s.count() for s in made.steps)
    assert second == first
    assert third == first + 1000 - 150
    assert shared_values(made.tables["df3"], made.tables["df4"], "item").count() == 150


# ------------------------------------------------------------- single tables


def one_column(spark, column, size=1000, **more):
    frame = generate_table(spark, Table("t", size, (column,)), **more)
    return [r[0] for r in frame.collect()]


def test_each_kind_of_column(spark):
    ints = one_column(spark, Column("c", T.IntegerType(), bounds=(-500, 499)))
    assert sorted(ints) == list(range(-500, 500))
    longs = one_column(spark, Column("c", T.LongType(), bounds=(0, 1 << 40)))
    assert len(set(longs)) == 1000 and max(longs) > 1 << 38
    reals = one_column(spark, Column("c", T.DoubleType(), bounds=(1.0, 1.5)))
    assert len(set(reals)) == 1000 and 1.0 <= min(reals) < max(reals) <= 1.5
    days = one_column(spark, Column("c", T.DateType(), bounds=("1200-01-01", "1202-09-26")))
    assert len(set(days)) == 1000 and min(days) == dt.date(1200, 1, 1)
    flags = one_column(spark, Column("c", T.BooleanType()))
    assert 400 < sum(flags) < 600


def test_columns_that_repeat(spark):
    for column, allowed in [
        (Column("c", T.IntegerType(), bounds=(3, 6), unique=False), {3, 4, 5, 6}),
        (Column("c", T.DateType(), bounds=("2020-01-01", "2020-01-02"), unique=False),
         {dt.date(2020, 1, 1), dt.date(2020, 1, 2)}),
        (Column("c", T.StringType(), values=("x", "y", "it's")), {"x", "y", "it's"}),
        (Column("c", T.DateType(), values=("2020-05-01",)), {dt.date(2020, 5, 1)}),
        (Column("c", T.BooleanType(), values=("true",)), {True}),
        (Column("c", T.DoubleType(), values=("1.5", 2)), {1.5, 2.0}),
    ]:
        assert set(one_column(spark, column)) == allowed
    reals = one_column(spark, Column("c", T.DoubleType(), bounds=(0.0, 2.0), unique=False))
    assert 0 <= min(reals) < 0.1 and 1.9 < max(reals) < 2


def test_list_without_replacement(spark):
    listed = tuple(f"v{i}" for i in range(50))
    found = one_column(spark, Column("c", T.StringType(), values=listed, repeatable=False), 50)
    assert sorted(found) == sorted(listed) and found != list(listed)


def test_own_bounds_come_before_the_defaults(spark):
    spec = changed(SHOP)
    made = generate(spark, spec, 1)
    dates = [r.bought_date for r in made.tables["user_buy"].collect()]
    assert min(dates) < dt.date(1979, 1, 1)


def test_filler_rows_are_the_rows_from_there_on(spark):
    table = Table("t", 100, (Column("c", T.IntegerType(), bounds=(0, 999)),))
    whole = [r.c for r in generate_table(spark, table).collect()]
    assert [r.c for r in generate_table(spark, table, start=60).collect()] == whole[60:]


def test_correlated_pair(spark):
    columns = (Column("k", T.IntegerType(), bounds=(0, 999)), Column("f", T.BooleanType()))
    left, right = correlated_pair(spark, Table("a", 50, columns), Table("b", 70, columns), 30, "k")
    assert (left.count(), right.count()) == (50, 70)
    both = left.join(right, "k")
    assert both.count() == 30
    assert left.join(right, ["k", "f"]).count() == 30


def test_next_table(spark):
    base = spark.range(500).selectExpr(
        "id AS n", "CAST(id * 3 AS INT) AS k", "date_add(DATE'2020-01-01', CAST(id AS INT)) AS d"
    )
    table = Table(
        "t",
        300,
        (
            Column("k", T.IntegerType(), bounds=(0, 5000)),
            Column("d", T.DateType(), bounds=("2000-01-01", "2040-01-01")),
            Column("own", T.StringType()),
        ),
    )
    made = next_table(base, "n", table, 120)
    assert made.columns == ["k", "d", "own"] and made.count() == 300
    assert {r.k for r in made.join(base, ["k", "d"]).collect()} == {3 * i for i in range(120)}
    assert made.filter("k > 1497").count() == 180 == made.filter("d > '2021-05-14'").count()
    assert made.select("k").distinct().count() == 300
    small = Table("t", 300, (Column("k", T.IntegerType(), bounds=(0, 1600)),))
    with pytest.raises(SpecError, match="above"):
        next_table(base, "n", small, 120)
    with pytest.raises(ValueError, match="rows are needed"):
        next_table(base.limit(100), "n", table, 120)


def test_generation_is_one_stage_of_generated_code(spark):
    frame = generate(spark, FOUR, 1).tables["df2"]
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert all(line.lstrip(" +-:").startswith("*(1)") for line in plan.strip().splitlines())


# ------------------------------------------------------------------ refusals


@pytest.mark.parametrize(
    "spec,message",
    [
        (table_of(SHOP, "product", price={"type": "DecimalType", "nullable": False}), "unknown type"),
        (table_of(SHOP, "product", price=field("Double", restriction="1:2")), "pair"),
        (table_of(SHOP, "product", product_name=field("String", restriction=(1, 2))), "no restriction"),
        (table_of(SHOP, "product", product_name=field("String", values="a,b")), "list"),
        (table_of(SHOP, "product", product_name=field("String", values=[])), "empty"),
        (table_of(SHOP, "product", product_name=field("String", string_format="?#")), "letters"),
        (table_of(SHOP, "product", product_id=field("Double")), "two types"),
        (joins_of(SHOP, matches=(10, 11)), "rise"),
        (joins_of(SHOP, matches=(21, 11)), "do not fit"),
        (joins_of(SHOP, types=("left", "cross")), "join type"),
        (changed(SHOP, join_conditions={}), "N - 1"),
        (changed(SHOP, join_conditions__j2__condition=("nothing", "product_id")), "has 'nothing'"),
        (changed(SHOP, restrictions__max_int=18), "19 values for 20 rows"),
        (changed(SHOP, restrictions__min_date="2050-01-01"), None),
    ],
)
def test_malformed_specs(spec, message):
    if message is None:
        Spec.from_dict(spec)  # no column uses the default dates
        return
    with pytest.raises(SpecError, match=message):
        Spec.from_dict(spec)


def test_nulls_only_come_from_outer_joins(spark):
    made = generate(spark, FOUR, 1)
    for frame in made.tables.values():
        nulls = frame.agg(*[F.count_if(F.col(c).isNull()) for c in frame.columns]).first()
        assert set(nulls) == {0}


def test_next_table_takes_fitting_rows_only(spark):
    base = spark.range(400).selectExpr(
        "CASE WHEN id % 2 = 0 THEN id END AS k", "CAST(id AS STRING) AS s", "id / 2D AS x",
        "id % 3 = 0 AS f", "id AS n",
    )
    columns = (
        Column("k", T.LongType(), bounds=(100, 5000)),
        Column("s", T.StringType(), pattern="###", letters="a"),
        Column("x", T.DoubleType(), bounds=(0.0, 1000.0)),
        Column("f", T.BooleanType()),
    )
    made = next_table(base, "n", Table("t", 120, columns), 50)
    assert made.join(base, "k").count() == 50 == made.join(base, ["k", "s", "x", "f"]).count()
    assert made.join(base, "k").agg({"k": "min"}).first()[0] == 100
    with pytest.raises(SpecError, match="rows are needed"):
        next_table(base, "n", Table("t", 500, columns), 151)
    few = spark.range(200).selectExpr("id % 5 AS k", "id AS n")
    with pytest.raises(SpecError, match="rows are needed"):
        next_table(few, "n", Table("t", 60, (Column("k", T.LongType(), bounds=(0, 900)),)), 50)


def test_doubles_of_a_narrow_range_are_different_or_refused(spark):
    wide = Table("t", 1000, (Column("x", T.DoubleType(), bounds=(1e15, 1e15 + 4000)),))
    assert generate_table(spark, wide).distinct().count() == 1000
    narrow = Table("t", 1000, (Column("x", T.DoubleType(), bounds=(1e15, 1e15 + 1)),))
    with pytest.raises(SpecError):
        generate_table(spark, narrow).count()


def test_draws_from_a_wide_range_are_uniform(spark):
    column = Column("n", T.LongType(), bounds=(0, 3 * (1 << 30) - 1), unique=False)
    made = generate_table(spark, Table("t", 60_000, (column,)))
    share = made.filter(f"n < {1 << 30}").count() / 60_000
    assert abs(share - 1 / 3) < 0.01


def test_added_columns_keep_the_rows(spark):
    base = spark.range(300).selectExpr("id * 3 AS k", "'v' AS v")
    made = add_columns(base, "k", [Column("n", T.IntegerType(), bounds=(1, 300))], seed=4)
    assert made.columns == ["k", "v", "n"] and made.select("k", "v").exceptAll(base).count() == 0
    assert {r.n for r in made.collect()} == set(range(1, 301))
    assert made.exceptAll(add_columns(base.repartition(7), "k", [Column("n", T.IntegerType(), bounds=(1, 300))], seed=4)).count() == 0


def test_long_lists_are_tables(spark):
    """A million values, none in the plan; a row has the same value however its list is kept."""
    listed = tuple(f"value {i}" for i in range(1_000_000))
    for repeatable in (True, False):
        column = Column("c", T.StringType(), values=listed, repeatable=repeatable)
        made = generate_table(spark, Table("t", 2000, (column, Column("f", T.BooleanType()))))
        assert "value 1" not in made._jdf.queryExecution().toString()
        found = [r.c for r in made.collect()]
        assert len(found) == 2000 and set(found) <= set(listed)
        assert len(set(found)) == 2000 if not repeatable else len(set(found)) > 1900
    short = Column("c", T.StringType(), values=listed[:1500])
    long = generate_table(spark, Table("t", 500, (short,))).collect()
    pools.INLINE, layout.INLINE, before = 2000, 2000, pools.INLINE
    try:
        assert sorted(generate_table(spark, Table("t", 500, (short,))).collect()) == sorted(long)
    finally:
        pools.INLINE = layout.INLINE = before


def test_a_list_given_as_a_frame(spark):
    base = spark.range(300).selectExpr("id AS k")
    names = spark.range(400).selectExpr("IF(id < 350, CONCAT('n', id % 350), NULL) AS name")
    made = add_columns(base, "k", [Column("own", T.StringType()), Column("f", T.BooleanType())], 1, {"own": names})
    assert made.columns == ["k", "own", "f"] and made.count() == 300
    assert made.join(names, made.own == names.name, "left_semi").count() == 300
    once = Column("own", T.StringType(), repeatable=False)
    assert add_columns(base, "k", [once], 1, {"own": names}).select("own").distinct().count() == 300
    with pytest.raises(SpecError, match="listed values"):
        add_columns(base, "k", [once], 1, {"own": names.filter("name < 'n2'")})
