"""Joins against a join by hand, and their plans where a key is hot."""

import itertools
import random
import re

import pytest

from joinwright.operators import checks as C
from joinwright.operators.compare import equal
from joinwright.operators.joins import equi_join, heavy_keys, hot_sides
from joinwright.operators.project import cast_columns, prefix_clashes, suffix_to_prefix
from joinwright.plans import chain
from joinwright.plans.chain import Step, chain_counts, chain_results, join_chain, measured


def by_hand(left, right, how, null_safe=False):
    """Rows (key, a, b) of a join of (key, a) and (key, b) on one named key."""
    same = (lambda x, y: x == y) if null_safe else (lambda x, y: x is not None and x == y)
    out = [(k, a, b) for k, a in left for j, b in right if same(k, j)]
    if how in ("left", "full"):
        out += [(k, a, None) for k, a in left if not any(same(k, j) for j, _ in right)]
    if how in ("right", "full"):
        out += [(k, None, b) for k, b in right if not any(same(j, k) for j, _ in left)]
    return sorted(out, key=repr)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def sides(spark, seed):
    rnd = random.Random(seed)
    keys = [*range(12), None]
    left, right = rnd.choices(keys, k=20), rnd.choices(keys[4:], k=15) + [4] * 10
    left = [(k, i) for i, k in enumerate(left)]
    right = [(k, i) for i, k in enumerate(right)]
    return (
        left,
        right,
        spark.createDataFrame(left, "k int, a int"),
        spark.createDataFrame(right, "k int, b int"),
    )


HOWS = ["inner", "left", "right", "full"]


@pytest.mark.parametrize("how,null_safe", list(itertools.product(HOWS, [False, True])))
def test_join_with_repeated_and_null_keys(spark, how, null_safe):
    left, right, a, b = sides(spark, HOWS.index(how) + 4 * null_safe)
    joined = equi_join(a, b, "k", how, null_safe)
    assert joined.columns == ["k", "a", "b"]
    assert rows(joined) == by_hand(left, right, how, null_safe)


@pytest.mark.parametrize("how", HOWS)
def test_hot_sides_do_not_change_the_result(spark, how):
    left, right, a, b = sides(spark, 3)
    for null_safe in (False, True):
        for hot in [(), ("left",), ("right",), ("left", "right")]:
            joined = equi_join(a, b, "k", how, null_safe, hot)
            assert rows(joined) == by_hand(left, right, how, null_safe)


def test_hot_sides_are_measured(spark):
    a = spark.createDataFrame([(1,)] * 5 + [(2,), (3,), (None,)], "k int")
    b = spark.createDataFrame([(i,) for i in range(8)], "k int")
    assert hot_sides(a, b, "k", 0.3) == ("left",)
    assert hot_sides(b, a, "k", 0.3) == ("right",)
    assert hot_sides(a, b.limit(0), "k", 0.99) == ()


@pytest.mark.parametrize("how", ["left", "full"])
@pytest.mark.parametrize("n", [2, 3, 4])
@pytest.mark.parametrize("hot", [(), ("left", "right")])
def test_a_chain_reads_no_table_more_than_twice(spark, tmp_path, how, n, hot):
    tables = {}
    for i, name in enumerate("abcde"[: n + 1]):
        path = str(tmp_path / name)
        spark.range(5).selectExpr("id AS k", f"id + {i} AS v{name}").write.parquet(path)
        tables[name] = spark.read.parquet(path)
    read = []
    original = chain.cut

    def cut(df):  # what a kept intermediate has read
        read.append(df._jdf.queryExecution().optimizedPlan().toString())
        return original(df)

    chain.cut = cut
    try:
        joined = join_chain(tables, [Step("k", how, hot=hot)] * n)
    finally:
        chain.cut = original
    read.append(joined._jdf.queryExecution().optimizedPlan().toString())
    most = 3 if hot and how == "full" else 2 if hot else 1
    for name in tables:
        assert sum(p.count(f"v{name}#") > 0 for p in read) >= 1
        reads = sum(len(re.findall(rf"Relation \[[^\]]*\bv{name}#", p)) for p in read)
        assert 1 <= reads <= most, (name, reads)
    assert joined.count() == 5


@pytest.mark.parametrize("how", HOWS)
def test_keys_of_two_names_both_stay(spark, how):
    _, _, a, b = sides(spark, 1)
    b = b.withColumnRenamed("k", "j")
    joined = equi_join(a, b, ("k", "j"), how)
    assert joined.columns == ["k", "a", "j", "b"]
    want = a.join(b, a.k == b.j, how)
    assert rows(joined) == rows(want)


def test_outer_is_full_and_other_types_are_refused(spark):
    _, _, a, b = sides(spark, 1)
    assert rows(equi_join(a, b, "k", "outer")) == rows(equi_join(a, b, "k", "full"))
    with pytest.raises(ValueError, match="join type"):
        equi_join(a, b, "k", "semi")


def test_clashing_names_are_refused(spark):
    _, _, a, _ = sides(spark, 1)
    with pytest.raises(ValueError, match="rename"):
        equi_join(a, a, "k")


def test_self_join(spark):
    _, _, a, _ = sides(spark, 1)
    joined = equi_join(a, a.withColumnRenamed("a", "b"), "k", "full")
    assert rows(joined) == rows(a.join(a.withColumnRenamed("a", "b"), "k", "full"))


@pytest.fixture
def hot_plans(spark):
    """Settings under which a partition of some kilobytes counts as skewed."""
    wanted = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("how,hot_side", [("left", "right"), ("right", "left"), ("full", "left"),
                                          ("full", "right"), ("inner", "right")])
def test_a_key_with_a_third_of_the_rows_is_split(spark, hot_plans, how, hot_side):
    few = spark.range(1000).selectExpr("id AS k", "'x' AS a")
    many = spark.range(0, 300_000, 1, 16).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 5000 END AS k", "md5(CAST(id AS STRING)) AS m"
    )
    left, right = (many, few) if hot_side == "left" else (few, many)

    def executed(df):
        execution = df._jdf.queryExecution()
        rows = execution.toRdd().count()
        return rows, execution.executedPlan().toString().split("Initial Plan")[0]

    count, plan = executed(equi_join(left, right, "k", how, hot=(hot_side,)))
    plain_count, plain = executed(left.join(right, "k", how))
    assert count == plain_count
    assert "SortMergeJoin(skew=true)" in plan
    if how != "inner":
        assert "skew=true" not in plain


# ------------------------------------------------------------------- names, types


def test_prefix_clashes(spark):
    a = spark.createDataFrame([(1, 2, 3)], "k int, x int, y int")
    b = spark.createDataFrame([(1, 5)], "k int, x int")
    a, b = prefix_clashes(a, "a", b, "b", keep=["k"])
    assert (a.columns, b.columns) == (["k", "a.x", "y"], ["k", "b.x"])


def test_suffix_to_prefix_twice_is_once(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "`x.a` int, `y.a` int, `x.b` int, z int")
    once = suffix_to_prefix(df, ["a", "b"])
    assert once.columns == ["a.x", "a.y", "b.x", "z"]
    assert suffix_to_prefix(once, ["a", "b"]).columns == once.columns


def test_cast_strict_and_not(spark):
    df = spark.createDataFrame([("1", "x"), ("b", "y"), (None, "z")], "n string, s string")
    lenient = cast_columns(df, {"n": "IntegerType"}, strict=False)
    assert [r.n for r in lenient.orderBy("s").collect()] == [1, None, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cast_columns(df, {"n": "IntegerType"}).collect()
    with pytest.raises(ValueError, match="unknown type"):
        cast_columns(df, {"n": "DecimalType"})
    with pytest.raises(ValueError, match="no such column"):
        cast_columns(df, {"m": "IntegerType"})


# -------------------------------------------------------------------------- chains


def chain_tables(spark, seed):
    rnd = random.Random(seed)

    def made(n, *columns):
        values = [[rnd.choice([*range(6), None]) for _ in columns] for _ in range(n)]
        return spark.createDataFrame(values, ", ".join(f"{c} int" for c in columns))

    return {
        "a": made(15, "u", "s", "p"),
        "b": made(20, "u", "d", "s"),
        "c": made(12, "d", "e", "u"),
    }


@pytest.mark.parametrize(
    "first,second",
    [("inner", "full"), ("left", "right"), ("right", "left"), ("full", "inner"), ("full", "full")],
)
def test_chain_counts_without_pairing(spark, first, second):
    tables = chain_tables(spark, 5)
    steps = [Step("u", first), Step("d", second)]
    results = chain_results(tables, steps)
    counted = [f.first()["rows"] for f in chain_counts(tables, steps)]
    assert counted == [r.count() for r in results]


def test_chain_names_show_the_owner(spark):
    results = chain_results(chain_tables(spark, 2), [Step("u", "inner"), Step("d", "left")])
    assert results[0].columns == ["u", "a.s", "p", "d", "b.s"]
    # u came from a, although b has it too
    assert results[1].columns == ["a.u", "a.s", "p", "d", "b.s", "e", "c.u"]
    assert results[1].filter("`a.s` = 1 OR `c.u` IS NULL").count() > 0


def test_every_clashing_column_is_renamed(spark):
    a = spark.createDataFrame([(1, 2, 3)], "k int, x int, y int")
    b = spark.createDataFrame([(1, 5, 6)], "k int, x int, y int")
    joined = join_chain({"a": a, "b": b}, [Step("k")])
    assert joined.columns == ["k", "a.x", "a.y", "b.x", "b.y"]


def test_key_of_another_name_that_clashes(spark):
    a = spark.createDataFrame([(1, 2), (4, 5)], "x int, y int")
    b = spark.createDataFrame([(1, 9), (3, 8)], "y int, x int")
    joined = join_chain({"a": a, "b": b}, [Step(("x", "y"), "full")])
    assert joined.columns == ["a.x", "a.y", "b.y", "b.x"]
    assert rows(joined) == sorted(
        [(1, 2, 1, 9), (4, 5, None, None), (None, None, 3, 8)], key=repr
    )


def test_filters_belong_to_their_step(spark):
    tables = {
        "a": spark.createDataFrame([(1,), (2,), (3,)], "k int"),
        "b": spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "k int, v string"),
        "c": spark.createDataFrame([(1, 1), (2, 2)], "k int, w int"),
    }
    steps = [Step("k", "inner", where="v <> 'x'"), Step("k", "right", where="w > 0")]
    results = chain_results(tables, steps)
    assert rows(results[0]) == [(2, "y")]
    assert rows(results[1]) == sorted([(2, "y", 2), (1, None, 1)], key=repr)
    assert [f.first()["rows"] for f in chain_counts(tables, steps)] == [1, 2]


def test_sql_rule_for_null_in_a_filter(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (3, 2)], "k int, x int")
    other = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    for where, left in [("x != 1", {3}), ("x IS DISTINCT FROM 1", {1, 3})]:
        joined = join_chain({"a": df, "b": other}, [Step("k", where=where)])
        assert {r.k for r in joined.collect()} == left


def test_unmatched_booleans_stay_null(spark):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    b = spark.createDataFrame([(1, False)], "k int, f boolean")
    joined = join_chain({"a": a, "b": b}, [Step("k", "left")])
    assert rows(joined) == [(1, False), (2, None)]


def test_checkpointed_chain_is_the_same(spark):
    tables = chain_tables(spark, 8)
    steps = [Step("u", "full"), Step("d", "full")]
    assert rows(join_chain(tables, steps, checkpoint=True)) == rows(join_chain(tables, steps))


def test_cardinality_check(spark):
    tables = chain_tables(spark, 5)
    steps = [Step("u", "left"), Step("d", "full")]
    sizes = [r.count() for r in chain_results(tables, steps)]
    report = C.report(tables, C.join_cardinality(steps, [sizes[0], sizes[1] + 3])).collect()
    assert [(r.actual, r.violations) for r in report] == [(sizes[0], 0), (sizes[1], 3)]


def test_wrong_number_of_steps(spark):
    with pytest.raises(ValueError, match="N - 1"):
        join_chain(chain_tables(spark, 1), [Step("u")])


# ----------------------------------------------------- counts and measured keys


def chain_of(spark, seed):
    import random

    rnd = random.Random(seed)
    key = lambda: rnd.choice([None, 0, 0, 0, 1, 2, 3])
    a = spark.createDataFrame([(key(), key(), rnd.randint(0, 5)) for _ in range(40)], "k int, j int, x int")
    b = spark.createDataFrame([(key(), rnd.randint(0, 5), rnd.choice(["u", None])) for _ in range(30)], "k int, x int, s string")
    c = spark.createDataFrame([(key(), rnd.randint(0, 3)) for _ in range(20)], "i int, y int")
    return {"a": a, "b": b, "c": c}


WHERES = [
    (None, None),
    ("`a.x` > 1", "y < 3 OR y IS NULL"),
    (("`b.x` IS NULL OR `b.x` > 2", "s IS NULL", "j IS NOT NULL"), "k > 0 OR k IS NULL"),
    ("`a.x` <= `b.x`", ("`a.x` + y > 2", "i = k OR i IS NULL OR k IS NULL", "1 = 1")),
    (("k >= 0", "`a.x` + `b.x` <> 4"), ("`b.x` < 5", "s = 'u' OR y = 1")),
]


@pytest.mark.parametrize("hows", [("left", "right"), ("full", "left"), ("inner", "full"), ("right", "inner"), ("full", "full")])
@pytest.mark.parametrize("n", range(len(WHERES)))
def test_filtered_chains_are_counted_as_they_join(spark, hows, n):
    """Nulls, keys that repeat on both sides, clashing names, conditions on one table and on more."""
    tables = chain_of(spark, n)
    steps = [Step("k", hows[0], where=WHERES[n][0]), Step(("j", "i"), hows[1], where=WHERES[n][1])]
    counted = [c.first()[0] for c in chain_counts(tables, steps)]
    assert counted == [r.count() for r in chain_results(tables, steps)]


def test_filtered_counts_pair_no_rows(spark):
    """A key with a million pairs is counted without making them."""
    many = spark.range(1000).selectExpr("0 AS k", "id AS x")
    other = spark.range(1000).selectExpr("0 AS k", "id AS y")
    counts = chain_counts({"a": many, "b": other}, [Step("k", where=("x < 500", "y >= 100"))])
    assert counts[0].first()[0] == 500 * 900
    plan = counts[0]._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" in plan.split("Join")[-1]
    mixed = chain_counts({"a": many, "b": other}, [Step("k", where="x % 2 = y % 2")])
    assert mixed[0].first()[0] == 500_000


def test_heavy_keys_are_found_without_a_shuffle_of_keys(spark):
    df = spark.range(20_000).selectExpr("CASE WHEN id % 3 = 0 THEN -1 WHEN id % 10 = 1 THEN NULL ELSE id END AS k")
    assert heavy_keys(df, "k", 0.05) == [-1]
    assert heavy_keys(df.selectExpr("CAST(k AS STRING) AS k"), "k", 0.05) == ["-1"]
    times = df.selectExpr("timestampadd(DAY, coalesce(k, 0), TIMESTAMP_NTZ'2020-01-01 00:00:00') AS k")
    assert len(heavy_keys(times, "k", 0.3)) == 1
    assert heavy_keys(df.limit(0), "k") == [] == heavy_keys(df.filter("k = 7"), "k")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    assert heavy_keys(df.mapInArrow(count, "k long"), "k", 0.05) == [-1]
    assert seen.value == 20_000


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_hot_keys_do_not_change_the_result(spark, how, null_safe):
    tables = chain_of(spark, 7)
    a, b = tables["a"].drop("x"), tables["b"].drop("x")
    plain = equi_join(a, b, "k", how, null_safe)
    for hot in [{"left": (0,)}, {"right": (0, 3)}, {"left": (0,), "right": (1, 99)}, {"left": ()}]:
        assert equal(equi_join(a, b, "k", how, null_safe, hot), plain)


def test_hot_keys_of_joined_rows_are_carried_along(spark):
    """The key is rare in its table and hot once that is joined; nothing is paired to see it."""
    users = spark.range(1000).selectExpr("id AS u", "id % 500 AS g")
    clicks = spark.range(5000).selectExpr("CASE WHEN id < 4000 THEN 7 ELSE id % 1000 END AS u", "id AS c")
    groups = spark.range(600).selectExpr("id AS g", "id AS name")
    tables = {"users": users, "clicks": clicks, "groups": groups}
    steps = [Step("u", "left"), Step("g", "full")]
    found = measured(tables, steps, 0.05)
    assert found[0].hot == {"right": (7,)} and found[1].hot == {"left": (7,)}
    assert equal(join_chain(tables, found), join_chain(tables, steps))
    assert has_rows(measured(tables, [Step("u"), Step("g")], 0.05)) == [{}, {}]


def has_rows(steps):
    return [s.hot for s in steps]
