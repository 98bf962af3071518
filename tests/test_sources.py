"""Tables written and read back."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import types as T

from joinwright.operators.compare import equal
from joinwright.sources import (
    made_folders,
    new_folder,
    read_table,
    read_tables,
    read_typed,
    remove_made_folders,
    save_tables,
    shared_folder,
    unconverted,
    write_table,
)


@pytest.fixture
def odd(spark):
    rows = [
        (1, 'say "hi", they said', 1.5, dt.date(1200, 1, 1), True),
        (2, "", 1e-300, dt.date(2047, 12, 2), False),
        (3, None, None, None, None),
        (5, "\\", None, None, None),
        (6, ' ends with \\" ', None, None, None),
        (4, "back\\slash, comma; № ünï", -0.1, dt.date(2020, 2, 29), True),
    ]
    return spark.createDataFrame(rows, "k int, s string, x double, d date, f boolean")


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_round_trip(spark, odd, fmt, tmp_path):
    path = write_table(odd, str(tmp_path / "odd"), fmt)
    assert equal(read_table(spark, path, fmt, odd.schema), odd)


def test_line_breaks(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a\nb "c"\r\nd'), (2, "e")], "k int, s string")
    path = write_table(df, str(tmp_path / "t"))
    back = read_table(spark, path, "csv", df.schema, multiline=True)
    assert sorted(r.k for r in back.collect()) == [1, 2]
    assert equal(back.filter("k = 2"), df.filter("k = 2"))
    assert back.filter("k = 1").first().s == 'a\nb "c"\r\nd'


def test_inferred_types(spark, odd, tmp_path):
    path = write_table(odd, str(tmp_path / "odd"))
    types = {f.name: f.dataType for f in read_table(spark, path).schema}
    assert types == {
        "k": T.IntegerType(), "s": T.StringType(), "x": T.DoubleType(),
        "d": T.DateType(), "f": T.BooleanType(),
    }


def test_overwrite(spark, odd, tmp_path):
    path = str(tmp_path / "odd")
    write_table(odd, path)
    write_table(odd.limit(1), path)
    assert read_table(spark, path, "csv", odd.schema).count() == 1


def test_names_of_saved_tables(spark, odd, tmp_path):
    paths = save_tables([odd, odd], str(tmp_path), "parquet", result=odd)
    assert list(paths) == ["Dataset№1", "Dataset№2", "Result"]
    named = save_tables({"a": odd, "b": odd.limit(2)}, f"{tmp_path}/n/", "csv")
    assert named == {n: f"{tmp_path}/n/{n}.csv" for n in "ab"}
    listed = ",".join(named.values())
    schemas = {"a": odd.schema, "b": odd.schema}
    back = read_tables(spark, listed, "csv", schemas)
    assert list(back) == ["a", "b"]
    assert [df.count() for df in back.values()] == [6, 2]
    with pytest.raises(ValueError, match="Result"):
        save_tables({"Result": odd}, str(tmp_path), result=odd)


def test_unknown_format(spark, odd, tmp_path):
    with pytest.raises(ValueError, match="unknown format"):
        write_table(odd, str(tmp_path), "orc")
    with pytest.raises(ValueError, match="unknown format"):
        read_table(spark, str(tmp_path), "json")


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_typed_scan_and_what_does_not_convert(spark, tmp_path, fmt):
    df = spark.createDataFrame(
        [("1", "2020-01-01"), ("x", "2020-13-01"), (None, None), ("4", "soon")],
        "n string, d string",
    )
    path = write_table(df, str(tmp_path / "t"), fmt)
    types = {"n": "IntegerType", "d": "DateType"}
    typed = read_typed(spark, path, types, fmt)
    assert sorted(r.n for r in typed.filter("n IS NOT NULL").collect()) == [1, 4]
    assert [r.d for r in typed.filter("d IS NOT NULL").collect()] == [dt.date(2020, 1, 1)]
    assert unconverted(spark, path, types, fmt).first().asDict() == {"n": 1, "d": 2}
    with pytest.raises(ValueError, match="unknown type"):
        read_typed(spark, path, {"n": "MapType"}, fmt)


def test_only_the_columns_asked_for_are_read(spark, odd, tmp_path):
    path = write_table(odd, str(tmp_path / "odd"), "parquet")
    plan = read_table(spark, path, "parquet").filter("k > 2").select("x")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<k:int,x:double>" in text
    assert "GreaterThan(k,2)" in text


def session(master, setting=None, directory=None):
    """As much of a session as is asked for the shared folder."""
    context = SimpleNamespace(master=master, directory=directory)
    context.getCheckpointDir = lambda: context.directory
    context.setCheckpointDir = lambda folder: setattr(context, "directory", folder)
    return SimpleNamespace(conf={"spark.checkpoint.dir": setting}, sparkContext=context)


def test_shared_folder_is_the_configured_one(spark):
    assert new_folder(spark).startswith(shared_folder(spark))
    assert new_folder(spark) != new_folder(spark)
    configured = session("yarn", "hdfs:///shared/")
    assert shared_folder(configured) == "hdfs:///shared/"
    assert configured.sparkContext.directory == "hdfs:///shared/"
    assert new_folder(configured).startswith("hdfs:///shared/")
    assert "//" not in new_folder(configured).removeprefix("hdfs:///")
    assert shared_folder(session("yarn", directory="hdfs:///set")) == "hdfs:///set"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn"))


def test_line_breaks_through_many_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\nb"), (2, 'c"\r\n,d'), (3, ""), (4, None)], "n int, v string")
    paths = save_tables({"a": df, "b": df}, str(tmp_path), "csv")
    schemas = {"a": df.schema, "b": df.schema}
    found = read_tables(spark, paths, "csv", schemas, multiline=True)
    for name in "ab":
        assert sorted(found[name].collect()) == sorted(df.collect())
    with pytest.raises(Exception, match="MALFORMED"):
        read_tables(spark, paths, "csv", schemas)["a"].collect()


def test_a_text_of_just_nul_is_refused(spark, tmp_path):
    df = spark.createDataFrame([("\0",)], "v string")
    with pytest.raises(Exception, match="NUL"):
        write_table(df, str(tmp_path / "t"))


def test_what_does_not_convert_is_what_is_counted(spark, tmp_path):
    values = ["true", "yes", "t", "0", "maybe", "", None, "2020-01-01", "1.5", "7"]
    df = spark.createDataFrame([(v, v, v) for v in values], "b string, n string, d string")
    path = write_table(df, str(tmp_path / "t.csv"))
    types = {"b": "BooleanType", "n": "IntegerType", "d": "DateType"}
    read = read_typed(spark, path, types).collect()
    counted = unconverted(spark, path, types).first()
    for c in types:
        assert counted[c] == sum(r[c] is None for r in read) - 1


def test_made_folders_can_be_removed(spark):
    df = spark.range(5)
    kept, gone = new_folder(spark), new_folder(spark)
    for folder in (kept, gone):
        df.write.parquet(folder)
    assert {kept, gone} <= set(made_folders())
    remove_made_folders(spark, [gone])
    assert gone not in made_folders() and kept in made_folders()
    assert spark.read.parquet(kept).count() == 5
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(gone)
