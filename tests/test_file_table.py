"""Upserts into a table of files: the rows, and which files were written."""

import pytest
from pyspark.sql import functions as F

from shopgrain import operators as op
from shopgrain.plans.saving import new_folder
from shopgrain.sinks import FileTable


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def hundred(spark, conf):
    """A thousand keys in a hundred files, ten neighbours each."""
    table = FileTable(spark, new_folder(spark))
    df = spark.range(1000).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    folders = df.repartitionByRange(100, "k")
    assert table.create(folders) == 1
    assert len(table.files()) == 100
    return table


def test_only_touched_files_are_rewritten(spark, hundred):
    before = set(hundred.files())
    key = hundred.read().where(f"_metadata.file_path like '%{sorted(before)[7].split('/')[-1]}'")
    (k,) = key.agg(F.min("k")).first()
    done = hundred.upsert(spark.createDataFrame([(k, "new")], "k long, v string"), ["k"])
    assert (done.version, done.kept, done.replaced) == (2, 99, 1)
    after = set(hundred.files())
    assert len(before - after) == 1 and len(after - before) == done.added
    got = dict(rows(hundred.read()))
    assert len(got) == 1000 and got[k] == "new" and set(got.values()) == {"old", "new"}
    assert set(dict(rows(hundred.read(1))).values()) == {"old"}
    assert hundred.versions() == [1, 2]


def test_new_keys_alone_touch_no_file(spark, hundred):
    source = spark.createDataFrame([(5000, "a"), (-3, "b"), (None, "c")], "k long, v string")
    done = hundred.upsert(source, ["k"])
    assert (done.kept, done.replaced) == (100, 0)
    assert hundred.read().count() == 1003


@pytest.mark.parametrize("keys", [["k"], ["k", "d"], ["s"], ["d"]])
def test_rows_equal_those_of_the_plain_upsert(spark, keys):
    kinds = "k int, s string, d date, x double, m decimal(9,2)"
    day = "DATE'2020-01-01' + cast(id % {} as int)"

    def made(n, factor, mark):
        return spark.range(n).selectExpr(
            f"IF(id % 7 = 3, NULL, cast(id * {factor} as int)) AS k",
            f"IF(id % 11 = 5, NULL, concat('s', id * {factor})) AS s",
            f"IF(id % 13 = 1, NULL, {day.format(9 * factor)}) AS d",
            f"cast({mark} as double) AS x",
            "cast(id as decimal(9,2)) AS m",
        )

    target, source = made(300, 1, 1), made(200, 2, 2)
    source = source.unionByName(source.limit(40)).select("m", "x", "d", "s", "k")
    table = FileTable(spark, new_folder(spark))
    table.create(target, sort_by=keys)
    assert table.read().schema.simpleString() == spark.createDataFrame([], kinds).schema.simpleString()
    table.upsert(source, keys)
    assert rows(table.read()) == rows(op.upsert_by_key(target, source, keys))


def test_empty_sides(spark):
    table = FileTable(spark, new_folder(spark))
    none = spark.createDataFrame([], "k long, v string")
    table.create(none)
    assert table.read().count() == 0
    table.upsert(none, ["k"])
    table.upsert(spark.createDataFrame([(1, "a"), (1, "a"), (None, "b")], none.schema), ["k"])
    assert rows(table.read()) == [(1, "a"), (None, "b")]
    table.upsert(none, ["k"])
    assert rows(table.read()) == [(1, "a"), (None, "b")] and table.versions() == [1, 2, 3, 4]


def test_a_version_is_committed_once(spark, hundred):
    one = spark.createDataFrame([(1, "x")], "k long, v string")
    stale = FileTable(spark, hundred.path)
    stale.versions = lambda: [1]  # a writer that has not seen the other's commit
    hundred.upsert(one, ["k"])
    with pytest.raises(Exception, match="(?i)already exists"):
        stale.upsert(one, ["k"])
    assert hundred.versions() == [1, 2] and hundred.read().count() == 1000


def test_columns_are_checked(spark, hundred):
    with pytest.raises(ValueError, match="key"):
        hundred.upsert(spark.range(1).toDF("k"), [])
    with pytest.raises(Exception, match="v"):
        hundred.upsert(spark.range(1).toDF("k"), ["k"])


def test_key_ranges_reach_the_reader(spark, hundred):
    replacing = spark.createDataFrame([(5,), (9,)], "k long")
    test = hundred._within(hundred.read(), replacing, ["k"])
    plan = hundred.read().where(test)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(k,5)" in plan and "LessThanOrEqual(k,9)" in plan
