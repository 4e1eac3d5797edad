from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shopgrain import operators as op


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [
            ("null", -1, -5, 1.0, Decimal("-1.5")),
            (None, 2, -6, -1.0, Decimal("2.5")),
            ("x", -1, None, None, None),
            ("x", -1, None, None, None),
            ("x", -1, None, None, None),
        ],
        "t string, i int, l bigint, d double, m decimal(5,1)",
    )


def test_profile(table, values):
    profile = op.profile_table(table, "demo")
    assert profile.columns == [
        "table_name",
        "column_name",
        "null_count",
        "negative_count",
        "data_type",
        "row_count",
        "column_count",
        "duplicate_count",
    ]
    assert values(profile) == [
        ("demo", "t", 2, 0, "string", 5, 5, 2),
        ("demo", "i", 0, 4, "int", 5, 5, 2),
        ("demo", "l", 3, 2, "bigint", 5, 5, 2),
        ("demo", "d", 3, 1, "double", 5, 5, 2),
        ("demo", "m", 3, 1, "decimal(5,1)", 5, 5, 2),
    ]


def test_profile_with_the_older_type_rule(table, values):
    profile = op.profile_table(table, "demo", reference_types=True)
    assert values(profile, "negative_count") == [0, 4, 0, 1, 0]


def test_profile_of_an_empty_table(table, values):
    profile = op.profile_table(table.where("false"), "none")
    assert set(values(profile, "null_count", "row_count", "duplicate_count")) == {
        (0, 0, 0)
    }
    assert profile.count() == 5


def test_profiles_of_a_dataset(table):
    profile = op.profile_tables({"a": table, "b": table.select("t")})
    assert profile.count() == 6
    with pytest.raises(ValueError, match="no table"):
        op.profile_tables({})


def test_changes_and_summary(table, spark, values):
    before = op.profile_tables({"a": table, "gone": table.select("t")})
    after_table = table.dropDuplicates().selectExpr(
        "coalesce(t, '?') AS t", "abs(i) AS i", "CAST(l AS STRING) AS l", "d", "1 AS extra"
    )
    after = op.profile_tables({"a": after_table})
    changes = {(t, c, m): (b, a) for t, c, m, b, a in values(op.profile_changes(before, after))}
    assert changes[("a", "t", "Null Count")] == ("2", "1")
    assert changes[("a", "i", "Negative Count")] == ("4", "0")
    assert changes[("a", "l", "Data Type Change")] == ("bigint", "string")
    assert changes[("a", "extra", "Data Type Change")] == ("", "int")
    assert changes[("a", "m", "Data Type Change")] == ("decimal(5,1)", "")
    assert changes[("gone", "t", "Null Count")] == ("2", "0")
    assert ("a", "d", "Data Type Change") not in changes

    summary = op.profile_summary(before, after).orderBy("table_name")
    assert values(summary) == [
        ("a", 5, 5, 2, 3, 5, 0),
        ("gone", 5, 1, 2, None, None, None),
    ]


def test_duplicate_count(table, values):
    assert values(op.duplicate_count(table)) == [2]
    assert values(op.duplicate_count(table.where("false"))) == [0]


def test_upsert(spark, values):
    target = spark.createDataFrame(
        [(1, "old"), (2, "old"), (None, "old")], "k int, v string"
    )
    source = spark.createDataFrame(
        [("new", 2), ("newer", 2), ("new", 3), ("new", None), ("new", None)],
        "v string, k int",
    )
    found = op.upsert_by_key(target, source, ["k"])
    assert found.columns == ["k", "v"]
    assert sorted(values(found), key=repr) == sorted(
        [(1, "old"), (2, "new"), (3, "new"), (None, "new"), (None, "new"), (None, "old")],
        key=repr,
    )
    again = op.upsert_by_key(found.where("k IS NOT NULL"), source.where("k > 0"), ["k"])
    assert sorted(values(again)) == [(1, "old"), (2, "new"), (3, "new")]


def test_upsert_checks_its_columns(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(ValueError, match="at least one key"):
        op.upsert_by_key(target, target, [])
    with pytest.raises(ValueError, match="missing columns"):
        op.upsert_by_key(target, target.drop("v"), ["k"])


def test_profile_and_duplicates_by_digest(spark, table, values):
    """The same numbers, with nulls, NaN, both zeros and rows that are all null."""
    more = spark.createDataFrame(
        [("x", None, 1, float("nan"), None), ("x", None, 1, float("nan"), None)]
        + [(None, 0, 1, 0.0, None), (None, 0, 1, -0.0, None), (None,) * 5, (None,) * 5],
        table.schema,
    )
    for df in (table, table.unionByName(more).unionByName(table), table.where("false")):
        plain = op.duplicate_count(df).first()
        assert op.duplicate_count(df, by_digest=True).first() == plain
        assert values(op.profile_table(df, "t", by_digest=True)) == values(
            op.profile_table(df, "t")
        )


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_equal_digests_of_different_rows_are_told_apart(spark, monkeypatch, bits):
    def crowded(df):
        few = F.pmod(F.xxhash64("id", "v"), F.lit(1 << bits))
        return df.withColumn("_d1", few).withColumn("_d2", F.lit(0))

    monkeypatch.setattr("shopgrain.operators.quality._digested", crowded)
    df = spark.range(50).selectExpr("id % 40 AS id", "concat('wide', id % 40) AS v")
    assert op.duplicate_count(df, by_digest=True).first()[0] == 10

