import math
from collections import Counter
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopgrain import operators as op
from shopgrain.operators import cleaning
from shopgrain.operators.modes import TRACKED, exact_modes
from shopgrain.operators.quantiles import exact_medians


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


# C1


def test_duplicates_keep_the_smallest_row(spark):
    df = frame(spark, "k int, a string, b int", (1, "y", 1), (1, "x", 2), (2, "z", 3))
    kept = op.remove_duplicates(df, ["k"]).orderBy("k").collect()
    assert [tuple(r) for r in kept] == [(1, "x", 2), (2, "z", 3)]


def test_null_keys_are_one_key(spark, values):
    df = frame(spark, "k int, a int", (None, 2), (None, 1), (1, 5))
    assert sorted(values(op.remove_duplicates(df, ["k"]), "a")) == [1, 5]


def test_duplicates_keep_column_order_and_types(spark):
    df = frame(spark, "a string, k int, `b.c` double", ("x", 1, 1.0), ("w", 1, 2.0))
    kept = op.remove_duplicates(df, ["k"])
    assert kept.dtypes == df.dtypes
    assert tuple(kept.first()) == ("w", 1, 2.0)


def test_order_by_and_keep_last(spark):
    df = frame(spark, "k int, a int, at int", (1, 9, 1), (1, 2, 5), (1, 3, 5))
    first = op.remove_duplicates(df, ["k"], order_by=["at"]).first()
    last = op.remove_duplicates(df, ["k"], order_by=["at"], keep="last").first()
    assert (first.a, first["at"]) == (9, 1)
    assert (last.a, last["at"]) == (3, 5)


def test_duplicates_over_all_columns(spark):
    df = frame(spark, "a int, b int", (1, 1), (1, 1), (1, 2))
    assert op.remove_duplicates(df).count() == 2
    assert op.remove_duplicates(df, ["a", "b"]).count() == 2


def test_duplicates_reject_unknown_columns_and_rules(spark):
    df = frame(spark, "a int", (1,))
    with pytest.raises(ValueError, match="missing columns"):
        op.remove_duplicates(df, ["b"])
    with pytest.raises(ValueError, match="keep"):
        op.remove_duplicates(df, ["a"], keep="any")


# C2-C7


MIXED = "t string, i int, d double, day date"


@pytest.fixture
def mixed(spark):
    return spark.sql(
        """SELECT * FROM VALUES ('null', 1, 1.5D, DATE '2020-01-01'),
        (NULL, NULL, NULL, NULL), ('', 4, double('NaN'), NULL),
        ('None', 4, 4.5D, DATE '2020-01-01') AS v(t, i, d, day)"""
    )


def test_constant_fills_null_and_null_text_only(mixed, values):
    filled = op.impute_nulls(mixed, ["t"], "constant", "?")
    assert values(filled, "t") == ["?", "?", "", "None"]


def test_text_constant_leaves_other_types(mixed, values):
    filled = op.impute_nulls(mixed, ["i", "d", "day"], "constant", "Not Available")
    assert values(filled, "i") == [1, None, 4, 4]
    assert values(filled, "d") == [1.5, None, None, 4.5]  # NaN is missing too
    assert filled.dtypes == mixed.dtypes


def test_number_constant_is_cut_to_the_column_type(mixed, values):
    assert values(op.impute_nulls(mixed, ["i"], "constant", 7.9), "i")[1] == 7
    assert values(op.impute_nulls(mixed, ["t"], "constant", 7), "t")[1] == "7"


def test_mean_is_cut_in_integer_columns_and_ignores_nan(mixed, values):
    filled = op.impute_nulls(mixed, ["i", "d"], "mean")
    assert values(filled, "i") == [1, 3, 4, 4]
    assert values(filled, "d") == [1.5, 3.0, 3.0, 4.5]


def test_mode_ignores_null_and_takes_the_smallest_tie(spark, values):
    df = frame(spark, "a string, n int", ("b", 2), ("a", 1), (None, 2), (None, 3))
    filled = op.impute_nulls(df, ["a", "n"], "mode")
    assert values(filled, "a") == ["b", "a", "a", "a"]
    nothing = op.impute_nulls(df.where("a IS NULL"), ["a"], "mode")
    assert values(nothing, "a") == [None, None]


@pytest.mark.parametrize("method", ["lazy", "digests"])
def test_modes_of_many_types(spark, values, method):
    exact = method == "digests"
    df = spark.range(3000).selectExpr(
        "id AS row",
        "IF(id % 3 = 0, 7, id) AS hot",
        "IF(id % 2 = 0, NULL, CAST(id % 5 AS STRING)) AS few",
        "IF(id = 5, NULL, 5000 - id) AS once",
        "IF(id = 5, NULL, repeat(CAST(9000 - id DIV 2 AS STRING), 300)) AS pairs",
        "CASE id % 3 WHEN 0 THEN CAST('NaN' AS DOUBLE) WHEN 1 THEN id * 0.5D END AS real",
        "IF(id = 5, NULL, CAST(id % 7 AS DECIMAL(12,2))) AS money",
        "IF(id = 5, NULL, TIMESTAMP'2024-01-01' + make_interval(0, 0, 0, id % 900)) AS ts",
        "IF(id = 5, NULL, named_struct('a', id % 3, 'b', 'x')) AS pair",
        "CAST(NULL AS INT) AS nothing",
    )
    filled = op.impute_nulls(df, df.columns[1:], "mode", exact=exact)
    assert filled.schema.simpleString() == df.schema.simpleString()
    fifth = filled.where("row = 5").drop("row")
    got = fifth.selectExpr("hot", "real", "nothing", "money", "pair.a", "ts = '2024-01-01'").first()
    assert tuple(got) == (5, 0.5, None, Decimal("0.00"), 0, True)
    assert values(fifth, "once", "pairs") == [(2001, "7501" * 300)]
    assert values(filled.where("row = 4"), "few") == ["0"]


def test_modes_hidden_by_equal_digests(spark, monkeypatch):
    """Values that share a digest are told apart by value."""
    rows = [(i,) for i in range(2000)] * 2 + [(5000,)] * 3 + [(9000,)] * 2 + [(9001,)] * 2
    df = spark.createDataFrame(rows, "x int")
    plain = F.xxhash64
    monkeypatch.setattr(
        "shopgrain.operators.modes.F.xxhash64",
        lambda c: F.when(c >= 9000, F.lit(1).cast("long")).otherwise(plain(c)),
    )
    assert exact_modes(df, ["x"]) == {"x": 5000}


def test_a_sketch_of_frequent_digests_holds_as_many_as_its_error_assumes(spark):
    for n, kept in ((TRACKED, TRACKED), (TRACKED + 1, 0)):
        df = spark.range(n).coalesce(1)
        top = df.agg(F.expr(f"approx_top_k(id, {TRACKED}, {TRACKED})")).first()[0]
        assert len(top) == kept


@settings(
    max_examples=10,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(st.lists(st.integers(0, 40), max_size=60), st.integers(0, 1500))
def test_modes_against_counting(spark, numbers, noise):
    rows = [(n,) for n in numbers] + [(100 + i,) for i in range(noise)] + [(None,)]
    counts = Counter(r[0] for r in rows if r[0] is not None)
    best = min(counts, key=lambda v: (-counts[v], v)) if counts else None
    assert exact_modes(spark.createDataFrame(rows, "x int"), ["x"]) == {"x": best}


def test_values_that_occur_once_are_never_counted_by_value(spark, monkeypatch):
    monkeypatch.setattr("shopgrain.operators.modes._best", None)
    df = spark.range(20_000).selectExpr("repeat(CAST(20000 - id AS STRING), 50) AS text")
    assert exact_modes(df, ["text"]) == {"text": "10000" * 50}


def test_median_exact_and_approximate(spark, values):
    numbers = spark.range(1001).select(
        F.when(F.col("id") != 1000, F.col("id")).alias("n")
    )
    exact = op.impute_nulls(numbers, ["n"], "median", exact=True)
    assert values(exact, "n")[-1] == 499
    approximate = op.impute_nulls(numbers, ["n"], "median")
    assert abs(values(approximate, "n")[-1] - 499) <= 10


@pytest.mark.parametrize("method", ["mean", "median"])
def test_statistics_of_text_raise(mixed, method):
    with pytest.raises(ValueError, match="numeric"):
        op.impute_nulls(mixed, ["t"], method)


def test_unknown_methods_raise(mixed):
    with pytest.raises(ValueError, match="method"):
        op.impute_nulls(mixed, ["t"], "guess")
    with pytest.raises(ValueError, match="strategy"):
        op.impute_missing_values(mixed, "constant", 1)


def test_missing_values_keep_the_null_text(mixed, values):
    filled = op.impute_missing_values(mixed, "value", "?", ["t"])
    assert values(filled, "t") == ["null", "?", "", "None"]


def test_missing_values_without_columns(mixed, values):
    filled = op.impute_missing_values(mixed)
    assert values(filled, "t")[1] is None
    assert values(filled, "i")[1] == 3
    assert values(op.impute_missing_values(mixed, "mode"), "i")[1] == 4


def test_decimal_mean(spark, values):
    df = frame(spark, "d decimal(10,2)", (Decimal("1.00"),), (Decimal("2.01"),), (None,))
    assert values(op.impute_nulls(df, ["d"], "mean"), "d")[2] == Decimal("1.51")


# exact median


@pytest.mark.parametrize(
    "sql",
    [
        "SELECT id AS v FROM range(10001)",
        "SELECT CAST(hash(id) AS DOUBLE) AS v FROM range(20000)",
        "SELECT id % 7 AS v FROM range(10000)",
        "SELECT CASE WHEN id % 3 = 0 THEN 5 ELSE id END AS v FROM range(9000)",
        "SELECT CASE WHEN id < 5000 THEN 0 ELSE 1 END AS v FROM range(10000)",
        "SELECT CAST(hash(id) % 1000 AS DECIMAL(12,3)) / 8 AS v FROM range(5000)",
        "SELECT CASE WHEN id % 5 = 0 THEN NULL ELSE -id * 0.25D END AS v FROM range(999)",
    ],
)
def test_exact_median_narrows_to_the_right_value(spark, sql):
    df = spark.sql(sql)
    ordered = sorted(r.v for r in df.collect() if r.v is not None)
    expected = ordered[(len(ordered) + 1) // 2 - 1]
    # A small sketch and a small last step force several narrowing passes.
    assert op.exact_median(df, "v", accuracy=20, sortable=10) == expected
    assert op.exact_median(df, "v") == expected


def test_a_median_takes_two_jobs(spark):
    columns = ["id * 7919 % 100003 AS a", "IF(id % 3 = 0, NULL, id % 10) AS b", "id * 0.5F AS c"]
    df = spark.range(100_003).selectExpr(*columns)
    group = "two-jobs"
    spark.sparkContext.setJobGroup(group, group)
    found = exact_medians(df, df.columns)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setJobGroup("one-job", "one-job")
    df.agg(*[F.max(c) for c in df.columns]).first()
    one = spark.sparkContext.statusTracker().getJobIdsForGroup("one-job")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 2 * len(one)
    assert found["a"] == 50_001 and found["c"] == 25_000.5
    assert found["b"] == df.selectExpr("percentile_disc(0.5) WITHIN GROUP (ORDER BY b)").first()[0]


@pytest.mark.parametrize("shift", [-0.3, -0.05, 0.05, 0.3])
def test_a_median_outside_its_first_cuts_is_found_beside_them(spark, monkeypatch, shift):
    plain = F.percentile_approx

    def shifted(column, at, accuracy):
        moved = [x + shift for x in at] if len(at) == 2 else at
        return plain(column, moved, accuracy)

    df = spark.range(20_001).selectExpr("id * 7919 % 20001 AS v")
    monkeypatch.setattr("shopgrain.operators.quantiles.F.percentile_approx", shifted)
    assert op.exact_median(df, "v", accuracy=100, sortable=300) == 10_000


def test_a_median_needs_an_accuracy(spark):
    with pytest.raises(ValueError, match="accuracy"):
        op.exact_median(spark.range(3), "id", accuracy=5)


def test_exact_median_without_values(spark):
    assert op.exact_median(spark.sql("SELECT CAST(NULL AS INT) AS v"), "v") is None


# C8, K1


def test_drop_nulls_splits_all_rows(spark, values):
    df = frame(
        spark,
        "k int, a string, b string",
        (1, "x", "null"),
        (2, "null", "x"),
        (3, "None", "x"),
        (4, "", "x"),
        (None, "x", "x"),
        (5, None, "x"),
    )
    kept, rejected = op.split_nulls(df, ["k", "a"])
    assert values(kept) == [(1, "x", None)]
    assert rejected.count() == 5
    assert values(op.drop_nulls(df, ["k", "a"])) == [(1, "x", None)]


def test_drop_nulls_over_all_columns_and_nan(spark):
    df = frame(spark, "a double, b int", (1.0, 1), (math.nan, 1), (1.0, None))
    kept, rejected = op.split_nulls(df)
    assert (kept.count(), rejected.count()) == (1, 2)


# C9, C12-C17


def test_remove_decimal(spark, values):
    df = frame(spark, "d double, t string", (-1.2, "3.9"), (None, "abc"), (2.0, None))
    floored = op.remove_decimal(df, ["d", "t", "absent"])
    assert values(floored) == [(-2, 3), (None, None), (2, None)]
    assert floored.dtypes == [("d", "bigint"), ("t", "bigint")]
    with pytest.raises(ValueError, match="missing columns"):
        op.remove_decimal(df, ["absent"], missing="raise")


NUMBERS = [(-1.2,), (0.0,), (None,), (math.nan,), (3.7,)]


@pytest.mark.parametrize(
    ("operation", "expected"),
    [
        ("absolute", [1.2, 0.0, None, "nan", 3.7]),
        ("remove", [None, 0.0, None, "nan", 3.7]),
        ("zero", [0.0, 0.0, 0.0, "nan", 3.7]),
        ("drop", [0.0, "nan", 3.7]),
    ],
)
def test_negative_values(spark, values, operation, expected):
    df = frame(spark, "d double", *NUMBERS)
    found = values(op.handle_negative_values(df, ["d"], operation), "d")
    assert ["nan" if v is not None and math.isnan(v) else v for v in found] == expected


def test_negative_values_with_floor(spark, values):
    df = frame(spark, "d double", (-1.2,), (0.0,), (None,), (3.7,))
    floored = op.handle_negative_values(df, ["d"], "absolute", apply_floor=True)
    assert values(floored, "d") == [1, 0, None, 3]


def test_negative_texts_keep_their_type(spark, values):
    df = frame(spark, "t string", ("-5",), ("abc",), (None,), ("2",))
    flipped = op.handle_negative_values(df, ["t"])
    assert values(flipped, "t") == ["5.0", "abc", None, "2"]
    zeroed = op.handle_negative_values(df, ["t"], "zero")
    assert values(zeroed, "t") == ["0", "0", "0", "2"]


def test_negative_values_reject_unknown_rule(spark):
    df = frame(spark, "d double", (1.0,))
    with pytest.raises(ValueError, match="operation"):
        op.handle_negative_values(df, ["d"], "flip")
    assert op.handle_negative_values(df, ["absent"]).collect() == df.collect()


# C18, C20, C21


def test_remove_string_is_a_pattern_unless_literal(spark, values):
    df = frame(spark, "t string", ("a\nb.c",), (None,))
    assert values(op.remove_string_from_columns(df, ["t"], r"\n"), "t") == ["ab.c", None]
    assert values(op.remove_string_from_columns(df, ["t"], "."), "t")[0] == "\n"
    plain = op.remove_string_from_columns(df, ["t"], ".", literal=True)
    assert values(plain, "t")[0] == "a\nbc"


def test_total_null_count(mixed, spark):
    # By row: the null text, four nulls, the missing day (NaN is not counted).
    assert op.calculate_total_null_count(mixed) == 1 + 4 + 1
    assert op.calculate_total_null_count(mixed.where("false")) == 0


def test_convert_column_type(spark, values):
    df = frame(spark, "t string", ("2020-01-05",), ("Invalid Date",), (None,))
    converted = op.convert_column_type(df, "t", "date")
    assert [str(v) for v in values(converted, "t")] == ["2020-01-05", "None", "None"]
    with pytest.raises(ValueError, match="cannot convert"):
        op.convert_column_type(df, "t", "no_type")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        op.convert_column_type(df, "t", "date", strict=True).collect()


def test_names_with_dots_and_spaces(spark, values):
    df = frame(spark, "`a.b c` double", (-1.5,), (None,))
    assert values(op.handle_negative_values(df, ["a.b c"]))[0] == 1.5
    assert values(op.impute_nulls(df, ["a.b c"], "constant", 2.0))[1] == 2.0
    assert op.split_nulls(df, ["a.b c"])[1].count() == 1
    dated = frame(spark, "`d.e` string", ("05/01/2023",))
    assert values(op.standardize_date_format(dated, "d.e"))[0] == "2023-01-05"
    assert cleaning.clean_phone_numbers(dated, "d.e").count() == 1


def test_duplicates_with_map_columns(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, map('b', 2, 'a', 1)), (1, map('a', 0)), (2, null) AS t(k, m)"
    )
    got = {r.k: r.m for r in op.remove_duplicates(df, ["k"]).collect()}
    assert got == {1: {"a": 0}, 2: None}


def test_medians_of_all_columns_take_the_same_passes(spark):
    from shopgrain.operators.quantiles import exact_medians

    def jobs(n):
        """Jobs of the medians of n columns, and the medians."""
        columns = [f"(id * {7 + i}) % 1009 AS c{i}" for i in range(n)]
        df = spark.range(2000).selectExpr(*columns)
        group = f"medians-{n}"
        spark.sparkContext.setJobGroup(group, group)
        found = exact_medians(df, df.columns, accuracy=100, sortable=50)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for c, value in found.items():
            ordered = sorted(r[c] for r in df.select(c).collect())
            assert value == ordered[(len(ordered) + 1) // 2 - 1]
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(6) <= jobs(1) + 2


def test_modes_read_the_input_twice(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (None, None)], "x int, y string")
    filled = op.impute_nulls(df, ["x", "y"], "mode")
    assert sorted(map(tuple, filled.collect())) == [(1, "a"), (1, "b"), (1, "b"), (2, "b")]
    plan = filled._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") <= 2
