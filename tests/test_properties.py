"""Properties that hold for any rows."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shopgrain import operators as op

few = settings(
    max_examples=6,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)

texts = st.sampled_from(
    ["null", "None", "", "x", "a@b.c", "05/01/2023", "2125550123", "-3", "2023-01-05"]
) | st.text(max_size=12).filter(lambda t: "\0" not in t)
numbers = st.floats(-1e6, 1e6) | st.just(math.nan) | st.none()
rows = st.lists(
    st.tuples(st.none() | st.integers(0, 4), st.none() | texts, numbers),
    min_size=1,
    max_size=25,
)
SCHEMA = "k int, t string, d double"


def bag(df):
    def plain(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else v

    return sorted(repr([plain(v) for v in r]) for r in df.collect())


STEPS = [
    lambda df: op.remove_duplicates(df, ["k"]),
    lambda df: op.remove_duplicates(df),
    lambda df: op.standardize_date_format(df, "t"),
    lambda df: op.validate_emails(df, "t", "bad"),
    lambda df: op.handle_negative_values(df, ["d"], "absolute"),
    lambda df: op.handle_negative_values(df, ["d"], "remove"),
    lambda df: op.handle_negative_values(df, ["d"], "zero"),
    lambda df: op.handle_negative_values(df, ["d"], "drop"),
    lambda df: op.drop_nulls(df, ["k", "t"]),
    lambda df: op.impute_nulls(df, ["t", "k"], "constant", 0),
    lambda df: op.impute_nulls(df, ["k", "t"], "mode"),
]


@pytest.mark.parametrize("step", STEPS)
@few
@given(data=rows)
def test_steps_are_idempotent(spark, step, data):
    once = step(spark.createDataFrame(data, SCHEMA))
    assert bag(step(once)) == bag(once)


@few
@given(data=rows)
def test_kept_and_rejected_are_the_input(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    kept, rejected = op.split_nulls(df, ["k", "d"])
    assert kept.count() + rejected.count() == len(data)
    assert op.split_nulls(kept, ["k", "d"])[1].isEmpty()


@few
@given(target=rows, source=rows)
def test_upserted_keys_are_the_source_rows(spark, target, source):
    left = op.remove_duplicates(spark.createDataFrame(target, SCHEMA), ["k"])
    right = spark.createDataFrame(source, SCHEMA)
    found = op.upsert_by_key(left.where("k IS NOT NULL"), right, ["k"])
    keyed = found.where("k IS NOT NULL")
    assert keyed.count() == keyed.select("k").distinct().count()
    unique = op.remove_duplicates(right.where("k IS NOT NULL"), ["k"])
    assert set(bag(unique)) <= set(bag(keyed))


@few
@given(data=rows)
def test_profile_counts_by_hand(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    profile = {r.column_name: r for r in op.profile_table(df, "x").collect()}
    assert profile["t"].null_count == sum(t in (None, "null") for _, t, _ in data)
    assert profile["d"].negative_count == sum(
        d is not None and not math.isnan(d) and d < 0 for _, _, d in data
    )
    distinct = {(k, t, None if d is None else repr(d + 0.0)) for k, t, d in data}
    assert profile["k"].duplicate_count == len(data) - len(distinct)


@few
@given(statuses=st.lists(st.sampled_from(["In stock", "To be ordered", "Out of stock"])))
def test_status_percentages_sum_to_100_or_0(spark, statuses):
    df = spark.createDataFrame([(s,) for s in statuses], "inventory_status string")
    shares = op.inventory_status_shares(df).collect()
    total = sum(r.percentage for r in shares)
    assert total == pytest.approx(100.0 if statuses else 0.0)
