"""Physical plans: what Spark is asked to do, and that nothing runs too early."""

from datetime import date

import pytest

import __spark_entry__ as entry
from shopgrain import operators as op
from shopgrain.plans import run_cleaning, run_transforms
from suite.cleaning import CLEANING, TRANSFORMS, raw_tables
from suite.views import view

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def planned(spark, name):
    return plan(entry.queries()[name](spark, SF_DIR))


JVM_ONLY = [n for n in entry.queries() if n != "s08_workbook_scan"]


@pytest.mark.parametrize("name", JVM_ONLY)
def test_no_python_workers_no_cross_joins(spark, name):
    text = planned(spark, name)
    for operator in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in text
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize(
    "name", ["a01_top_selling_products", "a03_top_revenue_products", "a13_premium_customers"]
)
def test_top_n_keeps_n_rows_per_task(spark, name):
    assert "TakeOrderedAndProject" in planned(spark, name)


@pytest.mark.parametrize(
    "name", ["a02_top_products_by_age_group", "a06_frequent_products_by_age_group"]
)
def test_rank_is_cut_before_the_shuffle(spark, name):
    text = planned(spark, name)
    assert "WindowGroupLimit" in text
    assert "Partial" in text


@pytest.mark.parametrize(
    "name", ["a05_frequent_products_by_year", "a21_monthly_product_trends"]
)
def test_year_filter_reaches_the_reader(spark, name):
    text = planned(spark, name)
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual" in text


@pytest.mark.parametrize(
    ("name", "exchanges"),
    [
        ("a01_top_selling_products", 3),  # per id, products, per name
        ("a09_total_revenue_by_product", 2),  # per id, products
        ("a12_customer_lifetime_value", 4),  # per order, orders, per customer, names
        ("a14_yearly_revenue", 3),  # per order, orders, per year
        ("a18_categorize_reviews", 2),  # per product, products
        ("c01_remove_duplicates_by_key", 1),
        ("c08_drop_nulls", 0),
        ("c11_clean_phone_numbers", 0),
        ("c23_clean_customers", 1),
        ("q03_duplicate_count", 2),  # equal rows, one total
        ("t04_enrich_orders", 1),
    ],
)
def test_shuffles(spark, conf, name, exchanges):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    assert planned(spark, name).count("Exchange ") == exchanges


@pytest.mark.parametrize("name", ["a01_top_selling_products", "a12_customer_lifetime_value"])
def test_items_are_summed_before_they_are_shuffled(spark, conf, name):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    text = planned(spark, name)
    scan = text.index("l_quantity", text.index("FileScan"))
    last_exchange = text.rindex("Exchange", 0, scan)
    assert "partial_sum" in text[last_exchange:scan]


def test_hot_duplicates_merge_in_the_map_tasks(spark):
    rows = spark.range(90_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS k", "id AS a", "'x' AS b"
    )
    kept = op.remove_duplicates(rows.repartition(8), ["k"])
    text = plan(kept)
    below_shuffle = text.index("Exchange hashpartitioning(k")
    assert "partial_min" in text[below_shuffle:]
    assert kept.where("k = -1").collect()[0].a == 0
    assert kept.count() == 60_001


def test_computed_fills_run_one_subquery(spark):
    text = planned(spark, "c03_impute_nulls_mean")
    assert text.count("+- Subquery subquery") == 1


def test_wide_tables(spark):
    wide = spark.range(50).selectExpr(
        *[
            f"CASE WHEN id % {i + 2} = 0 THEN 'null' ELSE 'x' END AS c{i}"
            for i in range(260)
        ]
    )
    nulls = sum(sum(v % (i + 2) == 0 for v in range(50)) for i in range(260))
    assert op.calculate_total_null_count(wide) == nulls
    kept, rejected = op.split_nulls(wide)
    assert kept.count() + rejected.count() == 50
    profile = op.profile_table(wide, "wide")
    assert profile.groupBy().sum("null_count").first()[0] == nulls


def test_only_used_columns_are_read(spark):
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in planned(
        spark, "a01_top_selling_products"
    )


def test_building_chains_starts_no_job(spark):
    tables = raw_tables(spark, SF_DIR)  # reading Parquet footers may start jobs
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "building chains")
    try:
        result = run_cleaning(tables, CLEANING)
        run_transforms(result.tables, TRANSFORMS)
        assert list(tracker.getJobIdsForGroup("lazy")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_steps_leave_the_session_alone(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.ansi.enabled",)}
    before["codegen"] = spark.conf.get("spark.sql.codegen.wholeStage")
    entry.queries()["a21_monthly_product_trends"](spark, SF_DIR).collect()
    assert spark.conf.get("spark.sql.ansi.enabled") == before["spark.sql.ansi.enabled"]
    assert spark.conf.get("spark.sql.codegen.wholeStage") == before["codegen"]


def hot_orders(spark):
    """Items of which a third belong to one order, and orders of one customer."""
    items = spark.range(300_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS order_id",
        "id % 50 AS product_id",
        "CAST(id % 4 AS INT) AS quantity",
        "repeat('x', 40) AS note",
    )
    orders = spark.range(300_000).selectExpr(
        "id AS order_id", "CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS customer_id"
    )
    customers = spark.range(300_000).selectExpr(
        "id AS customer_id", "CAST(id % 80 AS INT) AS age"
    )
    products = spark.range(50).selectExpr(
        "id AS product_id", "'p' || id AS product_name"
    )
    return customers, orders, items, products


def test_hot_keys_are_split_and_nothing_is_lost(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50k",
    )
    customers, orders, items, products = hot_orders(spark)
    found = op.top_products_by_age_group(customers, orders, items, products, top_n=50)
    total = found.groupBy().sum("total_quantity").first()[0]
    assert total == items.groupBy().sum("quantity").first()[0]
    found.collect()
    assert "skew=true" in plan(found)


def test_hot_target_keys_of_an_upsert_are_split(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50k",
    )
    target = spark.range(300_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN -5 ELSE id END AS k",
        "concat('xxx', sha2(string(id), 256)) AS v",
    )
    source = spark.range(200_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS k", "'new' AS v"
    )
    found = op.upsert_by_key(target, source, ["k"])
    kinds = found.selectExpr("substr(v, 1, 3) AS v").groupBy("v").count()
    counts = {r.v: r["count"] for r in kinds.collect()}
    new_keys = source.select("k").distinct().count()
    replaced = target.join(source, "k", "left_semi").count()
    assert counts == {"xxx": 300_000 - replaced, "new": new_keys}
    found.collect()
    assert "skew=true" in plan(found)


def test_hot_order_is_summed_completely(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    customers, orders, items, _ = hot_orders(spark)
    priced = items.selectExpr("*", "CAST(2 AS DECIMAL(12,2)) AS price")
    named = customers.selectExpr(
        "customer_id", "'a' AS first_name", "CAST(customer_id AS STRING) AS last_name"
    )
    found = op.customer_lifetime_value(priced, orders, named)
    expected = 2 * items.groupBy().sum("quantity").first()[0]
    assert found.groupBy().sum("CLV").first()[0] == expected


def test_date_filter_is_a_range(spark):
    orders = view(spark, SF_DIR, "shop_orders")
    start, end = date(1997, 1, 1), date(1998, 1, 1)
    found = op.frequent_products_by_year(
        view(spark, SF_DIR, "shop_order_item"),
        view(spark, SF_DIR, "shop_product"),
        orders,
        1997,
        top_n=1_000,
    )
    expected = (
        view(spark, SF_DIR, "shop_order_item")
        .join(orders.where(f"order_date >= '{start}' AND order_date < '{end}'"), "order_id")
        .count()
    )
    assert found.groupBy().sum("order_count").first()[0] == expected
