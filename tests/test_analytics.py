"""Business rules that are easy to get wrong, on a few rows."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shopgrain import operators as op
from shopgrain.operators.inventory import stock_status
from shopgrain.operators.reviews import rating_category


@pytest.fixture(scope="module")
def shop(spark):
    """Catalogue prices differ from item prices; two products share a name."""
    products = spark.createDataFrame(
        [
            (1, "pen", "office", Decimal("2.00"), 200),
            (2, "pen", "office", Decimal("3.00"), 20),
            (3, "mug", "kitchen", Decimal("5.00"), 0),
            (4, "lamp", None, Decimal("40.00"), None),
            (5, "unsold", "office", Decimal("1.00"), 10),
        ],
        "product_id bigint, product_name string, category string, "
        "price decimal(12,2), inventory int",
    )
    items = spark.createDataFrame(
        [
            (1, 10, 1, 4, Decimal("1.00")),
            (2, 10, 2, 5, Decimal("1.50")),
            (3, 11, 3, 9, Decimal("4.00")),
            (4, 12, 1, 1, Decimal("1.00")),
            (5, 12, 4, 2, Decimal("30.50")),
            (6, 13, 3, 1, Decimal("4.00")),
            (7, 13, 99, 50, Decimal("4.00")),  # not in the catalogue
            (8, None, None, 70, Decimal("4.00")),
            (9, 14, 1, None, Decimal("9.00")),
        ],
        "order_item_id int, order_id int, product_id bigint, quantity int, "
        "price decimal(12,2)",
    )
    orders = spark.createDataFrame(
        [
            (10, 100, date(2022, 12, 31)),
            (11, 101, date(2023, 1, 1)),
            (12, 102, date(2023, 12, 31)),
            (13, 100, date(2024, 1, 1)),
            (14, 102, None),
            (15, 103, date(2023, 5, 5)),
        ],
        "order_id int, customer_id int, order_date date",
    )
    customers = spark.createDataFrame(
        [
            (100, "Ada", "Low", date(2010, 5, 5), 14),
            (101, "Bob", None, date(1984, 5, 5), 40),
            (102, None, "Cey", None, None),
            (103, "Dee", "Fox", date(1990, 1, 1), 34),
        ],
        "customer_id int, first_name string, last_name string, birth_date date, age int",
    )
    return {
        "products": products,
        "order_items": items,
        "orders": orders,
        "customers": customers,
    }


def pick(shop, *names):
    return {n: shop[n] for n in names}


ITEMS = ("order_items", "products")


def test_top_selling_groups_by_name(shop, values):
    top = op.top_selling_products(**pick(shop, *ITEMS))
    assert values(top) == [("mug", 10), ("pen", 10), ("lamp", 2)]
    assert values(op.top_selling_products(**pick(shop, *ITEMS), top_n=1)) == [("mug", 10)]


def test_revenue_uses_catalogue_price(shop, values):
    top = op.top_revenue_products(**pick(shop, *ITEMS))
    assert values(top) == [("lamp", 80), ("mug", 50), ("pen", 25)]
    shares = op.top_revenue_shares(**pick(shop, *ITEMS), top_n=2)
    assert values(shares, "share_percent") == pytest.approx([61.538, 38.462], abs=1e-3)


def test_frequency_counts_lines(shop, values):
    top = op.frequent_products(**pick(shop, *ITEMS))
    assert values(top) == [("pen", 4), ("mug", 2), ("lamp", 1)]


def test_year_includes_both_ends(shop, values):
    tables = pick(shop, "order_items", "products", "orders")
    found = op.frequent_products_by_year(**tables, year=2023)
    assert values(found) == [("lamp", 1), ("mug", 1), ("pen", 1)]
    text_dates = shop["orders"].withColumn("order_date", F.col("order_date").cast("string"))
    found = op.frequent_products_by_year(**{**tables, "orders": text_dates}, year=2023)
    assert found.count() == 3


def test_age_groups_rank_ids_and_keep_ties(shop, values):
    tables = pick(shop, "customers", "orders", "order_items", "products")
    found = op.top_products_by_age_group(**tables, top_n=1).orderBy("age_group")
    assert values(found) == [
        ("40-49", 3, "mug", 9, 1),
        ("50+", 4, "lamp", 2, 1),
    ]  # the best of "<20" is not in the catalogue
    two = op.top_products_by_age_group(**tables, top_n=2)
    assert ("<20", 2, "pen", 5, 2) in values(two)
    tied = shop["order_items"].withColumn("quantity", F.lit(1))
    ties = op.top_products_by_age_group(**{**tables, "order_items": tied}, top_n=1)
    assert ties.where("age_group = '<20'").count() == 3


def test_age_groups_by_birth_year_rank_names(shop, values):
    tables = pick(shop, "customers", "orders", "order_items", "products")
    found = op.frequent_products_by_age_group(**tables, top_n=1)
    assert sorted(values(found)) == [
        ("40-49", "mug", 1, 1),
        ("50+", "pen", 2, 1),
        ("<20", "pen", 2, 1),
    ]
    later = op.frequent_products_by_age_group(**tables, top_n=1, as_of_year=2034)
    assert "20-29" in values(later, "age_group")


def test_average_revenue_uses_item_price(shop, values):
    found = op.average_revenue_by_category(**pick(shop, *ITEMS))
    assert dict(values(found)) == {"office": 4, "kitchen": 20, None: 61}
    assert dict(found.dtypes)["average_revenue"] == "bigint"


def test_total_revenue_by_product(shop, values):
    found = op.total_revenue_by_product(**pick(shop, *ITEMS))
    assert sorted(values(found)) == [
        (1, "pen", Decimal("10.00")),
        (2, "pen", Decimal("15.00")),
        (3, "mug", Decimal("50.00")),
        (4, "lamp", Decimal("80.00")),
    ]


def test_repeated_catalogue_rows_count_again_as_a_join_would(shop, spark, values):
    twice = shop["products"].unionByName(shop["products"])
    top = op.top_selling_products(shop["order_items"], twice)
    assert values(top) == [("mug", 20), ("pen", 20), ("lamp", 4)]
    average = op.average_revenue_by_category(shop["order_items"], twice)
    assert dict(values(average))["kitchen"] == 20


@pytest.mark.parametrize(
    ("revenue", "inventory", "status", "zero_first_status"),
    [
        (25_000.0, 101, "In stock", "In stock"),
        (25_000.01, 101, "To be ordered", "To be ordered"),
        (25_000.01, 100, "In stock", "In stock"),
        (0.0, 50, "In stock", "In stock"),
        (0.0, 49, "To be ordered", "To be ordered"),
        (0.0, 0, "To be ordered", "Out of stock"),
        (99_999.0, None, "In stock", "In stock"),
        (None, 10, "To be ordered", "To be ordered"),
    ],
)
def test_stock_status(spark, revenue, inventory, status, zero_first_status):
    row = spark.range(1).select(
        F.lit(revenue).cast("double").alias("r"), F.lit(inventory).cast("int").alias("i")
    )
    r, i = F.col("r"), F.col("i")
    assert row.select(stock_status(r, i)).first()[0] == status
    assert row.select(stock_status(r, i, zero_first=True)).first()[0] == zero_first_status


def test_inventory_status_and_shares(shop, values):
    found = op.inventory_status(**pick(shop, *ITEMS), revenue_above=9)
    assert sorted(values(found, "product_id", "inventory_status")) == [
        (1, "To be ordered"),
        (2, "To be ordered"),
        (3, "To be ordered"),
        (4, "In stock"),
    ]
    assert values(op.inventory_status_shares(found)) == [
        ("In stock", 1, 25.0),
        ("To be ordered", 3, 75.0),
        ("Out of stock", 0, 0.0),
    ]
    nothing = op.inventory_status_shares(found.where("false"))
    assert values(nothing, "percentage") == [0.0, 0.0, 0.0]


def test_lifetime_value_uses_item_price(shop, values):
    found = op.customer_lifetime_value(
        **pick(shop, "order_items", "orders", "customers")
    )
    assert sorted(values(found)) == [
        (100, "Ada Low", Decimal("215.50")),
        (101, "Bob", Decimal("36.00")),
        (102, "Cey", Decimal("62.00")),
    ]
    assert values(op.premium_customers(found, top_n=2), "customer_id") == [100, 102]


def test_yearly_revenue(shop, values):
    found = op.by_year(op.yearly_revenue(shop["orders"], shop["order_items"]))
    assert values(found) == [
        (None, None),
        (2022, Decimal("11.50")),
        (2023, Decimal("98.00")),
        (2024, Decimal("204.00")),
    ]


def test_reports_of_a_summary_by_day_equal_those_of_the_orders(shop, spark, values):
    extra = [(15, 9, date(2023, 5, 5)), (16, 9, date(2023, 5, 6)), (None, 9, date(2020, 1, 1))]
    orders = shop["orders"].union(spark.createDataFrame(extra, shop["orders"].schema))
    items = shop["order_items"]
    days = op.sales_by_day(orders, items)
    revenue = op.yearly_revenue(orders, items)
    assert sorted(values(op.yearly_revenue_of(days)), key=str) == sorted(values(revenue), key=str)
    for grain in ("year", "month", "day"):
        expected = values(op.max_orders_per_year(orders, grain=grain))
        assert sorted(values(op.max_orders_of(days, grain)), key=str) == sorted(expected, key=str)
    with pytest.raises(ValueError, match="grain"):
        op.max_orders_of(days, "week")


def test_summaries_of_disjoint_orders_add_up(shop, values):
    orders, items = shop["orders"], shop["order_items"]
    parts = [orders.where("order_id <= 12"), orders.where("order_id > 12")]
    for summary in (op.sales_by_day, op.product_sales_by_day):
        merged = op.merge_days(*[summary(part, items) for part in parts])
        whole = summary(orders, items)
        assert merged.columns == whole.columns
        assert sorted(values(merged), key=str) == sorted(values(whole), key=str)


def test_calendar_rollup_tells_missing_dates_from_wider_periods(shop, values):
    days = op.sales_by_day(shop["orders"], shop["order_items"])
    rolled = op.calendar_rollup(days).drop("revenue", "sold_orders")
    undated = values(rolled.where("year IS NULL"), "grain", "month", "day", "orders")
    assert sorted(undated) == [(g, None, None, 1) for g in ("day", "month", "year")]
    found = values(rolled.where("year = 2023"))
    assert set(found) == {
        ("year", 2023, None, None, 3),
        ("month", 2023, 1, None, 1),
        ("month", 2023, 5, None, 1),
        ("month", 2023, 12, None, 1),
        ("day", 2023, 1, 1, 1),
        ("day", 2023, 5, 5, 1),
        ("day", 2023, 12, 31, 1),
    }
    assert op.calendar_rollup(days.where("false")).count() == 0
    assert values(op.calendar_rollup(days, ["month"]).select("grain").distinct()) == ["month"]
    for wrong in ([], ["week"]):
        with pytest.raises(ValueError, match="grains"):
            op.calendar_rollup(days, wrong)


def test_rows_are_multiplied_by_grains_only_after_they_are_summed_by_day(shop):
    days = op.sales_by_day(shop["orders"], shop["order_items"])
    plan = op.calendar_rollup(days)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1
    # Plans are written from the result down to the scans.
    assert "hashpartitioning(_day" in plan[plan.index("Expand") :]


def test_max_orders(spark, values):
    days = [date(2023, 1, 1), date(2023, 1, 1), date(2023, 1, 9), date(2023, 2, 1)]
    orders = spark.createDataFrame(
        [(i, d) for i, d in enumerate(days)], "order_id int, order_date date"
    )
    for grain, expected in {"year": 4, "month": 3, "day": 2}.items():
        assert values(op.max_orders_per_year(orders, grain=grain)) == [(2023, expected)]
    with pytest.raises(ValueError, match="grain"):
        op.max_orders_per_year(orders, grain="week")


def test_rating_categories(spark, values):
    ratings = [0, 1, 2, 3, 4, 5, 6, -1, None]
    df = spark.createDataFrame([(r,) for r in ratings], "r bigint")
    assert values(df.select(rating_category(F.col("r")))) == [
        "very poor",
        "poor",
        "average",
        "satisfactory",
        "highly-satisfied",
        "excellent",
        "unknown",
        "unknown",
        "unknown",
    ]


def test_reviews_are_averaged_before_the_join(shop, spark, values):
    reviews = spark.createDataFrame(
        [(1, 5), (1, 4), (2, 5), (3, 5), (3, None), (4, None), (99, 5)],
        "product_id bigint, rating int",
    )
    found = op.categorize_reviews(reviews, shop["products"])
    assert sorted(values(found)) == [
        (1, "pen", 4, "highly-satisfied"),
        (2, "pen", 5, "excellent"),
        (3, "mug", 5, "excellent"),
        (4, "lamp", None, "unknown"),
    ]
    top = op.top_rated_products(found, top_n=3)
    assert values(top, "product_id") == [3, 2, 1]


def test_yearly_trends_fill_gaps_with_zero(shop, values):
    tables = pick(shop, "orders", "order_items", "products")
    found = op.yearly_product_trends(**tables, top_n=2)
    assert sorted(values(found)) == [
        ("mug", 2022, 0),
        ("mug", 2023, 9),
        ("mug", 2024, 1),
        ("pen", 2022, 9),
        ("pen", 2023, 1),
        ("pen", 2024, 0),
    ]
    one = op.yearly_product_trends(**tables, top_n=1)
    assert sorted(values(one, "year")) == [2023, 2024]


def test_monthly_trends_have_twelve_rows_per_product(shop, values):
    tables = pick(shop, "orders", "order_items", "products")
    found = op.monthly_product_trends(**tables, year=2023, top_n=2)
    assert found.count() == 24
    sold = sorted(values(found.where("total_quantity > 0")))
    assert sold == [(3, "mug", 1, 9), (4, "lamp", 12, 2)]


def test_text_quantities_skip_sentinels(shop, values):
    text = F.when(F.col("order_item_id") == 3, "Not Available").otherwise(
        F.col("quantity").cast("string")
    )
    items = shop["order_items"].withColumn("quantity", text)
    top = op.top_selling_products(items, shop["products"])
    assert values(top) == [("pen", 10.0), ("lamp", 2.0), ("mug", 1.0)]


def test_top_n_breaks_ties_by_the_other_columns(spark, values):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", None)], "name string, n int")
    assert values(op.top_n(df, "n", 2), "name") == ["a", "b"]
    assert values(op.top_n(df, "n", 3), "name") == ["a", "b", "c"]


def test_missing_columns_raise(shop):
    items = shop["order_items"].drop("quantity")
    with pytest.raises(ValueError, match=r"missing columns \['quantity'\]"):
        op.top_selling_products(items, shop["products"])
    with pytest.raises(ValueError, match="missing columns"):
        op.yearly_revenue(shop["orders"], items)
