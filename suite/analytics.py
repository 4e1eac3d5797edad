"""Business questions over the derived retail tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain import operators as op

from .registry import query
from .views import AS_OF, view

YEAR = 1997
NEAR_MEDIAN_REVENUE = 700_000

REVENUE = "CAST(i.price AS DECIMAL(12,2)) * CAST(i.quantity AS DECIMAL(10,0))"
CATALOGUE_REVENUE = "p.price * CAST(i.quantity AS DECIMAL(10,0))"

BAND = """CASE WHEN age < 20 THEN '<20' WHEN age < 30 THEN '20-29'
    WHEN age < 40 THEN '30-39' WHEN age < 50 THEN '40-49' ELSE '50+' END"""


def _items(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "shop_order_item")


def _products(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "shop_product")


def _orders(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "shop_orders")


def _customers(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "shop_customer")


@query(
    "a01_top_selling_products",
    """SELECT p.product_name, CAST(sum(i.quantity) AS BIGINT) AS total_quantity
    FROM shop_order_item i JOIN shop_product p ON i.product_id = p.product_id
    GROUP BY p.product_name ORDER BY total_quantity DESC, product_name LIMIT 10""",
)
def a01(spark, d):
    return op.top_selling_products(_items(spark, d), _products(spark, d))


@query(
    "a02_top_products_by_age_group",
    f"""WITH aged AS (SELECT customer_id, CAST(floor(date_diff('day', birth_date,
        DATE '{AS_OF}') / CAST(365.25 AS DOUBLE)) AS BIGINT) AS age
        FROM shop_customer),
    sold AS (SELECT {BAND} AS age_group, i.product_id,
        CAST(sum(i.quantity) AS BIGINT) AS total_quantity
        FROM aged c JOIN shop_orders o ON c.customer_id = o.customer_id
        JOIN shop_order_item i ON i.order_id = o.order_id GROUP BY ALL),
    ranked AS (SELECT *, CAST(rank() OVER (PARTITION BY age_group
        ORDER BY total_quantity DESC) AS INT) AS rank FROM sold)
    SELECT r.age_group, r.product_id, p.product_name, r.total_quantity, r.rank
    FROM ranked r JOIN shop_product p ON r.product_id = p.product_id
    WHERE r.rank <= 5""",
)
def a02(spark, d):
    aged = op.add_age_column(_customers(spark, d), "birth_date", as_of=AS_OF)
    return op.top_products_by_age_group(
        aged, _orders(spark, d), _items(spark, d), _products(spark, d)
    )


@query(
    "a03_top_revenue_products",
    f"""SELECT p.product_name, CAST(round(sum({CATALOGUE_REVENUE}), 2) AS DOUBLE)
        AS total_revenue
    FROM shop_order_item i JOIN shop_product p ON i.product_id = p.product_id
    GROUP BY p.product_name ORDER BY total_revenue DESC, product_name LIMIT 10""",
)
def a03(spark, d):
    return op.top_revenue_products(_items(spark, d), _products(spark, d))


@query(
    "a03b_top_revenue_shares",
    f"""WITH best AS (SELECT p.product_name,
        CAST(round(sum({CATALOGUE_REVENUE}), 2) AS DOUBLE) AS total_revenue
        FROM shop_order_item i JOIN shop_product p ON i.product_id = p.product_id
        GROUP BY p.product_name ORDER BY total_revenue DESC, product_name LIMIT 10)
    SELECT product_name, total_revenue, round(total_revenue * 100 /
        CAST((SELECT sum(CAST(total_revenue AS DECIMAL(38,2))) FROM best) AS DOUBLE),
        6) AS share_percent
    FROM best""",
)
def a03b(spark, d):
    shares = op.top_revenue_shares(_items(spark, d), _products(spark, d))
    return shares.selectExpr(
        "product_name", "total_revenue", "round(share_percent, 6) AS share_percent"
    )


@query(
    "a04_frequent_products",
    """SELECT p.product_name, count(i.product_id) AS order_count
    FROM shop_order_item i JOIN shop_product p ON i.product_id = p.product_id
    GROUP BY p.product_name ORDER BY order_count DESC, product_name LIMIT 10""",
)
def a04(spark, d):
    return op.frequent_products(_items(spark, d), _products(spark, d))


@query(
    "a05_frequent_products_by_year",
    f"""SELECT p.product_name, count(i.product_id) AS order_count
    FROM shop_order_item i JOIN shop_product p ON i.product_id = p.product_id
    JOIN shop_orders o ON i.order_id = o.order_id
    WHERE year(o.order_date) = {YEAR}
    GROUP BY p.product_name ORDER BY order_count DESC, product_name LIMIT 10""",
)
def a05(spark, d):
    return op.frequent_products_by_year(
        _items(spark, d), _products(spark, d), _orders(spark, d), YEAR
    )


@query(
    "a06_frequent_products_by_age_group",
    f"""WITH aged AS (SELECT customer_id, 2024 - year(birth_date) AS age
        FROM shop_customer),
    counted AS (SELECT {BAND} AS age_group, p.product_name,
        count(i.product_id) AS order_count
        FROM aged c JOIN shop_orders o ON c.customer_id = o.customer_id
        JOIN shop_order_item i ON i.order_id = o.order_id
        JOIN shop_product p ON p.product_id = i.product_id GROUP BY ALL),
    ranked AS (SELECT *, CAST(rank() OVER (PARTITION BY age_group
        ORDER BY order_count DESC) AS INT) AS rank FROM counted)
    SELECT * FROM ranked WHERE rank <= 5""",
)
def a06(spark, d):
    return op.frequent_products_by_age_group(
        _items(spark, d), _products(spark, d), _orders(spark, d), _customers(spark, d)
    )


AVERAGE_SQL = f"""SELECT p.category, CAST(floor(CAST(sum({REVENUE}) AS DOUBLE) /
        count({REVENUE})) AS BIGINT) AS average_revenue
    FROM shop_order_item i JOIN shop_product p ON i.product_id = p.product_id
    GROUP BY p.category"""


@query("a07_average_revenue_by_category", AVERAGE_SQL)
def a07(spark, d):
    return op.average_revenue_by_category(_items(spark, d), _products(spark, d))


@query(
    "a08_top_average_revenue",
    AVERAGE_SQL + " ORDER BY average_revenue DESC, category LIMIT 3",
)
def a08(spark, d):
    return op.top_n(a07(spark, d), "average_revenue", 3, ["category"])


PRODUCT_REVENUE_SQL = f"""SELECT p.product_id, p.product_name,
        sum({CATALOGUE_REVENUE}) AS total_revenue
    FROM shop_order_item i JOIN shop_product p ON i.product_id = p.product_id
    GROUP BY p.product_id, p.product_name"""


@query(
    "a09_total_revenue_by_product",
    f"""SELECT product_id, product_name, CAST(total_revenue AS DOUBLE) AS total_revenue
    FROM ({PRODUCT_REVENUE_SQL})""",
)
def a09(spark, d):
    return op.total_revenue_by_product(_items(spark, d), _products(spark, d))


def _status_sql(threshold: int, zero_first: bool = False) -> str:
    order_now = f"""WHEN r.total_revenue > {threshold} AND s.inventory > 100
        THEN 'To be ordered' WHEN s.inventory < 50 THEN 'To be ordered'"""
    empty = "WHEN s.inventory = 0 THEN 'Out of stock'"
    rules = f"{empty} {order_now}" if zero_first else f"{order_now} {empty}"
    return f"""SELECT s.product_id, s.product_name, s.inventory,
        CAST(r.total_revenue AS DOUBLE) AS total_revenue,
        CASE {rules} ELSE 'In stock' END AS inventory_status
    FROM ({PRODUCT_REVENUE_SQL}) r JOIN shop_product s ON r.product_id = s.product_id"""


@query("a10_inventory_status", _status_sql(25_000))
def a10(spark, d):
    return op.inventory_status(_items(spark, d), _products(spark, d))


@query("a10b_inventory_status_threshold", _status_sql(NEAR_MEDIAN_REVENUE))
def a10b(spark, d):
    return op.inventory_status(
        _items(spark, d), _products(spark, d), revenue_above=NEAR_MEDIAN_REVENUE
    )


@query("a10c_inventory_status_zero_first", _status_sql(NEAR_MEDIAN_REVENUE, True))
def a10c(spark, d):
    return op.inventory_status(
        _items(spark, d),
        _products(spark, d),
        revenue_above=NEAR_MEDIAN_REVENUE,
        zero_first=True,
    )


def _shares_sql(statuses: str) -> str:
    return f"""WITH statuses AS ({statuses}),
    names AS (SELECT unnest(['In stock', 'To be ordered', 'Out of stock'])
        AS inventory_status),
    counted AS (SELECT n.inventory_status, count(s.product_id) AS product_count
        FROM names n LEFT JOIN statuses s ON n.inventory_status = s.inventory_status
        GROUP BY n.inventory_status)
    SELECT inventory_status, product_count, round(CAST(product_count AS DOUBLE) * 100
        / (SELECT count(*) FROM statuses), 6) AS percentage
    FROM counted"""


@query("a11_inventory_status_shares", _shares_sql(_status_sql(NEAR_MEDIAN_REVENUE)))
def a11(spark, d):
    shares = op.inventory_status_shares(a10b(spark, d))
    return shares.selectExpr(
        "inventory_status", "product_count", "round(percentage, 6) AS percentage"
    )


LIFETIME_SQL = f"""SELECT c.customer_id,
        concat_ws(' ', c.first_name, c.last_name) AS customer_name,
        CAST(v.total AS DOUBLE) AS CLV
    FROM (SELECT o.customer_id, sum({REVENUE}) AS total
        FROM shop_order_item i JOIN shop_orders o ON i.order_id = o.order_id
        GROUP BY o.customer_id) v
    JOIN shop_customer c ON v.customer_id = c.customer_id"""


@query("a12_customer_lifetime_value", LIFETIME_SQL)
def a12(spark, d):
    return op.customer_lifetime_value(
        _items(spark, d), _orders(spark, d), _customers(spark, d)
    )


@query(
    "a13_premium_customers",
    LIFETIME_SQL + " ORDER BY CLV DESC, customer_name, c.customer_id LIMIT 10",
)
def a13(spark, d):
    return op.premium_customers(a12(spark, d))


YEARLY_SQL = f"""SELECT CAST(year(o.order_date) AS INT) AS year,
        CAST(sum({REVENUE}) AS DOUBLE) AS total_revenue
    FROM shop_order_item i JOIN shop_orders o ON i.order_id = o.order_id
    GROUP BY year(o.order_date)"""


@query("a14_yearly_revenue", YEARLY_SQL)
def a14(spark, d):
    return op.yearly_revenue(_orders(spark, d), _items(spark, d))


@query("a15_yearly_revenue_ordered", YEARLY_SQL + " ORDER BY 1")
def a15(spark, d):
    return op.by_year(a14(spark, d))


def _busiest_sql(grain: str) -> str:
    return f"""SELECT CAST(year(period) AS INT) AS year, max(n) AS max_orders
    FROM (SELECT date_trunc('{grain}', order_date) AS period, count(order_id) AS n
        FROM shop_orders GROUP BY 1) GROUP BY 1"""


@query("a16_max_orders_per_year", _busiest_sql("year"))
def a16(spark, d):
    return op.max_orders_per_year(_orders(spark, d))


@query("a16b_busiest_month_per_year", _busiest_sql("month"))
def a16b(spark, d):
    return op.max_orders_per_year(_orders(spark, d), grain="month")


@query("a16c_busiest_day_per_year", _busiest_sql("day"))
def a16c(spark, d):
    return op.max_orders_per_year(_orders(spark, d), grain="day")


@query("a17_max_orders_ordered", _busiest_sql("year") + " ORDER BY 1")
def a17(spark, d):
    return op.by_year(a16(spark, d))


@query(
    "a14b_calendar_rollup",
    f"""WITH sold AS (SELECT order_id, sum({REVENUE}) AS revenue FROM shop_order_item i
        GROUP BY order_id),
    dated AS (SELECT o.order_id, s.order_id AS sold_id, s.revenue,
        CAST(year(order_date) AS INT) AS year, CAST(month(order_date) AS INT) AS month,
        CAST(day(order_date) AS INT) AS day
        FROM shop_orders o LEFT JOIN sold s ON o.order_id = s.order_id)
    SELECT CASE WHEN grouping(day) = 0 THEN 'day' WHEN grouping(month) = 0 THEN 'month'
        ELSE 'year' END AS grain, year, month, day, count(order_id) AS orders,
        count(sold_id) AS sold_orders, CAST(sum(revenue) AS DOUBLE) AS revenue
    FROM dated GROUP BY GROUPING SETS ((year), (year, month), (year, month, day))""",
)
def a14b(spark, d):
    """All periods of the sales reports, from one summary by day."""
    return op.calendar_rollup(op.sales_by_day(_orders(spark, d), _items(spark, d)))


@query(
    "a20b_product_calendar",
    """WITH dated AS (SELECT i.product_id, i.quantity,
        CAST(year(order_date) AS INT) AS year, CAST(month(order_date) AS INT) AS month
        FROM shop_order_item i JOIN shop_orders o ON i.order_id = o.order_id)
    SELECT CASE WHEN grouping(month) = 0 THEN 'month' ELSE 'year' END AS grain, product_id,
        year, month, CAST(NULL AS INT) AS day, CAST(sum(quantity) AS BIGINT) AS quantity
    FROM dated GROUP BY GROUPING SETS ((product_id, year), (product_id, year, month))""",
)
def a20b(spark, d):
    """Quantities per product by year and month, from the summaries of two sets of orders."""
    orders = _orders(spark, d)
    early = F.coalesce(F.year("order_date") < YEAR, F.lit(True))
    summaries = [
        op.product_sales_by_day(part, _items(spark, d))
        for part in (orders.where(early), orders.where(~early))
    ]
    return op.calendar_rollup(op.merge_days(*summaries), ["year", "month"])


RATING_SQL = """SELECT r.product_id, p.product_name, r.average_rating,
        CASE r.average_rating WHEN 0 THEN 'very poor' WHEN 1 THEN 'poor'
        WHEN 2 THEN 'average' WHEN 3 THEN 'satisfactory' WHEN 4 THEN 'highly-satisfied'
        WHEN 5 THEN 'excellent' ELSE 'unknown' END AS rating_category
    FROM (SELECT product_id, CAST(floor(avg(rating)) AS BIGINT) AS average_rating
        FROM shop_review GROUP BY product_id) r
    JOIN shop_product p ON r.product_id = p.product_id"""


@query("a18_categorize_reviews", RATING_SQL)
def a18(spark, d):
    return op.categorize_reviews(view(spark, d, "shop_review"), _products(spark, d))


@query(
    "a19_top_rated_products",
    RATING_SQL + " ORDER BY average_rating DESC, p.product_name, r.product_id LIMIT 10",
)
def a19(spark, d):
    return op.top_rated_products(a18(spark, d))


@query(
    "a20_yearly_product_trends",
    """WITH yearly AS (SELECT CAST(year(o.order_date) AS INT) AS year, p.product_name,
        sum(i.quantity) AS quantity
        FROM shop_order_item i JOIN shop_orders o ON i.order_id = o.order_id
        JOIN shop_product p ON i.product_id = p.product_id GROUP BY ALL),
    best AS (SELECT product_name FROM yearly GROUP BY product_name
        ORDER BY sum(quantity) DESC, product_name LIMIT 5),
    shown AS (SELECT y.* FROM yearly y JOIN best b ON y.product_name = b.product_name),
    grid AS (SELECT b.product_name, y.year FROM best b,
        (SELECT DISTINCT year FROM shown) y)
    SELECT g.product_name, g.year,
        CAST(coalesce(s.quantity, 0) AS BIGINT) AS total_quantity_sold
    FROM grid g LEFT JOIN shown s
    ON g.product_name = s.product_name AND g.year = s.year""",
)
def a20(spark, d):
    return op.yearly_product_trends(
        _orders(spark, d), _items(spark, d), _products(spark, d), top_n=5
    )


@query(
    "a21_monthly_product_trends",
    f"""WITH monthly AS (SELECT i.product_id, p.product_name,
        CAST(month(o.order_date) AS INT) AS order_month, sum(i.quantity) AS quantity
        FROM shop_order_item i JOIN shop_orders o ON i.order_id = o.order_id
        JOIN shop_product p ON i.product_id = p.product_id
        WHERE year(o.order_date) = {YEAR} GROUP BY ALL),
    best AS (SELECT product_id, product_name FROM monthly
        GROUP BY product_id, product_name
        ORDER BY sum(quantity) DESC, product_name, product_id LIMIT 10),
    months AS (SELECT CAST(unnest(range(1, 13)) AS INT) AS order_month)
    SELECT b.product_id, b.product_name, g.order_month,
        CAST(coalesce(m.quantity, 0) AS BIGINT) AS total_quantity
    FROM best b CROSS JOIN months g LEFT JOIN monthly m
    ON b.product_id = m.product_id AND g.order_month = m.order_month""",
)
def a21(spark, d):
    return op.monthly_product_trends(
        _orders(spark, d), _items(spark, d), _products(spark, d), YEAR
    )
