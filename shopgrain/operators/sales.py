"""Questions about products sold: quantities, order counts and revenue.

Order items are the one table that grows without bound, so they are summed per
product (or per order) before any join. Map tasks do most of that work, a hot
product costs one row per task, and the joins see one row per product.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bands import age_band
from ..functions.columns import named, numeric, require_columns
from ..functions.dates import as_date, year_range
from .ranking import top_n as best_rows
from .ranking import top_n_per_group

# Fixed value: the year ages are counted in by default.
AGE_YEAR = 2024


def _sum_by(df: DataFrame, keys: Sequence[str], value: Column, name: str) -> DataFrame:
    return df.groupBy(*[named(k) for k in keys]).agg(F.sum(value).alias(name))


def _regroup(df: DataFrame, keys: Sequence[str], total: str) -> DataFrame:
    """Add up partial totals that were computed on finer keys."""
    return _sum_by(df, keys, named(total), total)


def _columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return require_columns(df, names).select(*[named(n) for n in names])


def top_selling_products(
    order_items: DataFrame,
    products: DataFrame,
    product_id_col: str = "product_id",
    product_name_col: str = "product_name",
    quantity_col: str = "quantity",
    top_n: int = 10,
) -> DataFrame:
    """Product names with the largest total quantity sold."""
    require_columns(order_items, [product_id_col, quantity_col])
    quantity = numeric(order_items, quantity_col)
    per_id = _sum_by(order_items, [product_id_col], quantity, "total_quantity")
    labels = _columns(products, [product_id_col, product_name_col])
    per_name = _regroup(
        per_id.join(labels, product_id_col), [product_name_col], "total_quantity"
    )
    return best_rows(per_name, "total_quantity", top_n, [product_name_col])


def _order_bands(
    customers: DataFrame,
    orders: DataFrame,
    age: Column,
    customer_id_col: str,
    order_id_col: str,
) -> DataFrame:
    """(order id, age band of its customer)."""
    bands = customers.select(named(customer_id_col), age_band(age).alias("age_group"))
    links = _columns(orders, [customer_id_col, order_id_col])
    return links.join(bands, customer_id_col).select(named(order_id_col), "age_group")


def top_products_by_age_group(
    customers: DataFrame,
    orders: DataFrame,
    order_items: DataFrame,
    products: DataFrame,
    customer_id_col: str = "customer_id",
    product_id_col: str = "product_id",
    order_id_col: str = "order_id",
    quantity_col: str = "quantity",
    product_name_col: str = "product_name",
    age_col: str = "age",
    top_n: int = 5,
) -> DataFrame:
    """Products (by id) with the largest quantity in each age band, ties kept."""
    require_columns(customers, [customer_id_col, age_col])
    require_columns(order_items, [order_id_col, product_id_col, quantity_col])
    bands = _order_bands(
        customers, orders, numeric(customers, age_col), customer_id_col, order_id_col
    )
    items = order_items.select(
        named(order_id_col),
        named(product_id_col),
        numeric(order_items, quantity_col).alias("quantity_sold"),
    )
    sold = _sum_by(
        items.join(bands, order_id_col),
        ["age_group", product_id_col],
        F.col("quantity_sold"),
        "total_quantity",
    )
    best = top_n_per_group(sold, "age_group", "total_quantity", top_n)
    labels = _columns(products, [product_id_col, product_name_col])
    return best.join(labels, product_id_col).select(
        "age_group",
        named(product_id_col),
        named(product_name_col),
        "total_quantity",
        "rank",
    )


def frequent_products_by_age_group(
    order_items: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    order_id_col: str = "order_id",
    product_id_col: str = "product_id",
    product_name_col: str = "product_name",
    customer_id_col: str = "customer_id",
    birth_date_col: str = "birth_date",
    top_n: int = 5,
    as_of_year: int = AGE_YEAR,
) -> DataFrame:
    """Product names on the most order lines in each age band, ties kept."""
    require_columns(customers, [customer_id_col, birth_date_col])
    age = F.lit(as_of_year) - F.year(as_date(customers, birth_date_col))
    bands = _order_bands(customers, orders, age, customer_id_col, order_id_col)
    lines = _columns(order_items, [order_id_col, product_id_col])
    per_id = _sum_by(
        lines.join(bands, order_id_col),
        ["age_group", product_id_col],
        F.lit(1).cast("bigint"),
        "order_count",
    )
    labels = _columns(products, [product_id_col, product_name_col])
    per_name = _regroup(
        per_id.join(labels, product_id_col),
        ["age_group", product_name_col],
        "order_count",
    )
    return top_n_per_group(per_name, "age_group", "order_count", top_n)


def total_revenue_by_product(
    order_items: DataFrame,
    products: DataFrame,
    product_id_col: str = "product_id",
    quantity_col: str = "quantity",
    price_col: str = "price",
    product_name_col: str = "product_name",
) -> DataFrame:
    """Quantity sold times catalogue price, per product id and name."""
    require_columns(order_items, [product_id_col, quantity_col])
    require_columns(products, [product_id_col, product_name_col, price_col])
    quantity = numeric(order_items, quantity_col)
    per_id = _sum_by(order_items, [product_id_col], quantity, "quantity_sold")
    priced = products.select(
        named(product_id_col),
        named(product_name_col),
        numeric(products, price_col).alias("catalogue_price"),
    )
    return _sum_by(
        per_id.join(priced, product_id_col),
        [product_id_col, product_name_col],
        F.col("catalogue_price") * F.col("quantity_sold"),
        "total_revenue",
    )


def top_revenue_products(
    order_items: DataFrame,
    products: DataFrame,
    product_id_col: str = "product_id",
    quantity_col: str = "quantity",
    price_col: str = "price",
    product_name_col: str = "product_name",
    top_n: int = 10,
) -> DataFrame:
    """Product names with the largest revenue at catalogue price, to the cent."""
    per_id = total_revenue_by_product(
        order_items, products, product_id_col, quantity_col, price_col, product_name_col
    )
    per_name = _regroup(per_id, [product_name_col], "total_revenue")
    rounded = per_name.withColumn("total_revenue", F.round("total_revenue", 2))
    return best_rows(rounded, "total_revenue", top_n, [product_name_col])


def frequent_products(
    order_items: DataFrame,
    products: DataFrame,
    product_id_col: str = "product_id",
    product_name_col: str = "product_name",
    top_n: int = 10,
) -> DataFrame:
    """Product names on the most order lines."""
    require_columns(order_items, [product_id_col])
    per_id = order_items.groupBy(named(product_id_col)).agg(
        F.count(named(product_id_col)).alias("order_count")
    )
    labels = _columns(products, [product_id_col, product_name_col])
    per_name = _regroup(
        per_id.join(labels, product_id_col), [product_name_col], "order_count"
    )
    return best_rows(per_name, "order_count", top_n, [product_name_col])


def frequent_products_by_year(
    order_items: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    year: int,
    order_id_col: str = "order_id",
    product_id_col: str = "product_id",
    product_name_col: str = "product_name",
    order_date_col: str = "order_date",
    top_n: int = 10,
) -> DataFrame:
    """``frequent_products`` over the orders of one year."""
    require_columns(orders, [order_id_col, order_date_col])
    in_year = orders.where(year_range(orders, order_date_col, year))
    lines = _columns(order_items, [order_id_col, product_id_col])
    of_year = lines.join(in_year.select(named(order_id_col)), order_id_col)
    return frequent_products(
        of_year, products, product_id_col, product_name_col, top_n
    )


def average_revenue_by_category(
    order_items: DataFrame,
    products: DataFrame,
    product_id_col: str = "product_id",
    quantity_col: str = "quantity",
    price_col: str = "price",
    category_col: str = "category",
) -> DataFrame:
    """Mean revenue of an order line at item price per category, rounded down."""
    require_columns(order_items, [product_id_col, quantity_col, price_col])
    revenue = numeric(order_items, price_col) * numeric(order_items, quantity_col)
    per_id = order_items.groupBy(named(product_id_col)).agg(
        F.sum(revenue).alias("revenue"), F.count(revenue).alias("lines")
    )
    labels = _columns(products, [product_id_col, category_col])
    per_category = (
        per_id.join(labels, product_id_col)
        .groupBy(named(category_col))
        .agg(F.sum("revenue").alias("revenue"), F.sum("lines").alias("lines"))
    )
    mean = F.try_divide(F.col("revenue"), F.col("lines"))
    return per_category.select(
        named(category_col), F.floor(mean).cast("bigint").alias("average_revenue")
    )


def top_revenue_shares(
    order_items: DataFrame,
    products: DataFrame,
    product_id_col: str = "product_id",
    quantity_col: str = "quantity",
    price_col: str = "price",
    product_name_col: str = "product_name",
    top_n: int = 10,
) -> DataFrame:
    """``top_revenue_products`` with each row's percentage of their sum."""
    best = top_revenue_products(
        order_items,
        products,
        product_id_col,
        quantity_col,
        price_col,
        product_name_col,
        top_n,
    )
    # The window sees only the top rows.
    shown = F.sum("total_revenue").over(Window.partitionBy(F.lit(0)))
    percent = F.try_divide(
        F.col("total_revenue").cast("double") * 100, shown.cast("double")
    )
    return best.withColumn("share_percent", percent)


def yearly_revenue(
    orders: DataFrame,
    order_items: DataFrame,
    order_id_col: str = "order_id",
    order_date_col: str = "order_date",
    price_col: str = "price",
    quantity_col: str = "quantity",
    year_col: str = "year",
    total_revenue_col: str = "total_revenue",
) -> DataFrame:
    """Revenue at item price per calendar year of the order."""
    require_columns(orders, [order_id_col, order_date_col])
    dated = orders.select(
        named(order_id_col), F.year(as_date(orders, order_date_col)).alias(year_col)
    )
    per_order = order_revenue(order_items, order_id_col, price_col, quantity_col)
    return _sum_by(
        per_order.join(dated, order_id_col),
        [year_col],
        F.col("order_revenue"),
        total_revenue_col,
    )


def order_revenue(
    order_items: DataFrame,
    order_id_col: str = "order_id",
    price_col: str = "price",
    quantity_col: str = "quantity",
) -> DataFrame:
    """Item price times quantity summed per order.

    The sum leaves the rows partitioned by order id, which the join with the
    orders needs anyway: summing first adds no shuffle and shrinks hot orders.
    """
    require_columns(order_items, [order_id_col, price_col, quantity_col])
    revenue = numeric(order_items, price_col) * numeric(order_items, quantity_col)
    return _sum_by(order_items, [order_id_col], revenue, "order_revenue")


def max_orders_per_year(
    orders: DataFrame,
    order_date_col: str = "order_date",
    order_id_col: str = "order_id",
    year_col: str = "year",
    max_orders_col: str = "max_orders",
    grain: str = "year",
) -> DataFrame:
    """Largest number of orders in any ``grain`` (year, month or day) of each year.

    With ``year`` that is the number of orders of the year.
    """
    require_columns(orders, [order_date_col, order_id_col])
    if grain not in ("year", "month", "day"):
        raise ValueError(f"grain must be 'year', 'month' or 'day', not {grain!r}")
    day = as_date(orders, order_date_col)
    year = F.year(day).alias(year_col)
    n = F.count(named(order_id_col)).alias(max_orders_col)
    if grain == "year":
        return orders.groupBy(year).agg(n)
    period = F.trunc(day, "month") if grain == "month" else day
    per_period = orders.groupBy(year, period.alias("_period")).agg(n)
    return per_period.groupBy(named(year_col)).agg(
        F.max(named(max_orders_col)).alias(max_orders_col)
    )


def by_year(df: DataFrame, year_col: str = "year") -> DataFrame:
    """A yearly report in calendar order."""
    require_columns(df, [year_col])
    return df.orderBy(named(year_col))
