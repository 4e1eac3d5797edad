"""Customer lifetime value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import named, require_columns
from .ranking import top_n as best_rows
from .sales import order_revenue


def customer_lifetime_value(
    order_items: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    order_id_col: str = "order_id",
    customer_id_col: str = "customer_id",
    price_col: str = "price",
    quantity_col: str = "quantity",
    first_name_col: str = "first_name",
    last_name_col: str = "last_name",
) -> DataFrame:
    """Revenue at item price per customer with orders: id, full name, ``CLV``."""
    require_columns(orders, [order_id_col, customer_id_col])
    require_columns(customers, [customer_id_col, first_name_col, last_name_col])
    per_order = order_revenue(order_items, order_id_col, price_col, quantity_col)
    links = orders.select(named(order_id_col), named(customer_id_col))
    per_customer = (
        per_order.join(links, order_id_col)
        .groupBy(named(customer_id_col))
        .agg(F.sum("order_revenue").alias("CLV"))
    )
    full_name = F.concat_ws(" ", named(first_name_col), named(last_name_col))
    names = customers.select(named(customer_id_col), full_name.alias("customer_name"))
    return per_customer.join(names, customer_id_col).select(
        named(customer_id_col), "customer_name", "CLV"
    )


def premium_customers(
    lifetime_values: DataFrame,
    customer_name_col: str = "customer_name",
    clv_col: str = "CLV",
    top_n: int = 10,
) -> DataFrame:
    """The customers with the largest lifetime value."""
    ties = [c for c in lifetime_values.columns if c not in (clv_col, customer_name_col)]
    return best_rows(lifetime_values, clv_col, top_n, [customer_name_col, *ties])
