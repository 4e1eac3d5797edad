"""Stock status of the products sold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import named, numeric, require_columns
from .sales import _sum_by as sum_by

# Status names and the default thresholds.
IN_STOCK = "In stock"
TO_BE_ORDERED = "To be ordered"
OUT_OF_STOCK = "Out of stock"
REVENUE_ABOVE = 25_000
INVENTORY_ABOVE = 100
INVENTORY_BELOW = 50


def stock_status(
    revenue: Column,
    inventory: Column,
    revenue_above: float = REVENUE_ABOVE,
    inventory_above: int = INVENTORY_ABOVE,
    inventory_below: int = INVENTORY_BELOW,
    zero_first: bool = False,
) -> Column:
    """Status of a product.

    Best sellers and low stocks are to be ordered. An empty stock is low too, so
    ``Out of stock`` shows only with ``zero_first=True``, which tests it first.
    An unknown inventory counts as in stock.
    """
    order_now = ((revenue > revenue_above) & (inventory > inventory_above)) | (
        inventory < inventory_below
    )
    empty = inventory == 0
    rules = [(order_now, TO_BE_ORDERED), (empty, OUT_OF_STOCK)]
    if zero_first:
        rules.reverse()
    (first, first_name), (second, second_name) = rules
    return F.when(first, first_name).when(second, second_name).otherwise(IN_STOCK)


def inventory_status(
    order_items: DataFrame,
    products: DataFrame,
    product_id_col: str = "product_id",
    product_name_col: str = "product_name",
    quantity_col: str = "quantity",
    price_col: str = "price",
    inventory_col: str = "inventory",
    revenue_above: float = REVENUE_ABOVE,
    inventory_above: int = INVENTORY_ABOVE,
    inventory_below: int = INVENTORY_BELOW,
    zero_first: bool = False,
) -> DataFrame:
    """Inventory, revenue and status of every product that was sold.

    Catalogue rows are joined once. An id with several names has the revenue of each
    name beside each of its rows.
    """
    require_columns(order_items, [product_id_col, quantity_col])
    require_columns(products, [product_id_col, product_name_col, price_col, inventory_col])
    quantity = numeric(order_items, quantity_col)
    sold = sum_by(order_items, [product_id_col], quantity, "quantity_sold")
    stock = products.select(
        named(product_id_col),
        named(product_name_col).alias("product_name"),
        numeric(products, inventory_col).alias("inventory"),
        numeric(products, price_col).alias("catalogue_price"),
    )
    per_row = F.col("catalogue_price") * F.col("quantity_sold")
    by_id = Window.partitionBy("product_id")
    joined = (
        sold.join(stock, product_id_col)
        .withColumnRenamed(product_id_col, "product_id")
        .withColumn("revenue", F.sum(per_row).over(Window.partitionBy("product_id", "product_name")))
        .withColumn("names", F.collect_set(F.struct("product_name", "revenue")).over(by_id))
        .select("product_id", "product_name", "inventory", F.explode("names.revenue").alias("total_revenue"))
    )
    status = stock_status(
        F.col("total_revenue"),
        F.col("inventory"),
        revenue_above,
        inventory_above,
        inventory_below,
        zero_first,
    )
    return joined.withColumn("inventory_status", status)


def inventory_status_shares(statuses: DataFrame) -> DataFrame:
    """Number and percentage of products in each of the three statuses.

    Counted in one pass; a status without products shows 0.
    """
    require_columns(statuses, ["inventory_status"])
    names = (IN_STOCK, TO_BE_ORDERED, OUT_OF_STOCK)
    counts = statuses.agg(
        *[
            F.count_if(F.col("inventory_status") == name).alias(f"n{i}")
            for i, name in enumerate(names)
        ]
    )
    total = F.col("n0") + F.col("n1") + F.col("n2")
    rows = [
        F.struct(
            F.lit(name).alias("inventory_status"),
            F.col(f"n{i}").alias("product_count"),
            F.coalesce(
                F.try_divide(F.col(f"n{i}").cast("double") * 100, total), F.lit(0.0)
            ).alias("percentage"),
        )
        for i, name in enumerate(names)
    ]
    return counts.select(F.inline(F.array(*rows)))
