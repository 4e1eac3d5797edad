"""Sales of the top products over time, with zeros where nothing was sold.

The calendar is built into the aggregation instead of being joined on: order
items are read once and no product list goes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import named, numeric, require_columns
from ..functions.dates import as_date, year_range
from .ranking import top_n as best_rows

MONTHS = range(1, 13)


def yearly_product_trends(
    orders: DataFrame,
    order_items: DataFrame,
    products: DataFrame,
    order_id_col: str = "order_id",
    order_date_col: str = "order_date",
    product_id_col: str = "product_id",
    quantity_col: str = "quantity",
    product_name_col: str = "product_name",
    top_n: int = 10,
) -> DataFrame:
    """Quantity per year of the product names sold most over all years.

    Every product gets every year in which any of them was sold. Orders without a
    date belong to no year and are left out.
    """
    require_columns(orders, [order_id_col, order_date_col])
    require_columns(order_items, [order_id_col, product_id_col, quantity_col])
    require_columns(products, [product_id_col, product_name_col])
    year = F.year(as_date(orders, order_date_col)).alias("year")
    dated = orders.select(named(order_id_col), year).where(F.col("year").isNotNull())
    items = order_items.select(
        named(order_id_col),
        named(product_id_col),
        numeric(order_items, quantity_col).alias("quantity_sold"),
    )
    per_id = (
        items.join(dated, order_id_col)
        .groupBy(named(product_id_col), "year")
        .agg(F.sum("quantity_sold").alias("quantity_sold"))
    )
    labels = products.select(named(product_id_col), named(product_name_col))
    per_year = (
        per_id.join(labels, product_id_col)
        .groupBy(named(product_name_col), "year")
        .agg(F.sum("quantity_sold").alias("quantity_sold"))
    )
    per_name = per_year.groupBy(named(product_name_col)).agg(
        F.sum("quantity_sold").alias("total_quantity_sold")
    )
    top = best_rows(per_name, "total_quantity_sold", top_n, [product_name_col])
    top = top.select(named(product_name_col).alias("_top"))
    # One row per top product; its map has one entry per calendar year.
    entry = F.struct("year", "quantity_sold")
    best = (
        per_year.join(top, named(product_name_col).eqNullSafe(F.col("_top")), "left_semi")
        .groupBy(named(product_name_col))
        .agg(F.map_from_entries(F.collect_list(entry)).alias("by_year"))
    )
    # This window sees only the top rows.
    seen = F.collect_list(F.map_keys("by_year")).over(Window.partitionBy(F.lit(0)))
    years = F.array_distinct(F.flatten(seen))
    grid = best.withColumn("years", years).select(
        named(product_name_col), "by_year", F.explode("years").alias("year")
    )
    sold = F.coalesce(F.try_element_at("by_year", F.col("year")), F.lit(0))
    return grid.select(
        named(product_name_col), "year", sold.alias("total_quantity_sold")
    )


def monthly_product_trends(
    orders: DataFrame,
    order_items: DataFrame,
    products: DataFrame,
    year: int,
    order_id_col: str = "order_id",
    order_date_col: str = "order_date",
    product_id_col: str = "product_id",
    quantity_col: str = "quantity",
    product_name_col: str = "product_name",
    top_n: int = 10,
) -> DataFrame:
    """Quantity in each of the twelve months of the products sold most in a year."""
    require_columns(orders, [order_id_col, order_date_col])
    require_columns(order_items, [order_id_col, product_id_col, quantity_col])
    require_columns(products, [product_id_col, product_name_col])
    month = F.month(as_date(orders, order_date_col)).alias("month")
    in_year = orders.where(year_range(orders, order_date_col, year)).select(
        named(order_id_col), month
    )
    items = order_items.select(
        named(order_id_col),
        named(product_id_col),
        numeric(order_items, quantity_col).alias("quantity_sold"),
    )
    quantity = F.col("quantity_sold")
    # One row per product with twelve sums, so no row per product and month.
    per_id = (
        items.join(in_year, order_id_col)
        .groupBy(named(product_id_col))
        .agg(
            *[
                F.coalesce(
                    F.sum(F.when(F.col("month") == m, quantity)), F.lit(0)
                ).alias(f"m{m}")
                for m in MONTHS
            ],
            F.sum(quantity).alias("total_sales"),
        )
    )
    labels = products.select(named(product_id_col), named(product_name_col))
    keys = [named(product_id_col), named(product_name_col)]
    sums = [*[f"m{m}" for m in MONTHS], "total_sales"]
    per_product = (
        per_id.join(labels, product_id_col)
        .groupBy(*keys)
        .agg(*[F.sum(s).alias(s) for s in sums])
    )
    ties = [product_name_col, product_id_col]
    best = best_rows(per_product, "total_sales", top_n, ties)
    months = F.array(
        *[
            F.struct(
                F.lit(m).alias("order_month"), F.col(f"m{m}").alias("total_quantity")
            )
            for m in MONTHS
        ]
    )
    return best.select(*keys, F.inline(months))
