"""One summary of sales per day that all reports by calendar period are sums of.

The orders and their items are read once; a row per day (and product, where wanted) is
all that the reports read afterwards. Summaries of different orders add up, so those of
new orders are merged in without reading the old ones again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import named, numeric, require_columns
from ..functions.dates import as_date
from .sales import order_revenue

# Fixed value: calendar periods, from the widest.
GRAINS = ("year", "month", "day")


def sales_by_day(
    orders: DataFrame,
    order_items: DataFrame,
    order_id_col: str = "order_id",
    order_date_col: str = "order_date",
    price_col: str = "price",
    quantity_col: str = "quantity",
) -> DataFrame:
    """``day, orders, sold_orders, revenue`` of every day with an order.

    ``sold_orders`` counts those that have items; ``revenue`` is at item price, null where
    there are none. Orders without a date are the day null. Items are summed per order
    before the join, which needs no further shuffle of them.
    """
    require_columns(orders, [order_id_col, order_date_col])
    dated = orders.select(named(order_id_col), as_date(orders, order_date_col).alias("_day"))
    per_order = order_revenue(order_items, order_id_col, price_col, quantity_col)
    per_order = per_order.withColumn("_sold", F.lit(1))
    return (
        dated.join(per_order, order_id_col, "left")
        .groupBy(F.col("_day").alias("day"))
        .agg(
            F.count(named(order_id_col)).alias("orders"),
            F.count("_sold").alias("sold_orders"),
            F.sum("order_revenue").alias("revenue"),
        )
    )


def product_sales_by_day(
    orders: DataFrame,
    order_items: DataFrame,
    order_id_col: str = "order_id",
    order_date_col: str = "order_date",
    product_id_col: str = "product_id",
    quantity_col: str = "quantity",
) -> DataFrame:
    """``product_id, day, quantity`` of every product and day with an item sold."""
    require_columns(orders, [order_id_col, order_date_col])
    require_columns(order_items, [order_id_col, product_id_col, quantity_col])
    dated = orders.select(named(order_id_col), as_date(orders, order_date_col).alias("_day"))
    items = order_items.select(
        named(order_id_col),
        named(product_id_col).alias("_product"),
        numeric(order_items, quantity_col).alias("_quantity"),
    )
    return (
        items.join(dated, order_id_col)
        .groupBy(F.col("_product").alias("product_id"), F.col("_day").alias("day"))
        .agg(F.sum("_quantity").alias("quantity"))
    )


def merge_days(*summaries: DataFrame) -> DataFrame:
    """One summary of the same form from those of disjoint sets of orders."""
    first, *others = summaries
    keys = [c for c in first.columns if c in ("product_id", "day")]
    together = first
    for other in others:
        together = together.unionByName(other)
    sums = [F.sum(c).alias(c) for c in first.columns if c not in keys]
    return together.groupBy(*keys).agg(*sums)


def calendar_rollup(days: DataFrame, grains: Sequence[str] = GRAINS) -> DataFrame:
    """``grain, year, month, day`` and the sums of each period, all grains in one pass.

    Parts of a date finer than the grain are null, ``grain`` tells such rows from those
    without a date. Other columns that name no number (``product_id``) stay keys.
    """
    unknown = [g for g in grains if g not in GRAINS]
    if unknown or not grains:
        raise ValueError(f"grains must be some of {GRAINS}, not {tuple(grains)!r}")
    require_columns(days, ["day"])
    by = [c for c in days.columns if c == "product_id"]
    parts = [_part(g).alias(f"_{g}") for g in GRAINS]
    sums = [c for c in days.columns if c not in (*by, "day")]
    dated = days.select(*[named(c) for c in by], *[named(c) for c in sums], *parts)
    keys = [F.col(f"_{g}") for g in GRAINS]
    # A set for each grain: the parts of the date down to it.
    sets = [[*map(named, by), *keys[: GRAINS.index(g) + 1]] for g in GRAINS if g in grains]
    finer = {g: F.grouping(F.col(f"_{g}")) for g in GRAINS}
    grain = (
        F.when(finer["day"] == 0, "day").when(finer["month"] == 0, "month").otherwise("year")
    )
    rolled = dated.groupingSets(sets, *map(named, by), *keys).agg(
        grain.alias("grain"), *[F.sum(named(c)).alias(c) for c in sums]
    )
    return rolled.select(
        "grain",
        *by,
        *[F.col(f"_{g}").alias(g) for g in GRAINS],
        *[named(c) for c in sums],
    )


def _part(grain: str) -> Column:
    return {"year": F.year("day"), "month": F.month("day"), "day": F.day("day")}[grain]


def yearly_revenue_of(days: DataFrame) -> DataFrame:
    """``yearly_revenue`` from a summary by day."""
    sold = days.where(F.col("sold_orders") > 0)
    year = F.year("day").alias("year")
    return sold.groupBy(year).agg(F.sum("revenue").alias("total_revenue"))


def max_orders_of(days: DataFrame, grain: str = "year") -> DataFrame:
    """``max_orders_per_year`` of any grain from a summary by day."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}, not {grain!r}")
    period = F.trunc("day", grain) if grain != "day" else F.col("day")
    year = F.year("day").alias("year")
    per_period = days.groupBy(year, period.alias("_period")).agg(F.sum("orders").alias("_n"))
    return per_period.groupBy("year").agg(F.max("_n").alias("max_orders"))
