"""Average product ratings and their categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import named, numeric, require_columns
from .ranking import top_n as best_rows

# Names of the ratings 0 to 5 and of everything else.
RATING_NAMES = (
    "very poor",
    "poor",
    "average",
    "satisfactory",
    "highly-satisfied",
    "excellent",
)
UNKNOWN_RATING = "unknown"


def rating_category(rating: Column) -> Column:
    """Name of a whole-number rating."""
    known = rating.between(0, len(RATING_NAMES) - 1)
    names = F.array(*[F.lit(n) for n in RATING_NAMES])
    named_rating = F.get(names, rating.cast("int"))
    return F.when(known, named_rating).otherwise(UNKNOWN_RATING)


def categorize_reviews(
    reviews: DataFrame,
    products: DataFrame,
    rating_col: str = "rating",
    product_id_col: str = "product_id",
    product_name_col: str = "product_name",
) -> DataFrame:
    """Average rating (rounded down) and its category per reviewed product."""
    require_columns(reviews, [product_id_col, rating_col])
    require_columns(products, [product_id_col, product_name_col])
    average = F.floor(F.avg(numeric(reviews, rating_col)))
    rated = reviews.groupBy(named(product_id_col)).agg(
        average.cast("bigint").alias("average_rating")
    )
    labels = products.select(named(product_id_col), named(product_name_col))
    return rated.join(labels, product_id_col).select(
        named(product_id_col),
        named(product_name_col),
        "average_rating",
        rating_category(F.col("average_rating")).alias("rating_category"),
    )


def top_rated_products(
    categorized: DataFrame,
    product_id_col: str = "product_id",
    product_name_col: str = "product_name",
    average_rating_col: str = "average_rating",
    top_n: int = 10,
) -> DataFrame:
    """The best rated products; equal ratings in order of name, then id."""
    return best_rows(
        categorized, average_rating_col, top_n, [product_name_col, product_id_col]
    )
