"""Table-level operators: DataFrame in, DataFrame out."""

from .calendar import (
    calendar_rollup,
    max_orders_of,
    merge_days,
    product_sales_by_day,
    sales_by_day,
    yearly_revenue_of,
)
from .cleaning import (
    calculate_total_null_count,
    clean_phone_numbers,
    convert_column_type,
    drop_nulls,
    handle_negative_values,
    impute_missing_values,
    impute_nulls,
    remove_decimal,
    remove_duplicates,
    remove_string_from_columns,
    split_nulls,
    standardize_date_format,
    total_null_count,
    validate_emails,
)
from .customers import customer_lifetime_value, premium_customers
from .enrich import add_age_column, add_state_columns
from .inventory import inventory_status, inventory_status_shares
from .modes import exact_modes
from .quality import (
    duplicate_count,
    profile_changes,
    profile_summary,
    profile_table,
    profile_tables,
)
from .quantiles import exact_median
from .ranking import top_n, top_n_per_group
from .reviews import categorize_reviews, top_rated_products
from .sales import (
    average_revenue_by_category,
    by_year,
    frequent_products,
    frequent_products_by_age_group,
    frequent_products_by_year,
    max_orders_per_year,
    order_revenue,
    top_products_by_age_group,
    top_revenue_products,
    top_revenue_shares,
    top_selling_products,
    total_revenue_by_product,
    yearly_revenue,
)
from .trends import monthly_product_trends, yearly_product_trends
from .upsert import upsert_by_key

__all__ = [name for name in dir() if not name.startswith("_")]
