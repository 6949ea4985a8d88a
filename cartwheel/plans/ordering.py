"""Declared result orders, applied when a mart is read (a stored table has no order)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The order each model declares; a leading minus is descending.
RESULT_ORDER = {
    "daily_revenue": ["order_date"],
    "fct_brand_performance": ["-order_month", "-total_revenue"],
    "fct_browser_performance": ["-event_month", "-revenue"],
    "fct_category_performance": ["-order_month", "-total_revenue"],
    "fct_cohort_revenue": ["signup_cohort", "months_since_signup"],
    "fct_customer_retention": ["signup_cohort", "months_since_signup"],
    "fct_distribution_center_performance": ["-order_month", "-total_revenue"],
    "fct_fulfillment_summary": ["-order_month"],
    "fct_geography_revenue": ["-order_month", "-total_revenue"],
    "fct_monthly_revenue": ["-order_month"],
    "fct_order_status": ["-order_month", "-order_count"],
    "fct_product_affinity": ["-lift"],
    "fct_returns": ["-return_rate"],
    "fct_traffic_source_performance": ["-event_month", "-revenue"],
    "fct_web_funnel": ["-event_date", "-total_sessions"],
}


def sort_columns(name: str) -> list:
    """Sort Columns of a model: NULLs first ascending, last descending."""
    return [F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_first() for c in RESULT_ORDER[name]]


def in_declared_order(df: DataFrame, name: str) -> DataFrame:
    """``df``, the rows of a model, in the order the model declares (as it is, if it declares none)."""
    return df.orderBy(*sort_columns(name)) if name in RESULT_ORDER else df


def read_ordered(ctx, name: str) -> DataFrame:
    """The model in its declared order (as it is, if it declares none)."""
    return in_declared_order(ctx.ref(name), name)
