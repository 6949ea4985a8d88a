"""Revenue and metric marts (REV1-REV4, MET1)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwheel.functions import count_if, mean, month_start_date, month_start_ts, safe_divide
from cartwheel.plans.context import model
from cartwheel.plans.customers import cohort_months


@model("fct_daily_revenue", "revenue")
def fct_daily_revenue(ctx):
    o = ctx.ref("fct_orders")
    daily = o.groupBy(F.to_date("order_created_at").alias("order_date")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("item_count").alias("total_items"),
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("total_profit").alias("total_profit"),
        F.countDistinct("user_id").alias("unique_customers"),
        # a user has one first order, so counting them needs no second distinct
        count_if(F.col("is_first_order") & F.col("user_id").isNotNull()).alias("new_customers"),
        count_if(F.col("order_status") == "Returned").alias("orders_returned"),
        count_if(F.col("order_status") == "Cancelled").alias("orders_cancelled"))
    return daily.select(
        "*", (F.col("unique_customers") - F.col("new_customers")).alias("repeat_customers"),
        safe_divide("total_revenue", "total_orders").alias("avg_order_value"),
        safe_divide("orders_returned", "total_orders").alias("return_rate"))


@model("fct_monthly_revenue", "revenue")
def fct_monthly_revenue(ctx):
    """Daily -> monthly, then lag/running sum over months.

    The window has no partition key, but its input is one row per month
    (bounded by the calendar), so the single window task is small.
    """
    d = ctx.ref("fct_daily_revenue")
    monthly = d.groupBy(month_start_date("order_date").alias("order_month")).agg(
        F.sum("total_orders").alias("total_orders"), F.sum("total_revenue").alias("total_revenue"),
        F.sum("total_profit").alias("total_profit"), F.sum("new_customers").alias("new_customers"),
        F.countDistinct("order_date").alias("active_days"))
    w = Window.orderBy("order_month")
    out = monthly.select(
        "*", F.lag("total_revenue").over(w).alias("prev_month_revenue"),
        F.lag("total_revenue", 12).over(w).alias("prev_year_revenue"),
        F.sum("total_revenue").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cumulative_revenue_ytd"))
    return out.select(
        "*", safe_divide(F.col("total_revenue") - F.col("prev_month_revenue"), F.col("prev_month_revenue")).alias("mom_growth_pct"),
        safe_divide(F.col("total_revenue") - F.col("prev_year_revenue"), F.col("prev_year_revenue")).alias("yoy_growth_pct"))


@model("fct_geography_revenue", "revenue")
def fct_geography_revenue(ctx):
    o = ctx.ref("fct_orders")
    monthly = o.groupBy(F.col("user_country").alias("country"),
                        month_start_ts("order_created_at").alias("order_month")).agg(
        F.count(F.lit(1)).alias("total_orders"), F.sum("total_revenue").alias("total_revenue"),
        F.sum("total_profit").alias("total_profit"), F.countDistinct("user_id").alias("unique_customers"),
        mean("total_revenue").alias("avg_order_value"))
    w = Window.partitionBy("order_month").orderBy(F.col("total_revenue").desc_nulls_last())
    return monthly.select("*", F.rank().over(w).alias("country_rank"))


@model("daily_revenue", "metrics")
def daily_revenue(ctx):
    """Daily metrics without cancelled/returned orders.

    ``count(distinct order_id)`` per day is a plain count: an order has one
    date and order_id is a declared unique key of fct_orders, so no
    distinct-aggregation shuffle is needed.
    """
    o = ctx.ref("fct_orders").where(~F.col("order_status").isin("Cancelled", "Returned"))
    return o.groupBy("order_date").agg(
        F.count("order_id").alias("order_count"), F.sum("total_revenue").alias("total_revenue"),
        F.sum("item_count").alias("total_items_sold"), mean("total_revenue").alias("avg_order_value"))


@model("fct_cohort_revenue", "revenue")
def fct_cohort_revenue(ctx):
    agg = cohort_months(ctx).select(
        "signup_cohort", F.col("activity_month").alias("order_month"), "months_since_signup",
        F.col("users").alias("total_cohort_users"), F.col("active").alias("active_customers"),
        F.col("orders").alias("total_orders"), F.col("revenue").alias("total_revenue"),
        F.col("cumulative_revenue").alias("cumulative_revenue_total"))
    return agg.select(
        "*", safe_divide("active_customers", "total_cohort_users").alias("active_pct"),
        safe_divide("total_revenue", "active_customers").alias("avg_revenue_per_active_user"),
        safe_divide("cumulative_revenue_total", "total_cohort_users").alias("ltv_to_date"))
