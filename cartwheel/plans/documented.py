"""Metrics the reference documents without shipping code.

Each is a thin projection or aggregate over a built mart.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.functions import safe_divide


def repeat_customer_rate(ctx):
    """Repeat customers (more than one order) over customers with orders; one row."""
    c = ctx.ref("fct_customer_orders")
    g = c.agg(F.count(F.lit(1)).alias("customers"),
              F.count_if(F.col("total_orders") > 1).alias("repeat_customers"))
    return g.select("*", safe_divide("repeat_customers", "customers").alias("repeat_customer_rate"))


def cart_abandonment(ctx):
    """1 - purchase / cart per day and traffic source (NULL without carts)."""
    f = ctx.ref("fct_web_funnel")
    return f.select("event_date", "traffic_source", "sessions_with_cart", "sessions_with_purchase",
                    (F.lit(1.0) - safe_divide("sessions_with_purchase", "sessions_with_cart"))
                    .alias("cart_abandonment_rate"))


def on_time_delivery_rate(ctx):
    """Delivered within the 7-day SLA over delivered orders, per month."""
    s = ctx.ref("fct_fulfillment_summary")
    return s.select("order_month", "orders_delivered", "delivered_7_days",
                    F.col("pct_delivered_within_7_days").alias("on_time_delivery_rate"))


def cohort_churn(ctx):
    """Customers of a cohort not active in a period, and their share."""
    r = ctx.ref("fct_customer_retention")
    churned = F.col("cohort_size") - F.col("active_customers")
    return r.select("signup_cohort", "months_since_signup", "cohort_size", "active_customers",
                    churned.alias("churned_customers"), safe_divide(churned, F.col("cohort_size")).alias("churn_rate"))
