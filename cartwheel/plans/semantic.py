"""Public semantic views (SEM1-SEM3): no personal data, governed filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.plans.context import model


@model("vw_orders", "semantic")
def vw_orders(ctx):
    o = ctx.ref("fct_orders").where(~F.col("order_status").isin("Cancelled", "Returned"))
    return o.select("order_id", "order_date", "user_country", "order_status",
                    F.col("total_revenue").alias("revenue"), "item_count")


@model("vw_users", "semantic")
def vw_users(ctx):
    u = ctx.ref("dim_users")
    o = ctx.ref("fct_customer_orders").select(F.col("user_id").alias("_o_user"), "total_orders",
                                              "first_order_at", "total_revenue")
    j = u.join(o, u["user_id"] == o["_o_user"], "left")
    return j.select("user_id", "country", "city", "age", "gender",
                    F.coalesce(F.col("total_orders"), F.lit(0)).alias("total_orders"), "first_order_at",
                    F.coalesce(F.col("total_revenue"), F.lit(0)).alias("lifetime_revenue"))


@model("vw_daily_revenue", "semantic")
def vw_daily_revenue(ctx):
    return ctx.ref("daily_revenue").select("order_date", F.col("total_revenue").alias("daily_revenue"),
                                           "order_count", "avg_order_value")
