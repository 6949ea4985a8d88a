"""Core marts: fct_orders and the dimensions (COR1-COR5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.functions import day_diff, quarter_end, safe_divide, us_week
from cartwheel.operators.calendar import SPINE_START, day_spine, spine_end
from cartwheel.operators.quantiles import ntile
from cartwheel.plans.context import model
from cartwheel.plans.intermediate import enriched_items


def first_order_flag(orders, user_col="user_id", ts_col="created_at", id_col="order_id"):
    """``row_number() over (partition by user order by ts, id) = 1`` without a per-user window.

    The earliest (ts, id) per user is a map-side-combinable ``min`` of a struct,
    so a user with a huge share of all orders costs one row per task; the flag
    is then a join on the unique order key.
    """
    firsts = orders.groupBy(user_col).agg(F.min(F.struct(ts_col, id_col)).alias("_f")).select(
        F.col(f"_f.{id_col}").alias("_first_id"))
    j = orders.join(firsts, orders[id_col] == firsts["_first_id"], "left")
    return j.withColumn("is_first_order", F.col("_first_id").isNotNull()).drop("_first_id")


ORDER_COLUMNS = ["order_id", "user_id", "user_country", "user_city", "order_status", "order_date", "order_created_at", "shipped_at",
                 "delivered_at", "returned_at", "item_count", "total_revenue", "total_profit", "line_item_count", "is_first_order"]


@model("fct_orders", "core")
def fct_orders(ctx):
    orders = ctx.ref("stg_orders")
    items = enriched_items(ctx, "order_id", "sale_price", "item_profit")
    users = ctx.ref("stg_users").select(F.col("user_id").alias("_u_id"), F.col("country").alias("user_country"),
                                        F.col("city").alias("user_city"))
    metrics = items.groupBy(F.col("order_id").alias("_m_id")).agg(
        F.sum("sale_price").alias("_rev"), F.sum("item_profit").alias("_profit"),
        F.count(F.lit(1)).alias("_lines"))
    o = first_order_flag(orders)
    j = (o.join(metrics, o["order_id"] == metrics["_m_id"], "left")
          .join(users, o["user_id"] == users["_u_id"], "left"))
    return j.select(
        "order_id", "user_id", "user_country", "user_city", F.col("status").alias("order_status"),
        F.to_date("created_at").alias("order_date"), F.col("created_at").alias("order_created_at"),
        "shipped_at", "delivered_at", "returned_at", "item_count",
        F.coalesce(F.col("_rev"), F.lit(0)).alias("total_revenue"),
        F.coalesce(F.col("_profit"), F.lit(0)).alias("total_profit"),
        F.coalesce(F.col("_lines"), F.lit(0)).alias("line_item_count"),
        "is_first_order")


# The reference's age bands (lower bound inclusive, upper inclusive).
AGE_BANDS = [("Under 18", None, 17), ("18-24", 18, 24), ("25-34", 25, 34), ("35-44", 35, 44),
             ("45-54", 45, 54), ("55-64", 55, 64)]
AGE_ELSE = "65+"


def age_group(age):
    out = F.when(age < 18, AGE_BANDS[0][0])
    for label, lo, hi in AGE_BANDS[1:]:
        out = out.when((age >= lo) & (age <= hi), label)
    return out.otherwise(AGE_ELSE)


@model("dim_users", "core")
def dim_users(ctx):
    u = ctx.ref("stg_users")
    signup = F.to_date("created_at")
    return u.select(
        "user_id", "email", "first_name", "last_name", "age", "gender", "city", "country",
        "latitude", "longitude", "traffic_source", "created_at",
        F.date_format(signup, "yyyy-MM").alias("signup_cohort"),
        day_diff(F.lit(ctx.as_of).cast("date"), signup).alias("tenure_days"),
        age_group(F.col("age")).alias("age_group"))


# Price tier labels by quartile, margin tier cut points.
PRICE_TIERS = {1: "Budget", 2: "Mid-Range", 3: "Premium"}
PRICE_TIER_ELSE = "Luxury"


@model("dim_products", "core")
def dim_products(ctx):
    p = ctx.ref("stg_products")
    calc = p.select(
        "product_id", "product_name", "brand", "category", "department", "cost", "retail_price", "sku",
        "distribution_center_id",
        (F.col("retail_price") - F.col("cost")).alias("margin_amount"),
        safe_divide(F.col("retail_price") - F.col("cost"), F.col("retail_price")).alias("margin_percentage"))
    calc = ntile(calc, 4, "retail_price", "price_quartile", key="product_id")
    mp = F.col("margin_percentage")
    margin_tier = (F.when(mp < 0.20, "Low").when((mp >= 0.20) & (mp < 0.40), "Medium").otherwise("High"))
    q = F.col("price_quartile")
    tier = None
    for k, label in PRICE_TIERS.items():
        tier = F.when(q == k, label) if tier is None else tier.when(q == k, label)
    return calc.select("*", margin_tier.alias("margin_tier"), tier.otherwise(PRICE_TIER_ELSE).alias("price_tier"))


@model("dim_date", "core")
def dim_date(ctx):
    d = F.col("date_day")
    dow = F.dayofweek(d)
    spine = day_spine(ctx.spark, ctx.param("spine_start", SPINE_START), spine_end(ctx))
    return spine.select(
        d.alias("date_key"), dow.cast("long").alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"), dow.isin(1, 7).alias("is_weekend"),
        us_week(d).alias("week_of_year"), F.month(d).cast("long").alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"), F.quarter(d).cast("long").alias("quarter"),
        F.year(d).cast("long").alias("year"),
        (d == F.trunc(d, "month")).alias("is_month_start"), (d == F.last_day(d)).alias("is_month_end"),
        (d == F.trunc(d, "quarter")).alias("is_quarter_start"), (d == quarter_end(d)).alias("is_quarter_end"))


@model("dim_distribution_centers", "core")
def dim_distribution_centers(ctx):
    return ctx.ref("stg_distribution_centers").select(
        "distribution_center_id", "distribution_center_name", "latitude", "longitude")
