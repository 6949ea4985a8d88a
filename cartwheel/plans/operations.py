"""Operations marts (OPS1-OPS5)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwheel.functions import count_if, mean, month_start_ts, safe_divide, ts_diff
from cartwheel.plans.context import model
from cartwheel.plans.intermediate import FIRST_PAIR, HAS_ID, JOINED_ITEMS, enriched_items
from cartwheel.plans.products import with_product


def _returned():
    return F.col("order_status") == "Returned"


@model("fct_order_status", "operations")
def fct_order_status(ctx):
    """Month x status counts with the month totals as a window over the aggregate.

    The reference joins a second month aggregate of the same input; a window
    sum over the (month, status) rows gives the same totals without a second
    scan, and its partitions hold only the few statuses of one month.
    """
    o = ctx.ref("fct_orders")
    s = o.groupBy(month_start_ts("order_created_at").alias("order_month"), "order_status").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("item_count").alias("item_count"),
        F.sum("total_revenue").alias("revenue")).where(F.col("order_month").isNotNull())
    m = Window.partitionBy("order_month")
    return s.select(
        "order_month", "order_status", "order_count", "item_count", "revenue",
        safe_divide(F.col("order_count"), F.sum("order_count").over(m)).alias("pct_of_month_orders"),
        safe_divide(F.col("revenue"), F.sum("revenue").over(m)).alias("pct_of_month_revenue"),
        safe_divide("revenue", "order_count").alias("avg_order_value"))


@model("fct_fulfillment", "operations")
def fct_fulfillment(ctx):
    """Order timing and SLA flags.

    The reference re-joins the staged orders to fct_orders on order_id for
    revenue; fct_orders already carries every staged column one row per order
    (order_id is unique, a declared check), so no join is needed.
    """
    o = ctx.ref("fct_orders")
    created, shipped, delivered = F.col("order_created_at"), F.col("shipped_at"), F.col("delivered_at")
    return o.select(
        "order_id", "user_id", F.col("order_status").alias("status"), created.alias("created_at"),
        "shipped_at", "delivered_at", "returned_at", "total_revenue", "item_count",
        ts_diff("HOUR", shipped, created).alias("processing_hours"),
        ts_diff("HOUR", delivered, shipped).alias("shipping_hours"),
        ts_diff("HOUR", delivered, created).alias("total_fulfillment_hours"),
        (ts_diff("DAY", shipped, created) == 0).alias("is_shipped_same_day"),
        (ts_diff("DAY", delivered, created) <= 3).alias("is_delivered_within_3_days"),
        (ts_diff("DAY", delivered, created) <= 7).alias("is_delivered_within_7_days"))


@model("fct_fulfillment_summary", "operations")
def fct_fulfillment_summary(ctx):
    f = ctx.ref("fct_fulfillment")
    agg = f.groupBy(month_start_ts("created_at").alias("order_month")).agg(
        F.count(F.lit(1)).alias("total_orders"), count_if(F.col("shipped_at").isNotNull()).alias("orders_shipped"),
        count_if(F.col("delivered_at").isNotNull()).alias("orders_delivered"),
        count_if(F.col("returned_at").isNotNull()).alias("orders_returned"),
        mean("processing_hours").alias("avg_processing_hours"), mean("shipping_hours").alias("avg_shipping_hours"),
        mean("total_fulfillment_hours").alias("avg_total_fulfillment_hours"),
        count_if("is_shipped_same_day").alias("same_day_ships"),
        count_if("is_delivered_within_3_days").alias("delivered_3_days"),
        count_if("is_delivered_within_7_days").alias("delivered_7_days"))
    return agg.select(
        "*", safe_divide("same_day_ships", "orders_shipped").alias("pct_shipped_same_day"),
        safe_divide("delivered_3_days", "orders_delivered").alias("pct_delivered_within_3_days"),
        safe_divide("delivered_7_days", "orders_delivered").alias("pct_delivered_within_7_days"),
        safe_divide("orders_returned", "orders_delivered").alias("return_rate"))


@model("fct_returns", "operations")
def fct_returns(ctx):
    """Summed by product id alone; the product's columns join the totals of the products that are kept."""
    min_orders = int(ctx.param("min_orders", 10))
    stored = JOINED_ITEMS in ctx.materialized  # with a mark that saves the exchange of a distinct count
    items = enriched_items(ctx, HAS_ID, "order_id", "product_id", "sale_price", "order_status", "order_returned_at",
                           "order_delivered_at", *([FIRST_PAIR] if stored else []))
    orders = count_if(F.col(FIRST_PAIR) & F.col("order_id").isNotNull()) if stored else F.countDistinct("order_id")
    days_to_return = F.when(_returned(), ts_diff("DAY", F.col("order_returned_at"), F.col("order_delivered_at")))
    agg = items.groupBy("product_id").agg(
        orders.alias("total_orders"), count_if(HAS_ID).alias("total_units_sold"),
        F.sum("sale_price").alias("total_revenue"), count_if(_returned()).alias("returned_orders"),
        count_if(_returned()).alias("returned_units"),
        F.sum(F.when(_returned(), F.col("sale_price")).otherwise(F.lit(0))).alias("revenue_lost_to_returns"),
        mean(days_to_return).alias("avg_days_to_return"))
    summed = ("total_units_sold", "total_revenue", "returned_orders", "returned_units", "revenue_lost_to_returns")
    agg = with_product(ctx, agg.where(F.col("total_orders") >= min_orders), {c: agg.schema[c].dataType for c in summed},
                       ["product_name", "brand", "category", "department"])
    return agg.select("*", safe_divide("returned_orders", "total_orders").alias("return_rate"))


@model("fct_distribution_center_performance", "operations")
def fct_distribution_center_performance(ctx):
    items = enriched_items(ctx, HAS_ID, "distribution_center_id", "order_created_at", "order_shipped_at",
                           "sale_price", "product_id", "order_status").where(~F.col("order_status").isin("Cancelled"))
    monthly = items.groupBy("distribution_center_id", month_start_ts("order_created_at").alias("order_month")).agg(
        count_if(HAS_ID).alias("items_shipped"), F.sum("sale_price").alias("total_revenue"),
        F.countDistinct("product_id").alias("unique_products"),
        mean(ts_diff("HOUR", F.col("order_shipped_at"), F.col("order_created_at"))).alias("avg_processing_hours"),
        count_if(_returned()).alias("items_returned"))
    # a handful of centres: the planner broadcasts it after its own size check
    dcs = ctx.ref("dim_distribution_centers").select(
        F.col("distribution_center_id").alias("_dc_id"), "distribution_center_name", "latitude", "longitude")
    j = monthly.join(dcs, monthly["distribution_center_id"] == dcs["_dc_id"], "inner").drop("_dc_id")
    return j.select("*", safe_divide("items_returned", "items_shipped").alias("return_rate"))
