"""Web analytics marts (WEB1-WEB4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.functions import count_if, mean, month_start_ts, safe_divide, ts_diff
from cartwheel.plans.context import model
from cartwheel.plans.staging import events

PAGE_VIEW_TYPES = ["product", "home", "department"]


@model("fct_sessions", "web")
def fct_sessions(ctx):
    """Session rollup; every aggregate combines map-side, so a huge session is cheap."""
    e = events(ctx, "session_id", "user_id", "created_at", "event_type", "browser", "traffic_source", "city", "state")
    t = F.col("event_type")
    agg = e.groupBy("session_id", "user_id").agg(
        F.min("created_at").alias("session_start_at"), F.max("created_at").alias("session_end_at"),
        F.count(F.lit(1)).alias("total_events"), count_if(t.isin(*PAGE_VIEW_TYPES)).alias("page_views"),
        F.max("browser").alias("browser"), F.max("traffic_source").alias("traffic_source"),
        F.max("city").alias("city"), F.max("state").alias("state"),
        (count_if(t == "cart") > 0).alias("has_cart"), (count_if(t == "purchase") > 0).alias("has_purchase"),
        (count_if(t == "cancel") > 0).alias("has_cancel"))
    return agg.select("*", ts_diff("SECOND", F.col("session_end_at"), F.col("session_start_at"))
                      .alias("session_duration_seconds"))


@model("fct_web_funnel", "web")
def fct_web_funnel(ctx):
    s = ctx.ref("fct_sessions")
    daily = s.groupBy(F.to_date("session_start_at").alias("event_date"), "traffic_source").agg(
        F.count(F.lit(1)).alias("total_sessions"), count_if(F.col("page_views") > 0).alias("sessions_with_product_view"),
        count_if("has_cart").alias("sessions_with_cart"), count_if("has_purchase").alias("sessions_with_purchase"),
        mean("session_duration_seconds").alias("avg_session_duration"))
    return daily.select(
        "*", safe_divide("sessions_with_product_view", "total_sessions").alias("product_view_rate"),
        safe_divide("sessions_with_cart", "total_sessions").alias("cart_rate"),
        safe_divide("sessions_with_purchase", "total_sessions").alias("purchase_rate"),
        safe_divide("sessions_with_purchase", "sessions_with_cart").alias("cart_to_purchase_rate"))


def sessions_with_same_day_orders(ctx):
    """Sessions LEFT JOIN orders on (user, same day), without materializing the fan-out.

    The reference joins every session to every same-day order of its user, so
    a session with n such orders counts n times.  Orders are first reduced to
    one row per (user, day) with their count and revenue; each session then
    carries a multiplicity ``_mult`` (n, or 1 when unmatched) and the revenue
    its expanded rows would sum to.  Aggregates weight by ``_mult``, which
    gives the reference's numbers exactly with one row per session.
    """
    s = ctx.ref("fct_sessions")
    od = ctx.ref("fct_orders").groupBy(
        F.col("user_id").alias("_o_user"), F.to_date("order_created_at").alias("_o_day")).agg(
        F.count(F.lit(1)).alias("_n_orders"), F.sum(F.coalesce(F.col("total_revenue"), F.lit(0))).alias("_rev"))
    j = s.join(od, (s["user_id"] == od["_o_user"]) & (F.to_date(s["session_start_at"]) == od["_o_day"]), "left")
    return j.select(
        "session_id", "user_id", "traffic_source", "browser", "session_start_at", "total_events", "has_purchase",
        F.coalesce(F.col("_n_orders"), F.lit(1)).alias("_mult"),
        F.coalesce(F.col("_rev"), F.lit(0)).alias("_revenue"))


def _weighted(pred):
    return F.sum(F.when(pred, F.col("_mult")).otherwise(F.lit(0)))


@model("fct_traffic_source_performance", "web")
def fct_traffic_source_performance(ctx):
    sr = sessions_with_same_day_orders(ctx)
    mult = F.col("_mult")
    monthly = sr.groupBy("traffic_source", month_start_ts("session_start_at").alias("event_month")).agg(
        F.sum(mult).alias("total_sessions"), F.countDistinct("session_id").alias("unique_users"),
        _weighted(F.col("has_purchase")).alias("conversions"), F.sum("_revenue").alias("revenue"),
        _weighted(F.col("total_events") == 1).alias("bounce_sessions"),
        F.try_divide(F.sum(F.col("total_events") * mult).cast("double"), F.sum(mult).cast("double"))
        .alias("avg_events_per_session"))
    return monthly.select(
        "*", safe_divide("conversions", "total_sessions").alias("conversion_rate"),
        safe_divide("revenue", "total_sessions").alias("revenue_per_session"),
        safe_divide("bounce_sessions", "total_sessions").alias("bounce_rate"))


@model("fct_browser_performance", "web")
def fct_browser_performance(ctx):
    sr = sessions_with_same_day_orders(ctx)
    monthly = sr.groupBy("browser", month_start_ts("session_start_at").alias("event_month")).agg(
        F.sum("_mult").alias("total_sessions"), _weighted(F.col("has_purchase")).alias("conversions"),
        F.sum("_revenue").alias("revenue"))
    return monthly.select(
        "*", safe_divide("conversions", "total_sessions").alias("conversion_rate"),
        safe_divide("revenue", "total_sessions").alias("revenue_per_session"))
