"""Staging: one renamed projection per source (STG1-STG7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.plans.context import model


@model("stg_orders", "staging")
def stg_orders(ctx):
    s = ctx.source("orders")
    return s.select("order_id", "user_id", "status", "created_at", "shipped_at", "delivered_at",
                    "returned_at", F.col("num_of_item").alias("item_count"))


@model("stg_order_items", "staging")
def stg_order_items(ctx):
    s = ctx.source("order_items")
    return s.select(F.col("id").alias("order_item_id"), "order_id", "user_id", "product_id",
                    "inventory_item_id", "status", "sale_price", "created_at", "shipped_at",
                    "delivered_at", "returned_at")


@model("stg_users", "staging")
def stg_users(ctx):
    s = ctx.source("users")
    return s.select(F.col("id").alias("user_id"), "first_name", "last_name", "email", "age", "gender",
                    "city", "state", "country", "postal_code", "latitude", "longitude",
                    "traffic_source", "created_at")


@model("stg_products", "staging")
def stg_products(ctx):
    s = ctx.source("products")
    return s.select(F.col("id").alias("product_id"), F.col("name").alias("product_name"), "brand",
                    "category", "department", "sku", "retail_price", "cost", "distribution_center_id")


EVENT_COLUMNS = ["event_id", "user_id", "session_id", "sequence_number", "event_type", "uri", "browser",
                 "traffic_source", "city", "state", "postal_code", "ip_address", "created_at", "event_date"]


def events(ctx, *columns: str):
    """Columns of ``stg_events``; a source that derives the sequence number is asked for it only if it is read."""
    plain = getattr(ctx.sources, "unnumbered_events", None)
    s = plain() if plain and "sequence_number" not in columns else ctx.source("events")
    s = s.withColumnRenamed("id", "event_id").withColumn("event_date", F.to_date("created_at"))
    return s.where(F.col("event_id").isNotNull()).select(*columns)


@model("stg_events", "staging")
def stg_events(ctx):
    return events(ctx, *EVENT_COLUMNS)


@model("stg_inventory_items", "staging")
def stg_inventory_items(ctx):
    s = ctx.source("inventory_items")
    return s.select(F.col("id").alias("inventory_item_id"), "product_id", "cost", "sold_at", "created_at",
                    "product_category", "product_name", "product_brand", "product_retail_price",
                    "product_department", "product_sku", "product_distribution_center_id",
                    F.col("sold_at").isNotNull().alias("is_sold"))


@model("stg_distribution_centers", "staging")
def stg_distribution_centers(ctx):
    s = ctx.source("distribution_centers")
    return s.select(F.col("id").alias("distribution_center_id"),
                    F.col("name").alias("distribution_center_name"), "latitude", "longitude")
