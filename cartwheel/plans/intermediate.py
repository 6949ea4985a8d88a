"""Intermediate models (INT1, INT2)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwheel.functions import count_if
from cartwheel.plans.context import model


INT1 = "int_order_items_enriched"
#: Items with their order's columns, a table that a job over many models may store once (``items_with_orders``).
JOINED_ITEMS = "items_with_orders"
KEPT_COLS = ["order_id", "user_id", "product_id", "sale_price"]
ITEM_COLS = ["order_item_id", *KEPT_COLS]
#: Whether an item has an id: what counts of items read instead of the ids.
HAS_ID = "has_order_item_id"
#: One row for each order and product of the stored join.
FIRST_PAIR = "first_of_order_and_product"
ORDER_COLS = {"order_status", "order_created_at", "order_shipped_at", "order_delivered_at",
              "order_returned_at", "order_date"}
PRODUCT_COLS = {"distribution_center_id", "cost", "item_profit", "product_name", "brand", "category",
                "department", "product_retail_price"}
USER_COLS = {"user_country", "user_city", "user_traffic_source", "user_signup_at"}
INT1_COLUMNS = [
    "order_item_id", "order_id", "user_id", "product_id", "distribution_center_id",
    "order_status", "order_created_at", "order_shipped_at", "order_delivered_at", "order_returned_at",
    "order_date", "sale_price", "cost", "item_profit", "product_name", "brand", "category", "department",
    "product_retail_price", "user_country", "user_city", "user_traffic_source", "user_signup_at"]


def _with_orders_and_users(items, orders, users):
    """Both left joins, without an exchange of the items by user.

    An item nearly always has the user of its order, so the users join the orders, which are fewer and
    narrower, and come along by order id.  Items with another user than their order, or with no order, join
    the users on their own id; both branches read the same exchange of the items.
    """
    same = F.col("user_id").eqNullSafe(F.col("_o_user"))
    owned = orders.join(users, orders["_o_user"] == users["_u_id"], "left")
    of_order = items.join(owned, items["order_id"] == owned["_o_id"], "left").where(same)
    other = items.join(orders, items["order_id"] == orders["_o_id"], "left").where(~same)
    return of_order.unionByName(other.join(users, other["user_id"] == users["_u_id"], "left"))


def _orders_for_items(ctx):
    return ctx.ref("stg_orders").select(
        F.col("order_id").alias("_o_id"), F.col("user_id").alias("_o_user"), F.col("status").alias("order_status"),
        F.col("created_at").alias("order_created_at"), F.col("shipped_at").alias("order_shipped_at"),
        F.col("delivered_at").alias("order_delivered_at"), F.col("returned_at").alias("order_returned_at"))


def items_with_orders(ctx):
    """The items left joined with their orders, to be stored under ``JOINED_ITEMS`` and read instead of joining again.

    An item whose order id is stored several times has a row for each; ``_first`` marks one of them, so the
    marked rows are the staged items.  The items' ids, long texts, are not stored, only whether there is one.
    ``FIRST_PAIR`` marks one row for each order and product: the rows of an order meet here for the join anyway.
    """
    nth = F.row_number().over(Window.partitionBy("_o_id").orderBy("order_created_at"))
    orders = _orders_for_items(ctx).drop("_o_user").where(F.col("_o_id").isNotNull()).withColumn("_nth", nth)
    items = item_rows(ctx, False)
    j = items.join(orders, items["order_id"] == orders["_o_id"], "left")
    pair = F.row_number().over(Window.partitionBy("order_id", "product_id").orderBy("_nth"))
    return j.select(*items.columns, "order_status", "order_created_at", "order_shipped_at", "order_delivered_at",
                    "order_returned_at", (F.coalesce(F.col("_nth"), F.lit(1)) == 1).alias("_first"), (pair == 1).alias(FIRST_PAIR))


def order_products(ctx):
    """The distinct (order_id, product_id) of the items that have an order id."""
    if JOINED_ITEMS in ctx.materialized:
        pairs = ctx.ref(JOINED_ITEMS).where(FIRST_PAIR).select("order_id", "product_id")
    else:
        pairs = enriched_items(ctx, "order_id", "product_id").distinct()
    return pairs.where(F.col("order_id").isNotNull())


def item_rows(ctx, ids: bool):
    """The staged items with ``HAS_ID``; without their ids they come from the stored join where there is one."""
    if not ids and JOINED_ITEMS in ctx.materialized:
        return ctx.ref(JOINED_ITEMS).where("_first").select(*KEPT_COLS, HAS_ID)
    return ctx.ref("stg_order_items").select(*(ITEM_COLS if ids else KEPT_COLS), F.col("order_item_id").isNotNull().alias(HAS_ID))


def _enrich(ctx, with_orders: bool, with_products: bool, with_users: bool, ids: bool = True):
    stored = with_orders and not ids and JOINED_ITEMS in ctx.materialized
    j = ctx.ref(JOINED_ITEMS) if stored else item_rows(ctx, ids)
    cols = [*(ITEM_COLS if ids else KEPT_COLS), HAS_ID, *([FIRST_PAIR] if stored else [])]
    if with_orders:
        o = None if stored else _orders_for_items(ctx)
        cols += ["order_status", "order_created_at", "order_shipped_at", "order_delivered_at", "order_returned_at",
                 F.to_date("order_created_at").alias("order_date")]
    if with_users:
        u = ctx.ref("stg_users").select(
            F.col("user_id").alias("_u_id"), F.col("country").alias("user_country"),
            F.col("city").alias("user_city"), F.col("traffic_source").alias("user_traffic_source"),
            F.col("created_at").alias("user_signup_at"))
        cols += ["user_country", "user_city", "user_traffic_source", "user_signup_at"]
    if with_orders and with_users and not stored:
        j = _with_orders_and_users(j, o, u)
    elif with_orders and not stored:
        j = j.join(o, j["order_id"] == o["_o_id"], "left")
    elif with_users:
        j = j.join(u, j["user_id"] == u["_u_id"], "left")
    if with_products:
        p = ctx.ref("stg_products").select(
            F.col("product_id").alias("_p_id"), "distribution_center_id", "cost", "product_name", "brand",
            "category", "department", F.col("retail_price").alias("product_retail_price"))
        j = j.join(p, j["product_id"] == p["_p_id"], "left")
        cols += ["distribution_center_id", "cost", (F.col("sale_price") - F.col("cost")).alias("item_profit"),
                 "product_name", "brand", "category", "department", "product_retail_price"]
    return j.select(*cols)


@model(INT1, "intermediate")
def int_order_items_enriched(ctx):
    """One row per order item with order status/timestamps, product and user context.

    Three LEFT equi-joins on declared unique keys (order, product, user), so
    the item grain is kept.  Joins on keys that can be hot get the planner's
    exchanges, which adaptive execution splits.
    """
    return _enrich(ctx, True, True, True).select(*INT1_COLUMNS)


def enriched_items(ctx, *columns: str):
    """Columns of ``int_order_items_enriched`` without joins nobody reads.

    When the build job has written the model, its table is read (column-pruned
    scan).  Otherwise only the joins the requested columns need are planned:
    the left joins are on declared unique keys, so dropping an unused one
    leaves the rows unchanged, and Spark itself keeps unused outer joins.
    """
    if INT1 in ctx.materialized:
        has_id = F.col("order_item_id").isNotNull().alias(HAS_ID)
        return ctx.ref(INT1).select(*[has_id if c == HAS_ID else c for c in columns])
    need = set(columns)
    return _enrich(ctx, bool(need & ORDER_COLS), bool(need & PRODUCT_COLS), bool(need & USER_COLS),
                   "order_item_id" in need).select(*columns)


@model("int_user_order_summary", "intermediate")
def int_user_order_summary(ctx):
    """Per-user totals; all aggregates combine map-side, so a hot user costs one row per task."""
    items = enriched_items(ctx, "user_id", "order_id", "sale_price", "item_profit", "order_created_at",
                           "order_status")
    return items.groupBy("user_id").agg(
        F.countDistinct("order_id").alias("total_orders"),
        F.sum("sale_price").alias("total_revenue"),
        F.sum("item_profit").alias("total_profit"),
        F.count(F.lit(1)).alias("total_items"),
        F.min("order_created_at").alias("first_order_at"),
        F.max("order_created_at").alias("last_order_at"),
        count_if(F.col("order_status") == "Returned").alias("total_returns"))
