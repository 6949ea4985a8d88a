"""Schemas of the seven e-commerce sources the models read.

Money is held as exact decimals (sale price to the cent, product cost to the
tenth of a cent) so that every sum is order-independent; the marts cast to
double once at their edge.
"""

from pyspark.sql.types import (
    DecimalType, DoubleType, LongType, StringType, StructField,
    StructType, TimestampNTZType,
)

TS = TimestampNTZType()
MONEY = DecimalType(18, 2)
PRICE = DecimalType(10, 2)
COST = DecimalType(12, 3)


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


ORDERS = _s(
    ("order_id", LongType()), ("user_id", LongType()), ("status", StringType()),
    ("created_at", TS), ("shipped_at", TS), ("delivered_at", TS), ("returned_at", TS),
    ("num_of_item", LongType()),
)

ORDER_ITEMS = _s(
    ("id", StringType()), ("order_id", LongType()), ("user_id", LongType()),
    ("product_id", LongType()), ("inventory_item_id", StringType()), ("status", StringType()),
    ("sale_price", MONEY), ("created_at", TS), ("shipped_at", TS), ("delivered_at", TS),
    ("returned_at", TS),
)

USERS = _s(
    ("id", LongType()), ("first_name", StringType()), ("last_name", StringType()),
    ("email", StringType()), ("age", LongType()), ("gender", StringType()), ("city", StringType()),
    ("state", StringType()), ("country", StringType()), ("postal_code", StringType()),
    ("latitude", DoubleType()), ("longitude", DoubleType()), ("traffic_source", StringType()),
    ("created_at", TS),
)

PRODUCTS = _s(
    ("id", LongType()), ("name", StringType()), ("brand", StringType()), ("category", StringType()),
    ("department", StringType()), ("sku", StringType()), ("retail_price", PRICE), ("cost", COST),
    ("distribution_center_id", LongType()),
)

EVENTS = _s(
    ("id", LongType()), ("user_id", LongType()), ("session_id", StringType()),
    ("sequence_number", LongType()), ("event_type", StringType()), ("uri", StringType()),
    ("browser", StringType()), ("traffic_source", StringType()), ("city", StringType()),
    ("state", StringType()), ("postal_code", StringType()), ("ip_address", StringType()),
    ("created_at", TS),
)

INVENTORY_ITEMS = _s(
    ("id", StringType()), ("product_id", LongType()), ("cost", COST), ("sold_at", TS),
    ("created_at", TS), ("product_category", StringType()), ("product_name", StringType()),
    ("product_brand", StringType()), ("product_retail_price", PRICE),
    ("product_department", StringType()), ("product_sku", StringType()),
    ("product_distribution_center_id", LongType()),
)

DISTRIBUTION_CENTERS = _s(
    ("id", LongType()), ("name", StringType()), ("latitude", DoubleType()),
    ("longitude", DoubleType()),
)

SOURCES = {
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "users": USERS,
    "products": PRODUCTS,
    "events": EVENTS,
    "inventory_items": INVENTORY_ITEMS,
    "distribution_centers": DISTRIBUTION_CENTERS,
}

__all__ = ["SOURCES", "ORDERS", "ORDER_ITEMS", "USERS", "PRODUCTS", "EVENTS", "INVENTORY_ITEMS",
           "DISTRIBUTION_CENTERS"]
