"""Product marts (PRD1-PRD4)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from cartwheel.functions import count_if, day_diff, mean, month_start_ts, safe_divide
from cartwheel.operators.pairs import frequent_pairs, item_basket_counts
from cartwheel.plans.context import model
from cartwheel.plans.intermediate import HAS_ID, enriched_items, order_products
from cartwheel.sources.schemas import COST


def _returned():
    return F.col("order_status") == "Returned"


ITEM_PERF_COLS = ("order_id", "user_id", "product_id", "order_status", "order_created_at",
                  "sale_price", "item_profit", "product_name", "brand", "category", "department",
                  "product_retail_price", "cost")


def sold_items(ctx):
    """Order items outside cancelled orders (NULL status is dropped, as NOT IN does)."""
    return enriched_items(ctx, *ITEM_PERF_COLS).where(~F.col("order_status").isin("Cancelled"))


def with_product(ctx, per_product, columns: dict, groups: list[str]):
    """Totals by product with the product's ``groups``, as if the items had been joined first and grouped by all of it.

    The items meet no wide row and no string key: they are summed by product id alone.  A product that is
    stored several times multiplies the ``columns`` (name -> type) that add up, as the join of its items would.
    """
    p = ctx.ref("stg_products").withColumnRenamed("retail_price", "product_retail_price")
    p = p.groupBy(F.col("product_id").alias("_p_id"), *groups).agg(F.count(F.lit(1)).alias("_copies"))
    j = per_product.join(p, per_product["product_id"] == p["_p_id"], "left")
    copies = F.coalesce(F.col("_copies"), F.lit(1))
    summed = {name: (F.col(name) * copies).cast(kind).alias(name) for name, kind in columns.items()}
    return j.select("product_id", *groups, *[summed.get(c, F.col(c)) for c in per_product.columns if c != "product_id"])


@model("fct_product_performance", "products")
def fct_product_performance(ctx):
    items = enriched_items(ctx, HAS_ID, "order_id", "product_id", "order_status", "order_created_at",
                           "sale_price").where(~F.col("order_status").isin("Cancelled"))
    agg = items.groupBy("product_id").agg(
        count_if(HAS_ID).alias("total_units_sold"), F.sum("sale_price").alias("total_revenue"),
        F.count("sale_price").alias("_priced"), F.countDistinct("order_id").alias("total_orders_containing"),
        mean("sale_price").alias("avg_sale_price"), F.min("order_created_at").alias("first_sold_at"),
        F.max("order_created_at").alias("last_sold_at"), count_if(_returned()).alias("units_returned"),
        F.sum(F.when(_returned(), F.col("sale_price")).otherwise(F.lit(0))).alias("revenue_lost_to_returns"))
    revenue = agg.schema["total_revenue"].dataType
    profit = DecimalType(min(revenue.precision + 2, 38), COST.scale)  # of the sum of price less cost
    agg = with_product(ctx, agg.where(F.col("total_units_sold") > 0),
                       {"total_units_sold": "long", "total_revenue": revenue, "_priced": "long", "units_returned": "long",
                        "revenue_lost_to_returns": agg.schema["revenue_lost_to_returns"].dataType},
                       ["product_name", "brand", "category", "department", "product_retail_price", "cost"])
    agg = agg.withColumn("total_profit", (F.col("total_revenue") - F.col("cost") * F.col("_priced")).cast(profit))
    as_of = F.lit(ctx.as_of).cast("date")
    return agg.select(
        "product_id", "product_name", "brand", "category", "department", "product_retail_price", "cost",
        "total_units_sold", "total_revenue", "total_profit", "total_orders_containing", "avg_sale_price",
        "first_sold_at", "last_sold_at", "units_returned", "revenue_lost_to_returns",
        safe_divide("units_returned", "total_units_sold").alias("return_rate"),
        safe_divide("total_profit", "total_revenue").alias("profit_margin_pct"),
        day_diff(as_of, F.to_date("last_sold_at")).alias("days_since_last_sale"))


def _monthly_perf(ctx, keys, extra_distinct, rank_col):
    items = sold_items(ctx)
    aggs = [F.count(F.lit(1)).alias("total_units_sold"), F.sum("sale_price").alias("total_revenue"),
            F.sum("item_profit").alias("total_profit"), mean("sale_price").alias("avg_sale_price"),
            F.countDistinct("order_id").alias("order_count"), F.countDistinct("user_id").alias("unique_customers")]
    aggs += [F.countDistinct(c).alias(a) for c, a in extra_distinct]
    aggs.append(count_if(_returned()).alias("items_returned"))
    monthly = items.groupBy(*keys, month_start_ts("order_created_at").alias("order_month")).agg(*aggs)
    w = Window.partitionBy("order_month").orderBy(F.col("total_revenue").desc_nulls_last())
    return monthly.select("*", safe_divide("items_returned", "total_units_sold").alias("return_rate"),
                          F.rank().over(w).alias(rank_col))


@model("fct_category_performance", "products")
def fct_category_performance(ctx):
    return _monthly_perf(ctx, ["category", "department"], [], "category_rank_by_revenue")


@model("fct_brand_performance", "products")
def fct_brand_performance(ctx):
    return _monthly_perf(ctx, ["brand"], [("product_id", "distinct_products_sold")], "brand_rank_by_revenue")


@model("fct_product_affinity", "products")
def fct_product_affinity(ctx):
    """Market-basket pairs (a < b) sharing at least ``min_support_count`` orders."""
    min_count = int(ctx.param("min_support_count", 10))
    baskets = order_products(ctx)
    stats = item_basket_counts(baskets, "order_id", "product_id")
    total = baskets.select(F.countDistinct("order_id").alias("t")).scalar()
    pairs = frequent_pairs(baskets, "order_id", "product_id", min_count, item_counts=stats)
    # names only for the products of surviving pairs
    products = ctx.ref("stg_products")
    j = pairs
    for side in ("a", "b"):
        named = products.select(F.col("product_id").alias(f"_p{side}"), F.col("product_name").alias(f"product_name_{side}"),
                                F.col("category").alias(f"category_{side}"))
        count = stats.select(F.col("product_id").alias(f"_s{side}"), F.col("basket_count").alias(f"product_{side}_order_count"))
        j = j.join(count, F.col(f"item_{side}") == F.col(f"_s{side}")).join(named, F.col(f"item_{side}") == F.col(f"_p{side}"), "left")
    co, pa, pb, t = (F.col("co_occurrence_count"), F.col("product_a_order_count"),
                     F.col("product_b_order_count"), F.col("total_order_count"))
    j = j.select(F.col("item_a").alias("product_id_a"), "product_name_a", "category_a",
                 F.col("item_b").alias("product_id_b"), "product_name_b", "category_b",
                 F.col("co_count").alias("co_occurrence_count"), "product_a_order_count",
                 "product_b_order_count", total.alias("total_order_count"))
    return j.select(
        "*", safe_divide(co, t).alias("support"), safe_divide(co, pa).alias("confidence_a_to_b"),
        safe_divide(co, pb).alias("confidence_b_to_a"),
        F.try_divide(safe_divide(co, t), safe_divide(pa, t) * safe_divide(pb, t)).alias("lift"))
