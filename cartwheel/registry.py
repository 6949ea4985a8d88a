"""Registered queries: key -> callable(spark, sf_dir) -> DataFrame.

Model keys resolve one model over the fixture sources of ``sf_dir`` and apply
the presentation cast (decimal money -> double, small ints -> bigint).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartwheel import DEFAULT_AS_OF
from cartwheel.functions import outward
from cartwheel.plans import load_models
from cartwheel.plans.context import ModelContext
from cartwheel.session import configure
from cartwheel.sources import FixtureSources

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def context(spark: SparkSession, sf_dir: str, as_of: str = DEFAULT_AS_OF, **params) -> ModelContext:
    """A new model context over the fixture sources of ``sf_dir``.

    Models are shared inside one context (one query call or one build), never across calls:
    a later call reads the tables as they are then.
    """
    configure(spark)
    load_models()
    ctx = ModelContext(spark, FixtureSources(spark, sf_dir), as_of=as_of, params=params)
    ctx.sf_dir = sf_dir
    return ctx


def query(name: str):
    def register(fn: Callable[[ModelContext], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return outward(fn(context(spark, sf_dir)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return register


def model_query(name: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return outward(context(spark, sf_dir).ref(name))
    run.__name__ = name
    return run


MODEL_KEYS = [
    "stg_orders", "stg_order_items", "stg_users", "stg_products", "stg_events", "stg_inventory_items",
    "stg_distribution_centers",
    "int_order_items_enriched", "int_user_order_summary",
    "fct_orders", "dim_users", "dim_products", "dim_distribution_centers",
    "fct_customer_orders", "fct_rfm_scores", "fct_customer_cohorts", "fct_customer_active_months",
    "fct_customer_retention",
    "fct_product_performance", "fct_category_performance", "fct_brand_performance", "fct_product_affinity",
    "fct_daily_revenue", "fct_monthly_revenue", "fct_cohort_revenue", "fct_geography_revenue", "daily_revenue",
    "fct_order_status", "fct_fulfillment", "fct_fulfillment_summary", "fct_returns",
    "fct_distribution_center_performance",
    "fct_sessions", "fct_web_funnel", "fct_traffic_source_performance", "fct_browser_performance",
    "vw_orders", "vw_users", "vw_daily_revenue",
]


def all_queries() -> dict[str, QueryFn]:
    load_models()
    import cartwheel.queries  # noqa: F401  (registers the non-model keys)
    out = {k: model_query(k) for k in MODEL_KEYS}
    out.update(QUERIES)
    return out
