"""The sparse cohort form against the dense grid, over the fixtures and planted users."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from cartwheel.functions import outward
from cartwheel.operators.calendar import month_grid
from cartwheel.plans import load_models
from cartwheel.plans.context import ModelContext
from cartwheel.registry import context


def _planted(spark):
    """A user without orders, orders before the signup, after the as-of month and of unknown users, a signup before the spine."""
    load_models()
    at = dt.datetime
    users = spark.createDataFrame(
        [(1, "2020-03", at(2020, 3, 9)), (2, "2020-03", at(2020, 3, 31)), (3, "2018-11", at(2018, 11, 2)), (4, None, None),
         (5, "2026-02", at(2026, 2, 1)), (None, "2020-03", at(2020, 3, 1))],
        "user_id bigint, signup_cohort string, created_at timestamp_ntz")
    orders = [(1, at(2020, 2, 1)), (1, at(2020, 3, 10)), (1, at(2020, 3, 11)), (1, at(2021, 1, 5)), (3, at(2018, 12, 24)),
              (3, at(2019, 1, 1)), (3, at(2025, 12, 31)), (3, at(2026, 1, 1)), (4, at(2020, 5, 5)), (9, at(2020, 5, 5)),
              (None, at(2020, 4, 1)), (5, at(2026, 2, 3)), (1, None)]
    orders = spark.createDataFrame([(u, t, 2, "10.25" if u != 3 else None) for u, t in orders],
                                   "user_id bigint, order_created_at timestamp_ntz, item_count bigint, r string")
    ctx = ModelContext(spark, lambda name: None, as_of="2025-12-31")
    ctx.replace("dim_users", users)
    ctx.replace("fct_orders", orders.withColumn("total_revenue", F.col("r").cast("decimal(18,2)")))
    return ctx


@pytest.fixture(params=["fixtures", "planted"])
def ctx(spark, request):
    return context(spark, SF_SMALL) if request.param == "fixtures" else _planted(spark)


def _same(a, b):
    a, b = outward(a), outward(b).select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() > 0


def test_carried_intervals_give_the_grid(ctx):
    sparse = ctx.ref("fct_customer_active_months")
    carried = sparse.select("user_id", F.explode(month_grid(F.col("activity_month"), F.col("valid_to"))).alias("activity_month"),
                            "cumulative_orders", "cumulative_revenue")
    dense = ctx.ref("fct_customer_cohorts").where("cumulative_orders > 0")
    _same(carried, dense)
    _same(sparse.drop("valid_to"), ctx.ref("fct_customer_cohorts").where("is_active"))


def test_cohort_totals_equal_those_of_the_grid(ctx):
    grid = ctx.ref("fct_customer_cohorts").groupBy("signup_cohort", "activity_month", "months_since_signup").agg(
        F.countDistinct("user_id").alias("users"), F.countDistinct(F.when(F.col("is_active"), F.col("user_id"))).alias("active"),
        F.sum("orders_in_month").alias("orders"), F.sum("revenue_in_month").alias("revenue"), F.sum("cumulative_revenue").alias("total"))
    _same(ctx.ref("fct_cohort_revenue").select(
        "signup_cohort", F.col("order_month").alias("activity_month"), "months_since_signup", F.col("total_cohort_users").alias("users"),
        F.col("active_customers").alias("active"), F.col("total_orders").alias("orders"), F.col("total_revenue").alias("revenue"),
        F.col("cumulative_revenue_total").alias("total")), grid)
    _same(ctx.ref("fct_customer_retention").select(
        "signup_cohort", "months_since_signup", F.col("cohort_size").alias("users"), F.col("active_customers").alias("active"),
        F.col("total_revenue").alias("revenue")), grid.select("signup_cohort", "months_since_signup", "users", "active", "revenue"))


def test_cohort_totals_do_not_read_the_grid(spark):
    ctx = context(spark, SF_SMALL)
    ctx.ref("fct_customer_retention"), ctx.ref("fct_cohort_revenue")
    assert "fct_customer_cohorts" not in ctx._resolved
