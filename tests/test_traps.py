"""Semantic traps on tiny hand-made sources."""

import datetime as dt

from pyspark.sql import functions as F

from cartwheel.plans import load_models
from cartwheel.plans.context import ModelContext
from cartwheel.sources.schemas import SOURCES

T = dt.datetime


def _sources(spark, **tables):
    """Tiny sources: any table not given is empty."""
    def get(name):
        rows = tables.get(name, [])
        return spark.createDataFrame(rows, SOURCES[name])
    return get


def _user(uid, created=T(2020, 1, 15), age=30, country="X"):
    return (uid, "F", "L", "e", age, "F", "c", "s", country, "p", 0.0, 0.0, "Search", created)


def _order(oid, uid, created, status="Complete", n=1):
    return (oid, uid, status, created, None, None, None, n)


def _item(iid, oid, uid, pid, price, status="Complete"):
    from decimal import Decimal
    return (iid, oid, uid, pid, iid, status, Decimal(price), None, None, None, None)


def _product(pid, price="10.00", cost="5.000"):
    from decimal import Decimal
    return (pid, f"p{pid}", "b", "cat", "Men", "sku", Decimal(price), Decimal(cost), 1)


def ctx_for(spark, **tables):
    load_models()
    return ModelContext(spark, _sources(spark, **tables), as_of="2025-12-31")


def test_null_age_is_65_plus_and_orders_without_items_count(spark):
    ctx = ctx_for(spark, users=[_user(1, age=None), _user(2, age=17)],
                  orders=[_order(10, 1, T(2021, 1, 1)), _order(11, 2, T(2021, 1, 2))],
                  order_items=[_item("a", 11, 2, 100, "5.00")], products=[_product(100)])
    ages = {r.user_id: r.age_group for r in ctx.ref("dim_users").collect()}
    assert ages == {1: "65+", 2: "Under 18"}
    orders = {r.order_id: (float(r.total_revenue), r.line_item_count) for r in ctx.ref("fct_orders").collect()}
    assert orders == {10: (0.0, 0), 11: (5.0, 1)}


def test_first_order_tie_break_by_order_id(spark):
    same = T(2021, 3, 1, 12)
    ctx = ctx_for(spark, users=[_user(1)], orders=[_order(20, 1, same), _order(19, 1, same), _order(21, 1, T(2021, 1, 1))])
    flags = {r.order_id: r.is_first_order for r in ctx.ref("fct_orders").collect()}
    assert flags == {19: False, 20: False, 21: True}


def test_not_in_drops_null_status(spark):
    ctx = ctx_for(spark, users=[_user(1)], orders=[_order(1, 1, T(2021, 1, 1), status=None)])
    assert ctx.ref("daily_revenue").count() == 0
    assert ctx.ref("fct_daily_revenue").count() == 1


def test_same_day_attribution_keeps_fan_out(spark):
    ev = [(i, 7, "s1", i, "purchase" if i == 1 else "product", None, "B", "Email", None, None, None, None,
           T(2024, 1, 5, 9, i)) for i in range(1, 3)]
    ctx = ctx_for(spark, users=[_user(7)], events=ev,
                  orders=[_order(1, 7, T(2024, 1, 5, 10)), _order(2, 7, T(2024, 1, 5, 18))],
                  order_items=[_item("x", 1, 7, 100, "3.00"), _item("y", 2, 7, 100, "4.00")],
                  products=[_product(100)])
    r = ctx.ref("fct_traffic_source_performance").collect()[0]
    # one session joined to two same-day orders counts twice
    assert (r.total_sessions, r.unique_users, r.conversions, float(r.revenue)) == (2, 1, 2, 7.0)


def test_lag_12_is_rows_not_months(spark):
    orders = [_order(i, 1, T(2020 + (i // 12), i % 12 + 1, 1)) for i in range(14) if i != 5]
    ctx = ctx_for(spark, users=[_user(1)], orders=orders)
    m = ctx.ref("fct_monthly_revenue").orderBy("order_month").collect()
    # 13 months with one gap: the 13th row's lag-12 is the first row, 13 calendar months back
    assert m[12].prev_year_revenue is not None and m[12].order_month.year == 2021


def test_orders_before_signup_vanish_from_cohorts(spark):
    ctx = ctx_for(spark, users=[_user(1, created=T(2021, 6, 10))],
                  orders=[_order(1, 1, T(2021, 5, 1)), _order(2, 1, T(2021, 7, 1))])
    c = ctx.ref("fct_customer_cohorts")
    assert c.agg(F.sum("orders_in_month")).collect()[0][0] == 1
    assert c.agg(F.min("activity_month")).collect()[0][0] == dt.date(2021, 6, 1)
    assert c.agg(F.max("activity_month")).collect()[0][0] == dt.date(2025, 12, 1)


def test_rfm_first_match_order(spark):
    from cartwheel.plans.customers import rfm_segment
    df = spark.createDataFrame([(2, 4, 4), (1, 4, 1), (3, 1, 5), (5, 5, 5)], "r long, f long, m long")
    got = [x[0] for x in df.select(rfm_segment(F.col("r"), F.col("f"), F.col("m"))).collect()]
    assert got == ["Needs Attention", "Can't Lose", "Promising", "Champions"]


def test_dim_date_calendar(spark):
    d = ctx_for(spark).ref("dim_date")
    assert d.count() == 2922
    rows = {r.date_key: r for r in d.where(F.col("date_key").isin(
        dt.date(2019, 1, 1), dt.date(2024, 3, 31), dt.date(2026, 12, 31))).collect()}
    a, b, c = rows[dt.date(2019, 1, 1)], rows[dt.date(2024, 3, 31)], rows[dt.date(2026, 12, 31)]
    assert (a.day_of_week, a.day_name, a.week_of_year, a.is_quarter_start) == (3, "Tuesday", 0, True)
    assert (b.day_of_week, b.is_weekend, b.is_month_end, b.is_quarter_end, b.quarter) == (1, True, True, True, 1)
    assert (c.week_of_year, c.month_name, c.is_quarter_end) == (int(dt.date(2026, 12, 31).strftime("%U")), "December", True)


def test_null_margin_is_high_tier(spark):
    ctx = ctx_for(spark, products=[_product(1, price="0.00", cost="0.000"), _product(2, price="10.00", cost="9.000")])
    tiers = {r.product_id: (r.margin_percentage, r.margin_tier) for r in ctx.ref("dim_products").collect()}
    assert tiers[1] == (None, "High") and tiers[2][1] == "Low"


def test_zero_orders_status_is_loyal(spark):
    from cartwheel.plans.customers import customer_status
    df = spark.createDataFrame([(0,), (1,), (3,), (None,)], "n bigint")
    got = [r[0] for r in df.select(customer_status(F.col("n"))).collect()]
    assert got == ["Loyal", "New", "Repeat", "Loyal"]


def test_cumulative_revenue_does_not_reset_at_year_end(spark):
    orders = [_order(1, 1, T(2020, 12, 5)), _order(2, 1, T(2021, 1, 5))]
    items = [_item("a", 1, 1, 100, "2.00"), _item("b", 2, 1, 100, "3.00")]
    ctx = ctx_for(spark, users=[_user(1)], orders=orders, order_items=items, products=[_product(100)])
    m = ctx.ref("fct_monthly_revenue").orderBy("order_month").collect()
    assert [float(r.cumulative_revenue_ytd) for r in m] == [2.0, 5.0]
