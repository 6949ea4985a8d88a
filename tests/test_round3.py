"""Round 3: memory of a task and shuffled bytes, on hand-made rows and plans."""

import contextlib
import datetime as dt
import io
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cartwheel.plans.intermediate import INT1_COLUMNS
from cartwheel.session import ADVISORY, INITIAL, PARTITIONS, TASK_MB, configure, size_mb
from test_traps import _item, _order, _product, _user, ctx_for

T = dt.datetime
LEAST = "spark.sql.adaptive.coalescePartitions.minPartitionSize"


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are at scale."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def plan_of(df) -> list[str]:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return [ln for ln in out.getvalue().splitlines() if ln.strip()]


def shop(spark, products=None):
    """Two orders of one product, one of another, one item without a known product, a cancelled order."""
    return ctx_for(
        spark, users=[_user(1), _user(2)],
        orders=[_order(10, 1, T(2021, 1, 1)), _order(11, 2, T(2021, 2, 1), "Returned"), _order(12, 2, T(2021, 2, 2), "Cancelled")],
        order_items=[_item("a", 10, 1, 100, "5.00"), _item("b", 10, 1, 100, "7.00"), _item("c", 11, 2, 100, "9.50"),
                     _item("d", 11, 2, 101, "3.25"), _item("e", 11, 2, 999, "1.00"), _item("f", 12, 2, 100, "8.00"),
                     _item("g", 10, 1, None, "2.00")],
        products=products or [_product(100), _product(101, cost=4)])


# totals by product

def test_shuffled_bytes_of_a_task_are_lowered_but_never_raised(spark):
    before = spark.conf.get(ADVISORY)
    assert [size_mb(x) for x in ("64MB", "16m", "67108864b", "1g", "16384k")] == [64, 16, 64, 1024, 16]
    try:
        spark.conf.set(ADVISORY, "64MB")
        assert size_mb(configure(spark).conf.get(ADVISORY)) == TASK_MB
        spark.conf.set(ADVISORY, "16k")
        assert configure(spark).conf.get(ADVISORY) == "16k"
    finally:
        spark.conf.set(ADVISORY, before)


@pytest.mark.parametrize("mart", ["fct_returns", "fct_product_performance"])
def test_items_are_summed_without_product_texts(spark, no_broadcast, mart):
    keyed = [ln for ln in plan_of(shop(spark).ref(mart)) if "Aggregate(keys=" in ln and "order_id" in ln.split("functions=")[0]]
    assert keyed and not any("product_name" in ln or "brand" in ln for ln in keyed)


def test_totals_by_product(spark):
    rows = {r.product_id: r for r in shop(spark).ref("fct_product_performance").collect()}
    assert set(rows) == {100, 101, 999, None}
    r = rows[100]
    assert (r.total_units_sold, float(r.total_revenue), float(r.total_profit), r.total_orders_containing) == (3, 21.5, 6.5, 2)
    assert (r.units_returned, float(r.revenue_lost_to_returns), r.product_name) == (1, 9.5, "p100")
    assert rows[999].product_name is None and rows[999].total_profit is None and float(rows[None].total_revenue) == 2.0


def test_a_product_stored_twice_counts_its_items_twice(spark):
    ctx = shop(spark, products=[_product(100), _product(100), _product(101), _product(101, cost=4)])
    twice = [r for r in ctx.ref("fct_product_performance").collect() if r.product_id == 100]
    assert [(r.total_units_sold, float(r.total_revenue), float(r.total_profit), r.total_orders_containing, r.avg_sale_price)
            for r in twice] == [(6, 43.0, 13.0, 2, 21.5 / 3)]
    apart = sorted(float(r.total_profit) for r in ctx.ref("fct_product_performance").collect() if r.product_id == 101)
    assert apart == [-1.75, -0.75]
    ctx.params["min_orders"] = 2
    assert [(r.product_id, r.total_orders, r.total_units_sold, float(r.return_rate)) for r in ctx.ref("fct_returns").collect()] == [(100, 3, 8, 2 / 3)]


# the cohort grid

def test_cohort_grid_keeps_its_number_of_partitions(spark):
    ctx = ctx_for(spark, users=[_user(1), _user(2)], orders=[_order(10, 1, T(2021, 1, 1))])
    lines = plan_of(ctx.ref("fct_customer_cohorts"))
    assert any("REPARTITION_BY_NUM" in ln for ln in lines) and not any("REPARTITION_BY_COL" in ln for ln in lines)


# the enriched items

def test_items_are_not_exchanged_by_user(spark, no_broadcast):
    from cartwheel.registry import all_queries
    lines = plan_of(all_queries()["int_order_items_enriched"](spark, "/root/testdata/sf0.001"))
    by_user = [i for i, ln in enumerate(lines) if re.search(r"Exchange hashpartitioning\(user_id#", ln)]
    # only items with another user than their order's
    assert by_user and all("Filter" in "".join(lines[i + 1:i + 3]) and "<=>" in "".join(lines[i + 1:i + 3]) for i in by_user)


def test_enriched_items_take_their_own_user(spark):
    other = (1, "F", "L", "e", 30, "F", "c2", "s", "Y", "p", 0.0, 0.0, "Email", T(2020, 5, 1))
    ctx = ctx_for(
        spark, users=[_user(1), other, _user(2, country="Z"), _user(None)], products=[_product(100)],
        orders=[_order(10, 1, T(2021, 1, 1)), _order(11, 2, T(2021, 1, 2)), _order(11, 1, T(2021, 1, 3)), _order(12, None, T(2021, 1, 4)),
                _order(None, 2, T(2021, 1, 5))],
        order_items=[_item("same", 10, 1, 100, "1.00"), _item("differs", 10, 2, 100, "1.00"), _item("twice", 11, 1, 100, "1.00"),
                     _item("nobody", 12, None, 100, "1.00"), _item("no order", 99, 2, 100, "1.00"), _item("null order", None, 1, 100, "1.00"),
                     _item("unknown user", 12, 7, 100, "1.00"), _item("order only", 10, None, 100, "1.00")])
    i, o, u = ctx.ref("stg_order_items"), ctx.ref("stg_orders"), ctx.ref("stg_users")
    plain = (i.join(o, i.order_id == o.order_id, "left").join(u, i.user_id == u.user_id, "left")
             .select(i.order_item_id, i.user_id, o.status, o.created_at, u.country, u.city))
    got = ctx.ref("int_order_items_enriched")
    assert got.columns == INT1_COLUMNS
    assert Counter(map(tuple, got.select("order_item_id", "user_id", "order_status", "order_created_at", "user_country", "user_city")
                       .collect())) == Counter(map(tuple, plain.collect()))


def test_an_exchange_begins_with_many_partitions_and_merges_by_size(spark):
    """However few shuffle partitions the session names, a task gets no more than its share of bytes."""
    old = {k: spark.conf.get(k, None) for k in (INITIAL, ADVISORY, LEAST)}
    try:
        spark.conf.unset(INITIAL)
        configure(spark)
        assert int(spark.conf.get(INITIAL)) == PARTITIONS > int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set(ADVISORY, "64k")
        spark.conf.set(LEAST, "64k")
        counted = spark.range(400_000).selectExpr("uuid() AS id").groupBy("id").count()
        tasks = counted.select(F.spark_partition_id().alias("p")).toPandas()["p"].nunique()
        assert tasks > 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set(INITIAL, "5000")
        configure(spark)
        assert spark.conf.get(INITIAL) == "5000"
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
